import random
from collections import Counter

import pytest

from simpairs.llm import suffix_dedup as sd


def brute(texts, depth):
    windows = Counter(t[k:k + depth] for t in texts for k in range(len(t) - depth + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - depth + 1):
            if windows[t[k:k + depth]] > 1:
                gone[k:k + depth] = b"\1" * depth
        spans = [k for k in range(len(t)) if gone[k] and (not k or not gone[k - 1])]
        out.append((len(t), sum(gone), len(spans), bytes(c for c, g in zip(t, gone) if not g)))
    return out


def texts_of(rng, n):
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(10, 70))) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            if rng.random() < 0.4:
                k = rng.randrange(len(p))
                p = p[:k] + rng.choice("xyzü") + p[k + 1:]
            parts.append(p if rng.random() < 0.6 else "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(1, 60))))
        out.append("".join(parts))
    return out + ["ab" * 60, "a" * 90, "", "short", out[0], out[0]]


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, small, monkeypatch):
    rng = random.Random(5)
    texts = texts_of(rng, 90)
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)] + [(None, None, "y", 2)],
                                 "doc_id long, text string, kept string, block int")
    if small:  # many blocks, buckets and segments; anchors with several runs are marked
        monkeypatch.setattr(sd, "BLOCK_BYTES", 600)
        monkeypatch.setattr(sd, "BUCKET_BYTES", 512)
    got = {r.doc_id: r for r in sd.remove_repeats(docs, depth=24).collect()}
    want = brute([t.encode() for t in texts] + [b""], 24)
    assert len(got) == len(texts) + 1
    for k, (n, removed, spans, kept) in enumerate(want[:-1]):
        r = got[k]
        assert (r.n_bytes, sum(e - s for s, e in zip(r.starts, r.ends)), len(r.starts), bytes(r.kept)) == (n, removed, spans, kept), k
    assert got[None].n_bytes == 0 and bytes(got[None].kept) == b""


def test_segments_and_marks(monkeypatch):
    """One process, without Spark: pieces of long texts and crowded anchors give the same spans."""
    import pandas as pd
    monkeypatch.setattr(sd, "SEGMENT", 64)
    monkeypatch.setattr(sd, "MANY_RUNS", 2)
    rng = random.Random(8)
    texts = texts_of(rng, 60)
    blocks = [pd.DataFrame({"__id": range(k, len(texts), 3), "__text": [t.encode() for t in texts[k::3]], "__block": k}) for k in range(3)]
    asks = pd.concat([sd._ask_runs(24, 3)(b) for b in blocks])
    runs = pd.concat([sd._judge_runs(p) for _, p in asks.groupby("bucket")])
    asks = pd.concat([sd._ask_windows(24, 3)(b, runs[runs.block == k]) for k, b in enumerate(blocks)])
    told = pd.concat([runs, *(sd._judge_windows(p) for _, p in asks.groupby("bucket"))])
    want = brute([t.encode() for t in texts], 24)
    for k, b in enumerate(blocks):
        for r in sd._cover(24)(b, told[told.block == k]).itertuples():
            assert (r.n_bytes, bytes(r.kept)) == (want[r.id][0], want[r.id][3])


def test_query_on_the_small_table(spark):
    import hashlib

    from simpairs.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    want = {i: (n, gone, spans, hashlib.sha256(kept).hexdigest()) for i, (n, gone, spans, kept) in zip(rows, brute(list(rows.values()), 200))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op1_suffix_dedup"](spark, sf).collect()}
    assert got == want and sum(w[1] for w in want.values()) > 0


def test_empty_table(spark):
    assert sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert [bytes(r.kept) for r in sd.remove_repeats(spark.createDataFrame([(1, "é"), (1, None)], "doc_id long, text string")).orderBy("n_bytes").collect()] == [b"", "é".encode()]
