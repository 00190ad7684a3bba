import hashlib
import random
import re

import pytest

from simpairs.llm import fingerprints as fp


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(t, n):
    q = len(t) // 4
    return t[:len(t) - q] + n[:q]


@pytest.mark.parametrize("ranges", [1 << 25, 500])
def test_successors_edits_and_likeness(spark, monkeypatch, ranges):
    monkeypatch.setattr(fp, "RANGE_BYTES", ranges)
    monkeypatch.setattr(fp, "TOP_RANGES", 4)
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdeé😀") for _ in range(rng.randint(1, 6)))
    rows = [(10 * k + (k > 30) * 10**9, " ".join(word() for _ in range(rng.choice([0, 1, 3, 5, 40, 300])))) for k in range(60)]
    rows += [(3, rows[5][1]), (5, rows[5][1]), (7, None), (8, " \t\n"), (600, "a b  c\nd e f g")]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, fingerprint string, __x int")
    got = {r.doc_id: r for r in fp.compare(docs, sum(len((t or "").encode()) for _, t in rows)).collect()}
    order = sorted((i, t or "") for i, t in rows)
    assert len(got) == len(order)
    misses = []
    for k, (i, t) in enumerate(order):
        n = order[(k + 1) % len(order)][1]
        r = got[i]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited(t, n).encode()).hexdigest()
        misses += [abs(r.near_edited - jaccard(t, edited(t, n))), abs(r.near_next - jaccard(t, n))]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert sum(misses) / len(misses) < 0.02 and max(misses) < 0.2
    assert got[3].fingerprint == got[5].fingerprint == got[50].fingerprint and got[3].near_next == 1.0
    assert got[7].fingerprint == got[8].fingerprint == "" and got[7].near_next == 1.0


def test_edges(spark):
    one = fp.compare(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string"), 8).collect()[0]
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and one.near_next == 1.0
    nulls = fp.compare(spark.createDataFrame([(None, "b c"), (None, "a"), (1, "z"), (1, "z")], "doc_id long, text string"), 8).collect()
    assert len(nulls) == 4 and sum(r.doc_id is None for r in nulls) == 2
    assert fp.compare(spark.createDataFrame([], "doc_id long, text string"), 0).count() == 0
    out = fp.fingerprint(spark.createDataFrame([("a b", 1)], "text string, fp int"), name="print")
    assert out.columns == ["text", "fp", "print"] and len(out.first()["print"]) == fp.BINS * fp.BITS // 4


def test_native_plan(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d")], "doc_id long, text string")
    plan = fp.compare(docs, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_short_texts_are_not_biased(spark):
    """The mean likeness of many pairs is their similarity, for each number of shingles."""
    rng = random.Random(9)
    rows, true = [], []
    for n in [*range(2, 21, 2), 3, 5, 7]:
        for _ in range(40):
            w = [f"w{rng.randrange(10**9)}" for _ in range(n + 5)]
            a, b = " ".join(w[:n + 4]), " ".join(w)  # n shingles, and one more
            rows.append((n, a, b))
            true.append(jaccard(a, b))
    d = spark.createDataFrame(rows, "n int, a string, b string").repartition(8)
    from pyspark.sql import functions as F
    got = d.select("n", fp.likeness(fp.bins_of(F.col("a")), fp.bins_of(F.col("b"))).alias("l")).groupBy("n").agg(F.avg("l").alias("l")).collect()
    assert len(got) == 13
    for r in got:
        assert abs(r.l - r.n / (r.n + 1)) < 0.03 + 0.6 / (r.n + 1) / 40 ** 0.5, r


def plain_bins(hashes):
    """The method restated: least hash per bin, then probes until a filled bin."""
    import xxhash
    size = 64 - (fp.BINS - 1).bit_length()
    own = {}
    for h in hashes:
        k = (h >> size) + fp.BINS // 2
        own[k] = min(own.get(k, h), h)
    out = []
    for i in range(fp.BINS):
        k, t = i, 0
        while k not in own:
            t += 1
            if len(own) == 1:
                k = next(iter(own))
                break
            # xxHash64 of two ints, chained as Spark does: the first one's hash is the seed of the second
            first = xxhash.xxh64(i.to_bytes(4, "little", signed=True), seed=42).intdigest()
            h = xxhash.xxh64(t.to_bytes(4, "little", signed=True), seed=first).intdigest()
            k = (h - (1 << 64) if h >> 63 else h) % fp.BINS
        out.append(own[k] & ((1 << fp.BITS) - 1))
    return out


def test_bins_are_the_method_restated(spark):
    from pyspark.sql import functions as F
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) for n in (1, 5, 6, 7, 9, 14, 40, 200, 2000)]
    d = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in d.select(fp.shingle_hashes(F.col("t")).alias("h"), fp.bins_of(F.col("t")).alias("b")).collect():
        assert list(r.b) == plain_bins(r.h)
