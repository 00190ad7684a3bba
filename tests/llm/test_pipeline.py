import random
import re

import pytest

import corpus_pipeline as cp
from tests.llm.test_exact_dedup import norm
from tests.llm.test_near_dedup import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small copy of the tables with more copies, near copies, nulls and repeated rows."""
    rng = random.Random(3)
    out = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.collect()]
    at = [c for c in docs.columns].index("text")
    more = []
    for k, r in enumerate(rows[:60]):
        words = r[at].split(" ")
        if k % 2 and len(words) > 120:
            words[rng.randrange(len(words))] = "changed"
        more.append((10_000 + k, *r[1:at], re.sub(" ", "  ", " ".join(words), count=1), *r[at + 1:]))
    empty = [(20_000, *rows[0][1:at], None, None, None, None), (20_001, *rows[0][1:at], "", "en", "src1", 0)]
    spark.createDataFrame(rows + more + empty, docs.schema).write.parquet(f"{out}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{out}/labels.parquet")
    return out


def test_every_stage_on_its_own_input(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs.collect()]
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append(docs.collect())
        if k < len(cp.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    start, good, exact, near, mixed, packed = seen
    ids = lambda rows: sorted(r.doc_id for r in rows)
    # the classifier: labelled good documents stay, labelled bad ones go
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = set(ids(good))
    assert {r.doc_id for r in good} <= {r.doc_id for r in start}
    hits = [(r.doc_id in kept) == (quality[r.doc_id] == 1) for r in start if r.doc_id in quality]
    assert sum(hits) / len(hits) > 0.95
    first = {}
    for r in sorted(good, key=lambda r: r.doc_id):
        first.setdefault(norm(r.text), r.doc_id)
    assert ids(exact) == sorted(first.values()) and len(exact) < len(good)
    assert ids(near) == sorted(i for i, _, c in brute([(r.doc_id, r.text) for r in exact], 5) if i == c)
    assert sorted(map(str, mixed)) == sorted(map(str, near))
    tokens = {}
    for r in packed:
        tokens.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in v) <= 1024 for v in tokens.values())
    assert {r.doc_id for r in packed} == set(ids(mixed))


def test_run_gives_the_last_stage(spark, folder):
    out = cp.run(spark, folder)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
    assert [name for name, _ in cp.STAGES] == ["quality_classifier", "exact_dedup", "near_dedup", "source_mixing", "best_fit_packing"]
    assert cp.ORACLE_SQL is None


def test_sequences_follow_the_written_mix(spark, tmp_path, monkeypatch):
    """Whole-pipeline order: any stretch of sequences holds the sources near their shares, which the stage before packing gave."""
    monkeypatch.setattr(cp.packing, "BLOCK_PIECES", 200)
    monkeypatch.setattr(cp.packing, "RUN_ROWS", 64)
    rng = random.Random(4)
    sizes = {"a": 1500, "b": 700, "c": 200}
    rows = [(f"{s}{k}", " ".join("tok" for _ in range(rng.randint(1, 400))), "en", s, k) for s, n in sizes.items() for k in range(n)]
    spark.createDataFrame(rows, "doc_id string, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")

    def shares(mixed, name):
        mixed.write.parquet(f"{tmp_path}/{name}")
        first = {}
        for r in cp.packing_stage(spark, spark.read.parquet(f"{tmp_path}/{name}"), "").collect():
            first.setdefault(r.sequence_id, []).extend(r.doc_id[0] * (r.piece == 0))
        order = [s for q in sorted(first) for s in first[q]]
        assert len(order) == len(rows)
        return [[order[k:k + 480].count(s) / 480 for s in sizes] for k in range(0, len(order) - 479, 160)]
    total = sum(n ** 0.7 for n in sizes.values())
    want = [n ** 0.7 / total for n in sizes.values()]
    # until the smallest source ends (at 200 / its share) the shares of all three hold
    until = int(200 / want[2])
    near = [s for k, s in enumerate(shares(cp.mixing_stage(spark, docs, ""), "mixed")) if 160 * k + 480 <= until]
    assert len(near) >= 3 and all(abs(x - y) < 0.1 for s in near for x, y in zip(s, want)), (near, want)
    # and without the stage they do not
    plain = shares(docs.repartitionByRange(4, "source"), "plain")
    assert any(abs(x - y) > 0.3 for x, y in zip(plain[0], want))
