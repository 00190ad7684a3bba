import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from simpairs.llm import hard_negatives as hn

COLS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=5, positives=5, negatives=3, low=50, high=95, scale=256):
    """rows of (id, label, vector) -> the contract, row by row."""
    ready = {}
    for i, lab, v in rows:
        if i is None or lab is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(scale * x) for x in v]
        if i not in ready or (lab, q) < ready[i]:
            ready[i] = (lab, q)
    out = []
    for a, (lab, q) in ready.items():
        if a % every:
            continue
        s = sorted((-sum(x * y for x, y in zip(q, v)), i, m == lab) for i, (m, v) in ready.items() if i != a)
        for p, pid, _ in [x for x in s if x[2]][:positives]:
            inside = [(-n, i) for n, i, same in s if not same and low * -p <= 100 * -n <= high * -p][:negatives]
            out += [(a, pid, k + 1, i, -p, n) for k, (n, i) in enumerate(inside)]
    return sorted(out)


def _run(spark, rows, kind="float", every=5, **more):
    df = spark.createDataFrame([(i, v, lab, 0, "x") for i, lab, v in rows],
                               f"vec_id long, embedding array<{kind}>, label int, score int, anchor string")
    got = hn.mine(df, F.col("vec_id") % every == 0, **more)
    assert got.columns == COLS
    return sorted(tuple(r) for r in got.collect())


def _vectors(rng, n, dim=6, labels=4):
    centre = rng.normal(size=(labels, dim))
    return [(int(i), int(i) % labels, [float(np.float32(x)) for x in centre[i % labels] * 0.5 + rng.normal(size=dim)]) for i in range(n)]


@pytest.mark.parametrize("block,wave", [(2048, 1 << 24), (7, 600)])
def test_equal_to_brute_force(spark, monkeypatch, block, wave):
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "WAVE_BYTES", wave)
    monkeypatch.setattr(hn, "TILE", 3)
    rows = _vectors(np.random.default_rng(block), 260)
    want = brute(rows)
    assert len(want) > 100 and _run(spark, rows) == want


def test_ties_nulls_repeats(spark):
    rng = random.Random(3)
    v = [[1.0, 0.5], [0.5, 0.5], [0.75, 0.25]]
    rows = [(i, rng.randrange(2), rng.choice(v)) for i in range(80)]  # many equal vectors: ties by id
    rows += [rows[3], (5, 9, [9.0, 9.0]), (5, 0, [1.0, 0.25])]  # repeated rows and ids
    rows += [(None, 1, [1.0, 1.0]), (201, None, [1.0, 1.0]), (202, 1, None), (203, 1, [1.0, None]), (205, 1, [float("nan"), 1.0]),
             (210, 0, [float("inf"), 1.0]), (215, 0, []), (220, 1, [1.0]), (225, 0, [1.0, 0.5, 7.0]), (-10, 1, [-1.0, -0.5]), (230, 77, [1.0, 1.0])]
    assert _run(spark, rows) == brute(rows)
    zero = [(i, i % 2, [0.0, 0.0]) for i in range(12)]  # windows of score zero hold the rows of score zero
    assert _run(spark, zero) == brute(zero) != []
    assert _run(spark, rows, positives=1, negatives=7, low=10, high=100) == brute(rows, positives=1, negatives=7, low=10, high=100)


def test_large_components(spark):
    rows = [(i, i % 2, [float(3 + i) * 2.0 ** 17, 2.0 ** 17 + i]) for i in range(30)]
    assert _run(spark, rows, "double") == brute(rows) != []
    with pytest.raises(Exception, match="do not fit 64 bits"):
        _run(spark, [(i, i % 2, [2.0 ** 30 * (i + 1)]) for i in range(6)], "double")


def test_empty_tables(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(1, 1, [1.0]), (2, 0, [1.0])]) == []  # no anchors


def test_windows_stream_over_batches():
    """The iterator sees one row at a time, in any cut into batches."""
    import pyarrow as pa
    keys = ["anchor", "score", "kind", "id"]
    rows = [(1, 100, 0, 9), (1, 95, 1, 3), (1, 95, 1, 3), (1, 80, 0, 4), (1, 80, 1, 8), (1, 76, 1, 2), (1, 60, 1, 1), (1, 40, 1, 5), (2, 0, 0, 1), (2, 0, 1, 7)]
    want = [(1, 9, 1, 3, 100, 95), (1, 9, 2, 8, 100, 80), (1, 9, 3, 2, 100, 76), (1, 4, 1, 2, 80, 76), (1, 4, 2, 1, 80, 60),
            (1, 4, 3, 5, 80, 40), (2, 1, 1, 7, 0, 0)]
    for size in (1, 3, 10):
        cuts = [pa.RecordBatch.from_pydict(dict(zip(keys, map(list, zip(*rows[k:k + size]))))) for k in range(0, len(rows), size)]
        got = [tuple(r[c] for c in COLS) for b in hn.open_windows(3, 50, 95)(cuts) for r in b.to_pylist()]
        assert got == want


def test_sorted_shuffle_by_anchor(spark):
    """The last exchange deals by anchor and sorts within the partitions."""
    keyed = spark.createDataFrame([(1, 2, 0, 3)], "anchor long, score long, kind int, id long")
    plan = keyed.repartition("anchor").sortWithinPartitions("anchor", F.desc("score"), "kind", "id")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(anchor" in plan and "], false, 0" in plan
