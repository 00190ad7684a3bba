import pytest
from pyspark.sql import functions as F

from simpairs.llm.mixing import frame_schedule, frame_shares, mix, phases, place


def test_less_than_one_block_of_deviation():
    for weights in ({"a": 1, "b": 1, "c": 1}, {"a": 0.7, "b": 0.2, "c": 0.05, "d": 0.05}, {"x": 1}, {str(k): 1 + k for k in range(20)}):
        shares = frame_shares(weights, 97)
        size = sum(shares.values())
        assert size == 97 and min(shares.values()) >= 1
        slots = frame_schedule(shares)
        owner = {t: s for s, own in slots.items() for t in own}
        assert sorted(owner) == list(range(size))
        had = dict.fromkeys(shares, 0)
        for t in range(size):
            had[owner[t]] += 1
            for s, n in had.items():
                assert abs(n * size - (t + 1) * shares[s]) < size


def test_phases_give_every_block_one_slot():
    blocks = {"a": 100, "b": 7, "c": 1, "d": 33}
    shares = frame_shares({"a": 1, "b": 5, "c": 1, "d": 2}, 16)
    seen = []
    for p in phases(blocks, shares):
        for s, (lo, hi, slots) in p["sources"].items():
            for j in range(hi - lo):
                seen.append((p["first"] + j // shares[s] * p["size"] + slots[j % shares[s]], s, lo + j))
    assert sorted(x[0] for x in seen) == list(range(sum(blocks.values())))
    for s, n in blocks.items():
        assert [b for _, x, b in sorted(seen) if x == s] == list(range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, "hot" if k % 3 == 0 else f"s{k % 7}", f"t{k}", 1, k) for k in range(700)]
    rows += [(None, None, None, 2, 0), (701, None, "", 3, 0), (702, "s1", "x", 4, 0), (702, "s1", "x", 4, 0)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, slot int, position long")


def test_places(spark, docs):
    import simpairs.llm.mixing as m
    old, m.RANGE_ROWS = m.RANGE_ROWS, 50
    try:
        got = place(docs, block_rows=8, frame=64).collect()
    finally:
        m.RANGE_ROWS = old
    assert len(got) == 704 and len({r.position for r in got}) == 704
    assert all(r.release <= r.slot < r.due for r in got)
    per = {}
    for r in got:
        per.setdefault((r.source, r.block), []).append(r.slot)
    assert all(len(set(v)) == 1 and len(v) <= 8 for v in per.values())
    n = len({v[0] for v in per.values()})
    assert n == len(per) and max(v[0] for v in per.values()) == n - 1
    # a source's blocks before any slot of the first phase: its share, give or take less than one
    first = min(max(v[0] for (s, _), v in per.items() if s == src) for src in {s for s, _ in per})
    for src in {s for s, _ in per}:
        share = next(r.share for r in got if r.source == src and r.slot == min(v[0] for (s, _), v in per.items() if s == src))
        for t in range(1, first + 1):
            assert abs(sum(v[0] < t for (s, _), v in per.items() if s == src) - t * share) < 1


def test_mix_keeps_rows_and_columns(spark, docs):
    out = mix(docs, {"hot": 1, "s1": 3}, block_rows=8, frame=64)
    assert out.columns == docs.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
    assert place(docs.limit(0)).count() == 0 and mix(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        frame_shares({"a": 0.0}, 8)


def test_names_may_clash_and_rows_of_one_place_are_spread(spark):
    data = [(None if k % 3 else k, f"s{k % 4}", {"k": k}, k, 0, 0, 0) for k in range(6000)]
    docs = spark.createDataFrame(data, "doc_id long, source string, m map<string,int>, position int, tie int, `all` int, at_id int")
    out = mix(docs, {"s1": 2, "s2": 1})
    assert out.columns == docs.columns
    assert sorted(r.position for r in out.select("position").collect()) == list(range(6000))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows make one partition
    try:
        per = [r["count"] for r in mix(docs).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(per) < 3000  # the 4000 rows without an id are in several partitions
