import hashlib
import random
import re

import pytest

from simpairs.llm import exact_dedup as ed


def rows(n=400):
    rng = random.Random(1)
    pool = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(60)]
    out = [(k, rng.choice(pool).replace(" ", rng.choice([" ", "\n", "  ", "\t \r"])), "x", True) for k in range(n)]
    out += [(1000 + k, "the copy that is a third", "x", True) for k in range(n // 2)]
    return out + [(None, "only a null id", "y", None), (None, pool[3], "y", None), (5000, None, None, None), (5001, "", "", False),
                  (7, "again", "z", True), (7, "again", "z", True), (8000, "é " * 100_000, "long", True)]


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def groups(data):
    out = {}
    for i, t, *_ in data:
        out.setdefault(norm(t), []).append(i)
    return out


def test_equals_brute_force(spark):
    data = rows()
    docs = spark.createDataFrame(data, "doc_id long, text string, keep_id string, kept boolean")
    own = groups(data)
    want = []
    for i, t, *_ in data:
        ids = own[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    got = [tuple(r) for r in ed.mark_duplicates(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


CLASHING = "doc_id long, text string, sha string, copies boolean, keep int, `all` int, id int, block int, __may_repeat int, __block int, `a.b` int"


@pytest.mark.parametrize("bound", [None, 0, 9])
def test_rows_that_stay(spark, monkeypatch, bound):
    """With broadcasts of the tables, without, and with a route filter of one block."""
    if bound is not None:
        monkeypatch.setattr(ed, "BROADCAST_BYTES", 0)
        monkeypatch.setattr("simpairs.llm.common.BROADCAST_BYTES", 0)
    if bound:
        monkeypatch.setattr(ed, "ROUTE_BYTES", bound)
    data = [(*r, k, 1, 2, 3, 4, 5, 6) for k, r in enumerate(rows())]
    docs = spark.createDataFrame(data, CLASHING)
    out = ed.drop_duplicates(docs)
    assert out.columns == docs.columns
    found = out.collect()
    got = {(r.doc_id, r.text) for r in found}
    assert len(found) == len(got) == len(groups(data))
    for i, t in got:
        ids = [x for x in groups(data)[norm(t)] if x is not None]
        assert i == min(ids, default=None)
    own = {(r[0], r[1]): set() for r in data}
    for r in data:
        own[r[0], r[1]].add(r)
    assert all(tuple(r) in own[r.doc_id, r.text] for r in found)


def _exchanges(plan):
    """Per shuffle of the optimised plan: whether whole rows go through it, and whether the route filter stands below it."""
    out, stack = [], []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, line))
        if "Scan" in line or "LocalTable" in line:
            above = [x for _, x in stack]
            out.append(above)
    return out


def test_only_rows_that_may_repeat_are_shuffled(spark, monkeypatch, tmp_path):
    spark.createDataFrame([(k, f"text {k % 900}") for k in range(1000)], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    paths = [p for p in _exchanges(ed.drop_duplicates(docs)._jdf.queryExecution().sparkPlan().toString()) if "text" in p[-1] and "parquet" in p[-1]]
    assert len(paths) == 1  # one scan of the texts

    def shuffled(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [p for p in _exchanges(plan) if "parquet" in p[-1] and "text" in p[-1] and any("Exchange hashpartitioning" in x for x in p)]
    assert not shuffled(ed.drop_duplicates(docs))
    monkeypatch.setattr(ed, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ed.drop_duplicates(docs)
        moved = shuffled(out)
        # the shuffled branch is joined with the route filter below its exchange
        assert len(moved) == 1
        at = max(k for k, x in enumerate(moved[0]) if "Exchange hashpartitioning" in x)
        assert any("BroadcastHashJoin" in x for x in moved[0][at:])
        assert out.count() == 900
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filter_never_misses_and_mostly_passes(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('text ', CASE WHEN id % 10 = 0 THEN id div 20 ELSE id + 10000 END) AS text")
    keyed = docs.select("doc_id", ed.digest("text").alias("sha"))
    filt, blocks = ed.repeat_filter(keyed, "sha", 3000)
    hit = {r.doc_id for r in ed._probe(keyed, "sha", filt, blocks).where("__may_repeat").select("doc_id").collect()}
    own = {}
    for r in docs.collect():
        own.setdefault(r.text, []).append(r.doc_id)
    repeated = {i for ids in own.values() if len(ids) > 1 for i in ids}
    assert repeated <= hit and len(hit - repeated) < 60


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ed.mark_duplicates(empty).count() == 0 and ed.drop_duplicates(empty).count() == 0
