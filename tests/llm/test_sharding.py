import hashlib

import pytest

from simpairs.llm import sharding as sh


def key(i, t):
    inner = hashlib.md5((t or "").encode()).hexdigest()
    return int(hashlib.md5(f"{'' if i is None else i}:{inner}".encode()).hexdigest()[:15], 16)


def brute(rows, limit):
    """Split while too large, bit by bit."""
    out, work = {}, [(0, 0, [(key(i, t), len((t or "").encode())) for i, t in rows])]
    while work:
        depth, prefix, own = work.pop()
        size = sum(b for _, b in own)
        if size <= limit or depth == 60:
            for h, _ in own:
                out[h] = (format(prefix, f"0{depth}b") if depth else "", depth, size, len(own), size <= limit)
            continue
        for bit in (0, 1):
            half = [x for x in own if (x[0] >> (59 - depth)) & 1 == bit]
            if half:
                work.append((depth + 1, 2 * prefix + bit, half))
    return out


@pytest.mark.parametrize("limit", [50, 400, 10 ** 9])
def test_equals_brute_force(spark, limit):
    rows = [(k, "w" * (k % 50)) for k in range(300)] + [(None, None), (None, "x"), (5, ""), (900, "long " * 100), (901, "same"), (901, "same")]
    rows += [(902, "equal rows of one hash " * 2)] * 20
    docs = spark.createDataFrame([(i, t, 0, "a") for i, t in rows], "doc_id long, text string, depth int, prefix string")
    want = brute(rows, limit)
    got = sh.assign(docs, limit)
    assert got.columns[:4] == docs.columns
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r)[4:] == want[key(r.doc_id, r.text)]


def test_write_empty_and_native(spark, tmp_path):
    docs = spark.createDataFrame([(k, "w" * 50) for k in range(100)], "doc_id long, text string")
    sh.write_shards(docs, str(tmp_path / "out"), limit=1000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and back.groupBy("shard").count().where("count > 20").count() == 0
    assert sh.assign(docs.limit(0)).count() == 0
    assert "Python" not in sh.assign(docs)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("big", [40_000, 3_000_000])
def test_one_huge_text_among_small_ones(spark, big):
    """The directory starts deep; the small rows' shards are found many depths higher up."""
    rows = [(k, "w" * (k % 20)) for k in range(200)] + [(1000, "z" * big), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 300)
    found = sh.assign(docs, 300).collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r)[2:] == want[key(r.doc_id, r.text)]


def test_columns_of_any_name(spark, tmp_path):
    docs = spark.createDataFrame([(k, "w" * 50, 1, 2, 3, 4, "s", 5, 6) for k in range(50)],
                                 "doc_id long, text string, __h int, __cell_1 int, h int, `__leaf.1` int, shard string, __shard int, `all` int")
    out = sh.assign(docs, 1000)
    assert out.columns == [*docs.columns, "___shard", "__depth", "__shard_bytes", "__shard_rows", "__fits"]
    plain = sh.assign(docs.select("doc_id", "text"), 1000)
    assert sorted(tuple(r)[:1] + tuple(r)[9:] for r in out.collect()) == sorted(tuple(r)[:1] + tuple(r)[2:] for r in plain.collect())
    assert all(tuple(r)[2:9] == (1, 2, 3, 4, "s", 5, 6) for r in out.collect())
    sh.write_shards(docs.drop("__leaf.1"), str(tmp_path / "out"), limit=1000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and "_shard" in back.columns and back.where("shard = 's'").count() == 50
