"""Uneven lookups: the same rows in every way of joining, and even tasks."""
from collections import Counter

import pytest
from pyspark.sql import functions as F

from simpairs.operators import lookup as lk


@pytest.fixture
def no_broadcast(monkeypatch):
    monkeypatch.setattr(lk, "BROADCAST_BYTES", 0)


def _rows(spark):
    # a third of all rows on one key, a sixth on a key that the table lacks, some nulls, a long tail
    key = (F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 6 == 1, "stranger").when(F.col("id") % 97 == 0, F.lit(None))
           .otherwise(F.concat(F.lit("w"), F.col("id") % 5000)))
    return spark.range(0, 60_000, 1, 8).select("id", key.alias("word"))


def _table(spark):
    return (spark.range(4000).select(F.concat(F.lit("w"), "id").alias("word"), F.col("id").cast("int").alias("idx"))
            .unionByName(spark.createDataFrame([("hot", -1)], "word string, idx int")))


def test_split_join_equals_plain_join(spark, no_broadcast):
    rows, table = _rows(spark), _table(spark)
    got = lk.lookup(rows, "word", table)
    assert got.columns == ["id", "word", "idx"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(table, "word", "left").select("id", "word", "idx").collect()))


def test_small_table_moves_no_row(spark):
    plan = lk.lookup(_rows(spark), "word", _table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_hot_keys_are_spread(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lk.lookup(_rows(spark), "word", _table(spark))
        sizes = sorted(Counter(r.p for r in out.select(F.spark_partition_id().alias("p")).collect()).values())
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 8 and sizes[-1] <= 3 * sizes[4]


def test_hot_keys_are_bounded_and_found(spark):
    assert {r.word for r in lk.hot_keys(_rows(spark), "word").collect()} >= {"hot", "stranger"}
    assert lk.hot_keys(spark.range(50_000).withColumnRenamed("id", "k"), "k").count() <= lk.HOT_KEYS
    assert lk.hot_keys(_rows(spark).limit(0), "word").count() == 0


def test_other_key_name_and_types(spark, no_broadcast):
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("k"))
    table = spark.range(5).select(F.col("id").alias("key"), F.array(F.col("id") * 2).alias("v"), F.lit("x").alias("s"))
    got = lk.lookup(rows, "k", table, "key").collect()
    assert all(r.v == ([2 * r.k] if r.k < 5 else None) and r.s == ("x" if r.k < 5 else None) for r in got) and len(got) == 1000
