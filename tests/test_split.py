from pyspark.sql import functions as F

from simpairs.config import PairConfig
from simpairs.operators.split import split_quotas, stratified_split


def test_published_split_sizes(spark):
    n = 394_210
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 2).alias("label"))
    q = split_quotas(df, "label").agg(F.sum("n_train"), F.sum("n_val"), F.sum("n_test")).first()
    assert tuple(q) == (275_947, 39_421, 78_842)


def test_split_disjoint_complete_and_exact(spark):
    df = spark.range(1001).select(F.col("id").alias("k"), (F.col("id") % 3).alias("label"))
    s = stratified_split(df, "k", "label", PairConfig())
    assert s.count() == 1001 and s.select("k").distinct().count() == 1001
    q = {r.label: r for r in split_quotas(df, "label").collect()}
    got = {(r.label, r.split): r.n for r in s.groupBy("label", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
    for lab, r in q.items():
        assert (got[(lab, "train")], got[(lab, "val")], got[(lab, "test")]) == (r.n_train, r.n_val, r.n_test)
