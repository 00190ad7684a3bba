"""Threshold selection: the same rows as a top-k, for any k, without one."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from simpairs.functions.hashing import keyed_hash
from simpairs.operators import numbering
from simpairs.operators import sampling as smp


@pytest.fixture
def small(monkeypatch):
    """Prefixes of a few rows and thresholds for any k."""
    monkeypatch.setattr(smp, "TOP_K_ROWS", 0)
    monkeypatch.setattr(numbering, "ROWS_PER_BUCKET", 100)


def _rows(spark, n=3000):
    # a third of the rows in one stratum, a null stratum, strata of one row
    s = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("id") % 7))
    return spark.range(n).select("id", F.when(F.col("id") == 5, "single").otherwise(s).alias("stratum"))


@pytest.mark.parametrize("k", [0, 1, 57, 1000, 2999, 3000, 5000])
def test_equal_to_top_k(spark, small, k):
    d = _rows(spark)
    got = smp.hash_sample(d, "id", k, 42, "t") if k else smp.threshold_select(d.withColumn("__h", keyed_hash(42, "t", "id")), "id", F.lit(0)).select(*d.columns)
    assert got.columns == d.columns
    want = d.orderBy(keyed_hash(42, "t", "id"), "id").limit(k)
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect())


@pytest.mark.parametrize("k", [1, 30, 400])
def test_per_stratum(spark, small, k):
    d = _rows(spark)
    w = Window.partitionBy("stratum").orderBy(keyed_hash(7, "t", "id"), "id")
    want = d.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k)
    got = smp.hash_sample(d, "id", k, 7, "t", ["stratum"])
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect())


def test_fractions_per_stratum(spark, small):
    d = _rows(spark)
    got = {r.stratum: r.n for r in smp.fraction_sample(d, "id", 0.2, 42, "f", ["stratum"]).groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = {r.stratum: r.n for r in d.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {s: int(n * 0.2) for s, n in size.items() if int(n * 0.2)}
    assert smp.fraction_sample(d, "id", 0.2, 42, "f").count() == 600
    assert smp.fraction_sample(d.limit(0), "id", 0.2, 42, "f").count() == 0


def test_large_k_ranks_the_edge_only(spark):
    d = spark.range(5_000_000)
    plan = smp.hash_sample(d, "id", 2_000_000, 42, "big")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "Limit" not in plan
    windows = [k for k, line in enumerate(plan.splitlines()) if "row_number" in line]
    lines = plan.splitlines()
    # what is ranked was first filtered to the edge prefix
    assert len([k for k in windows if "Window [" in lines[k]]) == 1 and "(__b" in plan
    assert smp.hash_sample(d, "id", 2_000_000, 42, "big").count() == 2_000_000
