from pyspark.sql import Window
from pyspark.sql import functions as F

from simpairs.functions.hashing import keyed_hash
from simpairs.operators import numbering
from simpairs.operators.numbering import hash_bucket, number_rows, row_count, running_totals, with_ranges
from tests.conftest import SF_ORACLE


def test_hash_value_matches_sql(spark):
    v = spark.range(1).select(keyed_hash(42, "x", F.lit("7")).alias("h")).first().h
    import duckdb
    assert v == duckdb.sql("SELECT ('0x' || substr(md5('42:x:7'), 1, 15))::BIGINT").fetchall()[0][0]


def test_number_rows_equals_global_window(spark, monkeypatch):
    monkeypatch.setattr(numbering, "ROWS_PER_BUCKET", 1000)
    o = spark.read.parquet(f"{SF_ORACLE}/orders.parquet").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("status"), "o_totalprice")
    d = o.withColumn("h", keyed_hash(42, "t", "o_orderkey"))
    ref = d.select("o_orderkey", F.row_number().over(Window.partitionBy("status").orderBy("h", "o_orderkey")).alias("r"))
    for parts in ("3", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = number_rows(d, [F.col("h"), F.col("o_orderkey")], hash_bucket(F.col("h"), row_count(o)), ["status"], "r")
        assert got.columns == [*d.columns, "r"] and got.join(ref, ["o_orderkey", "r"]).count() == o.count()
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_one_exchange_of_the_rows_and_a_bounded_bucket_table(spark):
    o = spark.read.parquet(f"{SF_ORACLE}/orders.parquet").withColumn("h", keyed_hash(42, "t", "o_orderkey"))
    n = number_rows(o, [F.col("h"), F.col("o_orderkey")], hash_bucket(F.col("h"), row_count(o)), ["o_orderstatus"], "r")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plan = n._jdf.queryExecution().executedPlan().toString().splitlines()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # below each exchange: either a partial aggregate, or the rows themselves (once)
    moved = [k for k, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    rows = [k for k in moved if "o_totalprice" in plan[k + 1]]
    assert len(rows) == 1, "\n".join(plan)
    assert o.select(hash_bucket(F.col("h"), row_count(o)).alias("b")).distinct().count() == 1


def test_running_totals_on_scores(spark):
    rows = [(float(i % 17) / 16.0, i % 3) for i in range(500)]
    df = spark.createDataFrame(rows, "p double, v int").groupBy("p").agg(F.sum("v").alias("v"))
    got = running_totals(with_ranges(df, F.col("p")), {"c": F.col("v")}, [F.col("p").desc()], -F.col(numbering.RANGE))
    ref = df.withColumn("c", F.sum("v").over(Window.orderBy(F.col("p").desc())))
    assert got.join(ref, ["p", "c"]).count() == df.count()


def test_quantile_ranges_follow_any_spread(spark, monkeypatch):
    """Two million scores within 1e-9 of each other, some of them equal, are dealt evenly; order and totals stay exact."""
    d = spark.range(0, 2_000_000, 1, 8).select("id", (F.lit(0.5) + F.pow(F.col("id") / 2e6, 3) * 1e-9).alias("p"))
    b = with_ranges(d, F.col("p")).select("p", F.col(numbering.RANGE).alias("b"))
    per = [r.n for r in b.groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(per) == 2_000_000 and len(per) > 400 and max(per) < 3 * 2_000_000 / len(per)
    w = Window.orderBy("p", "b")
    assert b.sample(0.005, 1).select((F.col("b") - F.lag("b").over(w)).alias("d")).where("d < 0").count() == 0


def test_ranges_of_odd_values(spark, monkeypatch):
    monkeypatch.setattr(numbering, "ROWS_PER_RANGE", 2)
    rows = [(k, v) for k, v in enumerate([None, float("nan"), 1.0, 1.0, -5.0, 1e300, float("inf"), 0.0, 2.0])]
    d = spark.createDataFrame(rows, "k long, v double")
    got = {r.k: r.b for r in with_ranges(d, F.col("v")).select("k", F.col(numbering.RANGE).alias("b")).collect()}
    assert got[4] <= got[7] <= got[2] == got[3] <= got[8] <= got[5] <= got[6] <= got[1] and got[0] == 0 and got[1] > 0
    assert with_ranges(d.where("false"), F.col("v")).collect() == []
    same = spark.range(1000).select(F.lit(7.0).alias("v"))
    assert with_ranges(same, F.col("v")).select(numbering.RANGE).distinct().count() == 1
