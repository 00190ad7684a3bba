from pyspark.sql import functions as F

from simpairs.config import PairConfig
from simpairs.operators import pairs as pr

SIZES = {"c0": 0, "c1": 1, "c2": 2, "c32": 32, "c33": 33, "c50": 50, "c51": 51, "c101": 101}
EXPECTED = {"c1": 0, "c2": 1, "c32": 496, "c33": 500, "c50": 500, "c51": 500, "c101": 500}


def _clauses(spark):
    rows, i = [], 0
    for c, n in SIZES.items():
        for _ in range(n):
            rows.append((c, i, f"text {i}"))
            i += 1
    return spark.createDataFrame(rows, "category string, clause_id long, clause string")


def test_positive_counts_per_category_size(spark):
    pos = pr.sample_positive_pairs(_clauses(spark), PairConfig())
    got = {r.category: r.n for r in pos.groupBy("category").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {c: got.get(c, 0) for c in EXPECTED} == EXPECTED
    assert pos.where("id1 = id2").count() == 0


def test_negatives_cross_categories_and_count(spark):
    c = _clauses(spark)
    cfg = PairConfig(num_negative=203_000)
    neg = pr.negative_pairs(c, cfg)
    assert neg.count() == 203_000
    assert neg.where("cat1 >= cat2").count() == 0
    cat = c.select(F.col("clause_id").alias("id1"), F.col("category").alias("k1"))
    assert neg.join(cat, "id1").where("k1 <> cat1").count() == 0


def test_labelled_pairs_ids_dense(spark):
    lp = pr.labelled_pairs(_clauses(spark), PairConfig())
    n = lp.count()
    assert lp.agg(F.min("pair_id"), F.max("pair_id"), F.countDistinct("pair_id")).first() == (0, n - 1, n)
    want = sum(min(k, k * (k - 1) // 2) for k in SIZES.values())
    assert {r.label: r.n for r in pr.pair_label_counts(lp).collect()} == {1: want, 0: want}


def test_positive_count_closed_form(spark):
    c = _clauses(spark)
    for per in (None, 7, 10 ** 6):
        cfg = PairConfig(pairs_per_category=per)
        assert pr.positive_count(c, cfg) == pr.positive_pairs(c, cfg).count()


def test_pairs_cover_the_whole_category(spark):
    """Distinct pairs, each of two clauses; all pairs when all are asked for; spread over all clauses otherwise."""
    c = _clauses(spark)
    every = pr.positive_pairs(c, PairConfig(pairs_per_category=10 ** 6))
    got = {(r.category, frozenset((r.id1, r.id2))) for r in every.collect()}
    assert len(got) == every.count() == sum(n * (n - 1) // 2 for n in SIZES.values())
    some = pr.positive_pairs(c, PairConfig(pairs_per_category=300)).where("category = 'c101'").collect()
    assert len({frozenset((r.id1, r.id2)) for r in some}) == 300
    assert len({x for r in some for x in (r.id1, r.id2)}) > 95


def test_draws_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(pr, "DRAW_CHUNK", 7)
    assert pr.positive_pairs(_clauses(spark), PairConfig(pairs_per_category=50)).distinct().count() == 0 + 1 + 4 * 50 + 50


def test_positive_count_property_all_sizes(spark):
    """Per category: min(500, m(m-1)/2), m = min(100, n) above 50 clauses, else n."""
    rows, i = [], 0
    for n in range(0, 121):
        for _ in range(n):
            rows.append((f"k{n:03d}", i, "x"))
            i += 1
    c = spark.createDataFrame(rows, "category string, clause_id long, clause string")
    got = {r.category: r.n for r in pr.sample_positive_pairs(c).groupBy("category").agg(F.count(F.lit(1)).alias("n")).collect()}
    for n in range(0, 121):
        m = min(100, n) if n > 50 else n
        assert got.get(f"k{n:03d}", 0) == min(500, m * (m - 1) // 2), n
    distinct = pr.sample_positive_pairs(c).select("id1", "id2").distinct().count()
    assert distinct == sum(got.values())


def test_draws_are_dealt_and_made_once(spark):
    """Few chunk rows become many draws: they stay dealt over the tasks, and both sides of a pair come from one draw."""
    c = spark.range(3000).selectExpr("concat('k', id % 60) AS category", "id AS clause_id")
    draws = pr.positive_draws(c)
    assert draws.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert draws.count() == 3000
    assert pr.positive_pairs(c)._jdf.queryExecution().optimizedPlan().toString().count("42:pos:") == 1


def test_labelled_pairs_the_same_with_and_without_tables(spark):
    c = _clauses(spark).unionByName(spark.createDataFrame([(None, 900, "a"), (None, 901, "b"), ("c2", 900, "c")], "category string, clause_id long, clause string"))
    rows = [sorted(map(tuple, pr.labelled_pairs(c, PairConfig(), m).collect()), key=str) for m in (True, False)]
    assert rows[0] == rows[1] and len(rows[0]) > 300
