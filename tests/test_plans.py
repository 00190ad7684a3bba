"""Physical-plan checks: pruning, partial window limits, bounded broadcasts, no Python."""
from simpairs.config import PairConfig
from simpairs.operators import metrics as me
from simpairs.operators import pairs as pr
from simpairs.operators import score as sc
from simpairs.operators.features import jaccard_scores
from simpairs.sources.tables import document_clauses
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_pair_sampling_prunes_text_and_limits_before_shuffle(spark):
    c = document_clauses(spark, SF_SMALL, "lang || '-' || source")
    s = pr.sample_for_pairs(c, PairConfig())
    f = _formatted(s)
    assert "WindowGroupLimit" in f
    reads = [line for line in f.splitlines() if line.startswith("ReadSchema")]
    assert reads and all("text" not in line for line in reads)


def test_no_forced_broadcast_of_draws(spark):
    c = document_clauses(spark, SF_SMALL, "lang")
    assert "isBroadcast" not in pr.negative_pairs(c, PairConfig(), 500)._jdf.queryExecution().logical().toString()
    assert "ResolvedHint" not in pr.negative_pairs(c, PairConfig(), 500)._jdf.queryExecution().analyzed().toString()


def test_registered_queries_without_text_do_not_read_it(spark):
    from simpairs.plans.queries import QUERIES
    for name in ("category_sizes", "category_pairs", "positive_pairs_small", "positive_pairs_large", "positive_counts", "positive_cap",
                 "positive_pairs_hash", "negative_pairs"):
        reads = [line for line in _formatted(QUERIES[name](spark, SF_SMALL)).splitlines() if line.startswith("ReadSchema")]
        assert reads and all("text" not in line for line in reads), name


def test_words_are_counted_before_the_shuffle(spark):
    from simpairs.operators.vocab import word_counts
    plan = _plan(word_counts(document_clauses(spark, SF_SMALL, "lang"))).splitlines()
    explode = next(k for k, line in enumerate(plan) if "Generate explode" in line)
    above = [line for line in plan[:explode] if "Exchange" in line or "HashAggregate" in line]
    assert "partial_sum" in above[-1] and not any("SortAggregate" in line for line in plan)
    below = [line for line in plan[explode:] if "Exchange hashpartitioning(word" in line]
    assert not below


def test_one_row_per_distinct_word_leaves_a_text(spark):
    from simpairs.operators.dictionary import dictionary
    from simpairs.operators.encode import encode
    from simpairs.functions.text import tokenize
    c = spark.createDataFrame([(1, "b a b b c a"), (2, ""), (3, "a")], "clause_id long, clause string")
    rows = {(r.clause_id, r.value): r["at"] for r in dictionary(c, tokenize("clause"), ["clause_id"]).collect()}
    assert rows == {(1, "a"): [1, 5], (1, "b"): [0, 2, 3], (1, "c"): [4], (2, None): None, (3, "a"): [0]}
    vocab = spark.createDataFrame([("a", 4), ("b", 5)], "word string, idx int")
    plan = _plan(encode(c, vocab)).splitlines()
    # words leave their text through one explode of its distinct words; nothing explodes tokens
    assert sum("Generate" in line for line in plan) == 1 and not any("posexplode" in line for line in plan)
    assert {r.clause_id: r.seq for r in encode(c, vocab).collect()} == {1: [5, 4, 5, 5, 1, 4], 2: [], 3: [4]}


def test_texts_are_attached_after_the_limit(spark):
    from simpairs.operators import examples as ex
    c = document_clauses(spark, SF_SMALL, "lang")
    pairs = spark.range(100).selectExpr("id AS pair_id", "id AS id1", "id + 1 AS id2", "cast(id % 2 AS int) AS label")
    scored = pairs.selectExpr("'m' AS model", "pair_id", "label", "0.5D AS probability", "1 AS predicted")
    plan = ex.qualitative_examples(scored, pairs, c)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    limit = next(k for k, line in enumerate(plan) if "__r" in line and "Filter" in line)
    joins = [k for k, line in enumerate(plan) if "Join" in line]
    assert len(joins) == 3 and all(k < limit for k in joins)


def test_one_score_curve(spark):
    scored = spark.range(100).selectExpr("'m' AS model", "id AS pair_id", "cast(id % 2 AS int) AS label", "id / 100.0D AS probability", "1 AS predicted")
    plan = me.evaluate(scored)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") <= 2  # the totals inside and over the buckets of one curve


def test_no_python_outside_the_scorer_surface(spark):
    c = document_clauses(spark, SF_SMALL, "lang")
    pairs = pr.labelled_pairs(c, PairConfig(), materialize=False)
    scored = sc.to_scored(jaccard_scores(pairs, c), "jaccard")
    p = _plan(me.evaluate(scored))
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in p
