import pytest
from pyspark.sql import functions as F

from simpairs.operators.examples import all_outcomes
from simpairs.operators.sampling import batch_numbers
from simpairs.operators.score import check_vocab_compatible


def test_batch_numbers(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    b = {r.k: (r.batch, r.n_batches) for r in batch_numbers(df, "k", 4).collect()}
    assert [b[k][0] for k in range(10)] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2] and b[0][1] == 3
    h = batch_numbers(df, "k", 4, seed=42)
    assert sorted(r.c for r in h.groupBy("batch").agg(F.count(F.lit(1)).alias("c")).collect()) == [2, 4, 4]


def test_vocab_compatibility(spark):
    v = spark.createDataFrame([("a", 0), ("b", 1)], "word string, idx int")
    assert check_vocab_compatible(2, v) == 2
    with pytest.raises(ValueError):
        check_vocab_compatible(3, v)


def test_all_outcomes(spark):
    rows = [("m", i, i % 2, 0.4 + (i % 3) * 0.1, int(0.4 + (i % 3) * 0.1 >= 0.5)) for i in range(50)]
    s = spark.createDataFrame(rows, "model string, pair_id long, label int, probability double, predicted int")
    p = spark.createDataFrame([(i, i, 100 + i) for i in range(50)], "pair_id long, id1 long, id2 long")
    c = spark.createDataFrame([(i, f"t{i}") for i in range(150)], "clause_id long, clause string")
    assert all_outcomes(s, p, c, max_rows=20).count() == 20
    out = all_outcomes(s, p, c).collect()
    assert len(out) == 50 and all((r.clause1, r.clause2) == (f"t{r.pair_id}", f"t{100 + r.pair_id}") for r in out)


def test_factory_runs_once_per_task(spark, tmp_path):
    from simpairs.operators.score import batch_score

    def factory():
        import uuid

        import numpy as np
        (tmp_path / uuid.uuid4().hex).touch()

        def score(a, b):
            assert len(a) <= 4
            return np.full(len(a), 0.25)
        return score
    pairs = spark.range(0, 40, 1, 3).selectExpr("id AS pair_id", "array(1, 2) AS seq1", "array(1, 3) AS seq2", "cast(id % 2 AS int) AS label")
    assert batch_score(pairs, factory, "m", batch_size=4).count() == 40
    assert len(list(tmp_path.iterdir())) == 3


def test_wrong_score_length_raises(spark):
    from simpairs.operators.score import batch_score
    pairs = spark.range(3).selectExpr("id AS pair_id", "array(1) AS seq1", "array(1) AS seq2", "1 AS label")
    with pytest.raises(Exception, match="scorer returned shape"):
        batch_score(pairs, lambda: (lambda a, b: [0.5] * (len(a) + 1)), "m").collect()


def test_timing_table_keeps_nulls(spark):
    from simpairs.operators.report import accuracy_time_table, throughput
    m = spark.createDataFrame([("a", .5, .5, .5, .5, .5, .5), ("b", .1, .1, .1, .1, .1, .1)],
                              "model string, accuracy double, precision double, recall double, f1_score double, roc_auc double, pr_auc double")
    t = throughput(spark.createDataFrame([("a", 2.0, 5), ("z", 0.0, 5)], "model string, eval_s double, n long"))
    got = {r.model: r for r in accuracy_time_table(m, t).collect()}
    assert got["a"].eval_seconds == "2.00" and got["a"].samples_per_second == "2.50" and got["a"].pr_auc == "0.5000"
    assert got["b"].eval_seconds is None and got["b"].samples_per_second is None


def test_training_log_and_stops(spark):
    from simpairs.operators.score import train_classifier
    rows = [([float(i % 2), float(i % 3)], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "features array<double>, label int")
    model, log = train_classifier(df, df, 2, epochs=12, iters_per_epoch=10, hidden=(4,))
    got = log.orderBy("epoch").collect()
    assert model is not None and [r.epoch for r in got] == list(range(len(got)))
    assert len(got) < 12 and got[-1].val_accuracy >= 0.995  # the target rule ends it
