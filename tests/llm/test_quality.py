import random
import zlib

import numpy as np
import pytest

from simpairs.llm import quality as q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r for r in q.classify(docs, labels).collect()}
    assert len(got) == docs.count()
    test = [(got[r.doc_id], r.quality) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(r.held_out and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r, _ in test)
    good = [r.predicted for r, y in test if y == 1]
    bad = [r.predicted for r, y in test if y == 0]
    assert sum(good) / len(good) > 0.97 and 1 - sum(bad) / len(bad) > 0.9


def test_only_rows_not_held_out_are_learned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    from pyspark.sql import functions as F
    turned = labels.withColumn("quality", F.when(q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r.doc_id: r.score for r in q.classify(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, "", "y"), (None, "some text", None), (3, "é " * 700_000, "z")],
                                 "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 0, 0)], "doc_id long, quality int, text int")
    got = q.classify(docs, labels).collect()
    assert len(got) == 5 and len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert not next(r for r in got if r.doc_id is None).held_out
    none = q.classify(docs, labels.limit(0)).collect()
    assert all(r.predicted == 1 for r in none)
    assert q.classify(docs.limit(0), labels).count() == 0
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns


def test_dual_coordinate_descent_reaches_the_optimum():
    """The dual objective ends where projected gradients vanish: margins of free rows are one."""
    rng = random.Random(0)
    rows = [np.array(sorted(rng.sample(range(40 if y else 20, 60 if y else 40), 5) + [k % 7]), np.int32) for k, y in enumerate([0, 1] * 40)]
    labels = np.array([0, 1] * 40)
    w, ratio = q.fit(rows, labels, sweeps=400)
    margin = np.array([w[r].sum() / np.linalg.norm(ratio[r]) for r in rows])
    assert ((margin >= 0) == (labels == 1)).all()
    one, _ = q.fit(rows[:1], labels[:1])
    assert one.sum() == -1


@pytest.mark.parametrize("text", ["", " ", "a", "aa bb cc\ndd ee ", "Ab! Ab! 12 éé zz"])
def test_features_in_pieces(text, monkeypatch):
    """Pieces that end at white space give the features of the whole, each once."""
    last = np.zeros(q.FEATURES, np.int32)
    whole = q.features(text, last).tolist()
    assert len(whole) == len(set(whole)) >= 2
    monkeypatch.setattr(q, "PIECE", 7)
    assert set(q.features(text, last).tolist()) == set(whole)


def test_fit_takes_one_row_of_an_id(spark, monkeypatch):
    # in place of the fit: how many examples it gets (a lambda, so that it travels by value)
    monkeypatch.setattr(q, "fit", lambda f, y: (np.full(4, len(f), np.float32), np.ones(4, np.float32)))
    hot = [(1, f"text number {k}") for k in range(500)] + [(2, "other words here")]
    docs = spark.createDataFrame(hot, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    weights, ratio = q.train(docs, labels)
    assert np.frombuffer(weights, np.float32)[0] == 2


def test_good_rows_keep_their_columns(spark):
    docs = spark.createDataFrame([(k, "a text", 1, 2, 3, 4) for k in range(3)], "doc_id long, text string, __score int, `all` int, `a.b` int, __id int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = q.keep_good(docs, labels)
    assert out.columns == docs.columns and {tuple(r)[2:] for r in out.collect()} == {(1, 2, 3, 4)}
