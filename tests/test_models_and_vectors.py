"""Saved models, word vectors, the scorer on whole sequences and on streams, unranked category pairs."""
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from simpairs.config import PairConfig
from simpairs.operators import pairs as pr
from simpairs.operators import score as sc
from simpairs.operators import vectors as vec
from simpairs.sources import models


def test_saved_model_is_whole_and_checked(spark, tmp_path):
    rows = [([float(i % 2), float(i % 3)], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "features array<double>, label int").withColumn("pair_id", F.monotonically_increasing_id())
    model, _ = sc.train_classifier(df, df, 2, epochs=1, iters_per_epoch=5, hidden=(4,))
    vocab = spark.createDataFrame([("a", 4), ("b", 5), ("c", 6)], "word string, idx int")
    path = f"{tmp_path}/model"
    assert models.save_model(model, path, vocab, {"threshold": 0.5})
    # the same vocabulary in another order and partitioning
    loaded, config = models.load_model(spark, path, vocab.orderBy(F.desc("idx")).repartition(3))
    assert config == {"threshold": 0.5}
    score = lambda m: sorted(map(tuple, sc.classifier_scores(m, df, "m").collect()))
    assert score(loaded) == score(model)
    swapped = spark.createDataFrame([("b", 4), ("a", 5), ("c", 6)], "word string, idx int")  # the same size
    for other in (swapped, vocab.limit(2), vocab.limit(0)):
        with pytest.raises(ValueError, match="trained with a vocabulary"):
            models.load_model(spark, path, other)
    # a second writer leaves the first artifact whole and nothing else behind
    assert not models.save_model(model, path, swapped, {"threshold": 0.9})
    assert os.listdir(tmp_path) == ["model"] and sorted(os.listdir(path)) == ["manifest", "model"]
    assert models.load_model(spark, path, vocab)[1] == {"threshold": 0.5}


def test_cooccurrences_and_vectors(spark):
    seqs = {1: [4, 5, 4, 4, 1, 6], 2: [], 3: [7], 4: [5, 1, 1, 4], 5: [6, 6, 5]}
    enc = spark.createDataFrame(list(seqs.items()), "clause_id int, seq array<int>")
    want = Counter()
    for s in seqs.values():
        for i, x in enumerate(s):
            for y in s[i + 1:i + 3]:
                if min(x, y) >= 4:
                    want[min(x, y), max(x, y)] += 1
    assert {(r.a, r.b): r.n for r in vec.cooccurrences(enc).collect()} == want
    c = spark.createDataFrame([("k", 1, "red green red blue"), ("k", 2, "green red"), ("k", 3, ""), ("k", 4, "alone"), ("k", 5, "blue red odd")],
                              "category string, clause_id long, clause string")
    vocab = spark.createDataFrame([("<PAD>", 0), ("<UNK>", 1), ("<START>", 2), ("<END>", 3), ("red", 4), ("green", 5), ("blue", 6), ("alone", 7)], "word string, idx int")
    got = {r.word: r.vector for r in vec.word_vectors(c, vocab, PairConfig(), 16).collect()}
    assert set(got) == {"red", "green", "blue", "alone"} and all(len(v) == 16 for v in got.values())
    assert not any(got["alone"]) and any(got["red"])


def test_scorer_sees_whole_ragged_sequences(spark):
    def factory():
        def score(a, b):
            assert a.dtype == np.int32 and a.shape == b.shape
            return (a.sum(axis=1) + 2 * b.sum(axis=1)) / 1e6
        return score
    rows = [(k, list(range(1, k + 1)), [k] * (k % 5) if k % 7 else None, k % 2) for k in range(100)]
    df = spark.createDataFrame(rows, "pair_id long, seq1 array<int>, seq2 array<int>, label int")
    got = {r.pair_id: r.probability for r in sc.batch_score(df, factory, "m", batch_size=7).collect()}
    assert all(abs(got[k] - (sum(a) + 2 * sum(b or [])) / 1e6) < 1e-12 for k, a, b, _ in rows)


def test_scorer_on_a_stream(spark, tmp_path):
    from simpairs.plans.queries import overlap_scorer
    rows = [(k, [k % 5, 7, 8], [7, k % 3], k % 2) for k in range(60)]
    df = spark.createDataFrame(rows, "pair_id long, seq1 array<int>, seq2 array<int>, label int")
    df.repartition(4).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    out = sc.batch_score(stream, overlap_scorer, "m")
    assert out.isStreaming
    run = out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").option("path", f"{tmp_path}/out").trigger(availableNow=True).start()
    run.awaitTermination(120)
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect()))
    assert got == sorted(map(tuple, sc.batch_score(df, overlap_scorer, "m").collect())) and len(got) == 60


@pytest.mark.parametrize("n", [2, 3, 50, 395, 1_000_003])
def test_unranked_pairs(spark, n):
    total = n * (n - 1) // 2
    step = max(1, total // 5000)
    i, j = pr.unranked_categories(F.col("id"), F.lit(n))
    got = spark.range(0, total, step).select("id", i.alias("i"), j.alias("j")).collect()
    for r in got:
        assert 0 <= r.i < r.j < n and r.i * (2 * n - r.i - 1) // 2 + r.j - r.i - 1 == r.id
    last = spark.range(total - 1, total).select(i.alias("i"), j.alias("j")).first()
    assert (last.i, last.j) == (n - 2, n - 1)


def test_draws_from_a_stream_of_ids(spark, tmp_path):
    c = spark.range(60).selectExpr("concat('k', id % 7) AS category", "id AS clause_id", "'t' AS clause")
    ids = spark.range(500).withColumnRenamed("id", "draw_id")
    ids.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = pr.negative_draws(c, draws=spark.readStream.schema(ids.schema).parquet(f"{tmp_path}/in"))
    run = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").option("path", f"{tmp_path}/out").trigger(availableNow=True).start()
    run.awaitTermination(120)
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").select("draw_id", "cat1", "row1", "cat2", "row2").collect()))
    assert got == sorted(map(tuple, pr.negative_draws(c, n_neg=500).select("draw_id", "cat1", "row1", "cat2", "row2").collect())) and len(got) == 500


def test_norms_are_taken_once_per_item(spark):
    """A vector's norm is taken where the item is read, not again for each of its pairs."""
    from simpairs.operators.features import cosine_probability, cosine_scores
    items = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, [-3.0, 4.5]), (4, None)], "clause_id long, embedding array<double>")
    pairs = spark.createDataFrame([(0, 1, 3, 1), (1, 1, 2, 0), (2, 3, 3, 1), (3, 1, 4, 0)], "pair_id long, id1 long, id2 long, label int")
    scored = cosine_scores(pairs, items)
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("SQRT") == 2
    vectors = {r.clause_id: r.embedding for r in items.collect()}
    for r in scored.collect():
        two = spark.createDataFrame([(vectors[r.id1], vectors[r.id2])], "a array<double>, b array<double>")
        assert r.probability == two.select(cosine_probability("a", "b")).first()[0]
    assert set(scored.columns) == {"pair_id", "id1", "id2", "label", "probability"}
