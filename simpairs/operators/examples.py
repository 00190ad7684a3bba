"""Qualitative examples: the first n correct and first n incorrect rows per model."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simpairs.functions.text import decode_label, ellipsis

EXAMPLE_COLS = ["model", "pair_id", "clause1", "clause2", "true_label", "predicted_label", "probability", "correct"]


def first_by_outcome(scored: DataFrame, n: int) -> DataFrame:
    """Rows of `scored` that are among the first n (by pair_id) of their (model, correct)
    group. The rank filter runs as a WindowGroupLimit before the shuffle."""
    w = Window.partitionBy("model", "correct").orderBy("pair_id")
    s = scored.withColumn("correct", F.col("label") == F.col("predicted"))
    return s.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def texts_of(chosen: DataFrame, pairs: DataFrame, clauses: DataFrame) -> DataFrame:
    """`chosen`(pair_id, ...) with clause1 and clause2. The pair ids are joined first; then each text is
    looked up for the chosen rows only."""
    ids = chosen.join(pairs.select("pair_id", "id1", "id2"), "pair_id")
    for k in ("1", "2"):
        ids = ids.join(clauses.select(F.col("clause_id").alias(f"id{k}"), F.col("clause").alias(f"clause{k}")), f"id{k}")
    return ids.drop("id1", "id2")


def qualitative_examples(scored: DataFrame, pairs: DataFrame, clauses: DataFrame, n: int = 10) -> DataFrame:
    """examples(model, pair_id, clause1, clause2, true_label, predicted_label, probability,
    correct): the rows are limited, then their texts attached."""
    j = texts_of(first_by_outcome(scored, n), pairs, clauses)
    return j.select("model", "pair_id", ellipsis("clause1").alias("clause1"), ellipsis("clause2").alias("clause2"),
                    decode_label("label").alias("true_label"), decode_label("predicted").alias("predicted_label"),
                    F.col("probability").cast("double").alias("probability"), "correct")


def report_examples(examples: DataFrame, n: int = 5) -> DataFrame:
    """The first n of each outcome, without the `correct` column (report projection)."""
    w = Window.partitionBy("model", "correct").orderBy("pair_id")
    return (examples.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n)
            .select("model", "pair_id", "clause1", "clause2", "true_label", "predicted_label", "probability"))


def all_outcomes(scored: DataFrame, pairs: DataFrame, clauses: DataFrame, max_rows: int | None = None,
                 seed: int = 42) -> DataFrame:
    """Every evaluated row with texts, labels and outcome (for writing complete correct /
    incorrect files); all of them, or `max_rows` per model drawn by keyed hash."""
    from simpairs.operators.sampling import hash_sample
    s = scored if max_rows is None else hash_sample(scored, "pair_id", max_rows, seed, "all_outcomes", ["model"])
    j = texts_of(s, pairs, clauses)
    return j.select("model", "pair_id", "clause1", "clause2", decode_label("label").alias("true_label"),
                    decode_label("predicted").alias("predicted_label"),
                    F.col("probability").cast("double").alias("probability"),
                    (F.col("label") == F.col("predicted")).alias("correct"))
