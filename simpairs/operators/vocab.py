"""Word counts, frequency-filtered vocabulary with first-appearance ids, corpus statistics."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from simpairs.functions.text import RESERVED_TOKENS, tokenize
from simpairs.operators.blocks import value_counts, words_of
from simpairs.operators.numbering import RANGE, number_rows, with_ranges
from simpairs.sources.shared import checkpointed, released


def tokens(clauses: DataFrame, max_pos: int | None = None) -> DataFrame:
    """clauses(category, clause_id, clause) -> (category, clause_id, pos, word), pos 0-based."""
    t = clauses.select("category", "clause_id", F.posexplode(tokenize("clause")).alias("pos", "word"))
    return t if max_pos is None else t.where(F.col("pos") < max_pos)


def _word_stats(clauses: DataFrame) -> DataFrame:
    """(word, cnt, cat_rank, clause_id, pos): counts, and the first appearance by (category name, clause_id, position).

    A block of clauses hands on each distinct word of a category once. Counts and first appearances are aggregated per (word, category)
    and then per word; all buffers are fixed-width numbers, so both are hash aggregates that start before the shuffle. Category
    ranks are joined to the aggregated words, never to texts."""
    own = value_counts(clauses, words_of(clauses), "category", "clause_id", "word")
    per = own.groupBy("word", "category").agg(
        F.sum("cnt").alias("cnt"), F.min("clause_id").alias("clause_id"), F.min_by("pos", "clause_id").alias("pos"))
    return per.join(_ranked(clauses), "category").groupBy("word").agg(
        F.sum("cnt").alias("cnt"), F.min_by("clause_id", "cat_rank").alias("clause_id"),
        F.min_by("pos", "cat_rank").alias("pos"), F.min("cat_rank").alias("cat_rank"))


def _ranked(clauses: DataFrame) -> DataFrame:
    """(category, cat_rank): categories in the order of their names."""
    return clauses.select("category").distinct().withColumn("cat_rank", F.row_number().over(Window.orderBy("category")))


def word_counts(clauses: DataFrame) -> DataFrame:
    """(word, cnt, first_category, first_clause_id, first_pos); first = earliest by
    (category name, clause_id, position)."""
    return _word_stats(clauses).join(_ranked(clauses), "cat_rank").select(
        "word", "cnt", F.col("category").alias("first_category"), F.col("clause_id").alias("first_clause_id"), F.col("pos").alias("first_pos"))


def reserved_vocab(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RESERVED_TOKENS, "word string, idx int")


def build_vocabulary(clauses: DataFrame, min_freq: int = 2) -> DataFrame:
    """vocab(word, idx): reserved ids 0..3, then words with cnt >= min_freq numbered
    4, 5, ... in order of first appearance.

    The word table (one row per word) and the vocabulary are made once, in the shared folder; words are numbered over quantile ranges of
    the first appearance, wherever in the corpus new words gather."""
    kept = checkpointed(_word_stats(clauses).where(F.col("cnt") >= min_freq))
    released(kept.sparkSession)
    low, high = (kept.select(f("clause_id").cast("double")).scalar() for f in (F.min, F.max))
    place = F.col("cat_rank") + (F.col("clause_id").cast("double") - low) / (high - low + 1.0)
    numbered = number_rows(with_ranges(kept, place), [F.col("cat_rank"), F.col("clause_id"), F.col("pos")], F.col(RANGE), (), "rn")
    words = numbered.select("word", (F.col("rn") + len(RESERVED_TOKENS) - 1).cast("int").alias("idx"))
    return reserved_vocab(clauses.sparkSession).unionByName(checkpointed(words))


def vocab_stats(vocab: DataFrame) -> DataFrame:
    n_special = len(RESERVED_TOKENS)
    return vocab.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.when(F.col("idx") < n_special, 1).otherwise(0)).cast("long").alias("special"),
        F.sum(F.when(F.col("idx") >= n_special, 1).otherwise(0)).cast("long").alias("regular"),
    )


def corpus_stats(clauses: DataFrame) -> DataFrame:
    """Categories, clauses, tokens and distinct words. Distinct words come from a grouped
    count, not a single-task countDistinct over all tokens."""
    base = clauses.agg(F.countDistinct("category").alias("n_categories"), F.count(F.lit(1)).alias("n_clauses"),
                       F.sum(F.size(tokenize("clause"))).cast("long").alias("n_tokens"))
    words = tokens(clauses).groupBy("word").count().agg(F.count(F.lit(1)).alias("n_distinct_words"))
    return base.select("*", words.select("n_distinct_words").scalar().alias("n_distinct_words"))


def category_sizes(clauses: DataFrame) -> DataFrame:
    return clauses.groupBy("category").agg(F.count(F.lit(1)).alias("n"))
