"""Access to the driver's parquet tables and the clause corpora derived from them."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simpairs.functions.text import DRAFT, clean_text, draft_text, null_to_nan

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """A scan of fewer partitions than the cluster has cores is dealt out by `key` before the costly text work above it,
    about a MB of its (compressed) size a task at least. Partitions and size are read from the plan; no job runs."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = df._jdf.queryExecution().toRdd().getNumPartitions()
    if parts >= cores:
        return df
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    wanted = min(cores, size >> 20)
    return df.repartition(wanted, key) if wanted > parts else df


def clean_clauses(df: DataFrame, text_col: str, null_policy: str = "literal_nan") -> DataFrame:
    """Apply the null policy and the cleaning chain to `text_col` -> `clause`."""
    if null_policy == "drop":
        df = df.where(F.col(text_col).isNotNull())
        raw = F.col(text_col)
    elif null_policy == "literal_nan":
        raw = null_to_nan(text_col)
    else:
        raise ValueError(f"unknown null_policy {null_policy!r}")
    return df.withColumn("clause", clean_text(raw))


def document_clauses(
    spark: SparkSession, sf_dir: str, category_expr: str = "lang", null_policy: str = "literal_nan"
) -> DataFrame:
    """documents -> clauses(category, clause_id, clause); category is any SQL expression."""
    docs = table(spark, sf_dir, "documents")
    df = spread(docs.select(F.expr(category_expr).cast("string").alias("category"),
                            F.col("doc_id").alias("clause_id"), "text"), "clause_id")
    return clean_clauses(df, "text", null_policy).select("category", "clause_id", "clause")


def document_drafts(spark: SparkSession, sf_dir: str, category_expr: str = "lang") -> DataFrame:
    """documents -> (category, clause_id, draft): `document_clauses` for operators on words, which clean and cut texts in their tasks."""
    df = spread(table(spark, sf_dir, "documents").select(
        F.expr(category_expr).cast("string").alias("category"), F.col("doc_id").alias("clause_id"), "text"), "clause_id")
    return df.select("category", "clause_id", draft_text(null_to_nan("text")).alias(DRAFT))


def embedding_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings -> (category, clause_id, embedding DOUBLE[]); category = label."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("label").cast("string").alias("category"), F.col("vec_id").alias("clause_id"),
                      F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
