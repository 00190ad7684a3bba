"""Sinks and reloads of run artifacts: vocabulary, prepared pairs, examples, results, histories.

Everything is written by the executors in parallel (Parquet / CSV / JSON lines); only
one-row-per-model report tables are coalesced to a single file.
"""
from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from simpairs.operators.history import HISTORY_COLS, history_columnar, history_from_columnar, normalise_history


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load_or_build(spark: SparkSession, path: str, builder: Callable[[], DataFrame], save: bool = True) -> DataFrame:
    """Read the artifact at `path` if present, else build it (and write it when `save`).
    Reading back the written table also gives later joins its real size statistics."""
    if _exists(spark, path):
        return spark.read.parquet(path)
    df = builder()
    if not save:
        return df
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def input_fingerprint(clauses: DataFrame) -> str:
    """Digest of a clause table's content: row count and an order-free sum of row hashes (one pass)."""
    h = F.xxhash64("category", "clause_id", "clause").cast("decimal(38,0)")
    r = clauses.agg(F.count(F.lit(1)).alias("n"), F.sum(h).alias("h")).first()
    return f"{r['n']}:{r['h']}"


def config_fingerprint(cfg, vocab_size: int | None = None, source: str = "") -> str:
    """Short stable digest of what a cached artifact depends on: parameters, vocabulary size, input."""
    d = dict(cfg.__dict__)
    d["vocab_size"], d["source"] = vocab_size, source
    return hashlib.sha256(json.dumps(d, sort_keys=True, default=str).encode()).hexdigest()[:12]


def load_or_build_vocab(spark: SparkSession, base: str, clauses: DataFrame, min_freq: int, source: str) -> DataFrame:
    """The saved vocabulary of this input and minimum frequency, else a new one (saved)."""
    from simpairs.operators.vocab import build_vocabulary
    key = hashlib.sha256(f"{min_freq}|{source}".encode()).hexdigest()[:12]
    return load_or_build(spark, f"{base.rstrip('/')}/vocab-{key}", lambda: build_vocabulary(clauses, min_freq).select("word", "idx"))


PAIR_COLS = ["pair_id", "seq1", "seq2", "label"]


def load_or_build_pairs(spark: SparkSession, base: str, cfg, builder: Callable[[], DataFrame], vocab_size: int | None = None,
                        source: str = "") -> DataFrame:
    """Prepared pairs saved for the same parameters, vocabulary size and input; missing, unreadable or
    incomplete ones are built and saved anew."""
    path = f"{base.rstrip('/')}/pairs-{config_fingerprint(cfg, vocab_size, source)}"
    if _exists(spark, path):
        try:
            saved = spark.read.parquet(path)
            if set(PAIR_COLS) <= set(saved.columns) and _exists(spark, f"{path}/_SUCCESS"):
                return saved
        except AnalysisException:
            pass
    builder().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_examples_csv(examples: DataFrame, path: str) -> None:
    """One folder per model and outcome (model=..., correct=...), header, no index."""
    (examples.write.mode("overwrite").option("header", True).option("escape", '"')
     .partitionBy("model", "correct").csv(path))


def write_report_csv(df: DataFrame, path: str) -> None:
    """Small per-model table as one CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def save_history_json(history: DataFrame, path: str) -> None:
    """Columnar JSON: per run one object {run, loss: [...], accuracy: [...], ...}."""
    history_columnar(history).write.mode("overwrite").json(path)


def save_history_csv(history: DataFrame, path: str) -> None:
    history.select(*HISTORY_COLS).write.mode("overwrite").option("header", True).csv(path)


def _file_stem(df: DataFrame) -> DataFrame:
    """`run` from the file name where the file has none."""
    if "run" in df.columns:
        return df
    stem = F.regexp_replace(F.url_decode(F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"\+", "%2B")), r"\.[^.]*$", "")
    return df.withColumn("run", stem)


_METRICS = {"loss", "accuracy", "val_loss", "val_accuracy", "train_loss", "train_accuracy"}


def load_history(spark: SparkSession, json_path: str | None = None, csv_path: str | None = None) -> DataFrame | None:
    """history(run, epoch, loss, accuracy, val_loss, val_accuracy) from JSON if there is a path and it exists, else
    from CSV, else None. JSON: objects {metric: [..]} with or without run and epoch lists, one per line or one (indented)
    per file; CSV: a row per epoch. Either key set of the metrics; a missing run is the file's name, missing epochs are
    numbered by position. A JSON that exists but cannot be parsed gives None: it does not fall through to CSV."""
    if json_path and _exists(spark, json_path):
        for multi in (False, True):
            df = spark.read.option("multiLine", multi).json(json_path)
            if "_corrupt_record" not in df.columns and _METRICS & set(df.columns):
                return history_from_columnar(_file_stem(df))
        return None
    if csv_path and _exists(spark, csv_path):
        try:
            df = _file_stem(spark.read.option("header", True).csv(csv_path))
        except AnalysisException:
            return None
        if not _METRICS & set(df.columns):
            return None
        if "epoch" not in df.columns:  # rows of one file in their order: a file has as many rows as epochs
            df = df.withColumn("__at", F.monotonically_increasing_id())
            df = df.withColumn("epoch", F.row_number().over(Window.partitionBy("run").orderBy("__at")) - 1)
        run = F.col("run").cast("long")
        whole = df.where(F.col("run").isNotNull() & F.expr("try_cast(run AS BIGINT)").isNull()).limit(1).count() == 0
        return normalise_history(df.withColumn("run", run if whole else F.col("run")).withColumn("epoch", F.col("epoch").cast("int")))
    return None
