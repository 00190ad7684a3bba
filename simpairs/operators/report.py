"""Per-model report tables: results, metric matrix, formatted summary, timing."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.config import PairConfig
from simpairs.operators.examples import first_by_outcome

METRIC_COLS = ["accuracy", "precision", "recall", "f1_score", "roc_auc", "pr_auc"]


def run_timestamp() -> F.Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")


def split_counts(split_df: DataFrame, model: str) -> DataFrame:
    """(model, training_samples, validation_samples, test_samples) from a split table."""
    def n(s):
        return F.sum(F.when(F.col("split") == s, 1).otherwise(0)).cast("long")
    return split_df.agg(n("train").alias("training_samples"), n("val").alias("validation_samples"),
                        n("test").alias("test_samples")).select(F.lit(model).alias("model"), "*")


def model_comparison(metrics: DataFrame, sizes: DataFrame, cfg: PairConfig = PairConfig(),
                     vocabulary_size=None, with_timestamp: bool = True) -> DataFrame:
    """Results table, one row per model: metrics + run parameters + data sizes."""
    v = vocabulary_size if vocabulary_size is not None else F.lit(None)
    v = v if isinstance(v, F.Column) else F.lit(v)
    out = metrics.join(sizes, "model", "left").select(
        "model", *METRIC_COLS, F.lit(cfg.epochs).alias("epochs"), F.lit(cfg.batch_size).alias("batch_size"),
        F.lit(cfg.learning_rate).alias("learning_rate"), "training_samples", "validation_samples", "test_samples",
        v.cast("long").alias("vocabulary_size"))
    return out.withColumn("timestamp", run_timestamp()) if with_timestamp else out


def metric_matrix(metrics: DataFrame, models: list[str]) -> DataFrame:
    """metric x model, missing -> 0 (the table behind a grouped bar chart)."""
    long = metrics.unpivot("model", METRIC_COLS, "metric", "value")
    return long.groupBy("metric").pivot("model", models).agg(F.first("value")).na.fill(0.0)


def _f4(c: F.Column) -> F.Column:
    # round with IEEE steps first, so every formatter prints the same 4 digits
    return F.format_string("%.4f", F.floor(c * 1e4 + 0.5) / 1e4)


def summary_table(metrics: DataFrame, scored: DataFrame, n: int = 10) -> DataFrame:
    """Formatted summary per model, with the sizes of the example samples."""
    ex = first_by_outcome(scored, n).groupBy("model").agg(
        F.sum(F.when(F.col("correct"), 1).otherwise(0)).cast("long").alias("Correct (Sample)"),
        F.sum(F.when(F.col("correct"), 0).otherwise(1)).cast("long").alias("Incorrect (Sample)"))
    m = metrics.join(ex, "model", "left")
    return m.select(F.col("model").alias("Model"), _f4(F.col("accuracy")).alias("Accuracy"),
                    _f4(F.col("precision")).alias("Precision"), _f4(F.col("recall")).alias("Recall"),
                    _f4(F.col("f1_score")).alias("F1-Score"), _f4(F.col("roc_auc")).alias("ROC-AUC"),
                    F.coalesce("Correct (Sample)", F.lit(0)).alias("Correct (Sample)"),
                    F.coalesce("Incorrect (Sample)", F.lit(0)).alias("Incorrect (Sample)"))


def throughput(timing: DataFrame) -> DataFrame:
    """timing(model, eval_s, n: rows scored) + samples_per_s, null for a time of 0."""
    return timing.withColumn("samples_per_s", F.when(F.col("eval_s") > 0, F.col("n") / F.col("eval_s")))


def _f2(c: F.Column) -> F.Column:
    # format_string prints a null as text, so nulls are kept out of it
    return F.when(c.isNotNull(), F.format_string("%.2f", F.floor(c * 100 + 0.5) / 100))


def accuracy_time_table(metrics: DataFrame, timing: DataFrame) -> DataFrame:
    """Accuracy, F1, ROC-AUC and PR-AUC next to evaluation time and throughput; models without timing keep nulls."""
    return metrics.join(timing, "model", "left").select(
        "model", *[_f4(F.col(c)).alias(c) for c in ("accuracy", "f1_score", "roc_auc", "pr_auc")],
        _f2(F.col("eval_s")).alias("eval_seconds"), _f2(F.col("samples_per_s")).alias("samples_per_second"))
