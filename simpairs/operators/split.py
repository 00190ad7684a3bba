"""Exact stratified train / validation / test split.

Quotas follow the usual stratified-shuffle-split arithmetic: n_test = ceil(test * n), the
rest is temp; per stratum the temp quota is the floor of the proportional share plus one
for the largest remainders (ties: ascending stratum); test takes what is left. The temp
part is split the same way with val_adj = val / (1 - test). Rows are then taken in a
keyed-hash order inside each stratum (bucketed numbering, so a two-valued stratum is not
two tasks).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simpairs.config import PairConfig
from simpairs.operators.sampling import hash_rank


def _approximate_mode(counts: Column, n_draws: Column, strata: str) -> Column:
    """Per-stratum integer quotas summing to n_draws (over a small strata table)."""
    whole = Window.partitionBy()
    cont = counts / F.sum(counts).over(whole) * n_draws
    fl = F.floor(cont)
    need = n_draws - F.sum(fl).over(whole)
    rk = F.row_number().over(Window.orderBy((cont - fl).desc(), F.col(strata).asc()))
    return (fl + F.when(rk <= need, 1).otherwise(0)).cast("long")


def split_quotas(df: DataFrame, strata: str, test_size: float = 0.2, val_size: float = 0.1) -> DataFrame:
    """(strata, cnt, n_train, n_val, n_test) - one row per stratum."""
    counts = df.groupBy(strata).agg(F.count(F.lit(1)).alias("cnt"))
    whole = Window.partitionBy()
    q = counts.withColumn("__n", F.sum("cnt").over(whole))
    q = q.withColumn("__n_temp", F.col("__n") - F.ceil(F.lit(float(test_size)) * F.col("__n").cast("double")))
    q = q.withColumn("__temp", _approximate_mode(F.col("cnt"), F.col("__n_temp"), strata))
    val_adj = float(val_size) / (1.0 - float(test_size))
    q = q.withColumn("__n_tr", F.col("__n_temp") - F.ceil(F.lit(val_adj) * F.col("__n_temp").cast("double")))
    q = q.withColumn("__tr", _approximate_mode(F.col("__temp"), F.col("__n_tr"), strata))
    q = q.withColumn("__min", F.min("cnt").over(whole))
    return q.select(
        strata, "cnt",
        F.when(F.col("__min") < 2, F.raise_error(F.lit("every stratum needs at least 2 rows")))
        .otherwise(F.col("__tr")).alias("n_train"),
        (F.col("__temp") - F.col("__tr")).alias("n_val"),
        (F.col("cnt") - F.col("__temp")).alias("n_test"))


def stratified_split(df: DataFrame, key: str, strata: str, cfg: PairConfig = PairConfig(),
                     tag: str = "split") -> DataFrame:
    """Add `split` in {train, val, test}; `key` must be unique."""
    q = split_quotas(df, strata, cfg.test_size, cfg.val_size).select(strata, "n_train", "n_val")
    ranked = hash_rank(df, key, cfg.seed, tag, [strata], "__r")
    j = ranked.join(q, strata)
    split = (F.when(F.col("__r") <= F.col("n_train"), "train")
             .when(F.col("__r") <= F.col("n_train") + F.col("n_val"), "val").otherwise("test"))
    return j.withColumn("split", split).drop("__r", "n_train", "n_val")


def split_sizes(split_df: DataFrame, strata: str = "label") -> DataFrame:
    return split_df.groupBy("split", strata).agg(F.count(F.lit(1)).alias("n"))
