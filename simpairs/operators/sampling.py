"""Reproducible hash-ordered samples (exact k, without replacement)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simpairs.functions.hashing import keyed_hash
from simpairs.operators.numbering import RANGE, ROWS_PER_BUCKET, hash_bucket, number_rows, row_count, with_ranges


def hash_rank(df: DataFrame, key: str, seed: int, tag: str, partition_cols: Sequence[str] = (),
              name: str = "rank") -> DataFrame:
    """1-based rank of each row in the order of h(seed, tag, key), ties by key."""
    d = df.withColumn("__h", keyed_hash(seed, tag, key))
    out = number_rows(d, [F.col("__h"), F.col(key)], hash_bucket(F.col("__h"), row_count(df)), partition_cols, name)
    return out.drop("__h")


#: up to so many rows a sample is one task's top-k; a larger one is found by its threshold
TOP_K_ROWS = ROWS_PER_BUCKET


def hash_sample(df: DataFrame, key: str, k: int, seed: int, tag: str, partition_cols: Sequence[str] = ()) -> DataFrame:
    """Exactly min(k, n) rows (of each partition) chosen uniformly without replacement: those of the least hash, ties by
    key. A small k is a top-k by hash (each task keeps k rows, nothing is ranked), or, with partitions, a rank limit that runs
    before the shuffle; beyond `TOP_K_ROWS` see `threshold_select`."""
    d = df.withColumn("__h", keyed_hash(seed, tag, key))
    if k > TOP_K_ROWS:
        return threshold_select(d, key, F.lit(k), partition_cols).select(*df.columns)
    if not partition_cols:
        return d.orderBy("__h", key).limit(k).drop("__h")
    w = Window.partitionBy(*partition_cols).orderBy("__h", key)
    return d.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k).drop("__r", "__h")


def fraction_sample(df: DataFrame, key: str, fraction: float, seed: int, tag: str, partition_cols: Sequence[str] = ()) -> DataFrame:
    """int(n * fraction) rows, exact, of all rows or of each partition."""
    d = df.withColumn("__h", keyed_hash(seed, tag, key))
    return threshold_select(d, key, F.floor(F.col("__all") * F.lit(fraction)), partition_cols).select(*df.columns)


def threshold_select(d: DataFrame, key: str, k: Column, partition_cols: Sequence[str] = ()) -> DataFrame:
    """The min(k, n) rows of the least (`__h`, key), in each partition, for any k. `k` may use `__all`, the partition's rows.

    A histogram of hash prefixes (a partial aggregate; as many prefixes as give about 60,000 rows each) says which prefix holds
    the cut of a partition. Rows below it pass where they are, those above go; only the rows of the edge prefixes
    are shuffled and ranked. So k rows never meet in one task, and no partition does either."""
    pcols = list(partition_cols)
    part = F.struct(*[F.col(c).alias(f"p{j}") for j, c in enumerate(pcols)], F.lit(0).alias("z"))
    d = d.withColumns({"__p": part, "__b": hash_bucket(F.col("__h"), row_count(d) * F.lit(16))})
    sizes = d.groupBy("__p", "__b").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy("__p")
    upto = sizes.withColumns({"__upto": F.sum("__n").over(w.orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)),
                              "__all": F.sum("__n").over(w)}).withColumn("__k", k.cast("long"))
    # the first prefix that reaches the cut; none where every row is wanted
    edge = upto.where(F.col("__upto") > F.col("__k")).groupBy("__p").agg(
        F.min(F.struct("__b", (F.col("__k") - F.col("__upto") + F.col("__n")).alias("more"))).alias("__e"))
    cut = d.join(edge.select("__p", F.col("__e.__b").alias("__at"), F.col("__e.more").alias("__more")), "__p", "left")
    below = cut.where(F.col("__at").isNull() | (F.col("__b") < F.col("__at")))
    rank = F.row_number().over(Window.partitionBy("__p").orderBy("__h", key))
    last = cut.where(F.col("__b") == F.col("__at")).withColumn("__r", rank).where(F.col("__r") <= F.col("__more"))
    names = [c for c in d.columns if c not in ("__p", "__b")]
    return below.select(*names).unionByName(last.select(*names))


def reshuffle_order(df: DataFrame, key: str, seed: int, epoch: int) -> DataFrame:
    """Per-epoch training order (only when a consumer needs an order)."""
    return df.orderBy(keyed_hash(seed, f"epoch{epoch}", key), key)


def batch_numbers(df: DataFrame, order_key: str, batch_size: int, seed: int | None = None) -> DataFrame:
    """Add `batch` = floor((row_no - 1) / batch_size) (0-based) and `n_batches` =
    ceil(n / batch_size). Rows are numbered by the numeric `order_key` (sequential loading)
    or, with `seed`, in keyed-hash order (shuffled loading)."""
    total = row_count(df)
    if seed is not None:
        n = hash_rank(df, order_key, seed, "batch", (), "__rn")
    else:
        n = number_rows(with_ranges(df, F.col(order_key)), [F.col(order_key)], F.col(RANGE), (), "__rn")
    return n.select(*df.columns, F.floor((F.col("__rn") - 1) / batch_size).cast("long").alias("batch"),
                    F.ceil(total / F.lit(batch_size)).cast("long").alias("n_batches"))
