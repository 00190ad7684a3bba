"""Ordered numbering and running totals without a global window.

A plain `row_number() OVER (ORDER BY k)` (or `PARTITION BY` a hot key) moves every row of
the partition into one task. Here the order is cut into buckets by a caller-supplied
expression that is monotone in the order key:

  1. sizes / sums per (partition, bucket): a partial aggregate of the pruned input
  2. exclusive running totals over that small table -> offsets
  3. window inside each (partition, bucket): the one exchange of the rows themselves
  4. join of the offsets on the same, non-null key, so that the window's distribution is kept

The result equals the global window exactly, for any partitioning, as long as the order key
is unique within the partition. The bucket table has one row per bucket: `hash_bucket(h, n)`
takes about one bucket per `ROWS_PER_BUCKET` rows.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simpairs.functions.hashing import HASH_HEX_DIGITS

_KEY = "__key"
ROWS_PER_BUCKET = 1_000_000
#: quantile ranges of `with_ranges`: at most RANGES (a square number), each of about ROWS_PER_RANGE rows at least
RANGE = "__range"
RANGES = 1024
ROWS_PER_RANGE = 4096
#: size of the quantile sketch: its rank error is below 0.1 %
SKETCH_K = 4096


def row_count(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery (a pruned count scan; no job while the plan is built)."""
    return df.select(F.count(F.lit(1))).scalar()


def hash_bucket(hash_col: Column, rows: Column) -> Column:
    """Monotone bucket of a keyed hash: as many of its top bits as give about
    ROWS_PER_BUCKET rows each."""
    bits = F.least(F.lit(30), F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(rows, F.lit(1)) / F.lit(float(ROWS_PER_BUCKET)))))).cast("int")
    return F.call_function("shiftright", hash_col, F.lit(4 * HASH_HEX_DIGITS) - bits)


def with_ranges(df: DataFrame, value: Column) -> DataFrame:
    """`df` and `RANGE`: a monotone bucket of a numeric value, ranges between its quantiles however its values are spread.

    The quantiles come from a mergeable KLL sketch (a partial aggregate of the pruned input, a fixed size); a small table gets
    fewer ranges. Values that are equal as doubles share a bucket; a null is in the first one, NaN in the last."""
    step = int(RANGES ** 0.5)
    sketch = df.select(value.cast("double").alias("v")).agg(F.kll_sketch_agg_double("v", F.lit(SKETCH_K)).alias("s"), F.count("v").alias("n"),
                                         F.least(F.lit(float(RANGES)), F.ceil(F.count(F.lit(1)) / ROWS_PER_RANGE)).alias("used"))
    ranks = F.array(*[F.lit(k / RANGES) for k in range(1, RANGES)])
    q = sketch.select(F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("s", ranks)).alias("q"), "used")
    # two levels: every step-th edge, and the edges between two of them
    edges = q.select(F.struct(F.array(*[F.get("q", F.lit(step * j - 1)) for j in range(1, step)]).alias("coarse"),
                              F.array(*[F.slice("q", step * j + 1, step - 1) for j in range(step)]).alias("fine"), "used").alias("e"))
    d = df.withColumns({"__edges": edges.scalar(), "__v": value.cast("double")})
    reached = lambda x: F.size(F.filter(x, lambda e: e <= F.col("__v")))
    d = d.withColumn("__coarse", F.coalesce(reached(F.col("__edges.coarse")), F.lit(0)))
    fine = reached(F.get("__edges.fine", F.col("__coarse")))
    place = F.col("__coarse") * step + F.when(fine > 0, fine).otherwise(0)
    return d.select(*df.columns, F.coalesce(F.floor(place * F.col("__edges.used") / float(RANGES)), F.lit(0)).cast("long").alias(RANGE))


def _keyed(df: DataFrame, bucket: Column, pcols: Sequence[str]) -> DataFrame:
    # a struct is never null itself, whatever its fields: a plain equi-join key that matches nulls
    fields = [F.col(c).alias(f"p{k}") for k, c in enumerate(pcols)]
    return df.withColumn(_KEY, F.struct(*fields, bucket.alias("b")))


def _before(pcols: Sequence[str]):
    w = Window.partitionBy(*[F.col(f"{_KEY}.p{k}") for k in range(len(pcols))]).orderBy(F.col(f"{_KEY}.b"))
    return w.rowsBetween(Window.unboundedPreceding, -1)


def running_totals(
    df: DataFrame,
    values: Mapping[str, Column],
    order_cols: Sequence[Column],
    bucket: Column,
    partition_cols: Sequence[str] = (),
    inclusive: bool = True,
) -> DataFrame:
    """Add one running-total column per entry of `values`, ordered by `order_cols` within
    `partition_cols`. `bucket` must be non-decreasing along `order_cols`."""
    pcols, names = list(partition_cols), list(values)
    b = _keyed(df, bucket, pcols)
    sums = b.groupBy(_KEY).agg(*[F.sum(values[n]).alias(f"__s_{n}") for n in names])
    offs = sums.select(_KEY, *[F.coalesce(F.sum(f"__s_{n}").over(_before(pcols)), F.lit(0)).alias(f"__off_{n}") for n in names])
    frame_end = Window.currentRow if inclusive else -1
    inside = Window.partitionBy(_KEY).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, frame_end)
    w = b.select("*", *[F.coalesce(F.sum(values[n]).over(inside), F.lit(0)).alias(f"__in_{n}") for n in names])
    j = w.join(offs, _KEY)
    return j.select(*df.columns, *[(F.col(f"__off_{n}") + F.col(f"__in_{n}")).alias(n) for n in names])


def number_rows(
    df: DataFrame,
    order_cols: Sequence[Column],
    bucket: Column,
    partition_cols: Sequence[str] = (),
    name: str = "rn",
) -> DataFrame:
    """1-based `row_number()` over `order_cols` within `partition_cols`, computed bucket-wise."""
    pcols = list(partition_cols)
    b = _keyed(df, bucket, pcols)
    counts = b.groupBy(_KEY).agg(F.count(F.lit(1)).alias("__n"))
    offs = counts.select(_KEY, F.coalesce(F.sum("__n").over(_before(pcols)), F.lit(0)).alias("__off"))
    w = b.withColumn("__rib", F.row_number().over(Window.partitionBy(_KEY).orderBy(*order_cols)))
    return w.join(offs, _KEY).select(*df.columns, (F.col("__off") + F.col("__rib")).alias(name))
