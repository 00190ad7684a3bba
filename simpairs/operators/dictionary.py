"""Dictionary form of array columns: each distinct value of a row once, with its positions.

Lookups of array elements then move one row per distinct value of an array instead of one per element, and
`regroup` puts the looked-up values back at their positions. All steps are built-in expressions: a
sort of (value, position) pairs inside the row, its run starts, and a slice per run - no step is quadratic in the array.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dictionary(df: DataFrame, values: Column, keep: list[str], value: str = "value") -> DataFrame:
    """`keep` columns, `value` and `at` (its 0-based positions, ascending): one row per distinct value of the row's
    array. A row without values is kept once, with a null value and null positions."""
    pairs = F.sort_array(F.transform(values, lambda v, i: F.struct(v.alias("v"), i.alias("p"))))
    d = df.select(*keep, pairs.alias("__s"))
    n = F.size("__s")
    fresh = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get("__s", i)["v"] != F.get("__s", i - 1)["v"]))
    d = d.withColumn("__first", F.when(n > 0, fresh).otherwise(F.array().cast("array<int>")))
    # a run's value and positions are cut out before the explode, so that no array is copied per distinct value
    d = d.withColumn("__end", F.concat(F.slice("__first", 2, F.greatest(F.size("__first"), F.lit(1))), F.array(n)))
    runs = F.zip_with("__first", "__end", lambda a, e: F.struct(
        F.get("__s", a)["v"].alias("v"), F.transform(F.slice("__s", a + 1, e - a), lambda x: x["p"]).alias("at")))
    d = d.select(*keep, F.explode_outer(F.when(n > 0, runs)).alias("__r"))
    return d.select(*keep, F.col("__r.v").alias(value), F.col("__r.at").alias("at"))


def regroup(rows: DataFrame, key: str, value: Column, present: Column, out: str) -> DataFrame:
    """(key, out): the array with `value` at each of its positions `at`. Rows that are not `present` add nothing, but
    keep their key."""
    g = rows.groupBy(key).agg(F.collect_list(F.when(present, F.struct(value.alias("v"), "at"))).alias("__g"))
    placed = F.flatten(F.transform("__g", lambda x: F.transform(x["at"], lambda p: F.struct(p.alias("p"), x["v"].alias("v")))))
    return g.select(key, F.transform(F.sort_array(placed), lambda x: x["v"]).alias(out))
