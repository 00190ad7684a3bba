"""Dictionary lookups whose keys may be very uneven.

`lookup` is a left join of rows with a table that has one row per key. Three cases:

* the table is small (its size is measured): it is broadcast, and no row moves;
* else the frequent keys are found with a mergeable frequent-items sketch over all rows. Their entries, at
  most `HOT_KEYS`, are broadcast, and their rows go through the join's exchange under keys of their own that
  deal them evenly over the tasks;
* all other keys are joined by shuffle.

Which keys count as frequent changes where rows go, never the result.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.sources.shared import checkpointed

#: a table is broadcast whole up to this many bytes
BROADCAST_BYTES = 64 << 20
#: bytes that an entry takes beside its key
ENTRY_BYTES = 64
#: a key with at least one row in SHARE is frequent; there are at most SHARE such keys
SHARE = 2000
HOT_KEYS = SHARE
#: entries of the sketch: its error is about 3.5 rows in TRACKED, well below one in SHARE
TRACKED = 32768
SPREAD = 1 << 16


def table_bytes(table: DataFrame, key: str, entry_bytes: int = ENTRY_BYTES) -> int:
    """Upper estimate of a table's size in memory: keys as text and `entry_bytes` for all else."""
    size = F.octet_length(F.col(key).cast("string")).cast("long") + entry_bytes
    return int(table.agg(F.sum(size).alias("b")).first()["b"] or 0)


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """(key): the keys that hold at least one in `SHARE` of the rows with a key. At most `HOT_KEYS` rows."""
    top = rows.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {TRACKED})").alias("__top"), F.count(F.lit(1)).alias("__n"))
    return (top.select(F.explode("__top").alias("__t"), "__n").where(F.col("__t.count") * SHARE >= F.col("__n"))
            .select(F.col("__t.item").alias(key)))


def lookup(rows: DataFrame, key: str, table: DataFrame, table_key: str | None = None,
           entry_bytes: int = ENTRY_BYTES) -> DataFrame:
    """All rows with the table's other columns, null where the key is missing from the table or null.

    `table` has one row per `table_key` (default: the name of `key`), and its other column names do not occur
    in `rows`. `entry_bytes`: what an entry takes beside its key. Rows that are equal in every column are dealt to one place."""
    table_key = table_key or key
    values = [c for c in table.columns if c != table_key]
    entries = table.select(F.col(table_key).alias("__k"), F.struct(*values).alias("__v"))
    out = [F.col(c) for c in rows.columns]
    if table_bytes(table, table_key, entry_bytes) <= BROADCAST_BYTES:
        found = rows.join(F.broadcast(entries), F.col(key) == F.col("__k"), "left")
        return found.select(*out, *[F.col(f"__v.{c}").alias(c) for c in values])
    hot = checkpointed(hot_keys(rows, key).withColumnRenamed(key, "__k"))
    known = entries.join(F.broadcast(hot), "__k")
    # a frequent key that the table lacks stays away from the shuffle's hot spots too
    none = hot.select("__k", F.lit(None).cast(entries.schema["__v"].dataType).alias("__v"))
    few = known.unionByName(none).groupBy("__k").agg(F.max("__v").alias("__hot_v")).withColumn("__hot", F.lit(True))
    tagged = rows.join(F.broadcast(few.withColumnRenamed("__k", "__hk")), F.col(key) == F.col("__hk"), "left")
    spread = F.pmod(F.xxhash64(*rows.columns), F.lit(SPREAD)) + 1
    # one struct as the join key: two columns would let the optimizer drop the constant one, and its spread with it
    own = F.when(F.col("__hot").isNull(), F.col(key)).alias("k")
    place = F.when(F.col("__hot") | F.col(key).isNull(), spread).otherwise(F.lit(0).cast("long")).alias("p")
    tagged = tagged.select(*out, "__hot_v", F.struct(own, place).alias("__own"))
    entries = entries.select(F.struct(F.col("__k").alias("k"), F.lit(0).cast("long").alias("p")).alias("__entry"), "__v")
    found = tagged.join(entries, F.col("__own") == F.col("__entry"), "left")
    value = F.coalesce("__hot_v", "__v")
    return found.select(*out, *[value[c].alias(c) for c in values])
