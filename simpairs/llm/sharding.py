"""Operator 6, sharding by extendible hashing, in DataFrame functions only.

A row's hash is 60 bits of MD5 over its id and text. The directory is indexed by hash-prefix bits: bucket
(depth, prefix) splits on the next bit only while it holds more than `limit` bytes, so every shard is the
shortest prefix that fits. Bytes are summed once per cell of a first depth (a few bits more than an even split needs)
and rolled up to all shorter prefixes; only cells that are still too large are summed again some bits deeper.

Scale: rows never move to build the directory; the sums are partial aggregates, and the directory has about
as many rows as there are shards. It stays a table, joined to the rows by cell. A single row beyond the limit, or equal
rows that together are, cannot be split: their shard has `fits` false.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simpairs.llm.common import boxed, cut, free_name, whole_text

HASH_BITS = 60
SHARD_BYTES = 1 << 20
FIRST_EXTRA_BITS, STEP_BITS, ROLL_BITS = 3, 8, 4


def row_hash(id_col: str, text_col: str) -> Column:
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.md5(whole_text(text_col)))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(h, depth) -> Column:
    """The first `depth` bits; depth may be a column."""
    return F.call_function("shiftright", h, F.lit(HASH_BITS) - depth)


def _level(rows: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """rows(h, b): leaves for the cells of depth `high` -> (cell, depth, prefix, shard_bytes, shard_rows, fits); prefixes shorter than
    `low` are known to be too large. A cell that does not fit comes with fits false.

    Sums roll up `ROLL_BITS` depths at a time; beyond those only the sums of the shortest prefixes go on, a 2^ROLL_BITS-th of the
    cells, and only while some of them fit."""
    units = cut(rows.groupBy(_prefix(F.col("h"), F.lit(high)).alias("cell")).agg(F.sum("b").alias("b"), F.count(F.lit(1)).alias("n")))
    steps, at = [], high
    while True:
        least = max(low, at - ROLL_BITS)
        each = (units.withColumn("depth", F.explode(F.sequence(F.lit(least), F.lit(at))))
                .withColumn("prefix", F.call_function("shiftright", F.col("cell"), F.lit(at) - F.col("depth"))))
        nodes = cut(each.groupBy("depth", "prefix").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_rows")))
        # of a cell's prefixes that fit, the shortest is its shard; prefixes of one that fits all fit
        fits = nodes.where((F.col("shard_bytes") <= limit) | (F.col("depth") == at))
        best = cut(each.select("cell", "depth", "prefix").join(fits, ["depth", "prefix"])
                   .groupBy("cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_rows")).alias("s")).select("cell", "s.*"))
        goes_on = (F.col("depth") == least) & (F.col("shard_bytes") <= limit)
        steps.append((best, goes_on))
        if least == low or not best.where(goes_on).limit(1).count():
            break
        units = nodes.where(F.col("depth") == least).select(F.col("prefix").alias("cell"), F.col("shard_bytes").alias("b"), F.col("shard_rows").alias("n"))
        at = least
    leaves = steps.pop()[0]
    for best, goes_on in reversed(steps):
        shorter = leaves.withColumnRenamed("cell", "of")
        leaves = best.where(~goes_on).unionByName(
            best.where(goes_on).select("cell", F.col("prefix").alias("of")).join(shorter, "of").drop("of"))
    return cut(leaves.withColumn("fits", F.col("shard_bytes") <= limit))


def assign(docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` plus __shard (its prefix bits as a string, '' for the whole), __depth, __shard_bytes, __shard_rows, __fits.

    Bytes are those of the text; null texts and null ids count as empty and are sharded like others. Rows equal in id and
    text share a shard. Columns of `docs` come back whatever their names; beside one of the same name a new column gets
    underscores before its own. An empty table gives no rows."""
    base = docs.select(row_hash(id_col, text_col).alias("h"), F.octet_length(whole_text(text_col)).cast("long").alias("b"))
    rows = cut(base)
    total = rows.agg(F.sum("b").alias("b")).first()["b"] or 0
    low, high = 0, min(HASH_BITS, max(0, math.ceil(math.log2(max(1, total / limit)))) + FIRST_EXTRA_BITS)
    out, levels = boxed(docs, h=row_hash(id_col, text_col)), []
    while True:
        leaves = _level(rows, low, high, limit)
        levels.append(high)
        last = high == HASH_BITS
        k = len(levels)
        kept = leaves if last else leaves.where("fits")
        found = kept.select(F.col("cell").alias(f"cell_{k}"), F.struct("depth", "prefix", "shard_bytes", "shard_rows", "fits").alias(f"leaf_{k}"))
        out = out.withColumn(f"cell_{k}", _prefix(F.col("h"), F.lit(high))).join(found, f"cell_{k}", "left")
        large = leaves.where("NOT fits").select("cell")
        if last or not large.limit(1).count():
            break
        rows = cut(rows.withColumn("cell", _prefix(F.col("h"), F.lit(high))).join(large, "cell", "left_semi").select("h", "b"))
        low, high = high + 1, min(HASH_BITS, high + STEP_BITS)
    leaf = F.coalesce(*[F.col(f"leaf_{k + 1}") for k in range(len(levels))])
    bits = F.when(leaf["depth"] > 0, F.lpad(F.bin(leaf["prefix"]), leaf["depth"], F.lit("0"))).otherwise(F.lit(""))
    new = {"__shard": bits, "__depth": leaf["depth"], "__shard_bytes": leaf["shard_bytes"], "__shard_rows": leaf["shard_rows"],
           "__fits": leaf["fits"]}
    return out.select("all.*", *[c.alias(free_name(docs, n)) for n, c in new.items()])


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """One folder per shard under `path`; rows are shuffled once, by shard. The folders are named shard=b<bits>, with underscores
    before that name where `docs` has such a column."""
    shard = free_name(docs, "shard")
    bits = F.concat(F.lit("b"), F.col(free_name(docs, "__shard"))).alias(shard)
    (assign(docs, limit, id_col, text_col).select(bits, *[F.col(f"`{c}`") for c in docs.columns])
     .repartition(shard).write.partitionBy(shard).parquet(path))
