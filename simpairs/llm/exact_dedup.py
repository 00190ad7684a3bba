"""Operator 10, exact dedup by two-pass Bloom filtering.

Pass 1 builds a blocked counting Bloom filter over the SHA-256 digests of the normalised texts:
a digest names one block of 65,536 counters and four counters in it; what is stored is one bit
per counter, "hit at least twice". Equal texts hit the same counters, so a digest one of whose
bits is clear occurs once for certain. Pass 2 probes every row: rows that may repeat are grouped
by digest (an exact check on the full digest), all others pass straight through without a shuffle.

Scale: a map task sends a digest at most twice however often it occurs there, so a text that is
a third of all rows costs two entries per task. The filter has two bytes per row; it is
broadcast up to `BROADCAST_BYTES` and joined by block beyond that, to digests and ids alone. Groups are counted with partial
aggregation, so that a hot one is a row per task; the table of groups goes back to the rows by the same rule: up
to that size as a broadcast, beyond it by a join that AQE splits where a digest is hot.

Texts (`drop_duplicates`): they meet the table of the digests that do repeat, not the filter. Up to the bound it is broadcast
and no text is shuffled. Beyond it a second filter, over those digests, of `ROUTE_BYTES` at most at any size, is broadcast, and only rows
that hit it are shuffled. That filter has 16 bits a repeated digest up to 33.5 million of them, then fewer: a text that occurs once
hits it with probability 0.002 there, 0.16 at 134 million and 0.75 at 500 million.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simpairs.llm.common import BROADCAST_BYTES, bounded, boxed, cut, parts_for, whole_text

BLOCK_COUNTERS = 1 << 16
PROBES = 4
COUNTERS_PER_ROW = 16
ROUTE_BYTES = 64 << 20
_FLUSH_ROWS = 1 << 18


def normalised(text_col: str) -> Column:
    return F.regexp_replace(whole_text(text_col), r"[\x20\x09-\x0D]+", " ")


def digest(text_col: str) -> Column:
    return F.unhex(F.sha2(normalised(text_col), 256))


def _number(sha: Column, first: int, n: int) -> Column:
    return F.conv(F.hex(F.substring(sha, first, n)), 16, 10).cast("long")


def _block(sha: Column, blocks: int) -> Column:
    return F.pmod(_number(sha, 1, 7), F.lit(blocks)).cast("int")


def _hits(shas: list[bytes], blocks: int) -> pd.DataFrame:
    raw = np.frombuffer(b"".join(shas), dtype=np.uint8).reshape(-1, 32)
    own, counts = np.unique(np.ascontiguousarray(raw).view("V32").ravel(), return_counts=True)
    raw = own.view(np.uint8).reshape(-1, 32)
    raw = np.repeat(raw, np.minimum(counts, 2), axis=0)
    block = ((np.ascontiguousarray(raw[:, :8]).view(">u8").ravel() >> np.uint64(8)) % np.uint64(blocks)).astype(np.int64)
    at = np.ascontiguousarray(raw[:, 8:8 + 2 * PROBES]).view(">u2").astype("<u2")
    order = np.argsort(block, kind="stable")
    block, at = block[order], at[order]
    starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
    ends = np.r_[starts[1:], len(block)]
    return pd.DataFrame({"block": block[starts].astype(np.int32),
                         "hits": [at[a:b].tobytes() for a, b in zip(starts, ends)]})


def repeat_filter(digests: DataFrame, sha_col: str, rows: int, least: int = 2, most_bytes: int | None = None) -> tuple[DataFrame, int]:
    """Pass 1 -> (block, bits) and the number of blocks; `bits` marks counters hit `least` times. The size follows `rows`, up to
    `most_bytes` if given."""
    blocks = parts_for(rows * COUNTERS_PER_ROW, BLOCK_COUNTERS)
    if most_bytes is not None:
        blocks = min(blocks, max(1, most_bytes * 8 // BLOCK_COUNTERS))

    def emit(batches):
        held: list[bytes] = []
        for pdf in batches:
            held.extend(bytes(x) for x in pdf[sha_col])
            if len(held) >= _FLUSH_ROWS:
                yield _hits(held, blocks)
                held = []
        if held:
            yield _hits(held, blocks)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        at = np.frombuffer(b"".join(bytes(x) for x in pdf["hits"]), dtype="<u2").reshape(-1, PROBES)
        # a row whose probes coincide counts once per counter, so that it alone never looks repeated
        at = np.sort(at, axis=1).astype(np.int32)
        fresh = np.c_[np.ones(len(at), bool), at[:, 1:] != at[:, :-1]]
        counts = np.bincount(at[fresh], minlength=BLOCK_COUNTERS)
        return pd.DataFrame({"block": [int(pdf["block"].iloc[0])], "bits": [np.packbits(counts >= least).tobytes()]})

    hits = digests.select(sha_col).mapInPandas(emit, "block int, hits binary")
    return cut(hits.groupBy("block").applyInPandas(merge, "block int, bits binary")), blocks


def _probe(df: DataFrame, sha_col: str, filt: DataFrame, blocks: int, bound: int | None = None) -> DataFrame:
    """Pass 2: adds `__may_repeat`. A filter of at most `bound` bytes (`BROADCAST_BYTES`) is broadcast."""
    f = filt.select(F.col("block").alias("__block"), F.col("bits").alias("__bits"))
    if blocks * BLOCK_COUNTERS // 8 <= (BROADCAST_BYTES if bound is None else bound):
        f = F.broadcast(f)
    hit = F.lit(True)
    for k in range(PROBES):
        at = _number(F.col(sha_col), 9 + 2 * k, 2).cast("int")
        byte = F.conv(F.hex(F.substring(F.col("__bits"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = hit & (F.expr("1") == F.call_function("shiftright", byte, F.lit(7) - at % 8).bitwiseAND(F.lit(1)))
    return (df.withColumn("__block", _block(F.col(sha_col), blocks)).join(f, "__block", "left")
            .withColumn("__may_repeat", F.coalesce(hit, F.lit(False))).drop("__block", "__bits"))


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """-> one row per input row: `id_col`, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of ASCII white space became one blank. Null
    texts count as empty, and empty texts equal each other. The smallest id of a group stays; a null
    id stays only where its group has no other id. Rows repeating both id and text get the same answer
    each. An empty table gives no rows; other columns are not read."""
    keyed = cut(docs.select(F.col(id_col).alias("__id"), digest(text_col).alias("__sha")))
    filt, blocks = repeat_filter(keyed, "__sha", keyed.count())
    probed = _probe(keyed, "__sha", filt, blocks)
    sure = probed.where(~F.col("__may_repeat")).select(
        F.col("__id"), F.col("__id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "__sha")
    may = probed.where("__may_repeat").select("__id", "__sha")
    groups = cut(may.groupBy("__sha").agg(F.min("__id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    found = may.join(bounded(groups, groups.count(), 96), "__sha").select("__id", "keep_id", "group_size", "__sha")
    return sure.unionByName(found).select(
        F.col("__id").alias(id_col), "keep_id", "group_size", F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("__sha")).alias("text_sha256"))


def _repeated(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(sha, keep, copies): the digests that several rows have, the id that stays (null only where there is no other) and the number
    of rows that have both. Digests and ids are all that moves."""
    keyed = cut(docs.select(F.col(id_col).alias("id"), digest(text_col).alias("sha")))
    filt, blocks = repeat_filter(keyed, "sha", keyed.count())
    may = _probe(keyed, "sha", filt, blocks).where("__may_repeat").groupBy("sha", "id").agg(F.count(F.lit(1)).alias("copies"))
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "copies")).alias("first")
    return cut(may.groupBy("sha").agg(least, F.sum("copies").alias("n")).where("n > 1")
               .select("sha", F.col("first.id").alias("keep"), F.col("first.copies").alias("copies")))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with exactly its columns, whatever their names. No row is shuffled while the table of repeated
    digests can be broadcast; beyond that only rows whose digest may repeat. Of rows that repeat both id and text one stays.
    Nulls as in `mark_duplicates`; an empty table gives no rows."""
    groups = _repeated(docs, id_col, text_col)
    told = groups.agg(F.count(F.lit(1)).alias("n"), F.max("copies").alias("copies"),
                      F.max(F.octet_length(F.col("keep").cast("string"))).alias("id_bytes")).first()
    rows = boxed(docs, id=F.col(id_col), sha=digest(text_col))
    passed = None
    if told["n"] * (96 + (told["id_bytes"] or 0)) <= BROADCAST_BYTES:
        groups = F.broadcast(groups)
    else:
        filt, blocks = repeat_filter(groups, "sha", told["n"], least=1, most_bytes=ROUTE_BYTES)
        probed = _probe(rows, "sha", filt, blocks, bound=ROUTE_BYTES)
        passed, rows = probed.where("NOT __may_repeat").select("all.*"), probed.where("__may_repeat").drop("__may_repeat")
    judged = rows.join(groups, "sha", "left")
    stays = judged.where(F.col("copies").isNull() | (F.col("id").eqNullSafe(F.col("keep")) & (F.col("copies") == 1))).select("all.*")
    if (told["copies"] or 0) > 1:  # rows equal in id and text: one of them, by a partial aggregate
        same = judged.where(F.col("id").eqNullSafe(F.col("keep")) & (F.col("copies") > 1))
        stays = stays.unionByName(same.groupBy("sha").agg(F.first("all").alias("all")).select("all.*"))
    return stays if passed is None else passed.unionByName(stays)
