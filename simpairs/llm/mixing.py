"""Operator 5, mixing sources to target weights by Pfair scheduling.

The documents of a source, in the order of a keyed hash, form blocks of `block_rows`. Target weights are shares f_s
of a frame of `frame` slots, one block per slot. Block j of a source is released at floor(j * F / f_s) and due at
ceil((j + 1) * F / f_s), where F is the sum of the shares of the sources that still have blocks; of the released blocks the one due
earliest takes the slot. So before every slot t of a phase a source has had t * f_s / F blocks, give or take less than one.
When a source has no blocks left, a new phase starts with the shares of the others. Each row gets
one place: nothing is dropped or repeated.

Scale: a schedule repeats after F slots, so one frame per phase (at most sources * frame numbers, from per-source
counts alone) places any number of blocks by arithmetic. Ranks inside a source come from counts per (source,
hash range), so a source that holds a third of all rows is numbered in as many tasks as its rows need.
"""
from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simpairs.llm.common import bounded, boxed, cut, parts_for

BLOCK_ROWS = 32
FRAME = 4096
TEMPERATURE = 0.7
RANGE_ROWS = 20_000


def frame_shares(weights: dict[str, float], frame: int) -> dict[str, int]:
    """Whole shares of a frame, at least one each, by largest remainder; sums to max(frame, sources)."""
    total = sum(weights.values())
    if total <= 0 or any(w < 0 for w in weights.values()):
        raise ValueError("weights must not be negative, and one must be positive")
    frame = max(frame, len(weights))
    exact = {s: w * frame / total for s, w in weights.items()}
    shares = {s: max(1, int(x)) for s, x in exact.items()}
    by_rest = sorted(weights, key=lambda s: (shares[s] - exact[s], s))
    k = 0
    while (gap := frame - sum(shares.values())) != 0:
        s = by_rest[k % len(by_rest)] if gap > 0 else max(shares, key=lambda x: (shares[x], x))
        shares[s] += 1 if gap > 0 else -1
        k += 1
    return shares


def frame_schedule(shares: dict[str, int]) -> dict[str, list[int]]:
    """Earliest deadline first over one frame: the slots of each source."""
    size = sum(shares.values())
    window = lambda s, j: (j * size // shares[s], -(-(j + 1) * size // shares[s]))
    waiting = [(0, s, 0) for s in sorted(shares)]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slots: dict[str, list[int]] = {s: [] for s in shares}
    for t in range(size):
        while waiting and waiting[0][0] <= t:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (window(s, j)[1], s, j))
        _, s, j = heapq.heappop(ready)
        slots[s].append(t)
        if j + 1 < shares[s]:
            heapq.heappush(waiting, (max(window(s, j + 1)[0], t + 1), s, j + 1))
    return slots


def phases(blocks: dict[str, int], shares: dict[str, int]) -> list[dict]:
    """Runs until a source ends: per phase its first slot, frame size and, per source, first block, end block, slots."""
    left = {s: n for s, n in blocks.items() if n}
    done = dict.fromkeys(left, 0)
    out, first = [], 0
    while left:
        own = {s: shares[s] for s in left}
        slots = frame_schedule(own)
        size = sum(own.values())
        end = 1 + min((n - 1) // own[s] * size + slots[s][(n - 1) % own[s]] for s, n in left.items())
        took = {s: end // size * own[s] + int(np.searchsorted(slots[s], end % size)) for s in left}
        out.append({"first": first, "size": size,
                    "sources": {s: (done[s], done[s] + took[s], slots[s]) for s in left}})
        done = {s: done[s] + took[s] for s in left}
        left = {s: n - took[s] for s, n in left.items() if n > took[s]}
        done = {s: done[s] for s in left}
        first += end
    return out


def place(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id", source_col: str = "source",
          block_rows: int = BLOCK_ROWS, frame: int = FRAME, temperature: float = TEMPERATURE, seed: int = 5) -> DataFrame:
    """-> one row per input row: `id_col`, `source_col`, share, block, slot, release, due, position.

    `weights` per source name (the name of null is ""); without them the weight is rows ** temperature. A
    source that `weights` lacks gets the smallest of them, none is dropped. `position` orders the rows: slot * block_rows + place in the block; the
    last block of a source may be short. Rows repeating an id stay in one hash range and get places of their own; null ids are
    ordinary. Empty table: no rows. Other columns are not read."""
    name = F.coalesce(F.col(source_col).cast("string"), F.lit(""))
    key = F.xxhash64(F.col(id_col).cast("string"), F.lit(seed))
    base = docs.select(F.col(id_col).alias("__id"), F.col(source_col).alias("__source"), name.alias("__name"), key.alias("__key"))
    bits = max(0, int(parts_for(base.count(), RANGE_ROWS) - 1).bit_length())
    # hash ranges in the order of the signed key
    base = base.withColumn("__range", F.shiftright("__key", 64 - bits) if bits else F.lit(0).cast("long"))
    counts = cut(base.groupBy("__name", "__range").agg(F.count(F.lit(1)).alias("n")))
    starts = counts.select("__name", "__range", (F.sum("n").over(
        Window.partitionBy("__name").orderBy("__range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("__start"))
    rows = {r["__name"]: r["n"] for r in counts.groupBy("__name").agg(F.sum("n").alias("n")).collect()}
    if weights is None:
        weights = {s: n ** temperature for s, n in rows.items()}
    lowest = min((w for w in weights.values() if w > 0), default=1.0)
    weights = {s: max(weights.get(s, 0.0), 0.0) or lowest for s in rows}
    shares = frame_shares(weights, frame) if rows else {}
    plan = phases({s: -(-n // block_rows) for s, n in rows.items()}, shares)
    table = [(s, lo, hi, p["first"], p["size"], shares[s], slots)
             for p in plan for s, (lo, hi, slots) in p["sources"].items() if hi > lo]
    spark = docs.sparkSession
    sched = spark.createDataFrame(table, "__name string, lo long, hi long, first long, size long, share long, slots array<int>")
    in_range = Window.partitionBy("__name", "__range").orderBy("__key", "__id")
    ranked = (base.join(starts, ["__name", "__range"])
              .withColumn("__rank", F.col("__start") + F.row_number().over(in_range) - 1)
              .withColumn("block", F.floor(F.col("__rank") / block_rows)))
    j = F.col("block") - F.col("lo")
    turn = F.col("first") + F.floor(j / F.col("share")) * F.col("size")
    sched = bounded(sched, len(table), 64 + 4 * max(len(r[-1]) for r in table)) if table else sched
    return (ranked.join(sched, (ranked["__name"] == sched["__name"]) & (F.col("block") >= F.col("lo")) & (F.col("block") < F.col("hi")))
            .withColumn("slot", turn + F.get(F.col("slots"), (j % F.col("share")).cast("int")))
            .select(F.col("__id").alias(id_col), F.col("__source").alias(source_col),
                    (F.col("share") / F.col("size")).alias("share"), "block", "slot",
                    (F.col("first") + F.floor(j * F.col("size") / F.col("share"))).alias("release"),
                    (F.col("first") + F.ceil((j + 1) * F.col("size") / F.col("share"))).alias("due"),
                    (F.col("slot") * block_rows + F.col("__rank") % block_rows).alias("position")))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """All rows of `docs`, with its columns, whatever their names, in mixed order: partitions are ranges of positions and rows are sorted
    in them. Rows repeating an id stand together, at the first of their places; rows with null ids stand first. Rows at one
    position are ordered, and spread over partitions, by a hash of the row."""
    at = cut(place(docs, weights, id_col, source_col, **options).where(F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("at_id")).agg(F.min("position").alias("position")))
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    rows = boxed(docs, id=F.col(id_col), tie=F.xxhash64(*plain))
    joined = rows.join(bounded(at, at.count(), 24), F.col("id") == F.col("at_id"), "left")
    return joined.repartitionByRange("position", "tie").sortWithinPartitions("position", "tie").select("all.*")
