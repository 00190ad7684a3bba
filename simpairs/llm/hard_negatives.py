"""Operator 12, hard-negative mining by a secondary-sort shuffle.

Scores are integer inner products of vectors whose components are floor(scale * x).

1. The rows that take part are packed into blocks of at most `BLOCK` rows. The anchors are a stated query set: they
   are sent to all blocks in waves of at most `WAVE_BYTES`, so no wave grows with the data.
2. Positives: each block scores its rows of an anchor's label and hands on its own best ones (the best of all are
   among them); a rank window over the few that are left picks the anchor's positives.
3. Negatives: each block scores its rows of other labels and hands on, for each positive of an anchor, the first
   ones of its score window. Again the first ones of all rows are among them.
4. Positives and negatives are shuffled with keys (anchor, descending score, kind, id): dealt by anchor, sorted within the
   partitions. A streaming iterator reads them once: a positive opens its window, a negative is emitted for
   every open window it lies in, a window closes when it is served or passed. It holds one anchor's open
   windows and nothing else, however many rows an anchor has.

Scores are exact: by floating point below 2^53, by 64-bit integers above; vectors whose inner product might not fit
64 bits raise an error.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from simpairs.llm.common import Scratch, cut, parts_for

BLOCK = 2048
WAVE_BYTES = 16 << 20
#: anchors scored against a block at a time
TILE = 512


def quantised(rows: DataFrame, id_col: str, label_col: str, vec_col: str, anchor: Column, scale: int) -> DataFrame:
    """(id, label, anchor, q): the rows that take part, one per id."""
    x = F.col(vec_col)
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    q = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    ready = rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & sound).select(
        F.col(id_col).cast("long").alias("id"), F.struct(F.col(label_col).cast("long").alias("label"), q.alias("q"),
                                                       F.coalesce(anchor, F.lit(False)).alias("anchor")).alias("r"))
    return ready.groupBy("id").agg(F.min("r").alias("r")).select("id", "r.label", "r.anchor", "r.q")


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of a list array as an int64 matrix; shorter vectors end in zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(sizes.max()) if len(sizes) else 0
    if len(values) == width * len(sizes):
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


_PACKED = "n int, ids binary, labels binary, matrix binary"


def _pack(block: int):
    """Rows -> blocks in ascending id: one row per block."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                ids = part.column("id").to_numpy(zero_copy_only=False)
                order = np.argsort(ids, kind="stable")
                m = _matrix(part.column("q"))[order]
                labels = part.column("label").to_numpy(zero_copy_only=False)[order]
                yield pa.RecordBatch.from_arrays([pa.array([len(ids)], pa.int32()), pa.array([ids[order].tobytes()], pa.binary()),
                                                  pa.array([labels.tobytes()], pa.binary()), pa.array([m.tobytes()], pa.binary())],
                                                 ["n", "ids", "labels", "matrix"])
    return run


def _unpacked(batch):
    for n, ids, labels, m in zip(*[batch.column(c).to_pylist() for c in ("n", "ids", "labels", "matrix")]):
        yield np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), np.frombuffer(m, np.int64).reshape(n, -1)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of a and b (int64); missing components count as zero."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not width:
        return np.zeros((len(a), len(b)))
    most = int(np.abs(a.astype(object)).max()) * int(np.abs(b.astype(object)).max()) * width if (
        max(-int(a.min()), int(a.max()), -int(b.min()), int(b.max())) >> 20) else (1 << 40) * width
    if most < 1 << 53:
        return a.astype(np.float64) @ b.astype(np.float64).T
    if most >= 1 << 63:
        raise ValueError("inner products of these vectors do not fit 64 bits")
    return a @ b.T


def _firsts(s: np.ndarray, ok: np.ndarray, k: int):
    """(row, column) of the up to k highest `ok` entries of each row, the leftmost first among equals; a generator."""
    least = -np.inf if s.dtype == np.float64 else np.iinfo(np.int64).min
    left = np.where(ok, s, least)
    rows = np.flatnonzero(ok.any(axis=1))
    left = left[rows]
    for _ in range(k):
        if not len(rows):
            return
        at = left.argmax(axis=1)
        here = left[np.arange(len(rows)), at] > least
        rows, left, at = rows[here], left[here], at[here]
        yield rows, at
        left[np.arange(len(rows)), at] = least


def _out(anchor, ids, values):
    join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(join(c)) for c in (anchor, ids, values)], ["anchor", "id", "score"])


def _best_of_label(sent, k: int, tile: int):
    """Each block's best k rows of every anchor's label, the anchor itself left out."""
    def run(batches):
        a_ids, a_labels, a_m = sent.value
        for batch in batches:
            for ids, labels, m in _unpacked(batch):
                out = ([], [], [])
                for label in np.intersect1d(labels, a_labels):
                    own, cols = np.flatnonzero(a_labels == label), np.flatnonzero(labels == label)
                    for at in range(0, len(own), tile):
                        rows = own[at:at + tile]
                        s = scores(a_m[rows], m[cols])
                        for r, c in _firsts(s, a_ids[rows][:, None] != ids[cols][None, :], k):
                            for x, y in zip(out, (a_ids[rows[r]], ids[cols[c]], s[r, c])):
                                x.append(y)
                yield _out(*out)
    return run


def _windows_of_others(sent, k: int, low: int, high: int, tile: int):
    """Each block's first k rows of other labels in every positive's window. sent: ids, labels, vectors and, per anchor, its
    positives' scores with how many there are."""
    def run(batches):
        a_ids, a_labels, a_m, pos, n_pos = sent.value
        # integer edges: low * p <= 100 * s <= high * p
        wide = pos.astype(object)
        first, last = (-((-low * wide) // 100)).astype(np.int64), (high * wide // 100).astype(np.int64)
        for batch in batches:
            for ids, labels, m in _unpacked(batch):
                out = ([], [], [])
                for at in range(0, len(a_ids), tile):
                    t = slice(at, at + tile)
                    s = scores(a_m[t], m)
                    other = a_labels[t][:, None] != labels[None, :]
                    for p in range(pos.shape[1]):
                        ok = other & (s >= first[t, p, None]) & (s <= last[t, p, None]) & (n_pos[t, None] > p)
                        for r, c in _firsts(s, ok, k):
                            for x, y in zip(out, (a_ids[at + r], ids[c], s[r, c])):
                                x.append(y)
                yield _out(*out)
    return run


def open_windows(k: int, low: int, high: int):
    """Rows sorted by (anchor, descending score, kind, id) -> negatives, in one pass and with one anchor's open windows.
    kind 0: a positive, 1: a negative; a row that comes twice counts once."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        anchor, windows, before = None, [], None
        for batch in batches:
            out = []
            for row in zip(*[batch.column(c).to_pylist() for c in ("anchor", "score", "kind", "id")]):
                a, s, kind, i = row
                if row == before:
                    continue
                before = row
                if a != anchor:
                    anchor, windows = a, []
                if not kind:
                    windows.append([i, s, 0])
                    continue
                done = False
                for w in windows:
                    if low * w[1] <= 100 * s <= high * w[1]:
                        w[2] += 1
                        out.append((a, w[0], w[2], i, w[1], s))
                    done |= w[2] == k or 100 * s < low * w[1]
                if done:  # served or passed
                    windows = [w for w in windows if w[2] < k and 100 * s >= low * w[1]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, types)], names)
    return run


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """-> anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchor`: which rows are anchors. An anchor's positives are its `positives` best other rows of the same label; for each of
    them, the first `negatives` rows of other labels with low * positive_score <= 100 * negative_score <= high *
    positive_score. Higher scores come first, ties by smaller id; positives of a negative score have no window.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Of rows that repeat an id one takes
    part: that of the least label, then the least vector. Missing components of shorter vectors count as zero.
    Labels and ids are integers. No rows or no anchors: an empty result. Other columns are not read."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "hard-negatives")
    try:
        ready = scratch.table(quantised(rows, id_col, label_col, vec_col, anchor, scale), "rows")
        parts = max(2 * spark.sparkContext.defaultParallelism, parts_for(ready.count(), 64 * BLOCK))
        packed = scratch.table(ready.select("id", "label", "q").repartition(parts).mapInArrow(_pack(BLOCK), _PACKED), "blocks")
        anchors = ready.where("anchor").select("id", "label", "q")
        size = anchors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("d")).first()
        waves = parts_for(size["n"] * (8 * (size["d"] or 0) + 8 * positives + 64), WAVE_BYTES, 1)
        wave = F.pmod(F.xxhash64("id", F.lit(12)), F.lit(waves))
        best, near = None, None
        for w in range(waves):
            # a wave holds about WAVE_BYTES of anchors, whatever the number of rows
            got = anchors.where(wave == w).orderBy("id").toArrow()
            held = [got.column("id").to_numpy(), got.column("label").to_numpy(), _matrix(got.column("q"))]
            sent = spark.sparkContext.broadcast(tuple(held))
            found = packed.mapInArrow(_best_of_label(sent, positives, TILE), "anchor long, id long, score long")
            first = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
            top = scratch.table(found.withColumn("k", F.row_number().over(first)).where(F.col("k") <= positives), f"positives-{w}")
            own = top.orderBy("anchor", "k").toArrow()  # at most `positives` rows for each anchor of the wave
            at, k = np.searchsorted(held[0], own.column("anchor").to_numpy()), own.column("k").to_numpy() - 1
            pos, n_pos = np.zeros((len(held[0]), positives), np.int64), np.bincount(at, minlength=len(held[0]))
            pos[at, k] = own.column("score").to_numpy()
            more = spark.sparkContext.broadcast((*held, pos, n_pos))
            others = scratch.table(packed.mapInArrow(_windows_of_others(more, negatives, low, high, TILE), "anchor long, id long, score long"), f"negatives-{w}")
            sent.destroy()
            more.destroy()
            both = [d.select("anchor", "score", F.lit(kind).alias("kind"), "id") for kind, d in enumerate((top, others))]
            near = both[0].unionByName(both[1]) if near is None else near.unionByName(both[0]).unionByName(both[1])
        keyed = near.repartition("anchor").sortWithinPartitions("anchor", F.desc("score"), "kind", "id")
        return cut(keyed.mapInArrow(open_windows(negatives, low, high),
                                    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"))
    finally:
        scratch.remove()
