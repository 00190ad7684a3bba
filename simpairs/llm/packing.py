"""Operator 7, best-fit packing with swap-based local search.

Documents become token ids plus an end token; longer ones are cut into pieces of the sequence length, the
remainder first. Pieces are dealt into blocks of bounded size; each block is filled best fit, longest first,
and then improved: pieces of the emptiest bin are moved, exchanged one for one or
two for one with other underfull bins wherever that raises the sum of squared fills, until the bin is empty, the block has
as few bins as its tokens need, or nothing improves. The sum of squares grows with each step, so the search
ends. The worse-filled bins of all blocks are then packed again together, level by level, in as many blocks of bounded size
as their pieces need, until one block holds them or a level gives no fewer bins.

With `written_order` the rows keep the order in which their files hold them, so that a mix made before packing is still one
after it: pieces are numbered in that order, a block is a contiguous run of them, and so are the blocks packed again together. A sequence
takes the number of its longest piece.
"""
from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simpairs.llm.common import cut, parts_for, tidy, whole_text
from simpairs.llm.tokens import byte_bpe

CAPACITY = 1024
END_ID = 2
BLOCK_PIECES = 8192
TRIES, NEAR = 16, 16  # breadth of the local search: bins worked on, partners of a piece looked at in its bin
RUN_ROWS = 8192  # rows of a file whose pieces are numbered in one window


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each piece: longest first, each into the fullest bin that has room."""
    bins = np.empty(len(lengths), np.int64)
    room: dict[int, list[int]] = {}  # free space -> bins
    mask = 0  # bit f: some bin has f free
    n = 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[k])
        fits = mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            own = room[free].pop()
            if not room[free]:
                mask &= ~(1 << free)
        else:
            free, own = capacity, n
            n += 1
        bins[k] = own
        left = free - size
        if left:
            if not room.get(left):
                room[left] = []
                mask |= 1 << left
            room[left].append(own)
    return bins


def _gain(d, high, low):
    """Growth of the sum of squares when `d` tokens go from a bin of fill `low` to one of fill `high`."""
    return 2 * d * (high - low + d)


def _pairs(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces that share a bin, as pairs of indices (with up to NEAR others of the bin each)."""
    order = np.argsort(bins, kind="stable")
    left, right = [], []
    for d in range(1, NEAR + 1):
        same = bins[order[:-d]] == bins[order[d:]] if d < len(order) else np.zeros(0, bool)
        if not same.any():
            break
        left.append(order[:-d][same])
        right.append(order[d:][same])
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def improve(lengths: np.ndarray, bins: np.ndarray, capacity: int) -> np.ndarray:
    """Swap-based local search; returns the bins. The emptiest bins are worked on, TRIES of them at a time."""
    bins = bins.copy()
    fill = np.bincount(bins, weights=lengths).astype(np.int64)
    least = -(-int(lengths.sum()) // capacity)
    stuck: set[int] = set()

    def best(ok: np.ndarray, d: np.ndarray, own: np.ndarray, b: int) -> int:
        at = np.flatnonzero(ok)
        return int(at[np.argmax(_gain(d[at], own[at], fill[b]))]) if at.size else -1

    def put(pieces, to: int) -> None:
        for k in pieces:
            size = lengths[k]
            fill[bins[k]] -= size
            fill[to] += size
            bins[k] = to

    def step(b: int, k: int) -> bool:
        """Move piece k of bin b, alone or with another one of b, or take one or two shorter ones back."""
        p = int(lengths[k])
        to = np.flatnonzero((fill > 0) & (fill + p <= capacity) & (fill >= fill[b]))
        to = to[to != b]
        if to.size:
            put([k], int(to[np.argmax(fill[to])]))
            return True
        own = fill[bins]
        other = (bins != b) & (own >= fill[b])
        mates = [m for m in np.flatnonzero(bins == b).tolist() if m != k]
        mates = sorted(mates, key=lambda m: -lengths[m])[:NEAR]
        for group in [[k], *([k, m] for m in mates)]:  # one for one, then two for one
            d = int(lengths[group].sum()) - lengths
            q = best(other & (d > 0) & (own + d <= capacity), d, own, b)
            if q >= 0:
                c = int(bins[q])
                put([q], b)
                put(group, c)
                return True
        x, y = _pairs(bins)  # one for two
        d = p - lengths[x] - lengths[y]
        own = fill[bins[x]]
        q = best((bins[x] != b) & (own >= fill[b]) & (d > 0) & (own + d <= capacity), d, own, b)
        if q >= 0:
            c = int(bins[x[q]])
            put([x[q], y[q]], b)
            put([k], c)
            return True
        return False

    while (used := np.flatnonzero(fill)).size > least:
        emptiest = used[np.argsort(fill[used], kind="stable")][:TRIES].tolist()
        b = next((x for x in emptiest if x not in stuck), None)
        if b is None:
            break
        own = np.flatnonzero(bins == b)
        moved = False
        for k in own[np.argsort(-lengths[own], kind="stable")].tolist():
            if bins[k] == b:
                moved |= step(b, k)
        stuck = set() if moved else stuck | {b}
    return bins


def pack_lengths(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each piece, numbered from 0 without gaps."""
    bins = improve(lengths, best_fit(lengths, capacity), capacity)
    return np.unique(bins, return_inverse=True)[1]


def _pieces(tokenizer: str, capacity: int, end_id: int, with_ids: bool, columns: list[str]):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        bpe = byte_bpe(tokenizer)
        for pdf in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for k, text in enumerate(pdf["__text"]):
                buf = bpe.ids(text) + end
                n, at, number = len(buf) // 4, 0, 0
                while at < n:
                    take = capacity if at or n <= capacity else n % capacity or capacity
                    take = min(take, n - at)
                    part = buf[4 * at:4 * (at + take)]
                    row.append(k)
                    piece.append(number)
                    start.append(at)
                    length.append(take)
                    crc.append(zlib.crc32(part))
                    ids.append(part)
                    at, number = at + take, number + 1
            out = pdf[columns].iloc[row].reset_index(drop=True)
            out = out.assign(piece=np.array(piece, np.int32), start=np.array(start, np.int64),
                             length=np.array(length, np.int64), ids_crc32=np.array(crc, np.int64))
            yield out.assign(ids=[np.frombuffer(x, "<u4").astype(np.int32) for x in ids]) if with_ids else out
        tidy()
    return run


def _numbered(pieces: DataFrame) -> DataFrame:
    """`pieces` with __row, their number from 0 in the order of files, rows and pieces."""
    pieces = pieces.withColumn("__run", F.floor(F.col("__at") / RUN_ROWS))
    # file names carry the number of the task that wrote them; one row per run
    part = F.try_to_number(F.regexp_extract("__file", r"part-(\d+)", 1), F.lit("9" * 18)).cast("long")
    starts = (pieces.groupBy("__file", "__run").agg(F.count(F.lit(1)).alias("n"))
              .select("__file", "__run", (F.sum("n").over(Window.orderBy(part, "__file", "__run")) - F.col("n")).alias("__start")))
    in_run = Window.partitionBy("__file", "__run").orderBy("__at", "piece")
    return (pieces.join(starts, ["__file", "__run"]).withColumn("__row", F.col("__start") + F.row_number().over(in_run) - 1)
            .drop("__file", "__at", "__run", "__start"))


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   end_id: int = END_ID, with_ids: bool = False, written_order: bool = False) -> DataFrame:
    """-> per piece: `id_col`, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    Null texts count as empty: one piece that holds the end token. Every input row is packed, repeated rows and null ids too;
    other columns are not read. An empty table gives no rows. Sequence ids are distinct but not gapless; with `written_order`,
    for which `docs` must be read from files, they follow the order of the rows in these."""
    at = [F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__at")] if written_order else []
    base = docs.select(F.col(id_col), whole_text(text_col).alias("__text"), *at)
    schema = docs.select(id_col).schema
    columns = [id_col, *["__file", "__at"] * written_order]
    fields = ", ".join([f"`{id_col}` {schema[id_col].dataType.simpleString()}"] + ["__file string, __at long"] * written_order
                       + ["piece int, start long, length long, ids_crc32 long"] + ["ids array<int>"] * with_ids)
    pieces = base.mapInPandas(_pieces(tokenizer, capacity, end_id, with_ids, columns), fields)
    # the checkpoint fixes __row; without written_order it is only a key that differs for every piece
    pieces = _numbered(cut(pieces)) if written_order else cut(pieces.withColumn("__row", F.monotonically_increasing_id()))
    blocks = parts_for(pieces.count(), BLOCK_PIECES)
    light = pieces.select("__row", "length") if with_ids else pieces
    at = light.withColumn("__block", (F.floor(F.col("__row") / BLOCK_PIECES) if written_order else
                                      F.pmod(F.xxhash64("__row"), F.lit(blocks))).cast("long"))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in at.schema)}, sequence_id long, offset long, __nth long"
    packed = before = None
    while True:
        done = cut(at.groupBy("__block").applyInPandas(_pack_block(capacity), schema))
        # __nth numbers the pieces of the underfull bins of a block
        left, lead = F.col("__nth").isNotNull(), F.col("sequence_id") == F.col("__row")
        sizes = cut(done.groupBy("__block").agg(F.count("__nth").alias("n"), F.count_if(lead).alias("bins"), F.count_if(left & lead).alias("open")))
        total = sizes.agg(F.count(F.lit(1)).alias("blocks"), *[F.sum(c).alias(c) for c in ("n", "bins", "open")]).first()
        if before is not None and total["bins"] >= open_bins:  # no fewer than the last level left
            packed = packed.unionByName(before)
            break
        if total["blocks"] <= 1 or not total["n"]:
            packed = done if packed is None else packed.unionByName(done)
            break
        packed = done.where(~left) if packed is None else packed.unionByName(done.where(~left))
        before, open_bins = done.where(left), total["open"]
        # contiguous runs of the open pieces; one row per block
        starts = sizes.select("__block", (F.sum("n").over(Window.orderBy("__block")) - F.col("n")).alias("__start"))
        at = (before.drop("sequence_id", "offset").join(starts, "__block")
              .withColumn("__block", F.floor((F.col("__start") + F.col("__nth")) / BLOCK_PIECES)).select(*at.columns))
    if with_ids:
        packed = pieces.join(packed.select("__row", "sequence_id", "offset"), "__row")
    return packed.select(id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * with_ids)


def _pack_block(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__row").reset_index(drop=True)
        lengths = pdf["length"].to_numpy()
        bins = pack_lengths(lengths, capacity)
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(lengths[order])
        fill = np.bincount(bins, weights=lengths).astype(np.int64)
        offset = np.empty(len(pdf), np.int64)
        offset[order] = ends - lengths[order] - np.repeat(np.cumsum(fill) - fill, np.bincount(bins))
        by_length = np.lexsort((-lengths, bins))  # the first of a bin is its longest piece
        lead = pdf["__row"].to_numpy()[by_length[np.searchsorted(bins[by_length], np.arange(len(fill)))]]
        nth = pd.array(np.arange(len(pdf)), "Int64")
        left = fill[bins] <= capacity * 9 // 10
        nth[left] = np.arange(left.sum())
        nth[~left] = pd.NA
        return pdf.assign(sequence_id=lead[bins], offset=offset, __nth=nth)
    return run


def sequences(packed: DataFrame) -> DataFrame:
    """From `pack_documents(..., with_ids=True)`: sequence_id, ids (at most `capacity` of them)."""
    part = F.struct("offset", "ids")
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(part)), lambda x: x["ids"])).alias("ids"))
