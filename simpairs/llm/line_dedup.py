"""Operator 3, line dedup by a segment-partition edit join.

Lines of different texts are linked when at most `tau` edits (insert, delete, replace a code point) turn one
into the other. A line of length l is split into tau + 1 even segments; of two linked lines at least one segment
of the shorter one stands unchanged in the longer one, near its place. So:

1. index entries (length, segment number, segment) and, for each line, probe entries: the substrings that a segment of
   a line up to tau shorter could be, at the few places that the length difference allows. Entries are
   64-bit keys; blocks of lines send them packed, with 31 bits of the line's hash, and a bucket keeps the keys
   that an index entry shares with another line;
2. only lines with such keys become candidates. The lines of one key are compared in chunks of at most about
   `CHUNK`, a hot key in several tasks; what leaves a chunk pair are verified links, never its pairs;
3. verification is a banded bit-parallel edit distance, for many pairs at a time: one bit per diagonal
   of the band, one word per number of errors;
4. links give classes (components); of a class the first line by (id, line number) stays.

Lines shorter than `min_chars` (and so too short for telling segments) are linked only when equal. Hashes
of lines have 64 bits; two lines that share a segment are missed only if 31 further bits agree (5e-10).
"""
from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.llm.common import Scratch, bounded, cut, parts_for, whole_text
from simpairs.llm.components import components
from simpairs.llm.words import mix

TAU, MIN_CHARS = 2, 16
CHUNK = 512
BUCKET_BYTES = 4 << 20
PIECE_CHARS = 1 << 19
_BASE, _BACK = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64))
_WHITE = " \t\r\x0b\x0c"
_powers: list[np.ndarray] = []


def _powers_to(n: int):
    if not _powers or len(_powers[0]) < n:
        both = []
        for base in (_BASE, _BACK):
            p = np.full(max(n, 2 * PIECE_CHARS), base, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _powers[:] = both
    return _powers


def line_hash(line: str) -> int:
    return int.from_bytes(hashlib.blake2b(line.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def own_lines(text: str | None) -> list[tuple[int, str]]:
    """(number, line without white space at its ends) of the lines that are not blank."""
    if not text:
        return []
    return [(k, s) for k, line in enumerate(text.split("\n")) if (s := line.strip(_WHITE))]


def _distinct(texts, least: int):
    """Batches of about PIECE_CHARS characters of distinct lines of at least `least` chars: (hashes, lines)."""
    held: dict[int, str] = {}
    size = 0
    for t in texts:
        for _, line in own_lines(t):
            if len(line) >= least and (h := line_hash(line)) not in held:
                held[h] = line
                size += len(line)
                if size >= PIECE_CHARS:
                    yield np.array(list(held), np.int64), list(held.values())
                    held, size = {}, 0
    if held:
        yield np.array(list(held), np.int64), list(held.values())


def segment(length: np.ndarray, k: int, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment k; the last length % (tau + 1) segments are one longer."""
    base, longer = length // (tau + 1), length % (tau + 1)
    short = tau + 1 - longer
    return k * base + np.maximum(0, k - short), base + (k >= short)


def entries(lines: list[str], tau: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, the line of each, and whether it is a probe."""
    size = np.array([len(s) for s in lines], np.int64)
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    up, down = _powers_to(len(points) + 1)
    prefix = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(mix(points + np.uint64(1)) * up[:len(points)], out=prefix[1:])
    begin = np.cumsum(size) - size
    keys, owner, probe = [], [], []
    every = np.arange(len(lines))
    for less in range(tau + 1):
        length = size - less
        for k in range(tau + 1):
            start, long = segment(length, k, tau)
            tag = mix(length.astype(np.uint64) * np.uint64(64) + np.uint64(k))
            # multi-match-aware: errors left of the segment number at most k, right of it at most tau - k
            low = np.maximum(np.maximum(start - k, start + less - (tau - k)), 0)
            high = np.minimum(np.minimum(start + k, start + less + (tau - k)), size - long)
            for shift in range(-tau, 2 * tau + 1):
                at = start + shift
                ok = (at >= low) & (at <= high) & (long > 0)
                if not ok.any():
                    continue
                x = begin[ok] + at[ok]
                part = (prefix[x + long[ok]] - prefix[x]) * down[x]
                keys.append(mix(part + tag[ok]))
                owner.append(every[ok])
                # at its own place and length the probe is the index entry itself
                probe.append(np.full(int(ok.sum()), not (less == 0 and shift == 0)))
    return np.concatenate(keys), np.concatenate(owner), np.concatenate(probe)


def _rows(batches):
    """id and row key go through as they are."""
    for batch in batches:
        found = [(at, k, line_hash(s)) for at, t in enumerate(batch.column("__text").to_pylist()) for k, s in own_lines(t)]
        at = pa.array([x[0] for x in found], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("__id").take(at), batch.column("__row").take(at), pa.array([x[1] for x in found], pa.int32()),
             pa.array([x[2] for x in found], pa.int64())], ["id", "row", "line", "h"])


def _ask(tau: int, least: int, bits: int):
    def run(batches):
        for pdf in batches:
            found = [[np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]]
            for hashes, lines in _distinct(pdf["__text"], least):
                keys, owner, probe = entries(lines, tau)
                found[0].append(keys)
                found[1].append((hashes.view(np.uint64)[owner] >> np.uint64(33)).astype(np.uint32) << 1 | probe)
            keys, tags = (np.concatenate(x) for x in found)
            order = np.argsort(keys)
            keys, tags = keys[order], tags[order].astype(np.uint32)
            bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(keys) else np.zeros(0, np.int64)
            ends = np.r_[cuts[1:], len(keys)]
            yield pd.DataFrame({"bucket": bucket[cuts], "entries": [keys[a:b].tobytes() + tags[a:b].tobytes() for a, b in zip(cuts, ends)]})
    return run


def _matched(pdf: pd.DataFrame) -> pd.DataFrame:
    raw = [bytes(x) for x in pdf["entries"]]
    keys = np.frombuffer(b"".join(x[:len(x) // 12 * 8] for x in raw), np.uint64)
    tags = np.frombuffer(b"".join(x[len(x) // 12 * 8:] for x in raw), np.uint32)
    order = np.lexsort((tags, keys))
    keys, tags = keys[order], tags[order]
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    line = tags >> 1
    several = np.minimum.reduceat(line, heads) != np.maximum.reduceat(line, heads)
    index = np.minimum.reduceat(tags & 1, heads) == 0
    return pd.DataFrame({"key": keys[heads][several & index].view(np.int64)})


def _offer(tau: int, least: int):
    def run(batches):
        for pdf in batches:
            for hashes, lines in _distinct(pdf["__text"], least):
                keys, owner, probe = entries(lines, tau)
                yield pd.DataFrame({"key": keys.view(np.int64), "h": hashes[owner], "probe": probe})
    return run


def _texts(least: int):
    def run(batches):
        for pdf in batches:
            for hashes, lines in _distinct(pdf["__text"], least):
                yield pd.DataFrame({"h": hashes, "line": lines})
    return run


def within(points: list[np.ndarray], a: np.ndarray, b: np.ndarray, tau: int, cells: int = 1 << 22) -> np.ndarray:
    """Whether the edit distance of points[a[k]] and points[b[k]] is at most tau (tau <= 3), for all k.

    Bit d of word e, after column j: row j + d - tau of the matrix is reached with at most e errors."""
    size = np.array([len(p) for p in points], np.int64)
    m, n = size[a], size[b]
    out = np.zeros(len(a), bool)
    near = np.flatnonzero(np.abs(m - n) <= tau)
    near = near[np.argsort(n[near], kind="stable")]
    full = (1 << (2 * tau + 1)) - 1
    at = 0
    while at < len(near):
        count = max(1, min(len(near) - at, cells // (int(n[near[at]]) + 1)))
        while count > 1 and count * (int(n[near[at + count - 1]]) + 1) > 2 * cells:
            count //= 2
        own = near[at:at + count]
        at += count
        rows, columns = int(m[own].max()), int(n[own].max())
        pattern = np.full((rows + 2 * tau + 3 + max(0, columns - rows), len(own)), 0xFFFFFFFF, np.uint32)
        text = np.full((columns, len(own)), 0xFFFFFFFE, np.uint32)
        for k, (x, y) in enumerate(zip(a[own], b[own])):
            pattern[tau:tau + len(points[x]), k] = points[x]
            text[:len(points[y]), k] = points[y]
        words = [np.full(len(own), sum(1 << d for d in range(tau, tau + e + 1)), np.uint8) for e in range(tau + 1)]
        live = np.arange(len(own))
        ends, goal = n[own], (m[own] - n[own] + tau).astype(np.uint8)
        for j in range(columns):
            equal = np.zeros(len(live), np.uint8)
            for d in range(2 * tau + 1):
                equal |= (pattern[j + d] == text[j]).view(np.uint8) << np.uint8(d)
            before, fresh = None, []
            for e in range(tau + 1):
                w = words[e] & equal
                if e:
                    w |= before | (before >> 1) | (fresh[-1] << 1) & np.uint8(full)
                before = words[e]
                fresh.append(w)
            words = fresh
            done = ends[live] == j + 1
            if done.any():
                out[own[live[done]]] = (words[tau][done] >> goal[live[done]]) & 1
            if j % 8 == 7 or done.any():
                keep = (words[tau] != 0) & ~done
                if 2 * int(keep.sum()) < len(live):
                    live, words = live[keep], [w[keep] for w in words]
                    pattern, text = pattern[:, keep], text[:, keep]
                    if not len(live):
                        break
    return out


def _verify(tau: int):
    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        points = [np.frombuffer(s.encode("utf-32-le", "surrogatepass"), "<u4") for s in pdf["line"]]
        probe, side, h = pdf["probe"].to_numpy(), pdf["side"].to_numpy(), pdf["h"].to_numpy()
        group = pdf["group"].to_numpy()
        size = np.array([len(p) for p in points], np.int64)
        heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for x, y in zip(heads, np.r_[heads[1:], len(group)]):
            two = side[x:y] == 1
            if two.any():  # the lines of one chunk against those of another
                p, q = (z.ravel() for z in np.meshgrid(x + np.flatnonzero(~two), x + np.flatnonzero(two), indexing="ij"))
            else:
                p, q = (x + z for z in np.triu_indices(y - x, 1))
            ok = ~(probe[p] & probe[q]) & (np.abs(size[p] - size[q]) <= tau) & (h[p] != h[q])
            left.append(p[ok])
            right.append(q[ok])
        left, right = np.concatenate(left), np.concatenate(right)
        linked = within(points, left, right, tau)
        x, y = h[left[linked]], h[right[linked]]
        return pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)}).drop_duplicates()

    def run(batches):
        rest = None
        for pdf in batches:
            pdf = pdf.assign(group=(pdf["key"].astype(str) + "," + pdf["i"].astype(str) + "," + pdf["j"].astype(str)))
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            last = pdf["group"].ne(pdf["group"].iloc[-1]).to_numpy().nonzero()[0] if len(pdf) else np.zeros(0, int)
            cut_at = int(last[-1]) + 1 if len(last) else 0
            if cut_at:
                yield judge(pdf.iloc[:cut_at])
            rest = pdf.iloc[cut_at:]
        if rest is not None and len(rest):
            yield judge(rest)
    return run


def line_links(base: DataFrame, lines: int, scratch: Scratch, tau: int, min_chars: int) -> DataFrame:
    """base(__text) -> links(a, b) between the hashes of distinct lines, each once."""
    least = max(min_chars, tau + 1)
    texts = base.select("__text")
    # about twelve entries of twelve bytes a line
    bits = (parts_for(lines * 144, BUCKET_BYTES) - 1).bit_length()
    keys = scratch.table(texts.mapInPandas(_ask(tau, least, bits), "bucket long, entries binary")
                         .groupBy("bucket").applyInPandas(_matched, "key long"), "keys")
    offers = scratch.table(texts.mapInPandas(_offer(tau, least), "key long, h long, probe boolean")
                           .join(bounded(keys, keys.count(), 16), "key", "left_semi")
                           .groupBy("key", "h").agg(F.min("probe").alias("probe")), "offers")
    wanted = scratch.table(offers.select("h").distinct(), "wanted")
    found = scratch.table(texts.mapInPandas(_texts(least), "h long, line string")
                          .join(bounded(wanted, wanted.count(), 16), "h", "left_semi").dropDuplicates(["h"]), "texts")
    parts = offers.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("n"))
    place = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    mine = F.col("mine")
    every = F.sequence(F.lit(0), F.col("n") - 1)
    to = F.concat(F.transform(F.filter(every, lambda j: j >= mine), lambda j: place(mine, j, 0)),
                  F.transform(F.filter(every, lambda i: i < mine), lambda i: place(i, mine, 1)))
    fed = (offers.join(parts, "key").withColumn("mine", F.pmod(F.xxhash64("h", F.lit(8)), F.col("n")).cast("int"))
           .select("key", "h", "probe", F.explode(to).alias("t")).select("key", "h", "probe", "t.*"))
    fed = fed.join(found, "h").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return scratch.table(fed.mapInPandas(_verify(tau), "a long, b long").distinct(), "links")


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tau: int = TAU,
                 min_chars: int = MIN_CHARS) -> DataFrame:
    """-> one row per line that is not blank: id, row (a hash of the whole text), line (number from 0), class_id (the least line hash of
    the class), n_links (distinct other lines within tau edits), first_id, first_line, kept.

    Lines are what stands between line feeds, compared without white space at their ends. Null and empty texts have no
    lines. The first line of a class by (id, text hash, number) stays; null ids come first. A document is an id with a
    text: rows with null ids, or that repeat an id with another text, are documents of their own; rows equal in both are
    one document listed again, and their lines get the same answers. Empty table: no rows. Other columns are not read."""
    if not 1 <= tau <= 3:
        raise ValueError("tau must be 1, 2 or 3")
    spark = docs.sparkSession
    scratch = Scratch(spark, "line-dedup")
    base = docs.select(F.col(id_col).alias("__id"), whole_text(text_col).alias("__text"))
    base = base.select("__id", F.xxhash64("__text").alias("__row"), "__text")
    id_type = base.schema["__id"].dataType.simpleString()
    told = scratch.table(base.mapInArrow(_rows, f"id {id_type}, row long, line int, h long"), "lines")
    links = line_links(base, told.count(), scratch, tau, min_chars)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    known = components(links).join(both.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("n_links")), "node")
    known = known.select(F.col("node").alias("h"), "root", "n_links")
    placed = (told.join(known, "h", "left")
              .select("id", "row", "line", F.coalesce("root", "h").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
    # of the classes only those with several lines need a first one
    first = placed.groupBy("class_id").agg(F.min(F.struct("id", "row", "line")).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1")
    out = cut(placed.join(first, "class_id", "left").select(
        "id", "row", "line", "class_id", "n_links", F.coalesce("f", F.struct("id", "row", "line")).alias("f")))
    scratch.remove()
    own = F.col("id").eqNullSafe(F.col("f.id")) & (F.col("row") == F.col("f.row")) & (F.col("line") == F.col("f.line"))
    return out.select("id", "row", "line", "class_id", "n_links", F.col("f.id").alias("first_id"), F.col("f.line").alias("first_line"), own.alias("kept"))


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tau: int = TAU, min_chars: int = MIN_CHARS) -> DataFrame:
    """`docs` with the removed lines (and their line feeds) taken out of `text_col`, plus __n_lines (all lines, blank ones
    too; 0 for null and empty texts), __n_links and __removed (line numbers, ascending). Null texts stay null."""
    per = (line_classes(docs, id_col, text_col, tau, min_chars).distinct().groupBy(F.col("id").alias("__of"), F.col("row").alias("__of_row"))
           .agg(F.sum("n_links").alias("__links"), F.array_sort(F.collect_list(F.when(~F.col("kept"), F.col("line")))).alias("__gone")))
    per = cut(per.where("__links > 0 OR size(__gone) > 0"))
    row = per.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("__gone")).alias("g")).first()
    this = F.col(id_col).eqNullSafe(F.col("__of")) & (F.xxhash64(whole_text(text_col)) == F.col("__of_row"))
    joined = docs.join(bounded(per, 1, 56 * row["n"] + 4 * (row["g"] or 0)), this, "left")
    gone = F.coalesce(F.col("__gone"), F.array().cast("array<int>"))
    lines = F.split(F.col(text_col), "\n", -1)
    kept = F.array_join(F.filter(lines, lambda s, i: ~F.array_contains(gone, i)), "\n")
    text = F.when(F.size(gone) > 0, kept).otherwise(F.col(text_col))
    return joined.select(
        *[text.alias(text_col) if c == text_col else docs[c] for c in docs.columns],
        F.when(F.length(whole_text(text_col)) > 0, F.size(lines)).otherwise(0).cast("long").alias("__n_lines"),
        F.coalesce("__links", F.lit(0)).cast("long").alias("__n_links"), gone.alias("__removed"))
