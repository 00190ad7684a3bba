"""Operator 1, suffix-array dedup by a depth-limited radix sort.

Suffixes are ordered only through `depth` bytes, by most-significant-digit passes; a suffix alone in its group
leaves the sort, and the groups equal after the last digit are exactly the repeated windows. The digits of a
suffix are taken so that neighbouring suffixes share them and travel as one record (a run):

1. the anchor: the gram of depth/4 bytes with the least hash in the window (leftmost on ties). It depends on the window's
   bytes only, and the windows of one anchor are a run of neighbouring starts;
2. the run's bytes with the anchor's place: a run that occurs twice is repeated throughout. Runs alone
   in their anchor's group leave;
3. for runs that occur once but share their anchor with other runs: the window itself.

Digits are 64-bit names (polynomial hashes of the bytes). Blocks of documents send each distinct digit once, packed and
sorted, to the bucket of its leading bits; the bucket answers each block with one code per digit. So a
passage that stands in a third of all documents costs a bucket one entry per block. A block in which one
anchor has many runs sends a mark instead of the runs and settles them by the last digit. Texts are
shuffled once, by block; all passes read that shuffle.

Names may collide: with n names compared, about n^2 / 2^65 pairs do.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.llm.common import parts_for, text_bytes, whole_text
from simpairs.llm.words import mix

DEPTH = 200
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 2 << 20
SEGMENT = 1 << 19  # bytes handled at a time inside a block
MANY_RUNS = 16
_PLACE = 24  # low bits of a key that hold the place in a segment
_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))
_BASE, _BACK = np.uint64(0xDA942042E4DD58B5), np.uint64(pow(0xDA942042E4DD58B5, -1, 1 << 64))
_ANCHOR = np.uint64(0xA0761D6478BD642F)
_powers: list[np.ndarray] = []


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, SEGMENT + (SEGMENT >> 2))
        both = []
        for base in (_BASE, _BACK):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _powers[:] = both
    return _powers[0], _powers[1]


class Segment:
    """Some bytes with the window starts that belong to them: for each run of neighbouring windows with one
    anchor its first and last start, document, anchor name and run name."""

    def __init__(self, pieces: list[tuple[int, int, bytes]], depth: int):
        # pieces: (document, place of the first byte in it, bytes); all starts whose window fits belong to the piece
        gram = depth // 4
        sizes = np.array([len(p[2]) for p in pieces])
        offsets = np.cumsum(sizes) - sizes
        self.bytes, self.depth = b"".join(p[2] for p in pieces), depth
        prefix, down = self._prefix()
        size = len(self.bytes)
        names = mix((prefix[gram:] - prefix[:size - gram + 1]) * down[:size - gram + 1])
        keys = (names >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(names), dtype=np.uint64)
        width = depth - gram + 1
        n = len(names) - width + 1  # window starts in the buffer
        padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
        padded[:len(keys)] = keys
        grid = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        anchor = (np.minimum(behind[:n], ahead[width - 1:width - 1 + n]) & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
        at = np.arange(n)
        if len(pieces) > 1:
            edge = np.zeros(n + depth, np.int8)
            edge[offsets] += 1
            edge[offsets + sizes - depth + 1] -= 1
            at = np.flatnonzero(np.cumsum(edge[:n], dtype=np.int8))
        anchor = anchor[at]
        new = np.r_[True, (np.diff(anchor) != 0) | (np.diff(at) != 1)]
        heads = np.flatnonzero(new)
        self.first, self.last = at[heads], at[np.r_[heads[1:], len(at)] - 1]
        place = anchor[heads]
        self.anchor = mix(names[place] + _ANCHOR)  # the least of many names is small; named anew, its leading bits are even
        count = (self.last - self.first).astype(np.uint64)
        whole = (prefix[self.last + depth] - prefix[self.first]) * down[self.first]
        self.run = mix(mix(whole + count) + (place - self.first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + count)
        piece = np.searchsorted(offsets, self.first, side="right") - 1
        self.doc = np.array([p[0] for p in pieces])[piece]
        self.shift = (np.array([p[1] for p in pieces]) - offsets)[piece]

    def _prefix(self) -> tuple[np.ndarray, np.ndarray]:
        """Running sums that give the name of any substring, and the factors that shift it to place 0."""
        b = np.frombuffer(self.bytes, np.uint8)
        up, down = _powers_to(len(b) + 1)
        prefix = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(_VALUES[b] * up[:len(b)], out=prefix[1:])
        return prefix, down

    def windows(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Names of all windows of some runs, and the position of each one's run in `runs`."""
        n = self.last[runs] - self.first[runs] + 1
        owner = np.repeat(np.arange(len(runs)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.first[runs][owner]
        if not len(at):
            return np.zeros(0, np.uint64), owner
        prefix, down = self._prefix()
        return mix((prefix[at + self.depth] - prefix[at]) * down[at]), owner


def segments(texts: list[bytes], depth: int):
    held, size = [], 0
    for d, t in enumerate(texts):
        for start in range(0, len(t) - depth + 1, SEGMENT):
            part = t[start:start + SEGMENT + depth - 1]
            if size + len(part) > SEGMENT and held:
                yield Segment(held, depth)
                held, size = [], 0
            held.append((d, start, part))
            size += len(part)
    if held:
        yield Segment(held, depth)


class Block:
    """The documents of one block, and what the passes say about them. Everything follows from the texts alone, so
    each pass can build it anew in the same order."""

    def __init__(self, pdf: pd.DataFrame, depth: int):
        self.pdf = pdf.assign(__text=[bytes(t) for t in pdf["__text"]])
        self.pdf = self.pdf.iloc[sorted(range(len(pdf)), key=lambda k: (str(self.pdf["__id"].iloc[k]), self.pdf["__text"].iloc[k]))]
        self.texts, self.depth = list(self.pdf["__text"]), depth
        self.segments = list(segments(self.texts, depth))
        nothing = np.zeros(0, np.uint64)
        anchor = np.concatenate([nothing, *(s.anchor for s in self.segments)])
        run = np.concatenate([nothing, *(s.run for s in self.segments)])
        order = np.lexsort((run, anchor))
        a, r = anchor[order], run[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (r[1:] != r[:-1])] if len(a) else np.zeros(0, bool)
        self.entry = np.empty(len(a), np.int64)  # run number -> distinct (anchor, run)
        self.entry[order] = np.cumsum(new) - 1
        self.a, self.r = a[new], r[new]
        times = np.diff(np.r_[np.flatnonzero(new), len(a)])
        self.twice = times > 1
        group = np.cumsum(np.r_[True, self.a[1:] != self.a[:-1]]) - 1 if len(self.a) else np.zeros(0, np.int64)
        own = np.bincount(group)[group] if len(group) else group
        self.crowded = own >= MANY_RUNS  # their anchor is marked; they are settled by the last digit

    def asked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Digits sent in passes 1 and 2, sorted by anchor: anchor, run, flag (0 once, 1 twice, 2 mark)."""
        marks = np.unique(self.a[self.crowded])
        a = np.r_[self.a[~self.crowded], marks]
        r = np.r_[self.r[~self.crowded], np.zeros(len(marks), np.uint64)]
        flag = np.r_[self.twice[~self.crowded].astype(np.uint8), np.full(len(marks), 2, np.uint8)]
        order = np.argsort(a, kind="stable")
        return a[order], r[order], flag[order]

    def codes(self, answer: np.ndarray) -> np.ndarray:
        """Per distinct run: 0 alone, 1 repeated, 2 open, 3 repeated and needed by open ones."""
        out = np.where(self.twice, 3, 2).astype(np.uint8)  # crowded ones
        marks = np.unique(self.a[self.crowded])
        a = np.r_[self.a[~self.crowded], marks]
        order = np.argsort(a, kind="stable")
        back = np.empty(len(a), np.uint8)
        back[order] = answer
        out[~self.crowded] = back[:int((~self.crowded).sum())]
        return out

    def windows(self, codes: np.ndarray):
        """Per segment: the segment, the codes of its runs, its runs that take part in pass 3."""
        seen = np.zeros(len(self.a), bool)
        at = 0
        for s in self.segments:
            entry = self.entry[at:at + len(s.anchor)]
            at += len(s.anchor)
            code = codes[entry]
            lead = np.zeros(len(entry), bool)
            lead[np.unique(entry, return_index=True)[1]] = True
            take = (code == 2) | (code == 3) & lead & ~seen[entry]
            seen[entry] = True
            yield s, code, np.flatnonzero(take)

    def last_digit(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct window names of pass 3, sorted, and whether each stands here twice."""
        names = [s.windows(runs)[0] for s, _, runs in self.windows(codes)]
        return _distinct(np.concatenate([np.zeros(0, np.uint64), *names]))


def _distinct(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    own, times = np.unique(names, return_counts=True)
    return own, times > 1


def _slices(names: np.ndarray, bits: int):
    """(bucket, from, to) of sorted names, by leading bits."""
    if not bits:
        return [(0, 0, len(names))] if len(names) else []
    bucket = (names >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(names) else np.zeros(0, np.int64)
    return [(int(bucket[x]), int(x), int(y)) for x, y in zip(cuts, np.r_[cuts[1:], len(names)])]


def _answer(pdf: pd.DataFrame, kind: str) -> np.ndarray:
    own = pdf[pdf["kind"] == kind].sort_values("bucket")
    return np.frombuffer(b"".join(map(bytes, own["codes"])), np.uint8)


def _frame(rows, columns):
    return pd.DataFrame(rows, columns=columns)


def _ask_runs(depth: int, bits: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        a, r, flag = Block(pdf, depth).asked()
        block = int(pdf["__block"].iloc[0])
        return _frame([(k, block, a[x:y].tobytes() + r[x:y].tobytes() + flag[x:y].tobytes())
                       for k, x, y in _slices(a, bits)], ["bucket", "block", "digits"])
    return run


def _judge_runs(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("block")
    digits = [bytes(x) for x in pdf["digits"]]
    n = np.array([len(x) // 17 for x in digits])
    a = np.frombuffer(b"".join(x[:8 * k] for x, k in zip(digits, n)), np.uint64)
    r = np.frombuffer(b"".join(x[8 * k:16 * k] for x, k in zip(digits, n)), np.uint64)
    flag = np.frombuffer(b"".join(x[16 * k:] for x, k in zip(digits, n)), np.uint8)
    order = np.lexsort((r, flag == 2, a))
    a, r, flag = a[order], r[order], flag[order]
    mark = flag == 2
    new_a = np.r_[True, a[1:] != a[:-1]]
    new = new_a | np.r_[True, (r[1:] != r[:-1]) | (mark[1:] != mark[:-1])]
    run, group = np.cumsum(new) - 1, np.cumsum(new_a) - 1
    times = np.bincount(run, weights=1 + (flag == 1))
    once = (times[run] < 2) | mark
    several = (np.bincount(group, weights=new) > 1) | (np.bincount(group, weights=mark) > 0)
    open_runs = np.bincount(group, weights=once) > 0  # some run of the group needs the last digit
    code = np.where(once, np.where(several[group], 2, 0), np.where((several & open_runs)[group] & new, 3, 1)).astype(np.uint8)
    back = np.empty(len(code), np.uint8)
    back[order] = code
    ends = np.cumsum(n)
    return _frame([(b, k, "runs", back[e - m:e].tobytes()) for b, k, e, m in zip(pdf["block"], pdf["bucket"], ends, n)],
                  ["block", "bucket", "kind", "codes"])


def _ask_windows(depth: int, bits: int):
    def run(docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return _frame([], ["bucket", "block", "digits"])
        own = Block(docs, depth)
        names, twice = own.last_digit(own.codes(_answer(told, "runs")))
        block = int(docs["__block"].iloc[0])
        return _frame([(k, block, names[x:y].tobytes() + twice[x:y].astype(np.uint8).tobytes())
                       for k, x, y in _slices(names, bits)], ["bucket", "block", "digits"])
    return run


def _judge_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("block")
    digits = [bytes(x) for x in pdf["digits"]]
    n = np.array([len(x) // 9 for x in digits])
    names = np.frombuffer(b"".join(x[:8 * k] for x, k in zip(digits, n)), np.uint64)
    flag = np.frombuffer(b"".join(x[8 * k:] for x, k in zip(digits, n)), np.uint8)
    _, back = np.unique(names, return_inverse=True)
    code = (np.bincount(back, weights=1 + flag)[back] > 1).astype(np.uint8)
    ends = np.cumsum(n)
    return _frame([(b, k, "windows", code[e - m:e].tobytes()) for b, k, e, m in zip(pdf["block"], pdf["bucket"], ends, n)],
                  ["block", "bucket", "kind", "codes"])


def _cover(depth: int):
    def run(docs: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return _frame([], ["id", "n_bytes", "starts", "ends", "kept"])
        own = Block(docs, depth)
        codes = own.codes(_answer(told, "runs"))
        parts = [(s, code, runs, *s.windows(runs)) for s, code, runs in own.windows(codes)]
        again = _distinct(np.concatenate([np.zeros(0, np.uint64), *(p[3] for p in parts)]))[0][_answer(told, "windows") > 0]
        found = [np.zeros((0, 3), np.int64)]  # document, start, end
        for s, code, runs, names, owner in parts:
            all_ = np.flatnonzero((code == 1) | (code == 3))
            found.append(np.c_[s.doc[all_], s.first[all_] + s.shift[all_], s.last[all_] + s.shift[all_] + depth])
            if len(runs) and len(again):
                hit = again[np.minimum(np.searchsorted(again, names), len(again) - 1)] == names
                inside = np.arange(len(names)) - np.searchsorted(owner, owner)
                at = (s.first[runs][owner] + inside + s.shift[runs][owner])[hit]
                found.append(np.c_[s.doc[runs][owner][hit], at, at + depth])
        found = np.concatenate(found)
        found = found[np.argsort(found[:, 0], kind="stable")]
        cuts = np.searchsorted(found[:, 0], np.arange(len(own.texts) + 1))
        spans = [found[x:y, 1:] for x, y in zip(cuts, cuts[1:])]
        rows = []
        for i, text, own_spans in zip(own.pdf["__id"], own.texts, spans):
            starts, ends = _union(own_spans)
            edges = [0, *np.c_[starts, ends].ravel().tolist(), len(text)]
            kept = b"".join(text[edges[k]:edges[k + 1]] for k in range(0, len(edges), 2))
            rows.append((i, len(text), starts, ends, kept))
        return _frame(rows, ["id", "n_bytes", "starts", "ends", "kept"])
    return run


def _union(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by half-open spans."""
    if not len(found):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    all_ = found[np.argsort(found[:, 0], kind="stable")]
    reach = np.maximum.accumulate(all_[:, 1])
    new = np.r_[True, all_[1:, 0] > reach[:-1]]
    heads = np.flatnonzero(new)
    return all_[heads, 0], reach[np.r_[heads[1:], len(all_)] - 1]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """-> one row per input row: `id_col`, n_bytes, starts, ends (the maximal removed runs, in bytes), kept (binary).

    Every byte goes that is covered by a string of `depth` bytes that also starts anywhere else. Texts shorter
    than that, null (as empty) and empty ones stay as they are. Rows repeating a text repeat all its
    windows. Null ids are ordinary; rows repeating an id share a block. An empty table gives no rows; other
    columns are not read."""
    if depth < 8:
        raise ValueError("depth must be at least 8 bytes")
    total = text_bytes(docs, text_col)
    blocks = parts_for(total, BLOCK_BYTES)
    runs_bits = (parts_for(total / (depth / 2.6) * 17, BUCKET_BYTES) - 1).bit_length()
    window_bits = (parts_for(total / 16 * 9, BUCKET_BYTES) - 1).bit_length()
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("__id"), whole_text(text_col).cast("binary").alias("__text"),
                       F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(blocks)).cast("long").alias("__block"))
    ask, tell = "bucket long, block long, digits binary", "block long, bucket long, kind string, codes binary"
    runs = (base.groupBy("__block").applyInPandas(_ask_runs(depth, runs_bits), ask)
            .groupBy("bucket").applyInPandas(_judge_runs, tell))
    windows = (base.groupBy("__block").cogroup(runs.groupBy("block")).applyInPandas(_ask_windows(depth, window_bits), ask)
               .groupBy("bucket").applyInPandas(_judge_windows, tell))
    out = base.groupBy("__block").cogroup(runs.unionByName(windows).groupBy("block")).applyInPandas(
        _cover(depth), f"id {id_type}, n_bytes long, starts array<long>, ends array<long>, kept binary")
    return out.withColumnRenamed("id", id_col)
