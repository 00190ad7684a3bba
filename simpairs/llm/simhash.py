"""Operator 11, SimHash near-dedup by bit-sliced comparison.

1. Every whole text gets a 64-bit SimHash of its word shingles, repeats included. Documents with the same
   fingerprint are one node from here on.
2. Candidates: the 64 bits are cut into radius + 2 parts. Two fingerprints that differ in at most `radius` bits
   agree on two whole parts at least, so a bucket for each pair of parts (ten tables of about 26 bits for radius 3)
   misses no link. Buckets of one fingerprint go away; larger ones than `CHUNK` are cut into chunks,
   and every two chunks meet in one group, so no group grows with the data.
3. Inside a group the fingerprints are stored as bit planes, 64 documents a machine word. A query's distances to a
   word's documents are updated together, two planes at a time, by carry-save bitwise counters that overflow
   beyond the radius; a word whose documents all have overflowed is abandoned. This is exact.
4. Links of a group leave it as a forest (each fingerprint to the least of its component in the group), and the
   forests' components over all groups are the classes.
"""
from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.llm.common import Scratch, cut, whole_text
from simpairs.llm.components import components
from simpairs.operators.lookup import lookup

SEED = 42
CHUNK = 2048
#: shingles hashed, and words compared, at a time
_SLICE = 8192
_WORDS = 1 << 15
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def simhash(text: str | None, words: int = 3) -> int:
    """Unsigned 64-bit fingerprint of a whole text: a bit is 1 if set in over half of the shingles' hashes."""
    w = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not w:
        return 0
    joined = b" ".join(w)
    n = min(words, len(w))
    size = np.fromiter(map(len, w), np.int64, len(w)) + 1
    ends = np.cumsum(size) - 1
    starts = (ends - size + 1)[:len(w) - n + 1]
    ends = ends[n - 1:]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _SLICE):
        a, b = starts[at:at + _SLICE].tolist(), ends[at:at + _SLICE].tolist()
        h = np.array([digest(joined[i:j], SEED) for i, j in zip(a, b)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = 2 * ones > len(starts)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_col: str = "text", words: int = 3, keep: list[str] | None = None, name: str = "fp") -> DataFrame:
    """`keep` columns of docs (all by default) and `name`: the fingerprint as a long."""
    keep = docs.columns if keep is None else keep

    @F.udf("long", useArrow=True)
    def of(text):
        return int(np.uint64(simhash(text, words)).astype(np.int64))
    return docs.select(*keep, of(whole_text(text_col)).alias(name))


def masks(radius: int) -> list[int]:
    """One mask per pair of the radius + 2 parts of 64 bits."""
    parts = radius + 2
    edges = [64 * k // parts for k in range(parts + 1)]
    part = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    return [a | b for a, b in combinations(part, 2)]


def planes(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vertical form of groups that lie one after another in `values`: (planes [64, words], alive [words], the first
    word of each group). Bit j of a word in plane i is bit i of the word's j-th document."""
    n_words = (sizes + 63) // 64
    first = np.cumsum(n_words) - n_words
    rows = np.zeros((int(n_words.sum()), 64), np.uint64)
    alive = np.zeros(rows.shape, bool)
    within = np.arange(len(values)) - np.repeat(starts, sizes)
    at = np.repeat(first, sizes) + within // 64
    rows[at, within % 64] = values
    alive[at, within % 64] = True
    bits = np.unpackbits(rows.view(np.uint8).reshape(len(rows), 64, 8), axis=2, bitorder="little")
    vertical = np.ascontiguousarray(np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")).view(np.uint64).reshape(64, -1)
    return vertical, np.packbits(alive, axis=1, bitorder="little").reshape(-1).view(np.uint64), first


def within_radius(vertical: np.ndarray, alive: np.ndarray, query: np.ndarray, word: np.ndarray, after: np.ndarray,
                  radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of a (query, word) pair, bits of the word's documents within the radius); pairs without any are left out.
    `after`: the documents of the word to be compared."""
    levels = max(1, int(radius + 1).bit_length() - (radius + 1 & radius == 0))
    preload = (1 << levels) - 1 - radius  # the counters overflow beyond the radius
    left = np.arange(len(query))
    want = after & alive[word]
    counter = [np.full(len(query), _ALL if preload >> k & 1 else 0, np.uint64) for k in range(levels)]
    over = ~want
    for p in range(0, 64, 2):
        a = vertical[p, word] ^ (np.uint64(0) - (query >> np.uint64(p) & np.uint64(1)))
        b = vertical[p + 1, word] ^ (np.uint64(0) - (query >> np.uint64(p + 1) & np.uint64(1)))
        both = counter[0] ^ a
        carry = (counter[0] & a) | (b & both)
        counter[0] = both ^ b
        for k in range(1, levels):
            more = counter[k] & carry
            counter[k] ^= carry
            carry = more
        over |= carry
        if p % 8 == 6:
            go = over != _ALL
            if not go.all():
                left, query, word, over = left[go], query[go], word[go], over[go]
                counter = [c[go] for c in counter]
                if not len(left):
                    break
    return left, ~over


def group_forest(values: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Groups that lie one after another in `values` (uint64) -> links (index, index of the first member of its component
    in the group)."""
    starts = np.cumsum(sizes) - sizes
    vertical, alive, first = planes(values, starts, sizes)
    within = np.arange(len(values)) - np.repeat(starts, sizes)
    own_word = np.repeat(first, sizes) + within // 64
    n_more = np.repeat((sizes + 63) // 64, sizes) - within // 64  # words from the own one on
    base = np.arange(len(values))
    label = base.copy()
    total = np.cumsum(n_more)
    lo = 0
    while lo < len(values):
        done = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, done + _WORDS, "right")))
        q = np.repeat(base[lo:hi], n_more[lo:hi])
        step = np.arange(len(q)) - np.repeat(total[lo:hi] - n_more[lo:hi] - done, n_more[lo:hi])
        word = own_word[q] + step
        # in its own word, only the documents after itself
        later = np.where(step == 0, _ALL << (within[q] % 64).astype(np.uint64) << np.uint64(1), _ALL)
        pair, bits = within_radius(vertical, alive, values[q], word, later, radius)
        if len(pair):
            hit, place = np.nonzero(np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            u = q[pair[hit]]
            v = u - within[u] + (word[pair[hit]] - first_of(first, word[pair[hit]])) * 64 + place
            _join(label, u, v)
        lo = hi
    moved = np.flatnonzero(label != base)
    return moved, label[moved]


def first_of(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    """First word of the group that a word belongs to."""
    return first[np.searchsorted(first, word, "right") - 1]


def _join(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Merge the components of the links (u, v); a label is the least index of its component."""
    while len(u):
        a, b = label[u], label[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _links(radius: int):
    """Sorted rows (bucket columns, fp) -> links between fingerprints; a group that ends with a batch waits for the next."""
    keys = ["t", "part", "i", "j"]

    def run(batches):
        held = None

        def found(table, upto):
            fp = table["fp"][:upto]
            change = np.any([table[k][1:upto] != table[k][:upto - 1] for k in keys], axis=0)
            starts = np.r_[0, np.flatnonzero(change) + 1]
            moved, root = group_forest(fp.view(np.uint64), np.diff(np.r_[starts, upto]), radius)
            return pa.RecordBatch.from_arrays([pa.array(fp[moved]), pa.array(fp[root])], ["a", "b"])

        for batch in batches:
            now = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in [*keys, "fp"]}
            held = now if held is None else {c: np.concatenate([held[c], now[c]]) for c in now}
            n = len(held["fp"])
            if not n:
                continue
            same = np.all([held[k] == held[k][-1] for k in keys], axis=0)
            last = n - int(np.argmin(same[::-1])) if not same.all() else 0  # first row of the last group
            if last:
                yield found(held, last)
                held = {c: x[last:] for c, x in held.items()}
        if held is not None and len(held["fp"]):
            yield found(held, len(held["fp"]))
    return run


def links(nodes: DataFrame, radius: int = 3) -> DataFrame:
    """nodes(fp: distinct longs) -> (a, b): links that join exactly the fingerprints reachable over steps of at most
    `radius` differing bits."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("part"))
                       for t, m in enumerate(masks(radius))])
    rows = nodes.select("fp", F.explode(tables).alias("x")).select("fp", "x.t", "x.part")
    shared = rows.groupBy("t", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(shared, ["t", "part"])
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    rows = rows.withColumn("c", chunks).withColumn("own", F.pmod(F.xxhash64("fp", F.lit(5)), F.col("c")).cast("int"))
    other = F.when(F.col("c") == 1, F.array(F.lit(0))).otherwise(
        F.array_remove(F.sequence(F.lit(0), F.col("c") - 1), F.col("own")))
    rows = rows.select("fp", "t", "part", "own", F.explode(other).alias("o"))
    rows = rows.select("t", "part", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "fp")
    dealt = rows.repartition("t", "part", "i", "j").sortWithinPartitions("t", "part", "i", "j")
    return dealt.mapInArrow(_links(radius), "a long, b long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3) -> DataFrame:
    """-> one row per input row: `id_col`, fingerprint (16 lowercase hex digits), component_id.

    Fingerprints link at `radius` or fewer differing bits; component_id is the least id reachable, itself included.
    Null and empty texts, and texts without words, have fingerprint zero and are linked like any other. Rows are judged
    by their text: rows that repeat an id with another text each have their own fingerprint and component. A
    null id is never a component's least id, unless the component has no other: then component_id is null. An empty
    table gives no rows; other columns are not read."""
    scratch = Scratch(docs.sparkSession, "simhash")
    try:
        told = scratch.table(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", words, ["id"]), "documents")
        nodes = scratch.table(told.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
        found = scratch.table(links(nodes.select("fp"), radius), "links")
        roots = components(found)
        placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
        least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
        classes = scratch.table(placed.join(least, "root").select("fp", "component_id"), "classes")
        return cut(lookup(told, "fp", classes).select(
            F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))
    finally:
        scratch.remove()
