"""Operator 8, MinHash near-dedup with sequential Bayesian verification.

1. Every document gets its shingle set, a 64-bit name of that set, `BANDS` x `ROWS` MinHash values and
   a key per band. Documents with the same set are one node from here on.
2. Band buckets with two or more nodes give candidates: each node against the bucket's least node.
3. Candidates are compared signature batch by signature batch; a pair is dropped as soon as, given the
   matches so far and a uniform prior, the probability that its similarity reaches the threshold is
   below `MISS`. Survivors are verified exactly on the full sets.
4. Verified links give components. A bucket whose nodes are still in different components is
   open: its nodes outside the main component are compared (same batches, same pruning, same exact check)
   with every node of the other components, in chunks of bounded size, each chunk
   pair emitting only a spanning forest. So every link that joins two components is tested, while no
   bucket is turned into all its pairs.

Miss: a pair of similarity 0.8 shares no band with probability (1 - 0.8^5)^27 = 2.2e-5, one of 0.85
with 3e-7; pruning loses at most 1e-7 per pair. Set names are 64-bit: ten billion distinct texts
give fewer than three wrong merges.
"""
from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.llm.common import Scratch, bounded, cut, tidy, whole_text
from simpairs.llm.components import components
from simpairs.llm.words import mix, shingle_set, text_words

BANDS, ROWS = 27, 5
MISS = 1e-7
CHUNK = 512
_SEEDS = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
_A, _B = _SEEDS[:BANDS * ROWS] | np.uint64(1), _SEEDS[BANDS * ROWS:]


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values (uint32) of a non-empty set."""
    least = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at:at + 4096, None] * _A[None, :] + _B[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    total = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    for k in range(ROWS):
        total = mix(total + rows[:, k])
    return total.view(np.int64)


def set_name(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_matches(threshold: float, miss: float, batch: int = 27) -> list[tuple[int, int]]:
    """(n, m): after n values, fewer than m matches make similarity >= threshold less likely than `miss`.
    With a uniform prior that probability is P(Binomial(n + 1, threshold) <= matches)."""
    out = []
    for n in range(batch, BANDS * ROWS + 1, batch):
        below, m = 0.0, 0
        while True:
            below += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if below >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def _survive(a: np.ndarray, b: np.ndarray, steps: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the rows of `a`, `b` that pass every batch, and their matches."""
    left, matches, done = np.arange(len(b)), np.zeros(len(b), np.int32), 0
    for n, least in steps:
        x = a[left, done:n] if len(a) == len(b) else a[:, done:n]
        matches = matches + (x == b[left, done:n]).sum(axis=1)
        ok = matches >= least
        left, matches, done = left[ok], matches[ok], n
    return left, matches


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _describe(size: int):
    """id and row key go through as they are."""
    def run(batches):
        for batch in batches:
            n, node, sig, keys = [], [], [], []
            for t in batch.column("text").to_pylist():
                s = shingle_set(text_words(t), size)
                m = signature(s) if len(s) else None
                n.append(len(s))
                node.append(set_name(s) if len(s) else None)
                sig.append(m.tobytes() if len(s) else None)
                keys.append(band_keys(m).tolist() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(sig, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], ["id", "row", "n", "node", "sig", "bands"])
        tidy()
    return run


def _sets(size: int):
    def run(batches):
        for batch in batches:
            sets = [shingle_set(text_words(t), size) for t in batch.column("text").to_pylist()]
            ok = [k for k, (s, x) in enumerate(zip(sets, batch.column("node").to_pylist())) if len(s) and set_name(s) == x]
            # typed, so that a batch without any set is as good as another
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(ok, pa.int64())), pa.array([len(sets[k]) for k in ok], pa.int64()),
                 pa.array([sets[k].view(np.int64) for k in ok], pa.list_(pa.int64()))], ["node", "n", "shingles"])
        tidy()
    return run


def _prune(steps):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                a, b = (np.frombuffer(b"".join(map(bytes, pdf[c])), np.uint32).reshape(len(pdf), -1) for c in ("sig_a", "sig_b"))
                keep = _survive(a, b, steps)[0]
                yield pdf[["a", "b"]].iloc[keep]
    return run


def _forest(steps, percent: int):
    """Verified links between components inside one chunk pair of one bucket: a spanning forest."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("node")
        t = int(pdf["band_no"].iloc[0])
        sig = np.frombuffer(b"".join(map(bytes, pdf["sig"])), np.uint32).reshape(len(pdf), -1)
        bands = np.stack(pdf["bands"].to_numpy())
        sets = [np.sort(np.asarray(s, np.int64)) for s in pdf["shingles"]]
        node, own = pdf["node"].to_numpy(), pd.factorize(pdf["root"])[0]
        side = pdf["side"].to_numpy()
        kind, order = int(pdf["kind"].iloc[0]), np.arange(len(pdf))
        group = np.arange(own.max() + 1)
        found = []
        # kind 0: outsiders (side 1) against insiders (side 0); 1: outsiders of one chunk; 2: of two (sides 1 and 2)
        for x in np.flatnonzero(side == 1):
            other = order[x + 1:] if kind == 1 else np.flatnonzero(side != 1)
            other = other[group[own[other]] != group[own[x]]]
            if t and len(other):  # a pair is looked at in its first common band only
                other = other[~(bands[other, :t] == bands[x, :t]).any(axis=1)]
            if not len(other):
                continue
            at, matches = _survive(sig[x:x + 1], sig[other], steps)
            for y in other[at[np.argsort(-matches, kind="stable")]]:
                if group[own[x]] != group[own[y]] and _linked(sets[x], sets[y], percent):
                    group[group == group[own[y]]] = group[own[x]]
                    found.append((node[x], node[y]))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")
    return run


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                percent: int = 80) -> DataFrame:
    """-> one row per input row: `id_col`, n_shingles, component_id, kept.

    Texts with 100 * |intersection| >= percent * |union| of their shingle sets are linked; component_id is the
    least id reachable. Texts without words (null and empty ones too) have n_shingles 0, are linked with
    nothing and stay. Rows are judged by their text: rows with null ids, and rows that repeat an id with another
    text, have links of their own; a component of null ids alone has component_id null. An empty table gives no rows;
    other columns are not read."""
    return _judged(docs, id_col, text_col, words, percent).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _judged(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """(id, row, n, component_id, stays): `row` is a hash of the whole text; of a component, the rows of the least (id, row), null ids
    last, stay."""
    scratch = Scratch(docs.sparkSession, "near-dedup")
    try:
        return _components(docs, id_col, text_col, words, percent, scratch)
    finally:
        scratch.remove()


def _components(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, scratch: Scratch) -> DataFrame:
    base = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text")).select("id", F.xxhash64("text").alias("row"), "text")
    id_type = base.schema["id"].dataType.simpleString()
    steps = least_matches(percent / 100, MISS)
    told = scratch.table(base.mapInArrow(_describe(words), f"id {id_type}, row long, n long, node long, sig binary, bands array<long>"),
                         "documents")
    rows = told.where("node IS NOT NULL").select("node", F.posexplode("bands").alias("band_no", "band"))
    shared = rows.groupBy("band").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead != last")
    members = scratch.table(rows.join(shared.select("band", "lead"), "band").groupBy("band", "node")
                            .agg(F.min("lead").alias("lead"), F.min("band_no").alias("band_no")), "members")
    nodes = members.select("node").distinct()
    # one row stands for a node, named by id and text
    picked = scratch.table(told.join(nodes, "node", "left_semi").groupBy(F.col("node").alias("of"))
                           .agg(F.min(F.struct("id", "row")).alias("p")).select("of", F.col("p.id").alias("p_id"), F.col("p.row").alias("p_row")), "picked")
    this = F.col("id").eqNullSafe(F.col("p_id")) & (F.col("row") == F.col("p_row"))
    sigs = scratch.table(told.select("id", "row", "node", "sig", "bands").join(picked, (F.col("node") == F.col("of")) & this, "left_semi")
                         .dropDuplicates(["node"]).select("node", "sig", "bands"), "signatures")
    n_picked = picked.count()

    # candidates against the bucket's least node, pruned batch by batch
    star = members.where("node != lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    side = [sigs.select(F.col("node").alias(c), F.col("sig").alias(f"sig_{c}")) for c in "ab"]
    left = scratch.table(star.join(side[0], "a").join(side[1], "b").select("a", "b", "sig_a", "sig_b")
                         .mapInPandas(_prune(steps), "a long, b long"), "survivors")
    # the full sets of the nodes that remain in question
    sets = scratch.table(base.join(bounded(picked, n_picked, 40), this).select(F.col("of").alias("node"), "text")
                         .mapInArrow(_sets(words), "node long, n long, shingles array<long>")
                         .dropDuplicates(["node"]), "sets")
    full = [sets.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("shingles").alias(f"s_{c}")) for c in "ab"]
    both = F.size(F.array_intersect("s_a", "s_b"))
    links = scratch.table(left.join(full[0], "a").join(full[1], "b")
                          .where(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both)).select("a", "b"), "links")
    roots = components(links)

    # open buckets: nodes of one bucket that are not yet in one component
    placed = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    per = (placed.groupBy("band").agg(F.min("root").alias("main"), F.max("root").alias("top"), F.count(F.lit(1)).alias("size"))
           .where("main != top AND size > 2").select("band", "main"))
    open_rows = scratch.table(placed.join(per, "band").select("band", "band_no", "node", "root", (F.col("root") != F.col("main")).alias("out")),
                              "open")
    sizes = (open_rows.groupBy("band").agg(F.ceil(F.sum(F.col("out").cast("int")) / CHUNK).cast("int").alias("n_out"),
                                           F.ceil(F.sum((~F.col("out")).cast("int")) / CHUNK).cast("int").alias("n_in")))
    spread = F.pmod(F.xxhash64("node", F.lit(3)), F.when(F.col("out"), F.col("n_out")).otherwise(F.col("n_in"))).cast("int")
    tasks = open_rows.join(sizes, "band").withColumn("mine", spread)

    def each(n):
        return F.sequence(F.lit(0), n - 1)

    def to(kind, i, j, side):
        return F.struct(F.lit(kind).alias("kind"), i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))

    mine = F.col("mine")
    out_in = F.transform(each(F.col("n_in")), lambda j: to(0, mine, j, 1))
    out_own = F.array(to(1, mine, mine, 1))
    out_low = F.transform(F.filter(each(F.col("n_out")), lambda j: j > mine), lambda j: to(2, mine, j, 1))
    out_high = F.transform(F.filter(each(F.col("n_out")), lambda j: j < mine), lambda j: to(2, j, mine, 2))
    in_out = F.transform(each(F.col("n_out")), lambda j: to(0, j, mine, 0))
    tasks = tasks.withColumn("t", F.explode(F.when(F.col("out"), F.concat(out_in, out_own, out_low, out_high)).otherwise(in_out)))
    fed = (tasks.select("band", "band_no", "node", "root", "t.*").join(sigs, "node").join(sets.select("node", "shingles"), "node"))
    more = scratch.table(fed.groupBy("band", "kind", "i", "j").applyInPandas(_forest(steps, percent), "a long, b long"), "more")
    roots = components(links.unionByName(more))

    whole = told.select("id", "row", "n", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    whole = cut(whole.select("id", "row", "n", "root"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    least = whole.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("component_id"), first)
    stays = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("row") == F.col("first.row"))
    found = whole.where("root IS NOT NULL").join(least, "root").select("id", "row", "n", "component_id", stays.alias("stays"))
    return cut(found.unionByName(whole.where("root IS NULL").select("id", "row", "n", F.col("id").alias("component_id"), F.lit(True).alias("stays"))))


def drop_near(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that stay, with its columns, whatever their names: of each component the row of the least id (null ids
    last, ties by a hash of the text). Rows equal in id and text stay or go together; all else as in `near_groups`."""
    gone = cut(_judged(docs, id_col, text_col, words, percent).where("NOT stays").select(
        F.col("id").alias("gone_id"), F.col("row").alias("gone_row")).distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("all"), F.col(id_col).alias("id"),
                       F.xxhash64(whole_text(text_col)).alias("row"))
    this = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("row") == F.col("gone_row"))
    return rows.join(bounded(gone, gone.count(), 32), this, "left_anti").select("all.*")
