"""Operator 13, ranked lexical search by a dual tree.

1. One scan of the whole texts leaves each document's number of terms and its counts of the items' terms. The number of
   documents, all their terms and the document frequencies are sums over all of them.
2. A document's coordinate of a term is (10^9 * tf) div (1000 * tf + 8 * m), an item's is the term's weight, and a score is
   the sum of products over the item's terms, in exact integers.
3. Items form a hierarchy; so do the documents of each block of `DOC_BLOCK`. A node holds the maximum of every coordinate
   below it, so the sum of products of two nodes' maxima bounds every score between them. Both hierarchies
   are descended together; a pair of nodes goes away with its whole batch when its bound is below the weakest kth
   score of all items below it (kept per task over its blocks), or zero. Leaf pairs left are scored, the most
   promising first. The pruning is exact: nothing that could be among the best, ties included, is skipped.
4. Each block hands on its candidates, at most k an item; a rank window over them gives the answer.

Items are a stated query set: they are searched in batches of about `BATCH_ENTRIES` (item, term) entries and `BATCH_ITEMS`
items, so what is sent to the tasks does not grow with the number of items.
"""
from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from simpairs.llm.common import Scratch, cut, parts_for

DOC_BLOCK = 2048
LEAF = 16
FAN = 8
BATCH_ENTRIES = 16_384
BATCH_ITEMS = 512
PIECE = 1 << 20
_CUTS = [c <= 0x2F or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F for c in range(256)]
_FOLD = bytes(32 if cut_here else c + 32 if 65 <= c <= 90 else c for c, cut_here in enumerate(_CUTS))


def term_counts(text: str | None, piece: int = PIECE) -> Counter:
    """Terms of a whole text with their numbers: maximal runs of ASCII letters and digits and characters beyond ASCII,
    only A-Z lower-cased. Long texts are taken in pieces that end between terms."""
    b = (text or "").encode("utf-8", "replace").translate(_FOLD)
    found, at = Counter(), 0
    while at < len(b):
        end = at + piece
        if end < len(b):
            end = b.find(b" ", end)
            end = len(b) if end < 0 else end
        found.update(b[at:end].split(b" "))
        at = end
    found.pop(b"", None)
    return found


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, term): the distinct terms of each item."""
    @F.udf("array<string>", useArrow=True)
    def of(text):
        return [t.decode("utf-8", "replace") for t in term_counts(text)]
    return items.select(F.col(item_col).alias("item"), F.explode(of(F.col(text_col))).alias("term")).distinct()


def _profiles(sent, piece: int):
    """Documents with terms -> their number of terms and the counts of the sent terms."""
    def run(batches):
        number = sent.value
        for batch in batches:
            n, keep, sizes, terms, counts = [], [], [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                c = term_counts(text, piece)
                if c:
                    own = [(number[t], v) for t, v in c.items() if t in number]
                    keep.append(k)
                    n.append(c.total())
                    sizes.append(len(own))
                    terms.extend(t for t, _ in own)
                    counts.extend(v for _, v in own)
            offsets = pa.array(np.cumsum([0, *sizes]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, kind)) for x, kind in ((terms, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), *lists],
                                             ["doc", "n", "terms", "counts"])
    return run


def _grouped_max(node: np.ndarray, term: np.ndarray, value: np.ndarray, width: int):
    """The maximum value of each (node, term)."""
    key = node * width + term
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[first] // width, key[first] % width, np.maximum.reduceat(value, first) if len(first) else value


class ItemTree:
    """Levels of item nodes, leaves (single items) first; each level as postings: term -> (nodes, maxima)."""

    def __init__(self, item: np.ndarray, term: np.ndarray, weight: np.ndarray, fan: int = FAN, leaf: int = LEAF):
        """Entries (item, term) of items 0.., and a weight per term. `fan`: children of a node, of documents too; `leaf`:
        documents of a leaf."""
        self.fan, self.leaf = fan, leaf
        self.width = max(1, len(weight))
        n = int(item.max()) + 1 if len(item) else 0
        # items that share their most common terms stand together
        common = np.argsort(-np.bincount(term, minlength=self.width), kind="stable")[:24]
        has = np.zeros((n, len(common)), bool)
        place = np.full(self.width, -1)
        place[common] = np.arange(len(common))
        ok = place[term] >= 0
        has[item[ok], place[term[ok]]] = True
        self.order = np.lexsort(has.T[::-1]) if n else np.zeros(0, np.int64)
        rank = np.empty(n, np.int64)
        rank[self.order] = np.arange(n)
        self.levels, self.sizes = [], []
        node, t, v = rank[item], term.astype(np.int64), weight[term]
        while True:
            by = np.argsort(t, kind="stable")
            start = np.searchsorted(t[by], np.arange(self.width + 1))
            self.levels.append((start, node[by], v[by]))
            self.sizes.append(n)
            if n <= 1:
                break
            node, t, v = _grouped_max(node // fan, t, v, self.width)
            n = -(-n // fan)
        # scores as large as these sums of products must stay exact
        per_item = np.bincount(rank[item], weights=weight[term].astype(float), minlength=max(1, self.sizes[0]))
        top = float(self.levels[-1][2].astype(float).sum())
        self.exact = max(per_item.max() if len(per_item) else 0.0, top) * 1e6 < 2 ** 53

    def sums(self, level: int, node: np.ndarray, term: np.ndarray, value: np.ndarray, n_nodes: int) -> np.ndarray:
        """[n_nodes, item nodes]: sums of products of the entries (node, term, value) with the level's maxima."""
        start, items, maxima = self.levels[level]
        many = start[term + 1] - start[term]
        total = int(many.sum())
        at = np.repeat(start[term] - (np.cumsum(many) - many), many) + np.arange(total)
        cell = np.repeat(node, many) * self.sizes[level] + items[at]
        product = np.repeat(value, many) * maxima[at]
        if self.exact:
            out = np.bincount(cell, weights=product, minlength=n_nodes * self.sizes[level])
        else:
            out = np.zeros(n_nodes * self.sizes[level], np.int64)
            np.add.at(out, cell, product)
        return out.reshape(n_nodes, self.sizes[level])


def search_block(tree: ItemTree, doc: np.ndarray, term: np.ndarray, value: np.ndarray, strength: np.ndarray, n_docs: int,
                 kth: np.ndarray, k: int) -> tuple[list[tuple[int, int, int]], int]:
    """Entries (doc, term, value) of documents 0..n_docs-1, in the order of their ids -> candidates (item rank, doc,
    score), and the number of documents scored for an item. `kth`: per item (in tree order), a score that
    the answer's kth reaches at least; raised as scores are found."""
    leaf_size, fan = tree.leaf, tree.fan
    # documents with the same strongest term stand together
    by = np.lexsort((strength, doc))
    last = np.flatnonzero(np.r_[doc[by][1:] != doc[by][:-1], True]) if len(by) else by
    lead = np.full(n_docs, -1, np.int64)
    lead[doc[by][last]] = term[by][last]
    order = np.argsort(lead, kind="stable")
    place = np.empty(n_docs, np.int64)
    place[order] = np.arange(n_docs)
    pos = place[doc]
    by = np.argsort(pos, kind="stable")
    pos, term, value = pos[by], term[by], value[by]
    levels, sizes = [_grouped_max(pos // leaf_size, term, value, tree.width)], [-(-n_docs // leaf_size)]
    while sizes[-1] > 1:
        node, t, v = levels[-1]
        levels.append(_grouped_max(node // fan, t, v, tree.width))
        sizes.append(-(-sizes[-1] // fan))
    weakest = [kth]
    for n in tree.sizes[1:]:
        weakest.append(np.minimum.reduceat(weakest[-1], np.arange(0, len(weakest[-1]), fan)))
    d, i = len(levels) - 1, len(tree.levels) - 1
    alive = np.ones((sizes[d], tree.sizes[i]), bool)
    while True:
        node, t, v = levels[d]
        some = alive.any(axis=1)[node]
        bound = tree.sums(i, node[some], t[some], v[some], sizes[d])
        alive &= (bound > 0) & (bound >= weakest[i][None, :])
        if not d and not i or not alive.any():
            break
        if d:
            d -= 1
            alive = np.repeat(alive, fan, axis=0)[:sizes[d]]
        if i:
            i -= 1
            alive = np.repeat(alive, fan, axis=1)[:, :tree.sizes[i]]
    if not alive.any():
        return [], 0
    kept: dict[int, list[tuple[int, int]]] = {}
    edges = np.searchsorted(pos, np.arange(sizes[0] + 1) * leaf_size)
    best = np.where(alive, bound, 0).max(axis=1)
    scored = 0
    for leaf in np.argsort(-best, kind="stable"):
        if not best[leaf]:
            break
        items = np.flatnonzero(alive[leaf] & (bound[leaf] >= kth))
        if not len(items):
            continue
        e = slice(edges[leaf], edges[leaf + 1])
        s = tree.sums(0, pos[e] - leaf * leaf_size, term[e], value[e], leaf_size)[:, items]
        scored += s.size
        for r, c in zip(*np.nonzero((s > 0) & (s >= kth[items][None, :]))):
            q, of, x = int(items[c]), int(order[leaf * leaf_size + r]), int(s[r, c])
            own = kept.setdefault(q, [])
            own.append((-x, of))
            if len(own) >= 4 * k:
                own.sort()
                del own[k:]
            if len(own) >= k:
                kth[q] = max(kth[q], -sorted(own)[k - 1][0])
    return [(q, of, -x) for q, own in kept.items() for x, of in sorted(own)[:k]], scored


def _search(sent, k: int, block: int):
    """Profiles -> (item, doc, score) candidates."""
    def run(batches):
        tree, weight, n_all, l_all = sent.value
        kth = np.zeros(max(1, tree.sizes[0]), np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, block):
                part = batch.slice(lo, block)
                ids = part.column("doc").to_pylist()
                order = sorted(range(len(ids)), key=lambda x: (ids[x] is None, ids[x] if ids[x] is not None else 0))
                part = part.take(pa.array(order, pa.int64()))
                ids = [ids[x] for x in order]
                terms, counts = part.column("terms"), part.column("counts")
                sizes = np.diff(terms.offsets.to_numpy())
                m = np.array([10 + 90 * n * n_all // l_all for n in part.column("n").to_pylist()], np.int64)
                term = terms.flatten().to_numpy().astype(np.int64)
                tf = counts.flatten().to_numpy()
                doc = np.repeat(np.arange(len(ids)), sizes)
                value = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
                found, _ = search_block(tree, doc, term, value, weight[term] * value, len(ids), kth, k)
                q, at, s = zip(*found) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(tree.order[x]) for x in q], pa.int32()), pa.array([ids[x] for x in at], part.column("doc").type),
                     pa.array(s, pa.int64())], ["q", "doc", "score"])
    return run


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """-> `item_col`, rank (int, from 1), `id_col`, score: the k highest-scoring documents of each item, scores above 0 only, equal
    scores by ascending id (a null id last).

    Null texts, and texts without terms, match nothing and are not counted. Rows that repeat a document's id are documents
    of their own; rows that repeat an item's id are one item with the terms of all. Items without terms, or whose terms no
    document holds, have no rows; so do empty tables. Other columns are not read."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical-search")
    base = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    doc_type = base.schema["doc"].dataType.simpleString()
    try:
        entries = scratch.table(item_terms(items, item_col, item_text_col), "items")
        size = entries.agg(F.count(F.lit(1)).alias("e"), F.countDistinct(F.struct("item")).alias("i")).first()
        batches = max(parts_for(size["e"], BATCH_ENTRIES), parts_for(size["i"], BATCH_ITEMS))
        out = None
        for b in range(batches):
            own = entries.where(F.pmod(F.xxhash64("item"), F.lit(batches)) == b).orderBy("item", "term").collect()
            names = list(dict.fromkeys(r["item"] for r in own))
            of, number = {x: q for q, x in enumerate(names)}, {t: j for j, t in enumerate(sorted({r["term"] for r in own}))}
            sent = spark.sparkContext.broadcast({t.encode(): j for t, j in number.items()})
            profiles = scratch.table(base.mapInArrow(_profiles(sent, PIECE), f"doc {doc_type}, n long, terms array<int>, counts array<long>"), f"profiles-{b}")
            sent.destroy()
            total = profiles.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("l")).first()
            if not total["n"]:
                continue
            # one row per term of the batch
            weight = F.floor(1000 * F.log(F.lit(float(2 * total["n"] + 2)) / (2 * F.count(F.lit(1)) + 1))).alias("w")
            weights = np.zeros(len(number), np.int64)
            for r in profiles.select(F.explode("terms").alias("t")).groupBy("t").agg(weight).collect():
                weights[r["t"]] = r["w"]
            tree = ItemTree(np.array([of[r["item"]] for r in own], np.int64), np.array([number[r["term"]] for r in own], np.int64), weights, FAN, LEAF)
            sent = spark.sparkContext.broadcast((tree, weights, total["n"], total["l"]))
            found = profiles.where(F.size("terms") > 0).mapInArrow(_search(sent, k, DOC_BLOCK), f"q int, doc {doc_type}, score long")
            best = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
            top = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            name = spark.createDataFrame(list(enumerate(names)), f"q int, item {entries.schema['item'].dataType.simpleString()}")
            part = scratch.table(top.join(F.broadcast(name), "q").select("item", "rank", "doc", "score"), f"found-{b}")
            sent.destroy()
            out = part if out is None else out.unionByName(part)
        if out is None:
            kind = entries.schema["item"].dataType.simpleString()
            out = spark.createDataFrame([], f"item {kind}, rank int, doc {doc_type}, score long")
        return cut(out.select(F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score"))
    finally:
        scratch.remove()
