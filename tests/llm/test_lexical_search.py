import math
import random
import re

import numpy as np
import pytest

from simpairs.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    """The contract over lists of (id, text)."""
    own = [(i, w) for i, t in docs if (w := words(t))]
    n_all, l_all = len(own), sum(len(w) for _, w in own)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(words(t))
    df = {}
    for _, w in own:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for i, terms in wanted.items():
        found = []
        for d, w in own:
            m = 100 - 90 + 90 * len(w) * n_all // l_all
            s = 0
            for t in terms:
                if tf := w.count(t):
                    s += math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * (1000000000 * tf // (1000 * tf + 8 * m))
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def _run(spark, docs, items, k=10):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, doc string")
    i = spark.createDataFrame([(x, t, 2) for x, t in items], "item_id long, text string, rank int")
    got = ls.search(d, i, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def _corpus(rng, n):
    zipf = [f"w{j}" for j in range(300)]
    def text(size):
        return " ".join(rng.choice(zipf[:rng.choice([5, 40, 300])]) for _ in range(size))
    docs = [(1000 - k, text(rng.randint(1, 60))) for k in range(n)]
    items = [(k, text(rng.randint(3, 25))) for k in range(30)]
    docs += [(2000 + k, items[k % 5][1] + " " + text(5)) for k in range(40)]  # passages of items, many with equal scores
    docs += [(3000 + k, items[1][1]) for k in range(20)]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_equal_to_brute_force(spark, monkeypatch, small):
    if small:  # many blocks, deep trees, several item batches, long texts in pieces
        for name, value in (("DOC_BLOCK", 50), ("LEAF", 3), ("FAN", 2), ("BATCH_ITEMS", 11), ("PIECE", 40)):
            monkeypatch.setattr(ls, name, value)
    docs, items = _corpus(random.Random(7), 400)
    docs += [(None, items[0][1]), (None, None), (5, None), (6, ""), (7, " .,!"), docs[0], docs[0], (1000, "other w1 text"), (8, "w250 " * 30_000)]
    items += [(100, None), (101, "..."), (102, "nowhere"), (0, "w7 w8 W9!w10"), (None, "w3 w4")]
    assert _run(spark, docs, items) == brute(docs, items)


def test_characters(spark):
    docs = [(1, "Été ÀB-cd a1_b2\x7fZ[z]"), (2, "été àb CD A1 b2 z"), (3, "`quoted`{x}@y:z;0/9"), (4, "İstanbul ＡＢ")]
    items = [(1, "ÉTÉ Été"), (2, "cd A1"), (3, "quoted x y z 0 9"), (4, "İstanbul ａｂ ＡＢ")]
    assert _run(spark, docs, items, 2) == brute(docs, items, 2)


def test_empty_tables(spark):
    assert _run(spark, [], [(1, "a")]) == [] == _run(spark, [(1, "a")], [])
    assert _run(spark, [(1, None)], [(1, "a")]) == []


def _block(rng, n_docs, n_items, vocabulary, scale=1):
    item, term = np.nonzero(rng.random((n_items, vocabulary)) < 0.1)
    weight = rng.integers(1, 9000, vocabulary) * scale
    doc, t = np.nonzero(rng.random((n_docs, vocabulary)) < 0.05)
    value = rng.integers(1, 1_000_000, len(doc))
    w = np.zeros((n_items, vocabulary), object)
    w[item, term] = weight[term]
    x = np.zeros((n_docs, vocabulary), object)
    x[doc, t] = value
    return ls.ItemTree(item, term, weight), doc, t, value, weight[t] * value, w @ x.T


@pytest.mark.parametrize("scale", [1, 10 ** 7])
def test_pruning_is_exact_and_prunes(scale):
    """Also where sums no longer fit floating point."""
    rng = np.random.default_rng(2)
    tree, doc, term, value, strength, scores = _block(rng, 600, 40, 200, scale)
    assert tree.exact == (scale == 1) and len(tree.levels) == 3
    kth = np.zeros(40, np.int64)
    found, scored = ls.search_block(tree, doc, term, value, strength, 600, kth, 10)
    got = {}
    for q, d, s in found:
        got.setdefault(int(tree.order[q]), []).append((-s, d))
    for i in range(40):
        want = sorted((-int(s), d) for d, s in enumerate(scores[i]) if s > 0)[:10]
        assert sorted(got.get(i, [])) == want
        assert kth[list(tree.order).index(i)] == (-want[-1][0] if len(want) == 10 else 0)
    again, less = ls.search_block(tree, doc, term, value, strength, 600, kth, 10)
    assert less < scored <= 40 * 608 and sorted(again) == sorted(found)


def test_node_maxima_bound_all_scores():
    rng = np.random.default_rng(3)
    tree, doc, term, value, _, scores = _block(rng, 64, 20, 80)
    top = ls._grouped_max(doc * 0, term, value, tree.width)
    for level in range(len(tree.levels)):
        bound = tree.sums(level, *top, 1)[0]
        for q, item in enumerate(tree.order):
            assert bound[q // ls.FAN ** level] >= scores[item].max()
