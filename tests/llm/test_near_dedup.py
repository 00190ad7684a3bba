import random
import re

import numpy as np
import pytest

from simpairs.llm import near_dedup as nd
from simpairs.llm.components import components
from simpairs.llm.words import shingle_set, text_words, word_hashes


def shingles(t, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute(rows, size):
    """Per row: set size and component; equal sets and sets of similarity 0.8 or more are linked."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for x in range(len(rows)):
        for y in range(x):
            a, b = sets[x], sets[y]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(x)] = find(y)
    out = []
    for x, (i, _) in enumerate(rows):
        ids = [rows[y][0] for y in range(len(rows)) if find(y) == find(x) and rows[y][0] is not None]
        out.append((i, len(sets[x]), min(ids, default=None) if sets[x] else i))
    return out


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    out = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([3, 4, 6, 30, 120]))]
        for _ in range(rng.randint(1, 4)):
            out.append(" ".join(base if rng.random() < 0.4 else edited(rng, base, rng.randint(1, 3))))
    # one large group: copies of a text with edits of their own, most pairs below the threshold
    base = [word() for _ in range(100)]
    out += [" ".join(edited(rng, base, rng.choice([1, 2, 2, 3, 4]))) for _ in range(120)]
    out += [out[5].upper(), out[5].replace(" ", "\n\t"), "", "  \n", "One", "one", "one two"]
    rng.shuffle(out)
    return [(3 * k + 2, t) for k, t in enumerate(out)] + [(0, None), (None, out[5]), (None, "null id alone"), (2, out[0]), (2, out[0])]


@pytest.mark.parametrize("chunk", [512, 7])
def test_equals_brute_force(spark, rows, chunk, monkeypatch):
    monkeypatch.setattr(nd, "CHUNK", chunk)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, node int, kept string")
    got = nd.near_groups(docs, words=4)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = brute(rows, 4)
    found = got.collect()
    assert sorted(str(tuple(r)[:3]) for r in found) == sorted(map(str, want))
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_rows_that_stay(spark, rows):
    names = "doc_id long, text string, __gone string, row long, gone_id int, all int, stays string"
    docs = spark.createDataFrame([(i, t, "c", 1, 2, 3, "s") for i, t in rows if i is not None], names).dropDuplicates()
    out = nd.drop_near(docs)
    want = {i for i, _, c in brute([r for r in rows if r[0] is not None], 5) if i == c}
    assert out.columns == docs.columns and {r.doc_id for r in out.collect()} == want


def test_repeated_ids_and_null_ids(spark):
    """Rows count by their text: an id may come with two texts, null ids have links."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    other = [f"v{rng.randrange(10**6)}" for _ in range(60)]
    near, far = " ".join(edited(rng, base, 1)), " ".join(edited(rng, other, 1))
    rows = [(1, " ".join(base)), (2, near), (2, "quite another text of this id"), (None, " ".join(other)), (None, far), (None, "alone"), (2**60 + 1, "big id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = nd.near_groups(docs)
    assert sorted(str(tuple(r)[:3]) for r in got.collect()) == sorted(map(str, brute(rows, 5)))
    kept = sorted((str(r.doc_id), r.text) for r in nd.drop_near(docs).collect())
    assert len(kept) == 5 and ("2", "quite another text of this id") in kept and ("1", rows[0][1]) in kept
    assert sum(k in (("None", rows[3][1]), ("None", far)) for k in kept) == 1 and ("None", "alone") in kept


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert nd.near_groups(empty).count() == 0 and nd.drop_near(empty).count() == 0


def test_pruning_bounds():
    """A kept pair of similarity 0.8 is lost with less than the chosen probability."""
    from math import comb
    for n, m in nd.least_matches(0.8, 1e-4):
        post = lambda k: sum(comb(n + 1, j) * .8 ** j * .2 ** (n + 1 - j) for j in range(k + 1))  # noqa: B023, E731
        assert post(m) >= 1e-4 and (m == 0 or post(m - 1) < 1e-4)
    sig = np.arange(nd.BANDS * nd.ROWS, dtype=np.uint32)
    other = np.stack([sig, sig + 1, np.where(sig % 10 == 0, sig + 1, sig)])
    left, matches = nd._survive(sig[None], other, nd.least_matches(0.8, 1e-4))
    assert left.tolist() == [0, 2] and matches[0] == len(sig)


def test_words_in_pieces():
    t = "Ab c\td" * 50 + "x" * 100 + " é\x0bz"
    assert text_words(t, chunk=17).tolist() == word_hashes(np.frombuffer(t.encode(), np.uint8)).tolist()
    assert len(shingle_set(text_words("a b c a b c a"), 4)) == 3 and len(shingle_set(text_words("a"), 4)) == 1


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, k) for k in range(2001, 2100)] + [(5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
