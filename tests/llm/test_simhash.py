import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from simpairs.llm import simhash as sh

WS = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]


def plain(text, k=3):
    """The contract, word for word."""
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for w in WS:
        t = t.replace(w, " ")
    w = [x for x in t.split(" ") if x]
    if not w:
        return 0
    s = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)]
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def roots(values, radius=3):
    """Component of each index, by all pairs."""
    own = list(range(len(values)))

    def top(x):
        while own[x] != x:
            x = own[x]
        return x
    for i, a in enumerate(values):
        for j in range(i):
            if bin(a ^ values[j]).count("1") <= radius:
                x, y = top(i), top(j)
                own[max(x, y)] = min(x, y)
    return [top(i) for i in range(len(values))]


def test_fingerprint_is_the_contract():
    rng = random.Random(1)
    texts = [None, "", " \n\t", "One", "one TWO", "ÀB cd\x0bEF", "a b a b a b", "x" * 100_000, "\x1f y z w"]
    texts += ["".join(rng.choice(["Ab ", "c", "\td ", "é ", "zz\n"]) for _ in range(rng.randint(1, 400))) for _ in range(60)]
    assert [sh.simhash(t) for t in texts] == [plain(t) for t in texts]
    assert sh.simhash("w " * 30_000) == plain("w " * 30_000)  # more shingles than a slice


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 6, 7])
def test_bit_slices_give_all_pairs(radius):
    rng = np.random.default_rng(radius)
    sizes = np.array([1, 2, 63, 64, 65, 130, 200])
    seeds = rng.integers(0, 1 << 63, 9, dtype=np.uint64)
    values = np.array([int(rng.choice(seeds)) ^ sum(1 << b for b in set(rng.integers(0, 64, rng.integers(0, 6)).tolist())) for _ in range(sizes.sum())], np.uint64)
    moved, root = sh.group_forest(values, sizes, radius)
    got, at = np.arange(len(values)), 0
    got[moved] = root
    for n in sizes:
        assert (got[at:at + n] - at).tolist() == roots([int(x) for x in values[at:at + n]], radius)
        at += n


def test_masks_miss_no_link():
    for radius in (0, 2, 3, 5):
        rng = random.Random(radius)
        m = sh.masks(radius)
        for _ in range(300):
            diff = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(diff & x == 0 for x in m)


def balls(rng, n):
    """Fingerprints around few centres, chains among them."""
    centres = [rng.getrandbits(64) for _ in range(6)]
    out = set()
    while len(out) < n:
        x = rng.choice(centres)
        for b in rng.sample(range(64), rng.randint(0, 5)):
            x ^= 1 << b
        out.add(x)
        if rng.random() < 0.2:
            out.add(rng.getrandbits(64))
    return sorted(out)


@pytest.mark.parametrize("chunk", [2048, 16])
def test_links_equal_brute_force(spark, monkeypatch, chunk):
    """Also with buckets cut into many chunks."""
    monkeypatch.setattr(sh, "CHUNK", chunk)
    values = balls(random.Random(chunk), 400)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    got = {r.node: r.root for r in sh.components(sh.links(nodes)).collect()}
    own = roots(values)
    groups = {}
    for k, v in enumerate(signed):
        groups.setdefault(got.get(v, v), set()).add(k)
    want = {}
    for k, r in enumerate(own):
        want.setdefault(r, set()).add(k)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def brute(rows):
    fp = [plain(t) for _, t in rows]
    own = roots(fp)
    least = {}
    for (i, _), r in zip(rows, own):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return sorted(((i, f"{f:016x}", least.get(r)) for (i, _), f, r in zip(rows, fp, own)), key=str)


def test_equal_to_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for k in range(40):
        w = [rng.choice("alpha Beta gamma delta eps zeta eta theta".split()) + str(rng.randint(0, 30)) for _ in range(rng.randint(1, 300))]
        rows.append((1000 - k, " ".join(w)))
        for c in range(k % 4):
            v = list(w)
            v[rng.randrange(len(v))] = "changed" if c else v[0]
            rows.append((k * 10 + c, "\n".join(v)))
    # nulls, empties, repeated rows, an id with two texts, null ids alone and among copies, a very long text
    rows += [(None, rows[0][1]), (None, "quite alone here"), (7, None), (8, ""), (9, " \t"), rows[1], rows[1], (3, "other text of three"),
             (5000, "Long " * 200_000), (5001, "long " * 200_000)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fp string, least int")
    got = sh.near_groups(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    assert sh.near_groups(docs.limit(0)).count() == 0


def test_query_covers_its_whole_table(spark):
    from simpairs.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in QUERIES["op11_simhash_dedup"](spark, sf).collect()), key=str) == brute(rows)
