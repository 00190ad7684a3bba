import random

import numpy as np
import pytest

from simpairs.llm import line_dedup as ld


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, s, n):
    for _ in range(n):
        k = rng.randrange(len(s) + 1)
        s = rng.choice([s[:k] + rng.choice("abé") + s[k:], s[:k] + s[k + 1:], s[:k] + rng.choice("abé") + s[k + 1:]])
    return s


@pytest.mark.parametrize("tau", [1, 2, 3])
def test_banded_distance_and_shared_segments(tau):
    rng = random.Random(tau)
    pool = ["".join(rng.choice("abé") for _ in range(rng.randint(4, 30))) for _ in range(40)]
    pool += [edited(rng, s, rng.randint(0, 4)) or "a" for s in pool for _ in range(3)]
    points = [np.frombuffer(s.encode("utf-32-le"), "<u4") for s in pool]
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(pool)), np.arange(len(pool))))
    want = np.array([abs(len(pool[x]) - len(pool[y])) <= tau and distance(pool[x], pool[y]) <= tau for x, y in zip(a, b)])
    assert (ld.within(points, a, b, tau) == want).all()
    assert (ld.within(points, a, b, tau, cells=64) == want).all()
    keys, owner, probe = ld.entries(pool, tau)
    index, probes = {}, {}
    for k, o, p in zip(keys.tolist(), owner.tolist(), probe.tolist()):
        (probes if p else index).setdefault(o, set()).add(k)
    for x, y in zip(a[want], b[want]):
        if len(pool[x]) <= len(pool[y]) and min(len(pool[x]), len(pool[y])) > tau:
            assert index[x] & (index[y] | probes.get(y, set())), (pool[x], pool[y])


def brute(rows, tau, least):
    lines = [(i, k, s) for i, t in rows for k, s in ld.own_lines(t)]
    own = sorted({s for _, _, s in lines})
    root = {s: s for s in own}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s
    links = dict.fromkeys(own, 0)
    for x in range(len(own)):
        for y in range(x):
            p, q = own[x], own[y]
            if min(len(p), len(q)) >= least and abs(len(p) - len(q)) <= tau and distance(p, q) <= tau:
                links[p] += 1
                links[q] += 1
                root[find(p)] = find(q)
    first = {}
    for i, k, s in sorted(lines, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        first.setdefault(find(s), (i, k))
    return {(i, k): (links[s], first[find(s)]) for i, k, s in lines}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    pool = ["".join(rng.choice("abcdefg é") for _ in range(rng.randint(1, 40))) for _ in range(60)]
    hot = "the one line that stands everywhere"
    out = []
    for k in range(80):
        lines = [edited(rng, rng.choice(pool), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 6))]
        lines.insert(rng.randrange(len(lines) + 1), hot if k % 3 else edited(rng, hot, 1))
        out.append((k, "\n".join(lines)))
    return out + [(80, None), (81, ""), (82, "\n \n"), (None, hot + "\nalone with a null id here"), (83, "  " + hot + " \t"), (84, out[0][1]), (84, out[0][1])]


@pytest.mark.parametrize("chunk", [512, 5])
def test_equals_brute_force(spark, rows, chunk, monkeypatch):
    monkeypatch.setattr(ld, "CHUNK", chunk)
    monkeypatch.setattr(ld, "BUCKET_BYTES", 4096)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, line int, h string")
    want = brute(rows, 2, 8)
    got = ld.line_classes(docs, tau=2, min_chars=8).collect()
    assert {(r.id, r.line) for r in got} == set(want)
    for r in got:
        assert (r.n_links, (r.first_id, r.first_line)) == want[(r.id, r.line)], (r, want[(r.id, r.line)])
        assert r.kept == ((r.id, r.line) == (r.first_id, r.first_line))


def test_texts(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows, 2, 16)
    out = ld.drop_lines(docs)
    assert out.columns == ["doc_id", "text", "__n_lines", "__n_links", "__removed"]
    texts = {}
    for r in out.collect():
        texts.setdefault(r.doc_id, r)
    for i, t in rows:
        gone = [k for k, _ in ld.own_lines(t) if want[(i, k)][1] != (i, k)]
        r = texts[i]
        assert r["__removed"] == gone and r["__n_lines"] == (len(t.split("\n")) if t else 0)
        assert r.text == (t if t is None else "\n".join(s for k, s in enumerate(t.split("\n")) if k not in gone))
    assert out.count() == len(rows)
    assert ld.line_classes(docs.limit(0)).count() == 0


def test_an_id_with_two_texts_keeps_unique_lines(spark):
    dup = "this very line stands in both of the texts"
    rows = [(5, dup + "\nonly here in the first text"), (5, "only there in the second text\n" + dup), (None, "a null id's own line, unique\nx"),
            (None, dup + "\nanother line of a null id, unique"), (2**60 + 1, dup)]
    got = {(r.doc_id, t): r for r, t in ((r, r.text) for r in ld.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())}
    texts = sorted(t for _, t in got)
    for line in ("only here in the first text", "only there in the second text", "a null id's own line, unique\nx", "another line of a null id, unique"):
        assert sum(line in t for t in texts) == 1, texts
    assert sum(dup in t for t in texts) == 1  # one copy stays, of the least (id, text)
