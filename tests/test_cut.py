"""Words cut by table in tasks: the words of the cleaned text, for any characters, rows and nulls."""
import random

from pyspark.sql import functions as F

from simpairs.functions.text import DRAFT, clean_text, draft_text, tokenize
from simpairs.operators import blocks
from simpairs.operators.encode import encode
from simpairs.operators.features import jaccard_scores
from simpairs.operators.vocab import build_vocabulary

# all characters of the table, those just past it, and some that change length, context or place when lower-cased
CHARS = [chr(c) for c in range(0x250)] + ["ẞ", "K", "Å", "Σ", "ς", " ", "　", "﻿", "中", "𝒜", "😀", "ͅ", "Ⅷ", "ǅ", "̇"]


def _texts(spark):
    rng = random.Random(5)
    texts = [None, "", " ", "\x00", "İ", "a\x00b", "\x85", "É", " ÉA b ", "ÀΣ. ΑΣ", "x" * 500]
    texts += [c for c in CHARS] + [f"A{c}b C" for c in CHARS]
    for k in range(600):
        pool = CHARS[:0x80] if k % 3 == 0 else CHARS[:0x23A] if k % 3 == 1 else CHARS
        texts.append("".join(rng.choice(pool) if rng.random() < 0.6 else rng.choice("aB, \n") for _ in range(rng.randint(0, 60))))
    rows = [("k", k, t) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "category string, clause_id long, text string").repartition(3)


def _both(spark):
    t = _texts(spark)
    return (t.select("category", "clause_id", clean_text("text").alias("clause")),
            t.select("category", "clause_id", draft_text("text").alias(DRAFT)))


def test_cut_words_are_those_of_the_clean_text(spark, monkeypatch):
    clean, draft = _both(spark)
    words = {r.clause_id: r.t or [] for r in clean.select("clause_id", tokenize("clause").alias("t")).collect()}
    ids = {w: k for k, w in enumerate(sorted({w for t in words.values() for w in t}))}
    vocab = spark.createDataFrame([(w, k + 2) for w, k in ids.items()], "word string, idx int")
    for size in (1, 40, 1 << 22):
        monkeypatch.setattr(blocks, "BLOCK_BYTES", size)
        assert {r.clause_id: r.seq for r in encode(draft, vocab).collect()} == {k: [ids[w] + 2 for w in t] for k, t in words.items()}
    got = {r.clause_id: r.seq for r in encode(draft, vocab, max_len=3).collect()}
    assert got == {k: ([ids[w] + 2 for w in t] + [0, 0, 0])[:3] for k, t in words.items()}


def test_same_vocabulary_and_scores(spark):
    clean, draft = _both(spark)
    clean, draft = (d.where("clause_id > 0") for d in (clean, draft))
    assert sorted(build_vocabulary(draft, 1).collect()) == sorted(build_vocabulary(clean, 1).collect())
    n = clean.count()
    pairs = spark.range(2000).select(F.col("id").alias("pair_id"), (F.col("id") * 7 % n + 1).alias("id1"), (F.col("id") * 13 % n + 1).alias("id2"), F.lit(1).alias("label"))
    sets = {r.clause_id: set(r.t) for r in clean.select("clause_id", tokenize("clause").alias("t")).collect()}
    want = {}
    for r in pairs.collect():
        a, b = sets[r.id1], sets[r.id2]
        want[r.pair_id] = len(a & b) / max(1, len(a | b))
    for d in (clean, draft):
        assert {r.pair_id: r.probability for r in jaccard_scores(pairs, d).collect()} == want


def test_no_text_is_moved_to_the_pairs(spark):
    _, draft = _both(spark)
    pairs = spark.range(20).selectExpr("id as pair_id", "id + 1 as id1", "id + 2 as id2", "1 as label")
    assert "LeftSemi" not in jaccard_scores(pairs, draft)._jdf.queryExecution().optimizedPlan().toString()
    assert dict(blocks.word_sets(draft, "clause_id", blocks.words_of(draft), "t").dtypes)["t"] == "array<bigint>"


def test_words_at_the_edges_of_texts():
    import pyarrow as pa

    from simpairs.functions.cut import char_tables, cut_words
    texts = ["left out", "a", "b!", None, "", "!", "\u00c9T\u00c9 d'un", " x\u00a0y ", "I\u0130", "z"]
    want = [["a"], ["b"], None, [], [], ["\u00e9t\u00e9", "dun"], ["x", "y"], ["ii"], ["z"]]
    got = cut_words(pa.array(texts).slice(1), char_tables())
    got.validate(full=True)
    # no word runs over the end of its text, and each text's words are its own
    assert got.to_pylist() == want
    assert cut_words(pa.array([], pa.string()), char_tables()).to_pylist() == []


def test_drafts_of_texts_beyond_the_table_are_clean(spark):
    d = spark.createDataFrame([(0, "A b!\n"), (1, "\u00c9\r\n"), (2, "\u4e2d!B"), (3, "x" * 100_000 + "\u4e2d!"), (4, None)], "k int, text string")
    # bytes that are no UTF-8 count as characters beyond the table
    d = d.unionByName(spark.sql("select 5 k, cast(X'4120ff42' as string) text")).select("k", draft_text("text").alias("d"))
    assert {r.k: r.d for r in d.collect()} == {0: "A b!\n", 1: "\u00c9\r\n", 2: "\u4e2db", 3: "x" * 100_000 + "\u4e2d", 4: None, 5: "a b"}


def test_names_of_different_words_differ():
    import pyarrow as pa

    from simpairs.functions.cut import word_names
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(0, 30))) for _ in range(20000)} | {"a" * k for k in range(40)})
    names = word_names(pa.array(words))
    assert len(set(names.tolist())) == len(words)
    # a name depends on the word alone
    assert word_names(pa.array(["zz", *words]).slice(1)).tolist() == names.tolist() and word_names(pa.array(words[:3])).tolist() == names[:3].tolist()
    assert word_names(pa.array([], pa.string())).tolist() == []


def test_first_places_and_counts_by_table_and_by_sort():
    import numpy as np
    rng = np.random.default_rng(1)
    for bound in (1, 7, 500, 10**7):
        key = rng.integers(0, bound, 300)
        want = np.unique(key, return_index=True, return_counts=True)
        assert all((a == b).all() for a, b in zip(blocks._firsts(key, bound), want))
    assert [len(x) for x in blocks._firsts(np.zeros(0, np.int64), 1)] == [0, 0, 0]
