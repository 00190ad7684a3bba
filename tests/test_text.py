from pyspark.sql import functions as F

from simpairs.functions.text import clean_text, ellipsis, null_to_nan, tokenize
from simpairs.functions.arrays import pad_truncate

EDGES = [
    ("a - b", "a  b"), ("x y", "x y"), ("café", "cafe"), ("½ ²", "½ ²"),
    ("a‿b", "ab"), ("  nan ", "nan"), ("a\x0bb\x1cc", "a b c"), ("中文，", "中文"),
    ("<PAD> x", "pad x"), ("", ""), (None, "nan"),
]


def test_clean_text_edges(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(EDGES)], "i int, s string")
    got = {r.i: r.c for r in df.select("i", clean_text(null_to_nan("s")).alias("c")).collect()}
    assert [got[i] for i in range(len(EDGES))] == [e for _, e in EDGES]


def test_tokenize_and_pad(spark):
    df = spark.createDataFrame([("",), ("a  b",), (" a b c d e ",)], "s string")
    toks = [r.t for r in df.select(tokenize(F.trim("s")).alias("t")).collect()]
    assert toks == [[], ["a", "b"], ["a", "b", "c", "d", "e"]]
    L = 4
    seqs = spark.createDataFrame([([],), ([1, 2, 3],), ([1, 2, 3, 4],), ([1, 2, 3, 4, 5],)], "s array<int>")
    got = [r.p for r in seqs.select(pad_truncate("s", L).alias("p")).collect()]
    assert got == [[0, 0, 0, 0], [1, 2, 3, 0], [1, 2, 3, 4], [1, 2, 3, 4]]


def test_ellipsis(spark):
    df = spark.createDataFrame([("x" * 149,), ("y" * 150,), ("z" * 151,)], "s string")
    got = [len(r.e) for r in df.select(ellipsis("s").alias("e")).collect()]
    assert got == [149, 150, 153]


def test_vocabulary_with_wide_ids(spark):
    from simpairs.operators.vocab import build_vocabulary, word_counts
    big = 2 ** 62
    rows = [("b", big, "x y x"), ("a", -big, "z y"), ("a", big + 2 ** 50, "w z"), ("a", 2 ** 50, "y q w q")]
    c = spark.createDataFrame(rows, "category string, clause_id long, clause string")
    assert [r.word for r in build_vocabulary(c, 1).where("idx > 3").orderBy("idx").collect()] == ["z", "y", "q", "w", "x"]
    got = {r.word: (r.cnt, r.first_category, r.first_clause_id, r.first_pos) for r in word_counts(c).collect()}
    assert got["w"] == (2, "a", 2 ** 50, 2) and got["x"] == (2, "b", big, 0) and got["z"] == (2, "a", -big, 0)
