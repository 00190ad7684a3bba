"""Arrays coded in blocks: one lookup row per distinct value of a block, the same arrays, rows that share a key, lost values."""
from pyspark.sql import functions as F

from simpairs.config import PairConfig
from simpairs.functions.text import tokenize
from simpairs.operators import blocks
from simpairs.operators import score as sc
from simpairs.operators.encode import decode, encode
from simpairs.operators.vocab import word_counts

TEXTS = [(1, "b a b  b c a"), (2, ""), (3, "a"), (4, "c c x"), (None, "a x b"), (5, None)]


def _clauses(spark, rows=TEXTS):
    return spark.createDataFrame([("k", i, t) for i, t in rows], "category string, clause_id long, clause string").coalesce(1)


def _vocab(spark):
    return spark.createDataFrame([("<PAD>", 0), ("<UNK>", 1), ("a", 4), ("b", 5), ("c", 6)], "word string, idx int")


def test_blocks_of_any_size_give_the_same_arrays(spark, monkeypatch):
    want = {1: [5, 4, 5, 5, 6, 4], 2: [], 3: [4], 4: [6, 6, 1], None: [4, 1, 5], 5: []}
    for size in (1, 3, 1 << 19):
        monkeypatch.setattr(blocks, "BLOCK_VALUES", size)
        e = encode(_clauses(spark), _vocab(spark))
        assert {r.clause_id: r.seq for r in e.collect()} == want
        back = {r.clause_id: r.text for r in decode(e, _vocab(spark)).collect()}
        assert back == {1: "b a b b c a", 2: "", 3: "a", 4: "c c <UNK>", None: "a <UNK> b", 5: ""}


def test_rows_that_share_an_id_are_merged_by_position(spark):
    rows = _clauses(spark, [(7, "a b"), (7, "c a b"), (None, "a"), (None, "b"), (8, "c")])
    e = encode(rows, _vocab(spark))
    assert {r.clause_id: r.seq for r in e.collect()} == {7: [4, 6, 4, 5, 5], None: [4, 5], 8: [6]}
    ids = spark.createDataFrame([(1, [4, 0, 99, 5]), (1, [6, 5])], "clause_id long, seq array<int>")
    # ids that are left out keep their places
    assert [r.text for r in decode(ids, _vocab(spark)).collect()] == ["a c b b"]


def test_a_block_hands_on_a_word_once(spark):
    texts = _clauses(spark, [(k, "same few words and same few words") for k in range(2000)])
    counted = blocks.value_counts(texts, tokenize("clause"), "category", "clause_id")
    assert counted.count() == 4 and {(r.value, r.cnt, r.clause_id, r.pos) for r in counted.collect()} == {
        ("same", 4000, 0, 0), ("few", 4000, 0, 1), ("words", 4000, 0, 2), ("and", 2000, 0, 3)}


def test_first_appearance_by_id_and_position(spark, monkeypatch):
    texts = _clauses(spark, [(9, "z a"), (3, "q z a"), (None, "n a"), (4, "a z")])
    want = {("z", 3, 3, 1), ("a", 4, 3, 2), ("q", 1, 3, 0), ("n", 1, None, None)}
    for size in (1, 1 << 19):
        monkeypatch.setattr(blocks, "BLOCK_VALUES", size)
        got = word_counts(texts).collect()
        assert {(r.word, r.cnt, r.first_clause_id, r.first_pos if r.first_clause_id is not None else None) for r in got} == want


def test_one_long_text_does_not_widen_the_others(spark):
    seen = spark.sparkContext.accumulator(0)

    def factory():
        def score(a, b):
            seen.add(a.size + b.size)
            return (a > 0).sum(axis=1) / 10_000.0
        return score
    ids = F.expr("sequence(1, case when id = 5 then 5000 else 1 + id % 7 end)")
    pairs = spark.range(0, 256, 1, 1).select(F.col("id").alias("pair_id"), F.lit(1).alias("label"), ids.alias("seq1"), F.array(F.lit(1)).alias("seq2"))
    got = {r.pair_id: r.probability for r in sc.batch_score(pairs, factory, "m", PairConfig(), batch_size=32).collect()}
    assert got == {k: (5000 if k == 5 else 1 + k % 7) / 10_000.0 for k in range(256)}
    # padded to the longest of the whole batch these were 32 rows of 5,000 ids a side
    assert seen.value < 32 * 5000 * 2 + 256 * 2 * 7


def test_training_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(sc, "TRAIN_ROWS", 50)
    rows = spark.range(0, 400, 1, 1).select(F.array(F.col("id") % 2 * 1.0, F.lit(0.5)).alias("features"), (F.col("id") % 2).alias("label"))
    assert sc.dealt(rows).rdd.getNumPartitions() == 8 and sc.dealt(rows).count() == 400
    assert sc.dealt(rows.limit(20)).rdd.getNumPartitions() == 1
    model, _ = sc.train_classifier(rows, rows.limit(40), 2, epochs=1, iters_per_epoch=5, hidden=(4,))
    assert sc.classifier_scores(model, rows.selectExpr("row_number() over (order by label) as pair_id", "label", "features"), "m").count() == 400
