"""Max pooling of token vectors in blocks: the same encodings however many vectors are broadcast, one evaluation, packed numbers."""
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from simpairs.operators import blocks
from simpairs.operators import features as fe
from simpairs.operators.encode import encode

ROWS = [(1, [4, 0, 5, 5]), (2, [0]), (3, []), (4, None), (None, [6]), (5, [9]), (6, [6, None]), (6, [4]), (-7, [-3, 5])]
VECTORS = [(0, [9.0, 9.0]), (4, [-1.0, 2.0]), (5, [-2.0, float("nan")]), (6, [0.0, -0.0]), (-3, [7.0, -9.0]), (None, [1.0, 1.0]), (9, None)]


@pytest.mark.parametrize("size", [32 << 20, 48, 0])
def test_encodings_do_not_depend_on_what_is_broadcast(spark, monkeypatch, size):
    monkeypatch.setattr(fe, "POOL_BYTES", size)
    encoded = spark.createDataFrame(ROWS, "clause_id long, seq array<int>").coalesce(1)
    vectors = spark.createDataFrame(VECTORS, "idx int, vector array<double>")
    want = [(1, [-1.0, 2.0]), (2, None), (3, None), (4, None), (None, None), (5, None), (6, [0.0, 2.0]), (6, [0.0, 2.0]), (-7, [7.0, -9.0])]
    padded = [(i, [9.0, 9.0] if i in (1, 2) else v) for i, v in want]
    for values in (1, 1 << 21):
        monkeypatch.setattr(blocks, "BLOCK_VALUES", values)
        for padding, rows in ((False, want), (True, padded)):
            got = fe.clause_encoding(encoded, vectors, padding).collect()
            assert sorted(map(tuple, got), key=str) == sorted(rows, key=str)


def test_texts_are_encoded_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    encoded = spark.range(500).selectExpr("id as clause_id", "array(cast(id % 7 as int), 3) as seq").mapInArrow(count, "clause_id long, seq array<int>")
    vectors = spark.range(7).selectExpr("cast(id as int) as idx", "array(id * 1.0D, -id * 1.0D) as vector")
    got = {r.clause_id: r.encoding for r in fe.clause_encoding(encoded, vectors).collect()}
    assert got == {k: [float(max(k % 7, 3)), float(-min(k % 7 or 3, 3))] for k in range(500)}
    assert seen.value == 500


def test_few_rows_are_shuffled(spark, monkeypatch):
    # ids that all clauses hold are pooled in place; each of the others is in one clause
    monkeypatch.setattr(fe, "POOL_BYTES", 24 * 50)
    exploded = []
    monkeypatch.setattr(fe, "max_pool", lambda df, *a: exploded.append(df.count()) or max_pool(df, *a))
    encoded = spark.range(200).selectExpr("id as clause_id", "concat(sequence(1, 40), array(1000 + cast(id as int))) as seq")
    vectors = spark.range(2000).selectExpr("cast(id as int) as idx", "array(id * 1.0D, -id * 1.0D) as vector")
    got = {r.clause_id: r.encoding for r in fe.clause_encoding(encoded, vectors).collect()}
    assert got == {k: [1000.0 + k, -1.0] for k in range(200)} and exploded == [400]


max_pool = fe.max_pool


def test_numbers_and_values_are_packed_whole():
    for n in ([], [0], [255, 0, 256], [1 << 40, 3], list(range(70_000))):
        assert blocks._unpacked(blocks._packed(np.array(n, np.int64))).tolist() == n
    assert len(blocks._packed(np.arange(100_000) % 300)) < 100_000
    for values in (pa.array(["a", None, ""]), pa.array([1, None], pa.int32()), pa.array([], pa.string())):
        assert blocks._restored(blocks._stored(values)).equals(values)


def test_coded_blocks_keep_words_and_missing_elements(spark, monkeypatch):
    rows = spark.createDataFrame([(1, ["b", None, "a", "b"]), (2, None), (3, [])], "k long, v array<string>").coalesce(1)
    table = spark.createDataFrame([("a", 4), ("b", 5)], "word string, idx int")
    assert {r.k: r.o for r in blocks.mapped(rows, "k", F.col("v"), table, "word", "o", 1).collect()} == {1: [5, 1, 4, 5], 2: [], 3: []}
    texts = spark.createDataFrame([("k", 1, "a b a")], "category string, clause_id long, clause string")
    assert [r.seq for r in encode(texts, table).collect()] == [[4, 5, 4]]
