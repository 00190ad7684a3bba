"""Token -> id encoding with UNK default, padding/truncation, id checks, decoding."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simpairs.functions.arrays import clamp_ids, pad_truncate
from simpairs.functions.text import DRAFT
from simpairs.operators.blocks import mapped, words_of

UNK_ID, PAD_ID = 1, 0


def encode(texts: DataFrame, vocab: DataFrame, id_col: str = "clause_id", text_col: str = "clause",
           max_len: int | None = None) -> DataFrame:
    """(id, text or draft) -> (id, seq ARRAY<INT>).

    Unknown words map to UNK (1). With `max_len` the sequence is truncated/right-padded
    to exactly `max_len` ids; tokens past `max_len` cannot appear in the result, so they
    are cut off before the lookup. Rows with no tokens keep an empty (or all-PAD) seq.

    Clauses are coded in blocks first (`blocks.mapped`), so one row per distinct word of a block meets the vocabulary. The lookup
    broadcasts a small vocabulary; a large one is joined by shuffle, with its frequent words dealt evenly
    (`lookup`). The ids come back to the coded clauses, one row per block through the shuffle.
    """
    words = words_of(texts, text_col)
    if max_len is not None and DRAFT not in texts.columns:
        words = F.slice(words, 1, max_len)
    ids = mapped(texts, id_col, words, vocab.select("word", "idx"), "word", "__seq", UNK_ID, max_len)
    seq = F.col("__seq")
    if max_len is not None:
        seq = pad_truncate(seq, max_len, PAD_ID)
    return ids.select(id_col, seq.alias("seq"))


def decode(encoded: DataFrame, vocab: DataFrame, id_col: str = "clause_id", skip_pad: bool = True) -> DataFrame:
    """(id, seq) -> (id, text): ids back to words, space-joined, PAD dropped; ids that the vocabulary lacks are left out.
    One lookup per distinct id of a block of sequences."""
    known = vocab.select(F.col("idx").alias("__idx"), "word")
    if skip_pad:
        known = known.where(F.col("__idx") != PAD_ID)
    return mapped(encoded, id_col, F.col("seq"), known, "__idx", "__w").select(id_col, F.array_join("__w", " ").alias("text"))


def clamp(encoded: DataFrame, vocab_size: int) -> DataFrame:
    return encoded.withColumn("seq", clamp_ids("seq", vocab_size))


def oov_guard(encoded: DataFrame, vocab_size: int) -> DataFrame:
    """One row: max id seen, vocab size, number of ids outside [0, vocab_size)."""
    return encoded.agg(
        F.max(F.array_max("seq")).alias("max_id"),
        F.lit(vocab_size).cast("long").alias("vocab_size"),
        F.sum(F.size(F.filter("seq", lambda x: (x >= vocab_size) | (x < 0)))).cast("long").alias("n_out_of_range"),
    ).withColumn("needs_clamp", F.col("max_id") >= F.col("vocab_size"))


def prepare_pairs(pairs: DataFrame, clauses: DataFrame, vocab: DataFrame, max_len: int | None) -> DataFrame:
    """pairs(pair_id, id1, id2, label, ...) -> (pair_id, seq1, seq2, label); whole ragged sequences without `max_len`.

    Each clause is encoded once (not once per pair) where it is read; only ids are moved to the pairs, no text.
    """
    enc = encode(clauses, vocab, max_len=max_len)
    e1 = enc.select(F.col("clause_id").alias("id1"), F.col("seq").alias("seq1"))
    e2 = enc.select(F.col("clause_id").alias("id2"), F.col("seq").alias("seq2"))
    out = pairs.join(e1, "id1").join(e2, "id2")
    keep = [c for c in ("split",) if c in pairs.columns]
    return out.select("pair_id", "seq1", "seq2", "label", *keep)
