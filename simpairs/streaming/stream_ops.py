"""Stateless operators on Structured Streaming input.

Cleaning, tokenising, thresholding and label decoding are row-wise Column expressions and
apply to a streaming DataFrame unchanged. Encoding needs a lookup join and a per-clause
regroup, so it runs per micro-batch through `foreachBatch` with the same batch operator
against a static (saved) vocabulary; every micro-batch is written idempotently under its
batch id, so a retried batch replaces its own output.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from simpairs.functions.scoring import clip01, threshold
from simpairs.functions.text import clean_text, decode_label, null_to_nan
from simpairs.operators.encode import encode


def clean_stream(stream: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) stream -> (clause_id, clause) stream; purely row-wise."""
    return stream.select(F.col(id_col).alias("clause_id"), clean_text(null_to_nan(text_col)).alias("clause"))


def threshold_stream(stream: DataFrame, prob_col: str = "probability", t: float = 0.5) -> DataFrame:
    p = clip01(prob_col)
    return stream.withColumn(prob_col, p).withColumn("predicted", threshold(prob_col, t)).withColumn(
        "predicted_label", decode_label("predicted"))


def encode_stream(stream: DataFrame, vocab: DataFrame, out_path: str, checkpoint_location: str,
                  max_len: int = 128, trigger_once: bool = True) -> StreamingQuery:
    """Clean + encode each micro-batch against `vocab`, append Parquet under
    out_path/batch_id=<n> (overwritten on retry)."""
    cleaned = clean_stream(stream, "clause_id", "text") if "text" in stream.columns else stream

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        enc = encode(batch, vocab, max_len=max_len)
        enc.write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}")

    w = cleaned.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
