import os
import tempfile

import pytest
from pyspark.sql import functions as F

from simpairs.config import PairConfig
from simpairs.operators.encode import encode
from simpairs.operators.vocab import build_vocabulary
from simpairs.plans import pipeline
from simpairs.sources.tables import document_clauses
from simpairs.streaming.stream_ops import clean_stream, encode_stream
from tests.conftest import SF_SMALL


def test_encode_stream_matches_batch(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    clauses = document_clauses(spark, SF_SMALL, "lang")
    vocab = build_vocabulary(clauses)
    stream = (spark.readStream.schema(docs.schema).option("pathGlobFilter", "documents.parquet")
              .option("maxFilesPerTrigger", 1).parquet(SF_SMALL).select(F.col("doc_id").alias("clause_id"), "text"))
    out = tempfile.mkdtemp(prefix="simpairs-stream-")
    q = encode_stream(stream, vocab, f"{out}/enc", f"{out}/ckpt", max_len=16)
    q.awaitTermination(120)
    got = {r.clause_id: r.seq for r in spark.read.parquet(f"{out}/enc").collect()}
    want = {r.clause_id: r.seq for r in encode(clauses, vocab, max_len=16).collect()}
    assert got == want and len(got) == docs.count()


def test_clean_stream_is_stateless(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    s = spark.readStream.schema(docs.schema).option("pathGlobFilter", "documents.parquet").parquet(SF_SMALL)
    assert clean_stream(s, "doc_id", "text").isStreaming


def test_pipeline_end_to_end(spark):
    out = tempfile.mkdtemp(prefix="simpairs-run-")
    clauses = document_clauses(spark, SF_SMALL, "source")
    r = pipeline.run(spark, clauses, out, PairConfig(num_examples=3))
    m = r.metrics.first()
    assert 0.0 <= m.accuracy <= 1.0 and 0.0 <= m.roc_auc <= 1.0
    assert r.results.count() == 1 and r.summary.count() == 1
    assert os.path.isdir(f"{out}/examples") and os.path.isdir(f"{out}/accuracy_time")
    assert r.scored.count() == r.split.where("split = 'test'").count()
    folders = lambda: {x for x in os.listdir(out) if x.startswith("vocab-")}
    first = folders()
    pipeline.run(spark, clauses, out, PairConfig(num_examples=3))
    assert folders() == first and len(first) == 1
    pipeline.run(spark, clauses, out, PairConfig(num_examples=3, min_freq=3))
    assert len(folders()) == 2
    sizes = {x.split: x.n for x in r.split.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sum(sizes.values()) == r.pairs.count()


def test_pipeline_with_batch_scorer(spark):
    from simpairs.plans.queries import overlap_scorer
    out = tempfile.mkdtemp(prefix="simpairs-run-")
    clauses = document_clauses(spark, SF_SMALL, "lang")
    r = pipeline.run(spark, clauses, out, PairConfig(max_seq_length=32), scorer=overlap_scorer, model_name="overlap")
    assert r.scored.count() > 0
    assert r.scored.where("probability < 0 OR probability > 1").count() == 0
    with pytest.raises(ValueError, match="vocabulary size"):
        pipeline.run(spark, clauses, out, PairConfig(max_seq_length=32), scorer=overlap_scorer, model_vocab_size=3)
