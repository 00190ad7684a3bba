"""The training-corpus pipeline: stages over `documents`, each written as Parquet and reread."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from simpairs.llm import exact_dedup, mixing, near_dedup, packing, quality
from simpairs.llm.common import documents
from simpairs.llm.queries import tokenizer_path
from simpairs.sources.shared import shared_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from `labels` (never from the held-out third)."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").select("doc_id", "quality")
    return quality.keep_good(docs, labels)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more) stays."""
    return near_dedup.drop_near(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in an order that follows the sources' target weights block by block."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place in it; the sequences follow the mixed order of the rows."""
    return packing.pack_documents(docs, tokenizer_path(), written_order=True)


STAGES = [("quality_classifier", quality_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage),
          ("source_mixing", mixing_stage), ("best_fit_packing", packing_stage)]
#: the classifier and the packing are beyond SQL; the stages are tested against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`, in order; the rows of the last one."""
    folder = f"{shared_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
