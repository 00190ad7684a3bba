"""Saved models: ML persistence with a manifest, published whole or not at all.

A model and its manifest (vocabulary digest and size, configuration) are written to a folder of their own and moved to their
place by one rename. Whoever comes second finds the place taken and drops its copy, so readers only ever see one
whole artifact. A model is loaded only for the vocabulary it was trained with.
"""
from __future__ import annotations

import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def vocabulary_digest(vocab: DataFrame) -> dict:
    """{"size", "digest"} of vocab(word, idx): the same for any order and partitioning of its rows. One row comes to the driver."""
    h = F.xxhash64("word", "idx")
    r = vocab.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s"), F.bit_xor(h).alias("x")).first()
    import hashlib
    return {"size": r["n"], "digest": hashlib.md5(f"{r['n']}:{r['s']}:{r['x']}".encode()).hexdigest()}


def _files(spark: SparkSession, path: str):
    """(file context, path class) of the file system that `path` is on."""
    sc = spark.sparkContext
    kind = sc._jvm.org.apache.hadoop.fs.Path
    uri = kind(path).getFileSystem(sc._jsc.hadoopConfiguration()).getUri()
    return sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, sc._jsc.hadoopConfiguration()), kind


def publish(spark: SparkSession, temporary: str, path: str) -> bool:
    """Move a finished folder to its place in one step; False, and the folder is dropped, if the place is taken."""
    files, kind = _files(spark, path)
    none = spark.sparkContext._gateway.new_array(getattr(spark.sparkContext._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        files.rename(kind(temporary), kind(path), none)
        return True
    except Exception:
        if not files.util().exists(kind(path)):
            raise
        files.delete(kind(temporary), True)
        return False


def save_model(model, path: str, vocab: DataFrame, config: dict) -> bool:
    """Write a fitted ML model with its manifest; True if this call's artifact is the one at `path`, False if one was there."""
    spark, path = vocab.sparkSession, path.rstrip("/")
    temporary = f"{path}.{uuid.uuid4().hex}"
    manifest = {"vocabulary": vocabulary_digest(vocab), "config": config}
    PipelineModel([model]).write().save(f"{temporary}/model")
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.text(f"{temporary}/manifest")
    return publish(spark, temporary, path)


def load_model(spark: SparkSession, path: str, vocab: DataFrame):
    """(model, config) of the artifact at `path`. Raises ValueError unless `vocab` is the vocabulary it was trained with."""
    path = path.rstrip("/")
    manifest = json.loads(spark.read.text(f"{path}/manifest").first()["value"])
    own, now = manifest["vocabulary"], vocabulary_digest(vocab)
    if own != now:
        raise ValueError(f"the model at {path} was trained with a vocabulary of {own['size']} words ({own['digest']}), not with this one "
                         f"of {now['size']} ({now['digest']}); rebuild that vocabulary or train again")
    return PipelineModel.load(f"{path}/model").stages[0], manifest["config"]
