"""The shared folder of the cluster and lineage cuts into it."""
from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session. Only when it is unset (local tests) a fresh
    scratch folder is created and registered."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext in this client (e.g. Spark Connect)
        sc = None
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = tempfile.mkdtemp(prefix="simpairs-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def by_value() -> None:
    """Serialise this package's functions (and a user scorer defined in it) by value into
    the Python tasks, so executors need no installed copy of the package."""
    try:
        import simpairs
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(simpairs)
    except (ImportError, ValueError):
        pass


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder: cuts the lineage (small plans, no
    recomputation of the upstream stages after an executor loss)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def released(spark: SparkSession) -> None:
    """Shuffle files of plans that nobody holds any more are deleted now. Spark's cleaner finds them when the driver's JVM collects its
    garbage, which by itself it may not do before the job ends."""
    import gc
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a Parquet table under the shared folder and read it back: a columnar,
    prunable lineage cut whose size statistics the planner can use (e.g. for broadcast)."""
    import uuid
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/simpairs-tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
