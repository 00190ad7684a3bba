"""Small helpers shared by the training-data operators."""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from simpairs.sources.shared import shared_dir

#: a side is broadcast only when its size, known beforehand, is at most this many bytes
BROADCAST_BYTES = 64 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def whole_text(col: str) -> Column:
    """The whole text, null counting as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def boxed(df: DataFrame, **more: Column) -> DataFrame:
    """The columns of `df` in one struct `all`, beside named expressions over them, so that no name of a user's column can
    clash with a working column. `select("all.*")` gives the columns back."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("all"), *[c.alias(n) for n, c in more.items()])


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores before it as it takes to be no column of `df`."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: a reliable checkpoint in the folder all executors share."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_bytes(df: DataFrame, text_col: str = "text") -> int:
    """Total bytes of a text column (one scan of that column, one number to the driver)."""
    return int(df.agg(F.sum(F.octet_length(whole_text(text_col)).cast("long")).alias("b")).first()["b"] or 0)


def parts_for(n: float, per_part: float, least: int = 1) -> int:
    """Number of groups such that each holds about `per_part` units; grows with the data."""
    return max(least, math.ceil(n / per_part))


def tidy() -> None:
    """At the end of a Python task: give memory that is free again back to the system, so that a worker which is kept for
    later tasks does not hold on to its largest need."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not this C library
        pass


class Scratch:
    """Parquet tables of one operator call in the shared folder, removed when the call is over.

    Written tables cut the lineage, keep columns prunable and survive a lost executor."""

    def __init__(self, spark: SparkSession, name: str):
        import uuid
        self.spark = spark
        self.path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def remove(self) -> None:
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def bounded(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """`df` marked for broadcast if its known size is within the bound; else left to a shuffle join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df
