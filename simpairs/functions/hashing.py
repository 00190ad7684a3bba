"""Deterministic keyed hashing: the only source of randomness in the package.

h(seed, tag, key) = first 15 hex digits of md5('<seed>:<tag>:<key>') as a non-negative BIGINT.
The same value is computable in plain SQL, it does not depend on partitioning, task retries
or execution order, which is what makes every sample and split reproducible on a cluster.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_HEX_DIGITS = 15


def _md5(seed: int, tag: str, key) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:{tag}:"), k.cast("string")))


def keyed_hash(seed: int, tag: str, key) -> Column:
    return F.conv(F.substring(_md5(seed, tag, key), 1, HASH_HEX_DIGITS), 16, 10).cast("bigint")


def bounded_draw(seed: int, tag: str, key, n) -> Column:
    """Uniform integer in [0, n) (modulo bias < n / 2^60)."""
    nn = F.col(n) if isinstance(n, str) else (n if isinstance(n, Column) else F.lit(n))
    return F.pmod(keyed_hash(seed, tag, key), nn.cast("bigint"))
