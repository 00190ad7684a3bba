"""Probability post-processing and loss, as Column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sigmoid(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(c)))


def clip01(c) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), _col(c).cast("double")))


def threshold(c, t: float = 0.5) -> Column:
    """Inclusive threshold: p >= t -> 1."""
    return (_col(c) >= F.lit(t)).cast("int")


def _clamped_log(x: Column) -> Column:
    # log clamped at -100 (log(0) -> -100), as in the usual BCE implementation
    return F.when(x <= 0, F.lit(-100.0)).otherwise(F.greatest(F.log(x), F.lit(-100.0)))


def bce(y, p) -> Column:
    yy, pp = _col(y).cast("double"), _col(p).cast("double")
    return -(yy * _clamped_log(pp) + (F.lit(1.0) - yy) * _clamped_log(F.lit(1.0) - pp))

