"""Fixed-length sequence and vector helpers as higher-order Column functions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_truncate(seq, length: int, pad_id: int = 0) -> Column:
    """Truncate to `length`, or right-pad with `pad_id` up to `length`."""
    return F.slice(F.concat(_col(seq), F.array_repeat(F.lit(pad_id), length)), 1, length)


def clamp_ids(seq, vocab_size) -> Column:
    v = F.lit(vocab_size) if isinstance(vocab_size, int) else _col(vocab_size)
    return F.transform(_col(seq), lambda x: F.greatest(F.lit(0), F.least(x, v - 1)))


def to_double_array(c) -> Column:
    return F.transform(_col(c), lambda x: x.cast("double"))


def abs_diff(a, b) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: F.abs(x - y))


def elementwise_product(a, b) -> Column:
    return F.zip_with(_col(a), _col(b), lambda x, y: x * y)


def pair_features(a, b) -> Column:
    """[e1, e2, |e1 - e2|, e1 * e2] in this order."""
    return F.concat(_col(a), _col(b), abs_diff(a, b), elementwise_product(a, b))


def array_sum(c) -> Column:
    return F.aggregate(_col(c), F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return array_sum(elementwise_product(a, b))


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def render_ids(seq) -> Column:
    """Space-separated rendering of an int array (for comparison and CSV sinks)."""
    return F.array_join(F.transform(_col(seq), lambda x: x.cast("string")), " ")
