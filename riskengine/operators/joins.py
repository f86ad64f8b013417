"""Join helper: keep rows without a group. The join strategy is left to adaptive execution."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def group_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join of per-group figures in which null is a group of its own, as in ``groupBy``."""
    other = {k: f"_right_{k}" for k in keys}
    same = [F.col(k).eqNullSafe(F.col(r)) for k, r in other.items()]
    joined = left.join(right.withColumnsRenamed(other), functools.reduce(lambda a, b: a & b, same), how)
    return joined.drop(*other.values())
