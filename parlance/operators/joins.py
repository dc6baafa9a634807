"""Joins whose keys may be NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def same_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL equals NULL; the left side's keys are kept."""
    renamed = right.select(*[F.col(f"`{c}`").alias(f"_right_{c}" if c in keys else c) for c in right.columns])
    match = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_right_{k}`")) for k in keys]
    joined = left.join(renamed, reduce(lambda a, b: a & b, match), how)
    return joined.drop(*[f"_right_{k}" for k in keys])
