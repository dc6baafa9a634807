"""Small numeric expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(value: Column, low: float, high: float) -> Column:
    """The value moved into [low, high]; NaN stays NaN."""
    return F.when(F.isnan(value), value).otherwise(F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def sigmoid(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def bce_with_logits(score: Column, label: Column) -> Column:
    """Binary cross-entropy of one logit, in the form that cannot overflow."""
    return F.greatest(score, F.lit(0.0)) - score * label + F.log1p(F.exp(-F.abs(score)))


def dot(vector: Column, weights: list[float]) -> Column:
    """Dot product of an array column with a short constant vector."""
    constant = F.array(*[F.lit(float(w)) for w in weights])
    products = F.zip_with(vector, constant, lambda x, w: x * w)
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)
