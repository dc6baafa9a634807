"""Deterministic pseudo-randomness and row fingerprints.

All "random" choices derive from md5 of a seed and a row key. They do not depend
on partitioning, can be recomputed after a lost executor, and can be reproduced by
any engine with an md5 function.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TWO_POW_32 = 4294967296.0


def digest(*parts: Column | str | int) -> Column:
    """md5 hex text of the parts joined by ``:``; plain Python values are literals."""
    return F.md5(F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts]))


def _leading_int(hex_text: Column, digits: int) -> Column:
    return F.conv(F.substring(hex_text, 1, digits), 16, 10).cast("bigint")


def uniform(*parts: Column | str | int) -> Column:
    """Uniform double in [0, 1) from the first 32 bits of the digest."""
    return _leading_int(digest(*parts), 8) / F.lit(TWO_POW_32)


def standard_normal(*parts: Column | str | int) -> Column:
    """Box-Muller normal from two uniforms, rounded so that later orderings are stable."""
    u1 = (_leading_int(digest(*parts, "a"), 8) + F.lit(1)) / F.lit(TWO_POW_32)
    u2 = uniform(*parts, "b")
    return F.round(F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2.0 * math.pi) * u2), 5)


def hash_bucket(hex_text: Column, digits: int) -> Column:
    """Bucket number from the leading hex digits: 16**digits buckets, in digest order."""
    return _leading_int(hex_text, digits).cast("int")


def pick(options: list, draw: Column) -> Column:
    """One of a short list of constants, chosen by a uniform draw."""
    values = F.array(*[F.lit(o) for o in options])
    return F.element_at(values, (F.floor(draw * F.lit(float(len(options)))) + 1).cast("int"))


def weighted_pick(options: list[str], weights: list[float], draw: Column) -> Column:
    """One of a short list of constants with the given probabilities."""
    if len(options) != len(weights) or abs(sum(weights) - 1.0) > 1e-9:
        raise ValueError("weights must match the options and sum to 1")
    chosen, upper = None, 0.0
    for option, weight in zip(options[:-1], weights[:-1]):
        upper = round(upper + weight, 12)
        branch = draw < F.lit(upper)
        chosen = F.when(branch, F.lit(option)) if chosen is None else chosen.when(branch, F.lit(option))
    return F.lit(options[-1]) if chosen is None else chosen.otherwise(F.lit(options[-1]))


def null_if_nan(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into NULL (only floating columns can hold NaN)."""
    col = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(col), col)
    return col


def _as_text(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    col = null_if_nan(df, name)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return (col + F.lit(0.0)).cast("string")  # -0.0 and 0.0 are one value
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col).cast("string")  # an instant, whatever the session's time zone
    if isinstance(dtype, T.BinaryType):
        return F.hex(col)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.when(col.isNotNull(), F.to_json(F.struct(col), {
            "ignoreNullFields": "false", "timeZone": "UTC", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}))
    return col.cast("string")


def row_fingerprint(df: DataFrame, columns: list[str] | None = None) -> Column:
    """32-byte SHA-256 of all cells, NULL-aware, so that equal rows have equal fingerprints.

    Counting duplicates by fingerprint shuffles 32 bytes per row instead of the row.
    Each cell is length-prefixed, so different rows cannot render to the same text.
    """
    parts = []
    for name in columns or df.columns:
        text = _as_text(df, name)
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat_ws(",", *parts), 256))
