"""Cleaning steps and the log of what they removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from parlance.functions.hashing import null_if_nan
from parlance.operators.quality import is_iso_timestamp, profile_totals, row_profile
from parlance.operators.ranking import as_literal, median_type
from parlance.operators.selection import medians


def _nan_to_null(df: DataFrame) -> DataFrame:
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    return df.withColumns({c: null_if_nan(df, c) for c in floating}) if floating else df


def remove_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each group of equal rows; missing cells equal each other.

    Copies collapse before the shuffle, so a row repeated a billion times costs no more
    than one row per task.
    """
    return _nan_to_null(df).dropDuplicates()


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in a given order.

    The rank-one filter lets Spark drop later rows per task before the shuffle, so a hot
    key is reduced to one row per task first.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def fix_invalid_timestamps(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Drop rows whose timestamp is malformed or missing; no change without such a column."""
    if timestamp not in df.columns:
        return df
    return df.where(is_iso_timestamp(null_if_nan(df, timestamp)))


def drop_missing(df: DataFrame) -> DataFrame:
    """Drop rows with any missing cell."""
    return _nan_to_null(df).dropna("any")


def non_null(df: DataFrame, column: str) -> DataFrame:
    """One column without its missing values."""
    return df.select(null_if_nan(df, column).alias(column)).where(F.col(column).isNotNull())


def most_frequent(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row holding the mode of each string column, ties to the smallest value, NULL if all missing.

    Counted by a distributed ``groupBy``; the winner is a minimum, so no task holds all values.
    """
    cells = F.inline(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(f"`{c}`").alias("value")) for i, c in enumerate(columns)
    ]))
    counts = (
        df.select(cells).where(F.col("value").isNotNull())
        .groupBy("i", "value").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("i").agg(F.min(F.struct((-F.col("n")).alias("minus_n"), "value")).alias("best"))
    )
    return counts.agg(*[
        F.max(F.when(F.col("i") == i, F.col("best.value"))).alias(c) for i, c in enumerate(columns)
    ])


def impute_missing(df: DataFrame) -> DataFrame:
    """Fill string columns with their mode and numeric columns with their exact median.

    A numeric column with gaps becomes a double, a 64-bit integer one a decimal that holds every value and the
    median exactly; decimals keep their type, to whose scale the median is rounded half up. Columns without gaps stay as they
    are. All medians are found in the same few passes.
    """
    clean = _nan_to_null(df)
    strings = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    filled = {}
    if strings:
        # one subquery for all modes; the uses below refer to the same plan and run it once
        modes = most_frequent(clean, strings).select(F.struct(*[F.col(f"`{c}`") for c in strings]).alias("m"))
        for c in strings:
            filled[c] = F.coalesce(F.col(f"`{c}`"), modes.scalar()[c])
    if numbers:
        # one small row tells which columns need a median at all
        gaps = clean.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in numbers]).first().asDict()
        for c, median in medians(clean, [c for c in numbers if gaps[c]]).items():
            kind = clean.schema[c].dataType
            kind = kind if isinstance(kind, T.DecimalType) else median_type(kind)
            filled[c] = F.coalesce(F.col(f"`{c}`").cast(kind), as_literal(median, kind))
    return clean.withColumns(filled) if filled else clean


def handle_missing(df: DataFrame, strategy: str = "drop") -> DataFrame:
    if strategy == "drop":
        return drop_missing(df)
    if strategy == "impute":
        return impute_missing(df)
    raise ValueError(f"unknown strategy {strategy!r}: use 'drop' or 'impute'")


def clean(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Distinct, well-formed, complete rows.

    The row-wise filters commute with removing copies, so they are put first: Spark then
    shuffles only the rows that survive. The result equals dedupe-first.
    """
    return df.transform(fix_invalid_timestamps, timestamp).transform(drop_missing).transform(remove_duplicates)


def log_rows() -> Column:
    """Rows ``(step, operation, removed)`` over the columns of ``profile_totals``."""
    entry = lambda step, name, removed: F.struct(
        F.lit(step).alias("step"), F.lit(name).alias("operation"), F.col(removed).cast("bigint").alias("removed")
    )
    return F.array(
        entry(1, "remove_duplicates", "copies"),
        entry(2, "fix_invalid_timestamps", "invalid_rows"),
        entry(3, "handle_missing_drop", "incomplete_rows"),
    )


def cleaning_log(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Rows each step removes (duplicates, then timestamps, then missing), from one scan."""
    totals = profile_totals(row_profile(df, timestamp), len(df.columns))
    return totals.select(F.inline(log_rows()))
