"""Data-quality metrics: completeness, uniqueness, format validity.

Metrics are long rows ``(metric, value, n_bad, n_total, threshold, pass)``. A metric
of an empty table has no value and does not pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.hashing import null_if_nan, row_fingerprint

# Acceptance thresholds and the format pattern (anchored at the start only).
COMPLETENESS_MIN = 0.95
UNIQUENESS_MIN = 0.98
VALIDITY_MIN = 0.99
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"


def is_missing(df: DataFrame, name: str) -> Column:
    return null_if_nan(df, name).isNull()


def missing_cells(df: DataFrame) -> Column:
    """Number of missing cells of a row."""
    total = F.lit(0)
    for name in df.columns:
        total = total + is_missing(df, name).cast("int")
    return total


def is_iso_timestamp(column: Column) -> Column:
    """Prefix test of the text; NULL stays NULL."""
    return column.cast("string").rlike(ISO_TIMESTAMP)


def metric_row(name: str, value: Column, n_bad: Column, n_total: Column, threshold: float) -> Column:
    return F.struct(
        F.lit(name).alias("metric"),
        value.cast("double").alias("value"),
        n_bad.cast("bigint").alias("n_bad"),
        n_total.cast("bigint").alias("n_total"),
        F.lit(threshold).alias("threshold"),
        F.coalesce(value >= F.lit(threshold), F.lit(False)).alias("pass"),
    )


def _completeness(missing: Column, cells: Column) -> Column:
    return metric_row("completeness", F.lit(1.0) - F.try_divide(missing, cells), missing, cells, COMPLETENESS_MIN)


def _uniqueness(copies: Column, rows: Column) -> Column:
    return metric_row("duplicate_rate", F.lit(1.0) - F.try_divide(copies, rows), copies, rows, UNIQUENESS_MIN)


def _validity(valid: Column, present: Column) -> Column:
    value = F.coalesce(F.try_divide(valid, present), F.lit(0.0))
    return metric_row("format_validity", value, present - valid, present, VALIDITY_MIN)


def _no_timestamp_column() -> Column:
    return metric_row("format_validity", F.lit(1.0), F.lit(0), F.lit(0), VALIDITY_MIN)


def _rows(one_row: DataFrame, *metrics: Column) -> DataFrame:
    return one_row.select(F.inline(F.array(*metrics)))


def completeness(df: DataFrame) -> DataFrame:
    """Share of present cells, in one pass over all columns."""
    totals = df.agg(
        F.coalesce(F.sum(missing_cells(df).cast("bigint")), F.lit(0)).alias("missing"),
        (F.count(F.lit(1)) * F.lit(len(df.columns))).alias("cells"),
    )
    return _rows(totals, _completeness(F.col("missing"), F.col("cells")))


def duplicate_rate(df: DataFrame) -> DataFrame:
    """Share of rows that are not a repetition of an earlier equal row."""
    groups = df.select(row_fingerprint(df).alias("fp")).groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
    totals = groups.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("copies"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
    )
    return _rows(totals, _uniqueness(F.col("copies"), F.col("rows")))


def format_validity(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Share of well-formed timestamps among the non-missing ones; 1.0 if there is no such column."""
    if timestamp not in df.columns:
        return _rows(df.agg(F.count(F.lit(1)).alias("n")), _no_timestamp_column())
    present = null_if_nan(df, timestamp)
    totals = df.agg(
        F.count_if(is_iso_timestamp(present)).alias("valid"),
        F.count(present).alias("present"),
    )
    return _rows(totals, _validity(F.col("valid"), F.col("present")))


def row_profile(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """Distinct rows by fingerprint with what the quality metrics need of each.

    One scan and one shuffle of about 50 bytes per row; the flags are functions of the
    row, so having them in the grouping key costs nothing and copies merge before the shuffle.
    """
    if timestamp in df.columns:
        present = null_if_nan(df, timestamp)
        filled, ok = present.isNotNull(), F.coalesce(is_iso_timestamp(present), F.lit(False))
    else:
        filled, ok = F.lit(False), F.lit(True)
    return (
        df.select(
            row_fingerprint(df).alias("fp"), missing_cells(df).alias("missing"),
            filled.alias("ts_present"), ok.alias("ts_ok"),
        )
        .groupBy("fp", "missing", "ts_present", "ts_ok").agg(F.count(F.lit(1)).alias("n"))
    )


def profile_totals(profile: DataFrame, width: int) -> DataFrame:
    """Counts behind the metrics of the raw rows, and of the rows that cleaning would keep."""
    n, kept = F.col("n"), F.col("ts_ok") & (F.col("missing") == 0)
    total = lambda value: F.coalesce(F.sum(value), F.lit(0)).cast("bigint")
    return profile.agg(
        total(n).alias("rows"),
        (total(n) * F.lit(width)).alias("cells"),
        total(n * F.col("missing")).alias("missing"),
        total(n - 1).alias("copies"),
        total(F.when(F.col("ts_present"), n)).alias("present"),
        total(F.when(F.col("ts_present") & F.col("ts_ok"), n)).alias("valid"),
        F.count_if(~F.col("ts_ok")).alias("invalid_rows"),
        F.count_if(F.col("ts_ok") & (F.col("missing") > 0)).alias("incomplete_rows"),
        F.count_if(kept).alias("kept_rows"),
    )


def scorecard_metrics(has_timestamp: bool) -> list[Column]:
    """The three metric rows over the columns of ``profile_totals``."""
    return [
        _completeness(F.col("missing"), F.col("cells")),
        _uniqueness(F.col("copies"), F.col("rows")),
        _validity(F.col("valid"), F.col("present")) if has_timestamp else _no_timestamp_column(),
    ]


def cleaned_scorecard_metrics(has_timestamp: bool, width: int) -> list[Column]:
    """The same metrics for the cleaned rows: distinct, complete and well-formed by construction."""
    zero, kept = F.lit(0), F.col("kept_rows")
    return [
        _completeness(zero, kept * F.lit(width)),
        _uniqueness(zero, kept),
        _validity(kept, kept) if has_timestamp else _no_timestamp_column(),
    ]


def dq_scorecard(df: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """All data-quality metrics from one scan."""
    totals = profile_totals(row_profile(df, timestamp), len(df.columns))
    return _rows(totals, *scorecard_metrics(timestamp in df.columns))
