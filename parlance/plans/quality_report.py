"""The quality report: DQ of the cleaned table, drift of the raw one, and the verdict."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.operators.cleaning import log_rows
from parlance.operators.drift import KL_MAX, ddq_scorecard
from parlance.operators.quality import (
    cleaned_scorecard_metrics, profile_totals, row_profile, scorecard_metrics,
)


def _status(passed: Column) -> Column:
    return F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL"))


def roll_up(metrics: DataFrame, group: str) -> DataFrame:
    """``group, status``: PASS iff every metric row of the group passes."""
    verdict = F.bool_and(F.coalesce(F.col("pass"), F.lit(False)))
    return metrics.groupBy(group).agg(_status(verdict).alias("status"))


def quality_metrics(raw: DataFrame, production: DataFrame, timestamp: str = "timestamp",
                    threshold: float = KL_MAX) -> DataFrame:
    """All metric rows of the report with the section and the table they were measured on.

    Raw scores, cleaned scores and the cleaning log are all functions of the distinct
    rows, so the raw table is profiled once and not cleaned to be measured.
    """
    has_ts = timestamp in raw.columns
    totals = profile_totals(row_profile(raw, timestamp), len(raw.columns))
    tag = lambda dataset, section, metrics: F.transform(
        F.array(*metrics),
        lambda m: F.struct(
            F.lit(section).alias("section"), F.lit(dataset).alias("dataset"),
            m["metric"].alias("metric"), m["value"].alias("value"), m["n_bad"].alias("n_bad"),
            m["n_total"].alias("n_total"), m["threshold"].alias("threshold"), m["pass"].alias("pass"),
        ),
    )
    measured = totals.select(F.inline(F.concat(
        tag("raw", "dq_raw", scorecard_metrics(has_ts)),
        tag("cleaned", "dq", cleaned_scorecard_metrics(has_ts, len(raw.columns))),
    )))
    drift = ddq_scorecard(raw, production, threshold).select(
        F.lit("ddq").alias("section"), F.lit("raw").alias("dataset"), "metric", "value",
        F.lit(None).cast("bigint").alias("n_bad"), F.lit(None).cast("bigint").alias("n_total"),
        "threshold", "pass",
    )
    return measured.unionByName(drift)


def quality_report(raw: DataFrame, production: DataFrame, timestamp: str = "timestamp",
                   generated_at: Column | None = None, threshold: float = KL_MAX) -> DataFrame:
    """One nested row: metrics, status per section, cleaning log and overall status."""
    has_ts, width = timestamp in raw.columns, len(raw.columns)
    totals = profile_totals(row_profile(raw, timestamp), width)
    by_name = lambda metrics: F.map_from_entries(F.transform(
        metrics, lambda m: F.struct(m["metric"], m)
    ))
    dq = totals.select(
        F.array(*cleaned_scorecard_metrics(has_ts, width)).alias("dq"), log_rows().alias("log")
    )
    drift = ddq_scorecard(raw, production, threshold)
    # three rows, one per fixed feature
    ddq = drift.agg(F.array_sort(F.collect_list(F.struct("metric", "value", "threshold", "pass"))).alias("ddq"))
    all_pass = lambda metrics: F.forall(metrics, lambda m: m["pass"])
    section = lambda metrics: F.struct(
        by_name(metrics).alias("metrics"), _status(all_pass(metrics)).alias("status")
    )
    return dq.withColumn("ddq", ddq.scalar()).select(
        (F.current_timestamp() if generated_at is None else generated_at).cast("string").alias("timestamp"),
        section(F.col("dq")).alias("dq_assessment"),
        section(F.col("ddq")).alias("ddq_assessment"),
        F.struct(
            F.transform(F.col("log"), lambda e: F.struct(e["operation"].alias("operation"), e["removed"].alias("removed")))
            .alias("operations"),
            F.size("log").alias("total_operations"),
        ).alias("cleaning_summary"),
        _status(all_pass(F.col("dq")) & all_pass(F.col("ddq"))).alias("overall_status"),
    )


def report_summary(raw: DataFrame, production: DataFrame, timestamp: str = "timestamp") -> DataFrame:
    """The report as one flat row of statuses and removed-row counts."""
    return summarise(quality_report(raw, production, timestamp))


def summarise(report: DataFrame) -> DataFrame:
    """One flat row of a nested report, also of one that was written and read back."""
    removed: Mapping[str, int] = {"removed_duplicates": 0, "removed_invalid": 1, "removed_incomplete": 2}
    return report.select(
        F.col("dq_assessment.status").alias("dq_status"),
        F.col("ddq_assessment.status").alias("ddq_status"),
        "overall_status",
        *[F.col("cleaning_summary.operations")[i]["removed"].alias(name) for name, i in removed.items()],
    )
