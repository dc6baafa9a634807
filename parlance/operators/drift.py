"""Distributional quality: value distributions and KL divergence.

Both tables are tagged, unioned and counted per (feature, value) in one shuffle with
map-side counts, so a value that fills a third of the table arrives as a few partial
counts. All features are handled in the same pass. KL is then a plain sum over the
distinct values; no join and no window is needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.hashing import null_if_nan

EPSILON = 1e-10  # fixed value: stands in for a category one side lacks
KL_MAX = 0.1  # fixed value: a feature passes below it

Features = Sequence[str] | Mapping[str, Column]


def quarter_label(timestamp: Column, unparsed: str = "label", typed: bool = False) -> Column:
    """``2021-Q3`` for an ISO timestamp text, or for a date or timestamp column (``typed``).

    ``unparsed='label'`` gives missing cells the label ``nan-Qnan`` and malformed ones
    ``invalid``, which then count as periods of their own; ``'drop'`` makes both NULL.
    """
    if unparsed not in ("label", "drop"):
        raise ValueError("unparsed must be 'label' or 'drop'")
    # the leading-date test keeps time-only or year-only texts from being completed
    parsed = timestamp if typed else F.when(
        timestamp.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(timestamp)
    )
    label = F.concat(F.year(parsed).cast("string"), F.lit("-Q"), F.quarter(parsed).cast("string"))
    if unparsed == "drop":
        return label
    return F.when(timestamp.isNull(), F.lit("nan-Qnan")).otherwise(F.coalesce(label, F.lit("invalid")))


def _unpivot(df: DataFrame, features: Features) -> DataFrame:
    if isinstance(features, Mapping):
        columns = features
    else:
        columns = {f: null_if_nan(df, f) for f in features}
    pairs = [
        F.struct(F.lit(name).alias("feature"), col.cast("string").alias("value"))
        for name, col in columns.items()
    ]
    return df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull())


def value_distribution(df: DataFrame, features: Features) -> DataFrame:
    """``feature, value, n, share`` of the non-missing values."""
    counts = _unpivot(df, features).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    return (
        counts.join(F.broadcast(totals), "feature")  # one row per named feature
        .select("feature", "value", "n", (F.col("n") / F.col("total")).alias("share"))
    )


def paired_counts(production: DataFrame, training: DataFrame, features: Features,
                  production_features: Features | None = None) -> DataFrame:
    """``feature, value, n_p, n_q`` over the union of both sides' values."""
    p = _unpivot(production, production_features or features).select("*", F.lit(1).alias("p"), F.lit(0).alias("q"))
    q = _unpivot(training, features).select("*", F.lit(0).alias("p"), F.lit(1).alias("q"))
    return (
        p.unionByName(q).groupBy("feature", "value")
        .agg(F.sum("p").alias("n_p"), F.sum("q").alias("n_q"))
    )


def _feature_totals(counts: DataFrame, epsilon: float) -> DataFrame:
    """Per feature: row totals and what the two sides sum to after the epsilon fill."""
    only_p, only_q = F.col("n_q") == 0, F.col("n_p") == 0
    return counts.groupBy("feature").agg(
        F.sum("n_p").alias("total_p"),
        F.sum("n_q").alias("total_q"),
        (F.lit(1.0) + F.lit(epsilon) * F.count_if(only_q)).alias("mass_p"),
        (F.lit(1.0) + F.lit(epsilon) * F.count_if(only_p)).alias("mass_q"),
    )


def aligned_distribution(production: DataFrame, training: DataFrame, features: Features,
                         epsilon: float = EPSILON, production_features: Features | None = None) -> DataFrame:
    """``feature, value, p, q``: both distributions on the union of values, filled and renormalised."""
    counts = paired_counts(production, training, features, production_features)
    totals = _feature_totals(counts, epsilon).where((F.col("total_p") > 0) & (F.col("total_q") > 0))
    fill = lambda n, total, mass: (
        F.when(F.col(n) > 0, F.col(n) / F.col(total)).otherwise(F.lit(epsilon)) / F.col(mass)
    )
    return counts.join(F.broadcast(totals), "feature").select(  # one row per named feature
        "feature", "value", fill("n_p", "total_p", "mass_p").alias("p"), fill("n_q", "total_q", "mass_q").alias("q")
    )


def kl_divergence(production: DataFrame, training: DataFrame, features: Features,
                  epsilon: float = EPSILON, production_features: Features | None = None) -> DataFrame:
    """``feature, kl``: KL(production || training) with natural logarithms.

    With p = n/P for present values and epsilon otherwise, the sum over values splits
    into sums of counts and logs of counts, so the totals need not be known beforehand:
    one aggregation gives the sums, and the last step combines them per feature. A side
    without any value has no distribution and gives NULL.
    """
    counts = paired_counts(production, training, features, production_features)
    n, m = F.col("n_p").cast("double"), F.col("n_q").cast("double")
    both, only_p, only_q = (n > 0) & (m > 0), m == 0, n == 0
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    sums = counts.groupBy("feature").agg(
        F.sum(n).alias("P"), F.sum(m).alias("Q"),
        zero(F.sum(F.when(both, n * (F.ln(n) - F.ln(m))))).alias("shared_log"),
        zero(F.sum(F.when(both, n))).alias("shared"),
        zero(F.sum(F.when(only_p, n * F.ln(n)))).alias("p_log"),
        zero(F.sum(F.when(only_p, n))).alias("p_rows"),
        F.count_if(only_p).cast("double").alias("p_values"),
        zero(F.sum(F.when(only_q, F.ln(m)))).alias("q_log"),
        F.count_if(only_q).cast("double").alias("q_values"),
    )
    eps, log_eps = F.lit(epsilon), F.ln(F.lit(epsilon))
    c = F.col
    raw = (
        c("shared_log") + c("shared") * (F.ln(c("Q")) - F.ln(c("P")))
        + c("p_log") - c("p_rows") * (F.ln(c("P")) + log_eps)
    ) / c("P") + eps * (c("q_values") * (log_eps + F.ln(c("Q"))) - c("q_log"))
    mass_p = F.lit(1.0) + eps * c("q_values")
    mass_q = F.lit(1.0) + eps * c("p_values")
    kl = raw / mass_p - F.ln(mass_p) + F.ln(mass_q)
    return sums.select("feature", F.when((c("P") > 0) & (c("Q") > 0), kl).alias("kl"))


# The metric name of each conversation feature.
METRIC_OF_FEATURE = {
    "product_category": "category_balance",
    "sentiment": "sentiment_distribution",
    "quarter": "temporal_consistency",
}


def drift_metrics(kl: DataFrame, metric_of_feature: Mapping[str, str], threshold: float = KL_MAX) -> DataFrame:
    """KL rows as metric rows ``(metric, value, threshold, pass)``; every named feature appears."""
    names = F.array(*[
        F.struct(F.lit(f).alias("feature"), F.lit(m).alias("metric")) for f, m in metric_of_feature.items()
    ])
    # a feature without any value on either side has no KL row: it is reported as failed
    pivot = kl.agg(F.map_from_entries(F.collect_list(F.struct("feature", "kl"))).alias("kls"))  # one per feature
    value = F.try_element_at(F.col("kls"), F.col("feature"))
    return pivot.select("kls", F.inline(names)).select(
        "metric", value.alias("value"), F.lit(threshold).alias("threshold"),
        F.coalesce(value < F.lit(threshold), F.lit(False)).alias("pass"),
    )


def conversation_features(df: DataFrame, unparsed: str = "label") -> dict[str, Column]:
    return {
        "product_category": F.col("product_category"),
        "sentiment": F.col("sentiment"),
        "quarter": quarter_label(F.col("timestamp"), unparsed),
    }


def ddq_scorecard(training: DataFrame, production: DataFrame, threshold: float = KL_MAX,
                  unparsed: str = "label") -> DataFrame:
    """Category, sentiment and temporal drift of a conversation table, in one pass."""
    kl = kl_divergence(production, training, conversation_features(training, unparsed))
    return drift_metrics(kl, METRIC_OF_FEATURE, threshold)
