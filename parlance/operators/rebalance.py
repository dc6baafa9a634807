"""Weights and samples that even out unequal classes.

Everything follows from one small count per class. Choices derive from md5 of a seed and the row's
key. Classes with NULL are a class of their own. The counts are joined by size: Spark
broadcasts them where they are few, and splits a hot class's join where they are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.hashing import uniform
from parlance.operators.joins import same_keys

RUN = 1 << 16  # copies that one task makes of a row before another takes over


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``label, n, weight`` with weight = rows / (classes * n), so that every class weighs the same in sum."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")))
    rows = totals.scalar()
    return counts.withColumn("weight", rows["rows"].cast("double") / (rows["classes"] * F.col("n")))


def _whole(share: Column, seed: int, key: Column) -> Column:
    """A whole number whose expectation is ``share``: the remainder is one more copy by a coin."""
    floor = F.floor(share)
    return (floor + F.when(uniform(seed, "copies", key) < share - floor, 1).otherwise(0)).cast("bigint")


def oversample(df: DataFrame, key: str, label: str, target: int | None = None, seed: int = 42) -> DataFrame:
    """Repeat rows so that every class has about ``target`` rows (default: those of the largest class).

    Each row of a class of n rows comes floor(target / n) times, and once more by a coin for the
    remainder. Classes above the target keep each row once. ``copy`` numbers the copies from 0. Rows with
    many copies are first cut into runs of ``RUN`` copies, which are spread over the tasks, so a class of one row against
    a billion needs no more memory than any other.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    wanted = F.lit(target) if target is not None else counts.agg(F.max("_n")).scalar()
    counts = counts.withColumn("_share", F.greatest(F.lit(1.0), wanted.cast("double") / F.col("_n")))
    copies = _whole(F.col("_share"), seed, F.col(key))
    own = [F.col(f"`{c}`") for c in df.columns]
    counted = same_keys(df, counts, [label]).select(*own, copies.alias("_copies"))
    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)
    few = counted.where(F.col("_copies") <= RUN).select(*own, F.explode(upto(F.col("_copies"))).alias("copy"))
    runs = counted.where(F.col("_copies") > RUN).select(
        *own, "_copies", F.explode(upto(F.ceil(F.col("_copies") / RUN).cast("bigint"))).alias("_run"))
    many = runs.repartition(key, "_run").select(
        *own, F.explode(F.sequence(F.col("_run") * RUN, F.least(F.col("_copies"), (F.col("_run") + 1) * RUN) - 1)).alias("copy"))
    return few.unionByName(many)


def stratified_match(df: DataFrame, reference: DataFrame, key: str, strata: str, seed: int = 42) -> DataFrame:
    """A sample of ``df`` whose shares per stratum are those of ``reference``.

    The sample is as large as the scarcest stratum allows; a stratum that the reference lacks gives no rows, and one
    that ``df`` lacks cannot be matched and is left out. Rows are kept by a coin per key.
    """
    have = df.groupBy(strata).agg(F.count(F.lit(1)).alias("_have"))
    want = reference.groupBy(strata).agg(F.count(F.lit(1)).alias("_want"))
    ratios = same_keys(have, want, [strata]).withColumn("_ratio", F.col("_want").cast("double") / F.col("_have"))
    fractions = ratios.select(strata, (F.col("_ratio") / ratios.agg(F.max("_ratio")).scalar()).alias("_fraction"))
    kept = same_keys(df, fractions, [strata]).where(uniform(seed, "stratum", F.col(key)) < F.col("_fraction"))
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])
