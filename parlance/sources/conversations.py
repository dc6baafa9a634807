"""Generated retail conversation tables with controllable quality problems.

The records hang on an existing key column (``spark.range`` or any table), one
record per key, by narrow hash expressions: no shuffle, no driver loop, the same
rows under any partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.functions.hashing import pick, uniform, weighted_pick

COLUMNS = ["customer_id", "product_category", "sentiment", "timestamp", "conversation_text", "outcome"]
SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in COLUMNS])

# Domains, the two weightings, and the covered day range.
CATEGORIES = ["Electronics", "Clothing", "Home", "Sports"]
SENTIMENTS = ["positive", "neutral", "negative"]
OUTCOMES = ["purchase", "abandon", "escalate"]
FIRST_DAY = "2019-01-01"
DAY_SPAN = 2191

TEXTS = [
    "Does this laptop come with a charger?",
    "The jacket ripped after one week",
    "Which blender is the quietest one?",
    "My parcel has not arrived yet",
    "I would like a refund for the shoes",
    "Is there a discount for two pairs?",
    "The headphones sound great, thank you",
    "Can you compare these two vacuums?",
    "I was charged twice for one order",
    "Do you ship weights to the islands?",
]


@dataclass(frozen=True)
class ConversationSpec:
    seed: int
    id_format: str
    category_weights: tuple[float, ...]
    sentiment_weights: tuple[float, ...]
    outcome_weights: tuple[float, ...]
    texts: tuple[str, ...]


TRAINING = ConversationSpec(
    42, "CUST_%06d", (0.60, 0.30, 0.07, 0.03), (0.4, 0.4, 0.2), (0.3, 0.6, 0.1), tuple(TEXTS)
)
PRODUCTION = ConversationSpec(
    123, "PROD_%06d", (0.25, 0.25, 0.25, 0.25), (0.33, 0.34, 0.33), (0.35, 0.55, 0.10),
    ("a message logged in production",),
)


def random_iso_day(draw: Column) -> Column:
    """A uniformly chosen day as ISO text at midnight."""
    day = F.date_add(F.to_date(F.lit(FIRST_DAY)), F.floor(draw * F.lit(float(DAY_SPAN))).cast("int"))
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00"))


def generate(keys: DataFrame, key: str, spec: ConversationSpec) -> DataFrame:
    """One conversation record per key: ``key`` plus the six conversation columns."""
    k = F.col(key)
    draw = lambda tag: uniform(spec.seed, tag, k)
    return keys.select(
        k,
        F.format_string(spec.id_format, k).alias("customer_id"),
        weighted_pick(CATEGORIES, list(spec.category_weights), draw("cat")).alias("product_category"),
        weighted_pick(SENTIMENTS, list(spec.sentiment_weights), draw("sen")).alias("sentiment"),
        random_iso_day(draw("ts")).alias("timestamp"),
        pick(list(spec.texts), draw("text")).alias("conversation_text"),
        weighted_pick(OUTCOMES, list(spec.outcome_weights), draw("out")).alias("outcome"),
    )


def generate_range(spark: SparkSession, n: int, spec: ConversationSpec = TRAINING) -> DataFrame:
    """``n`` records on a fresh key column ``id``."""
    return generate(spark.range(n), "id", spec)


def inject_missing(df: DataFrame, key: str, rate: float = 0.20, seed: int = 42,
                   columns: list[str] | None = None) -> DataFrame:
    """Blank each cell independently with probability ``rate``."""
    targets = set(COLUMNS if columns is None else columns)
    return df.select(*[
        F.when(uniform(seed, "missing", c, F.col(key)) >= F.lit(rate), F.col(c)).alias(c)
        if c in targets else F.col(c)
        for c in df.columns
    ])


def inject_duplicates(df: DataFrame, key: str, rate: float = 0.05, seed: int = 42) -> DataFrame:
    """Append a copy of each row with probability ``rate``; ``copy_no`` tells the copies apart.

    One scan: the row is exploded in place instead of being read again for a union.
    """
    last = F.when(uniform(seed, "duplicate", F.col(key)) < F.lit(rate), F.lit(1)).otherwise(F.lit(0))
    return df.withColumn("copy_no", F.explode(F.sequence(F.lit(0), last)))


def inject_invalid_timestamps(df: DataFrame, keys: list[str], rate: float = 0.03, seed: int = 42,
                              column: str = "timestamp") -> DataFrame:
    """Replace the timestamp by a malformed text with probability ``rate``."""
    if column not in df.columns:
        return df
    parts = [F.col(k).cast("string") for k in keys]
    broken = F.concat(F.lit("INVALID_DATE_"), F.concat_ws("_", *parts))
    return df.withColumn(
        column, F.when(uniform(seed, "invalid", *parts) < F.lit(rate), broken).otherwise(F.col(column))
    )


def with_quality_problems(df: DataFrame, key: str, missing: float = 0.20, duplicates: float = 0.05,
                          invalid: float = 0.03, seed: int = 42) -> DataFrame:
    """Missing cells, then duplicates, then malformed timestamps; the six columns only."""
    dirty = inject_missing(df, key, missing, seed)
    dirty = inject_duplicates(dirty, key, duplicates, seed)
    return inject_invalid_timestamps(dirty, [key, "copy_no"], invalid, seed).select(*COLUMNS)
