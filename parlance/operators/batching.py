"""Training examples and padded batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parlance.operators.ranking import Order, hash_rank, ordered_rank
from parlance.operators.vocabulary import PAD

IGNORE = -100  # fixed value: target id that losses skip


def next_token_pairs(df: DataFrame, ids: str = "ids") -> DataFrame:
    """Input and target shifted by one token; sequences of a single token give no example.

    Written as a generator of at most one row. A filter on the length would be pushed down
    and make Spark compute an encoded sequence twice.
    """
    length = F.size(ids)
    example = F.struct(
        F.slice(F.col(ids), F.lit(1), length - 1).alias("input_ids"),
        F.slice(F.col(ids), F.lit(2), length - 1).alias("target_ids"),
    )
    others = [c for c in df.columns if c != ids]
    return df.select(*others, F.inline(F.when(length > 1, F.array(example))))


def pad_batches(df: DataFrame, key: str, sequences: dict[str, int], batch_size: int = 32, seed: int = 42,
                order: Order | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Number batches of ``batch_size`` rows and pad arrays to the longest first array of the batch.

    ``sequences`` maps each array column to its padding id; the first one sets the length.
    Rows are taken in seeded hash order, or in ``order`` (unique) if given. A batch is one
    small group; nothing larger meets in a task. ``keys``: see ``hash_rank``.
    """
    ranked = hash_rank(df, key, seed, "_rank", keys) if order is None else ordered_rank(df, order, "_rank")
    batch = Window.partitionBy("batch_id")
    lead = next(iter(sequences))
    sized = ranked.withColumn("batch_id", F.floor(F.col("_rank") / F.lit(batch_size)).cast("bigint")).withColumn(
        "_longest", F.max(F.size(lead)).over(batch)
    )
    padded = {
        c: F.concat(F.col(c), F.array_repeat(F.lit(pad), F.greatest(F.col("_longest") - F.size(c), F.lit(0))))
        for c, pad in sequences.items()
    }
    return sized.withColumns(padded).drop("_rank", "_longest")


def pad_language_batches(df: DataFrame, key: str, batch_size: int = 32, seed: int = 42,
                         keys: DataFrame | None = None) -> DataFrame:
    return pad_batches(df, key, {"input_ids": PAD, "target_ids": PAD}, batch_size, seed, keys=keys)


def pad_response_batches(df: DataFrame, key: str, batch_size: int = 16, seed: int = 42,
                         keys: DataFrame | None = None) -> DataFrame:
    """Targets are padded with the ignored id instead of PAD."""
    return pad_batches(df, key, {"input_ids": PAD, "target_ids": IGNORE}, batch_size, seed, keys=keys)
