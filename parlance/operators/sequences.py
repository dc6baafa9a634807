"""Ordered-sequence operators over numbered steps (turn 0, 1, 2, ... per group).

A window over a whole group would put a very long group into one task. The windows
here run over (group, chunk of consecutive turns) instead; what crosses a chunk
border travels in a small carry table read from the rows at the borders only.

Where episodes are known to be short, ``max_turns`` states the bound: the carry table is
left out, all operators then share one shuffle and sort by group, and a row beyond the
bound stops the job with an error instead of growing a window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parlance.operators.joins import same_keys

CHUNK = 65536


def _chunk(turn: str, size: int) -> Column:
    return F.floor(F.col(turn) / F.lit(size)).cast("bigint")


def _guarded(value: Column, turn: str, max_turns: int) -> Column:
    """The value, or an error for a turn outside [0, max_turns)."""
    message = F.concat(F.lit(f"turn outside [0, {max_turns}): "), F.col(turn).cast("string"))
    inside = (F.col(turn) >= 0) & (F.col(turn) < max_turns)
    return F.when(inside, value).otherwise(F.raise_error(message))


def previous_value(df: DataFrame, group: str, turn: str, value: Column | str, initial: Column | float,
                   name: str, chunk: int = CHUNK, max_turns: int | None = None) -> DataFrame:
    """Add the value of the preceding turn, ``initial`` at the first turn of a group."""
    value = F.col(value) if isinstance(value, str) else value
    initial = initial if isinstance(initial, Column) else F.lit(initial)
    if max_turns is not None:
        before = F.lag(F.struct(_guarded(value, turn, max_turns).alias("v"))).over(
            Window.partitionBy(group).orderBy(turn)
        )
        return df.withColumn(name, F.when(before.isNull(), initial).otherwise(before["v"]))
    local = Window.partitionBy(group, "_chunk").orderBy(turn)
    rows = df.withColumn("_value", value).withColumn("_chunk", _chunk(turn, chunk))
    # the last value of the last chunk before that has any rows, whatever turns are missing
    ends = rows.groupBy(group, "_chunk").agg(F.max_by(F.struct("_value"), turn).alias("_end"))
    carry = ends.select(
        group, "_chunk", F.lag("_end").over(Window.partitionBy(group).orderBy("_chunk")).alias("_carry"))
    before = F.coalesce(F.lag(F.struct("_value")).over(local), F.col("_carry"))
    return (
        same_keys(rows, carry, [group, "_chunk"], "left")
        .withColumn(name, F.when(before.isNull(), initial).otherwise(before["_value"]))
        .select(*df.columns, name)
    )


def return_chunk(gamma: float) -> int:
    """Turns per chunk: beyond it a discounted reward weighs less than 1e-120."""
    if not 0.0 <= gamma <= 1.0:
        raise ValueError("gamma must lie in [0, 1]")
    if gamma in (0.0, 1.0):
        return CHUNK
    return max(1, math.ceil(math.log(1e-120) / math.log(gamma)))


def discounted_returns(df: DataFrame, group: str, turn: str, reward: str, gamma: float = 0.99,
                       name: str = "discounted_return", chunk: int | None = None,
                       max_turns: int | None = None) -> DataFrame:
    """Add the return-to-go ``G_t = r_t + gamma * G_{t+1}`` of each step.

    Inside a chunk the recursion has the closed form ``sum(gamma^k r_k) / gamma^t``,
    with exponents counted from the chunk start so that they cannot underflow. Turns are
    walked from the last to the first, so the sum grows by one row at a time.
    """
    size = chunk or return_chunk(gamma)
    value = F.col(reward) if max_turns is None else _guarded(F.col(reward), turn, max_turns)
    if gamma == 0.0:
        return df.withColumn(name, value)
    power = lambda exponent: F.pow(F.lit(float(gamma)), exponent)
    onward = lambda *keys: (
        Window.partitionBy(*keys).orderBy(F.col(turn).desc()).rowsBetween(Window.unboundedPreceding, 0))
    if max_turns is not None and max_turns <= size:
        t = F.col(turn).cast("double")
        return df.withColumn(name, F.sum(power(t) * value).over(onward(group)) / power(t))
    rows = (
        df.withColumn("_reward", value).withColumn("_chunk", _chunk(turn, size))
        .withColumn("_o", (F.col(turn) - F.col("_chunk") * F.lit(size)).cast("double"))
    )
    sums = rows.groupBy(group, "_chunk").agg(F.sum(power(F.col("_o")) * F.col("_reward")).alias("_s"))
    by_chunk = Window.partitionBy(group).orderBy("_chunk")
    gap = (F.lead("_chunk").over(by_chunk) - F.col("_chunk") - 1).cast("double") * F.lit(size)
    carry = _chunk_returns(sums, group, float(gamma) ** size).select(
        group, "_chunk", (F.lead("_v").over(by_chunk) * power(gap)).alias("_carry"))
    inside = F.sum(power(F.col("_o")) * F.col("_reward")).over(onward(group, "_chunk")) / power(F.col("_o"))
    beyond = F.coalesce(F.col("_carry"), F.lit(0.0)) * power(F.lit(float(size)) - F.col("_o"))
    return (
        same_keys(rows, carry, [group, "_chunk"], "left")
        .withColumn(name, inside + beyond)
        .select(*df.columns, name)
    )


def _chunk_returns(sums: DataFrame, group: str, gamma: float) -> DataFrame:
    """Returns-to-go ``_v`` at the starts of chunks: the same recursion on a sequence many times shorter."""
    if gamma <= 1e-100:
        return sums.withColumn("_v", F.col("_s"))  # what lies beyond the chunk weighs nothing
    if gamma == 1.0:
        ahead = Window.partitionBy(group).orderBy(F.col("_chunk").desc()).rowsBetween(Window.unboundedPreceding, 0)
        return sums.withColumn("_v", F.sum("_s").over(ahead))
    shorter = sums.withColumnRenamed("_chunk", "_turn")
    return discounted_returns(shorter, group, "_turn", "_s", gamma, "_v").withColumnRenamed("_turn", "_chunk")


def best_before(df: DataFrame, group: str | None, step: str, value: str, name: str,
                chunk: int = CHUNK, max_turns: int | None = None) -> DataFrame:
    """Add the maximum over all earlier steps of the group, NULL at its first step."""
    keys = [group] if group else []
    if max_turns is not None:
        earlier = Window.partitionBy(*keys).orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(name, F.max(_guarded(F.col(value), step, max_turns)).over(earlier))
    rows = df.withColumn("_chunk", _chunk(step, chunk))
    earlier_chunks = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        rows.groupBy(*keys, "_chunk").agg(F.max(value).alias("_m"))
        .withColumn("_carry", F.max("_m").over(earlier_chunks))
        .select(*keys, "_chunk", "_carry")
    )
    earlier_rows = Window.partitionBy(*keys, "_chunk").orderBy(step).rowsBetween(Window.unboundedPreceding, -1)
    return (
        same_keys(rows, carry, [*keys, "_chunk"])
        .withColumn(name, F.greatest(F.max(value).over(earlier_rows), F.col("_carry")))
        .select(*df.columns, name)
    )
