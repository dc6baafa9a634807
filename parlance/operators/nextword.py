"""Next-token statistics: the table form of a next-token model.

Works on encoded sequences, so a model has at most (vocabulary size)^2 rows and the
per-token totals at most one row per vocabulary entry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parlance.operators.batching import next_token_pairs
from parlance.session import freeze

SMOOTHING = 0.1
HEAD_PAIRS = 500_000  # pairs of a model that travel to every task; some 40 MB


def shifted_pairs(examples: DataFrame, *keep: str) -> DataFrame:
    """``prev, next`` of each position of shifted examples, from the row's own arrays (no window)."""
    pairs = F.arrays_zip(F.col("input_ids").alias("prev"), F.col("target_ids").alias("next"))
    return examples.select(*keep, F.inline(pairs).alias("prev", "next"))


def token_pairs(encoded: DataFrame, *keep: str, ids: str = "ids") -> DataFrame:
    """``prev, next`` of each adjacent position of whole sequences."""
    return shifted_pairs(next_token_pairs(encoded.select(*keep, F.col(ids).alias("_ids")), "_ids"), *keep)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body over a value that is computed once a row, however often the body's own lambdas refer to it."""
    return F.transform(F.array(value), body)[0]


def distinct_pairs(encoded: DataFrame, *keep: str, ids: str = "ids") -> DataFrame:
    """``prev, next, n`` of the distinct adjacent pairs of each sequence, counted in its own sorted array of pairs."""
    def adjacent(whole: Column) -> Column:
        return F.transform(F.slice(whole, F.lit(1), F.greatest(F.size(whole) - 1, F.lit(0))), lambda prev, i: F.struct(
            prev.alias("prev"), F.get(whole, i + 1).alias("next")))

    def with_starts(pairs: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(pairs) - 1), lambda i: (i == 0) | (F.get(pairs, i) != F.get(pairs, i - 1)))
        return F.struct(pairs.alias("pairs"), first.alias("starts"))

    def counted(both: Column) -> Column:
        pairs, starts = both["pairs"], both["starts"]
        return F.transform(starts, lambda i, k: F.struct(
            F.get(pairs, i)["prev"].alias("prev"), F.get(pairs, i)["next"].alias("next"),
            (F.coalesce(F.get(starts, k + 1), F.size(pairs)) - i).cast("bigint").alias("n")))

    in_order = F.array_sort(_let(F.col(ids), adjacent))
    found = _let(_let(in_order, with_starts), counted)
    return encoded.where(F.size(ids) > 1).select(*keep, F.inline(found))


def pair_counts(encoded: DataFrame, ids: str = "ids") -> DataFrame:
    """``prev, next, n``; counted per task before the shuffle, so no pair is hot."""
    return token_pairs(encoded, ids=ids).groupBy("prev", "next").agg(F.count(F.lit(1)).alias("n"))


def model_of_counts(counts: DataFrame, vocab_size: int, smoothing: float = SMOOTHING) -> DataFrame:
    """``prev, next, n, prev_n, probability`` with add-k smoothing."""
    totals = counts.groupBy("prev").agg(F.sum("n").alias("prev_n"))
    return (
        counts.join(totals, "prev")
        .withColumn("probability", (F.col("n") + F.lit(smoothing)) / (F.col("prev_n") + F.lit(smoothing * vocab_size)))
    )


def bigram_model(encoded: DataFrame, vocab_size: int, smoothing: float = SMOOTHING, ids: str = "ids") -> DataFrame:
    """The smoothed model of whole encoded sequences."""
    return model_of_counts(pair_counts(encoded, ids), vocab_size, smoothing)


def _with_cost(pairs: DataFrame, model: DataFrame, vocab_size: int, smoothing: float) -> DataFrame:
    """Add ``cost``, the negative log probability. Spark splits the join of a hot pair, or broadcasts a small model."""
    totals = model.groupBy("prev").agg(F.max("prev_n").alias("prev_n"))
    unseen = F.lit(smoothing) / (F.coalesce("prev_n", F.lit(0)) + F.lit(smoothing * vocab_size))
    return (
        pairs.join(model.select("prev", "next", "probability"), ["prev", "next"], "left")
        .join(totals, "prev", "left")  # at most one row per vocabulary entry
        .withColumn("cost", -F.ln(F.coalesce("probability", unseen)))
    )


def frequent_pairs(model: DataFrame) -> DataFrame:
    """The most frequent pairs, ``HEAD_PAIRS`` at most: all from that half power of two of their count on with which they fit."""
    step = F.floor(F.log2("n") * 2)
    sizes = model.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs")).where(F.col("step").isNotNull())
    so_far = F.sum("pairs").over(Window.orderBy(F.desc("step")))  # over at most 128 rows
    least = sizes.withColumn("so_far", so_far).where(F.col("so_far") <= HEAD_PAIRS).agg(F.min("step")).scalar()
    return model.where(step >= least)


def gathered_pairs(encoded: DataFrame, key: str, head: DataFrame, ids: str = "ids") -> DataFrame:
    """``key, found, prev, next, n, known``: one row for all pairs of a sequence that the head holds, with the sum of their
    costs, and the counted other ones.

    The row of those found has no ``next``, so it joins nothing, and the key's hash as ``prev``, so a join deals such rows evenly.
    """
    known = head.select("prev", "next", (-F.ln("probability")).alias("known"))
    priced = token_pairs(encoded.where(F.size(ids) > 1), key, ids=ids).join(F.broadcast(known), ["prev", "next"], "left")
    found = F.col("known").isNotNull()
    prev, next_ = F.when(found, F.hash(key)).otherwise(F.col("prev")), F.when(~found, F.col("next"))
    return priced.groupBy(key, found.alias("found"), prev.alias("prev"), next_.alias("next")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("known").alias("known")
    )


def sequence_perplexity(encoded: DataFrame, key: str, model: DataFrame, vocab_size: int,
                        smoothing: float = SMOOTHING, ids: str = "ids") -> DataFrame:
    """``key, tokens, nll, perplexity`` of each sequence under a bigram model.

    Frequent pairs get their cost where they stand, from the head of the model, and are summed before the shuffle; only
    rare ones are joined with the model.
    """
    model = freeze(model)
    scored = _with_cost(gathered_pairs(encoded, key, frequent_pairs(model), ids), model, vocab_size, smoothing)
    cost = F.when(F.col("found"), F.col("known")).otherwise(F.col("cost") * F.col("n"))
    sums = scored.groupBy(key).agg(F.sum("n").alias("tokens"), (F.sum(cost) / F.sum("n")).alias("nll"))
    return sums.withColumn("perplexity", F.exp("nll"))


def perplexity_of_counts(counts: DataFrame, model: DataFrame, vocab_size: int, smoothing: float = SMOOTHING) -> DataFrame:
    """One row for all sequences whose pairs were counted."""
    scored = _with_cost(counts, model, vocab_size, smoothing)
    return (
        scored.agg(F.sum("n").alias("tokens"), (F.sum(F.col("cost") * F.col("n")) / F.sum("n")).alias("nll"))
        .withColumn("perplexity", F.exp("nll"))
    )


def corpus_perplexity(encoded: DataFrame, model: DataFrame, vocab_size: int, smoothing: float = SMOOTHING,
                      ids: str = "ids") -> DataFrame:
    """One row for all sequences; pairs are counted before they meet the model."""
    return perplexity_of_counts(pair_counts(encoded, ids), model, vocab_size, smoothing)


def next_token_topk(model: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` likeliest followers of each token, equal counts by id."""
    rank = F.row_number().over(Window.partitionBy("prev").orderBy(F.desc("n"), "next"))
    return model.withColumn("rank", rank).where(F.col("rank") <= k)
