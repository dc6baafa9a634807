"""Statistics over logged training and scoring runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parlance.functions.arithmetic import bce_with_logits, clip, sigmoid
from parlance.operators.joins import same_keys
from parlance.operators.sequences import best_before

# Fixed values.
PERPLEXITY_TARGET = 50.0
ACCURACY_TARGET = 0.85
CLIP_EPSILON = 0.2


def loss_perplexity(batches: DataFrame, by: list[str], loss: str = "loss") -> DataFrame:
    """Mean of the batch losses, its exponential, and whether that meets the target."""
    return batches.groupBy(*by).agg(F.count(loss).alias("batches"), F.avg(loss).alias("loss")).select(
        *by, "batches", "loss", F.exp("loss").alias("perplexity"),
        (F.exp("loss") < F.lit(PERPLEXITY_TARGET)).alias("target_met"),
    )


def masked_token_loss(tokens: DataFrame, by: list[str], target: str = "target", nll: str = "nll",
                      ignore: int = 0) -> DataFrame:
    """Mean negative log-likelihood of the tokens whose target is not the ignored id."""
    counts = F.col(target) != F.lit(ignore)
    return tokens.groupBy(*by).agg(
        F.count_if(counts).alias("tokens"), F.avg(F.when(counts, F.col(nll))).alias("loss")
    )


def trailing_loss(batches: DataFrame, epoch: str = "epoch", batch: str = "batch", loss: str = "loss",
                  every: int = 20, chunk: int = 1 << 16) -> DataFrame:
    """Mean of the last ``every`` logged losses, reported at each batch whose number is a multiple of it.

    Batches may be missing from the log; a row without a number comes before all others. Rows are cut into chunks by
    their numbers, and a sliding window never leaves its chunk, so a long epoch is spread. The first rows of a chunk
    also count the last ones before it: of each chunk at most ``every`` - 1 losses are handed on, over as many
    chunks as it takes where the log is thin. Losses that are missing count for nothing, but as rows.
    """
    rows = batches.select(epoch, batch, F.col(loss).cast("double").alias("_loss"), F.floor(F.col(batch) / F.lit(chunk)).alias("_chunk"))
    in_chunk = Window.partitionBy(epoch, "_chunk").orderBy(batch)
    last = in_chunk.rowsBetween(1 - every, 0)
    slid = rows.withColumns({
        "_sum": F.sum("_loss").over(last), "_n": F.count("_loss").over(last), "_place": F.row_number().over(in_chunk),
        "_lacks": F.lit(every) - F.count(F.lit(1)).over(last)})
    reported = slid.where(F.pmod(F.col(batch), F.lit(every)) == 0)
    from_end = F.row_number().over(Window.partitionBy(epoch, "_chunk").orderBy(F.col(batch).desc()))
    ends = rows.withColumn("_from_end", from_end).where(F.col("_from_end") < every)
    tails = ends.groupBy(epoch, "_chunk").agg(F.sort_array(F.collect_list(F.struct((-F.col("_from_end")).alias("at"), "_loss")))["_loss"].alias("_tail"))
    # A chunk holds one row at least, so the chunks before that can matter are as few as the rows.
    earlier = Window.partitionBy(epoch).orderBy("_chunk").rowsBetween(-max(1, every - 1), -1)
    before = tails.select(epoch, "_chunk", F.flatten(F.collect_list("_tail").over(earlier)).alias("_before"))
    whole = reported.where(F.col("_lacks") <= 0)
    starts = same_keys(reported.where(F.col("_lacks") > 0), before, [epoch, "_chunk"])
    handed = F.filter(F.slice(F.reverse("_before"), F.lit(1), F.col("_lacks").cast("int")), lambda x: x.isNotNull())
    filled = starts.withColumn("_handed", handed).select(
        epoch, batch, (F.coalesce("_sum", F.lit(0.0)) + F.aggregate("_handed", F.lit(0.0), lambda s, x: s + x)).alias("_sum"),
        (F.col("_n") + F.size("_handed")).alias("_n"))
    return whole.select(epoch, batch, "_sum", "_n").unionAll(filled).select(
        epoch, batch, F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n")).alias("avg_loss"))


def best_checkpoints(history: DataFrame, step: str = "epoch", accuracy: str = "accuracy",
                     run: str | None = None) -> DataFrame:
    """Steps whose accuracy beats all earlier ones (and 0), with the target verdict."""
    known = history.withColumn("_known", F.when(~F.isnan(accuracy), F.col(accuracy)))  # NaN beats nothing
    before = best_before(known, run, step, "_known", "_best")
    return (
        before.where(F.col("_known") > F.coalesce("_best", F.lit(0.0))).drop("_best", "_known")
        .withColumn("target_met", F.col(accuracy) >= F.lit(ACCURACY_TARGET))
    )


def preference_accuracy(scored: DataFrame, by: list[str] | None = None, score: str = "score",
                        label: str = "label") -> DataFrame:
    """Share of examples whose thresholded sigmoid equals the label."""
    positive = ~F.isnan(score) & (sigmoid(F.col(score)) > 0.5)  # NaN is not above the threshold
    predicted = F.when(positive, F.lit(1.0)).otherwise(F.lit(0.0))
    hit = F.when(predicted == F.col(label), F.lit(1.0)).otherwise(F.lit(0.0))
    return scored.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def preference_bce(scored: DataFrame, by: list[str] | None = None, score: str = "score",
                   label: str = "label") -> DataFrame:
    """Mean binary cross-entropy of the scores as logits."""
    return scored.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n"), F.avg(bce_with_logits(F.col(score), F.col(label))).alias("bce")
    )


def probability_ratio(new_logp: Column, old_logp: Column) -> Column:
    return F.exp(new_logp - old_logp)


def ppo_objective(steps: DataFrame, by: list[str] | None = None, old_logp: str = "old_logp",
                  new_logp: str = "new_logp", advantage: str = "advantage",
                  epsilon: float = CLIP_EPSILON) -> DataFrame:
    """Clipped surrogate loss, negated so that lower is better."""
    ratio = probability_ratio(F.col(new_logp), F.col(old_logp))
    gain = F.least(ratio * F.col(advantage), clip(ratio, 1.0 - epsilon, 1.0 + epsilon) * F.col(advantage))
    return steps.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"), (-F.avg(gain)).alias("ppo_loss"))
