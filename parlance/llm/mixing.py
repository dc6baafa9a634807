"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

A document of size x in source s gets the rate min(cap, exp(lambda_s * x / mean_s)): of all rates
up to the cap that meet the source's target, the ones of least relative entropy to one copy each.
lambda_s minimises the convex dual; Newton's method runs for all sources at once over counts of
(source, size), which hold all that the dual depends on. Rates become whole copies by a hash
draw per document; one shift of the draws per source, found from histograms, brings
the rounded sum to within about one document of the target, and a second shift for the documents
smaller than what is left then closes most of the rest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parlance.llm.common import column, packed, written

WEIGHTS = (3.0, 1.0, 2.0)
TOLERANCE = 1e-9
BINS = 4096


def _same_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    right = right.withColumnRenamed("source", "source_")
    return left.join(right, F.col("source").eqNullSafe(F.col("source_")), how).drop("source_")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Sources by code point, NULL last, take the weights in turn. Together they get ``share`` of all
    sizes by weight; a target stops at ``cap`` times its source's size and the excess is shared
    again by weight. In the order of cap / weight the stopped sources come first, so running
    sums give the final level in one go. One row per source passes through one window.
    """
    everything = W.orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(everything) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int"))
    limits = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    ratio = F.col("limit") / F.col("weight")
    by_level = W.orderBy(ratio, F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(W.unboundedPreceding, -1)
    whole = by_level.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    levels = limits.withColumns({
        "rest": F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)),
        "weights": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
    }).withColumn("level", F.col("rest") / F.col("weights"))
    # The level of the first source that is not stopped holds for it and all after it.
    free_from = F.when(F.col("limit") > F.col("level") * F.col("weight"), ratio)
    first_free = F.min_by("level", free_from).over(whole)
    return levels.select("source", "source_size", F.least(
        F.col("limit"), F.coalesce(first_free * F.col("weight"), F.col("limit"))).alias("target"))


def rate(size: Column, tilt: Column, mean: Column, cap: float) -> Column:
    """The tilted rate; exponents are cut at ln(cap) first, so none overflows."""
    return F.exp(F.least(tilt * size / mean, F.lit(math.log(cap))))


def _sum(terms: Column) -> Column:
    """A sum that does not depend on the order of its terms, so that reruns agree to the last bit."""
    return F.sum(terms.cast("decimal(38,6)")).cast("double")


def solve_tilts(counts: DataFrame, targets: DataFrame, cap: float = 2.0, max_steps: int = 60) -> DataFrame:
    """Newton steps, guarded by a bracket, on the dual of every source; ends when all sources meet their targets.

    The tilts live in a written table beside their sources, so their number may grow. Nothing but
    one count per step reaches the driver. Sources that are not solved after ``max_steps`` are an error.
    """
    facts = counts.groupBy("source").agg(
        F.sum("n").alias("n"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
    state = _same_source(targets, facts).select(
        "source", "source_size", "target",
        F.greatest(F.col("source_size") / F.col("n"), F.lit(1e-9)).alias("mean"), F.col("least"),
    ).withColumns({
        "tilt": F.lit(0.0), "done": F.col("source_size") == 0,
        # At the upper end every document is at the cap. Below zero the function is convex and Newton's
        # method walks down from the right, so the lower end is only a far limit.
        "upper": F.coalesce(F.lit(math.log(cap) * (1 + 1e-9)) * F.col("mean") / F.col("least"), F.lit(0.0)),
        "lower": F.lit(-1e6),
    })
    state = written(state.withColumn("tilt", F.when(F.col("target") >= F.col("source_size") * cap, F.col("upper")).otherwise(F.col("tilt")))
                    .withColumn("done", F.col("done") | (F.col("target") >= F.col("source_size") * cap)), "tilts")
    for _ in range(max_steps):
        if state.where("NOT done").isEmpty():
            break
        x = F.col("size") / F.col("mean")
        words = F.col("n") * F.col("size") * rate(F.col("size"), F.col("tilt"), F.col("mean"), cap)
        free = F.col("tilt") * x < F.lit(math.log(cap))
        sums = _same_source(counts, state.where("NOT done").select("source", "mean", "tilt")).groupBy("source").agg(
            _sum(words).alias("words"), _sum(F.when(free, words * x).otherwise(0.0)).alias("slope"))
        step = _same_source(state, sums, "left").withColumns({
            "excess": F.col("words") - F.col("target"),
        }).withColumns({
            "now_done": F.col("done") | (F.abs("excess") <= F.col("target") * TOLERANCE + 1e-6),
            "upper": F.when(F.col("excess") > 0, F.col("tilt")).otherwise(F.col("upper")),
            "lower": F.when(F.col("excess") < 0, F.col("tilt")).otherwise(F.col("lower")),
        }).withColumn("newton", F.when(F.col("slope") > 0, F.col("tilt") - F.col("excess") / F.col("slope")))
        inside = (F.col("newton") > F.col("lower")) & (F.col("newton") < F.col("upper"))
        moved = F.when(F.coalesce(inside, F.lit(False)), F.col("newton")).otherwise((F.col("lower") + F.col("upper")) / 2)
        state = written(step.select(
            "source", "source_size", "target", "mean", "least",
            F.when(F.col("now_done"), F.col("tilt")).otherwise(moved).alias("tilt"),
            F.col("now_done").alias("done"), "upper", "lower"), "tilts")
    else:
        if left := state.where("NOT done").count():
            raise RuntimeError(f"{left} sources did not meet their targets in {max_steps} steps")
    return state.select("source", "source_size", "target", "mean", "tilt")


def _draw(id_col: Column, size: Column) -> Column:
    """Uniform in [0, 1), from the row's id and size."""
    return F.shiftrightunsigned(F.xxhash64(id_col, size, F.lit("mix")), 11) / F.lit(float(2**53))


def _shift_bins(rows: DataFrame, solved: DataFrame, cap: int, rounds: int = 2) -> DataFrame:
    """For each source the shift of all draws that brings the rounded words nearest to the target.

    Copy k of a row is taken when shift >= k - rate - draw. Words by that threshold are
    counted in bins of [-1, 1], then in bins of the one bin where the running sum meets the target.
    """
    level = rate(F.col("size"), F.col("tilt"), F.col("mean"), float(cap)) + F.col("draw")
    events = _same_source(rows.select("source", "size", "draw"), solved).where("size > 0").select(
        "source", "target", "size",
        F.explode(F.array(*[F.lit(float(k)) - level for k in range(1, cap + 1)])).alias("at"))
    where = solved.select("source", F.lit(-1.0).alias("low"), F.lit(0.0).alias("below"))
    width = 2.0 / BINS
    for _ in range(rounds):
        bins = _same_source(events, where).withColumn(
            # Before the first bin copies are taken for sure; in later rounds they are in ``below``.
            "bin", F.floor((F.col("at") - F.col("low")) / F.lit(width))).where(F.col("bin") < BINS)
        if width < 2.0 / BINS:
            bins = bins.where("bin >= 0")
        sums = bins.groupBy("source", F.greatest("bin", F.lit(-1)).alias("bin")).agg(
            F.sum("size").cast("double").alias("words"), F.first("target").alias("target"), F.first("low").alias("low"), F.first("below").alias("below"))
        running = sums.withColumn("upto", F.col("below") + F.sum("words").over(W.partitionBy("source").orderBy("bin")))
        first = running.where("upto >= target").withColumn(
            "k", F.row_number().over(W.partitionBy("source").orderBy("bin"))).where("k = 1")
        found = first.select("source", "target", "upto", (F.col("low") + F.col("bin") * F.lit(width)).alias("low"),
                             (F.col("upto") - F.col("words")).alias("below"))
        edge = width
        where = written(found, "shifts").select("source", "low", "below", "target", "upto")
        last, where = where, where.select("source", "low", "below")
        width /= BINS
    # Either edge of the last bin; the nearer one wins.
    return last.select("source", F.when(
        F.col("upto") - F.col("target") <= F.col("target") - F.col("below"), F.col("low") + F.lit(edge)
    ).otherwise(F.col("low")).alias("shift"))


def _rate(cap: int) -> Column:
    return rate(F.col("size"), F.col("tilt"), F.col("mean"), float(cap))


def _copies(cap: int) -> Column:
    shift = F.when(F.col("size") <= F.col("small"), F.col("small_shift")).otherwise(F.col("shift"))
    return F.least(F.greatest(F.floor(_rate(cap) + F.col("draw") + shift), F.lit(0)), F.lit(cap)).cast("int")


def _shift_small(rows: DataFrame, solved: DataFrame, cap: int) -> DataFrame:
    """Add (small, small_shift): rows no larger than the words still off the target get a shift of their own."""
    plain = solved.withColumns({"small": F.lit(0).cast("bigint"), "small_shift": F.lit(0.0)})
    words = F.col("size") * _copies(cap)
    taken = _same_source(rows, plain).groupBy("source").agg(F.sum(words).alias("taken"))
    left = written(_same_source(solved, taken).withColumn("small", F.floor(F.abs(F.col("target") - F.col("taken")))), "left")
    small = _same_source(rows, left.select("source", "small")).where("size > 0 AND size <= small").drop("small")
    share = _same_source(small, plain).groupBy("source").agg(F.sum(words).alias("by_small"))
    aims = _same_source(left, share).withColumn("target", F.col("target") - F.col("taken") + F.col("by_small"))
    shifts = _shift_bins(small, aims.select("source", "source_size", "target", "mean", "tilt"), cap)
    found = _same_source(left, shifts.withColumnRenamed("shift", "small_shift"), "left").drop("taken")
    return found.withColumns({
        "small": F.when(F.col("small_shift").isNull(), 0).otherwise(F.col("small")),
        "small_shift": F.coalesce("small_shift", F.lit(0.0))})


def mix(rows: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source",
        weights=WEIGHTS, share: float = 1.5, cap: int = 2) -> DataFrame:
    """The input as a struct ``_row`` beside size, source_size, target, rate and copies.

    ``copies`` (0 to ``cap``) says how often the mix takes the row. Sizes are whole numbers, NULL
    counts as 0, and they may be of any magnitude: a row larger than its source's target is taken or left; rows of size
    0 add nothing to their source and have rate 1. NULL is a source of its own.
    Rows that repeat id and size are drawn alike. An empty table gives no rows. Extra columns stay in ``_row``.
    """
    given = packed(rows, id=column(id_col), source=column(source_col), size=F.coalesce(size, F.lit(0)).cast("bigint"))
    given = given.withColumn("draw", _draw(F.col("id"), F.col("size")))
    narrow = written(given.select("source", "size", "draw"), "sizes")
    counts = written(narrow.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "counts")
    sizes = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    solved = solve_tilts(counts, source_targets(sizes, weights, share, float(cap)), float(cap))
    solved = _same_source(solved, _shift_bins(narrow, solved, cap), "left")
    solved = written(solved.withColumn("shift", F.coalesce("shift", F.lit(0.0))), "solved")
    solved = written(_shift_small(narrow, solved, cap), "solved")
    return _same_source(given, solved).select(
        "_row", "size", "source_size", "target", _rate(cap).alias("rate"), _copies(cap).alias("copies"))
