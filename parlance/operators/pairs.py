"""Context/response pairs, their scores and labels, and preference pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from parlance.functions.arithmetic import clip
from parlance.functions.hashing import digest, standard_normal, uniform
from parlance.functions.text import fill_template, labelled_context, words
from parlance.operators.batching import IGNORE
from parlance.operators.joins import same_keys
from parlance.operators.ranking import among_first
from parlance.operators.vocabulary import BOS, EOS, MAX_LENGTH, SEP_TOKEN, word_ids

# Response templates by sentiment, products by category, quality phrases.
RESPONSE_TEMPLATES = {
    "positive": [
        "I'm glad you're interested! I recommend {product} which has excellent reviews.",
        "Great choice! Our {product} is highly rated for {quality}.",
        "Perfect! I suggest {product} - it's one of our best sellers.",
    ],
    "neutral": [
        "I can help you with that. I recommend {product} for your needs.",
        "Let me suggest {product} which fits your requirements.",
        "I'd recommend {product} based on what you're looking for.",
    ],
    "negative": [
        "I understand your frustration. Let me help you find {product} with {quality}.",
        "I apologize for the issue. I recommend {product} which has {quality}.",
        "I'm sorry about that. Our {product} has excellent {quality} ratings.",
    ],
}
PRODUCTS = {
    "Electronics": ["TechPro Laptop", "UltraSound Headphones", "SmartView Monitor"],
    "Clothing": ["TrekPro Jeans", "ComfortFit Shirt", "ActiveWear Jacket"],
    "Home": ["DuraClean Vacuum", "SmartCook Blender", "CozyComfort Sofa"],
    "Sports": ["TrailRunner Shoes", "FlexFit Yoga Mat", "PowerLift Weights"],
}
QUALITIES = [
    "excellent durability",
    "high customer ratings",
    "premium quality materials",
    "outstanding performance",
    "long warranty coverage",
]
# Score rule and bands.
BASE_SCORE, SCORE_NOISE, SCORE_RANGE = 3.5, 0.3, (2.0, 5.0)
BONUSES = [("negative", "understand", 0.5), ("positive", "glad", 0.3)]
GOOD_MIN, BAD_BELOW = 4.0, 3.5
TOP_N = 500


def _choices(options: dict[str, list[str]], by: Column) -> Column:
    """The option list of a key from a handful of constants; NULL for an unknown key."""
    entries = []
    for name, values in options.items():
        entries += [F.lit(name), F.array(*[F.lit(v) for v in values])]
    return F.try_element_at(F.create_map(*entries), by)


def _choose(values: Column, draw: Column) -> Column:
    return F.element_at(values, (F.floor(draw * F.size(values)) + 1).cast("int"))


def rule_score(sentiment: Column, response: Column, noise: Column) -> Column:
    """Base score, a bonus for a fitting wording, noise, clipped; rounded so that ties are ties."""
    score = F.lit(BASE_SCORE)
    for when_sentiment, word, bonus in BONUSES:
        fits = (sentiment == when_sentiment) & F.contains(response, F.lit(word))
        score = score + F.when(fits, F.lit(bonus)).otherwise(F.lit(0.0))
    return F.round(clip(score + F.lit(SCORE_NOISE) * noise, *SCORE_RANGE), 6)


def sft_pairs(df: DataFrame, key: str, seed: int = 42, n_pairs: int | None = None) -> DataFrame:
    """``key, context, response, quality_score`` for each conversation; a narrow projection.

    An unknown sentiment takes the neutral templates. An unknown category has no product:
    its row is kept with a NULL response. ``n_pairs`` keeps the first rows by key.
    """
    rows = df if n_pairs is None else df.orderBy(key).limit(n_pairs)
    k = F.col(key)
    templates = F.coalesce(
        _choices(RESPONSE_TEMPLATES, F.col("sentiment")),
        F.array(*[F.lit(t) for t in RESPONSE_TEMPLATES["neutral"]]),
    )
    response = fill_template(
        _choose(templates, uniform(seed, "template", k)),
        _choose(_choices(PRODUCTS, F.col("product_category")), uniform(seed, "product", k)),
        _choose(F.array(*[F.lit(q) for q in QUALITIES]), uniform(seed, "quality", k)),
    )
    context = labelled_context(
        F.col("product_category"), F.col("sentiment"), F.col("outcome"), F.col("conversation_text")
    )
    return (
        rows.select(k, context.alias("context"), F.col("sentiment"), response.alias("response"))
        .withColumn(
            "quality_score", rule_score(F.col("sentiment"), F.col("response"), standard_normal(seed, "noise", k))
        )
        .drop("sentiment")
    )


def top_n_label(df: DataFrame, key: str, score: str = "quality_score", n: int = TOP_N,
                name: str = "is_good") -> DataFrame:
    """Flag the ``n`` best-scored rows; equal scores by key, missing scores last. With fewer rows all are flagged.

    The cut-off row is found first; flagging is then a comparison, without a join.
    """
    return df.withColumn(name, among_first(df, [(score, False), (key, True)], n))


def label_averages(df: DataFrame, label: str = "is_good", score: str = "quality_score") -> DataFrame:
    """``label, n, avg_score`` for good, other and all rows, in one aggregation."""
    good = F.col(label)
    totals = df.agg(
        F.count_if(good).alias("n_good"), F.avg(F.when(good, F.col(score))).alias("good"),
        F.count_if(~good).alias("n_other"), F.avg(F.when(~good, F.col(score))).alias("other"),
        F.count(F.lit(1)).alias("n_all"), F.avg(score).alias("all"),
    )
    row = lambda name: F.struct(
        F.lit(name).alias("label"), F.col(f"n_{name}").alias("n"), F.col(name).alias("avg_score")
    )
    return totals.select(F.inline(F.array(row("good"), row("other"), row("all"))))


def score_band(score: Column) -> Column:
    """'good' from 4.0, 'bad' below 3.5, NULL between and for a missing score."""
    good = ~F.isnan(score) & (score >= F.lit(GOOD_MIN))
    return F.when(good, F.lit("good")).when(score < F.lit(BAD_BELOW), F.lit("bad"))


def contexts_with_both(df: DataFrame, context: str = "context", score: str = "quality_score") -> DataFrame:
    """Contexts that have a good and a bad response."""
    band = score_band(F.col(score))
    return (
        df.groupBy(context)
        .agg(F.bool_or(band == "good").alias("g"), F.bool_or(band == "bad").alias("b"))
        .where(F.col("g") & F.col("b")).select(context)
    )


def first_contexts(df: DataFrame, order: str, n: int, context: str = "context") -> DataFrame:
    """Distinct contexts in order of first appearance, at most ``n``."""
    return df.groupBy(context).agg(F.min(order).alias("first_at")).orderBy("first_at", context).limit(n)


def preference_pairs(df: DataFrame, key: str, context: str = "context", response: str = "response",
                     score: str = "quality_score", band: Column | None = None, seed: int = 42,
                     n_contexts: int | None = None) -> DataFrame:
    """One good and one bad response per context that has both, each picked by seeded hash.

    The pick is a minimum of the hash, 60 bits of it as a number, per context and side: one aggregation in buffers
    of fixed width, in which a context that holds a third of the rows is one row per task. Only the winners'
    responses are then fetched, by context, side and hash, a key of the join that no context makes hot; where
    hashes agree in 60 bits, the whole hash, the key and the response decide among the fetched.
    """
    rows = df
    if n_contexts is not None:
        chosen = first_contexts(df, key, n_contexts, context).select(context)
        rows = df.join(chosen, context, "left_semi")  # Spark broadcasts it if its bytes, not its rows, are few
    side = score_band(F.col(score)) if band is None else band
    hashed = digest(seed, "pick", F.col(key))
    leading = F.conv(F.substring(hashed, 1, 15), 16, 10).cast("bigint")
    # A generator of one row each: conditions on the side are not moved into the projections that compute the score.
    drawn = rows.select(F.inline(F.array(F.struct(
        F.col(context).alias("_context"), side.alias("_side"), leading.alias("_pick"), F.col(key).alias("_key"),
        F.col(response).alias("_response"), F.col(score).cast("double").alias("_score")))))
    drawn = drawn.where(F.col("_side").isin("good", "bad"))
    least = lambda name: F.min(F.when(F.col("_side") == name, F.col("_pick"))).alias(name)
    best = drawn.groupBy("_context").agg(least("good"), least("bad")).where("good IS NOT NULL AND bad IS NOT NULL")
    wanted = best.select("_context", F.inline(F.array(*[
        F.struct(F.lit(name).alias("_side"), F.col(name).alias("_pick")) for name in ("good", "bad")])))
    # NULL is a context like any other.
    fetched = same_keys(drawn, wanted, ["_context", "_side", "_pick"]).repartition("_context")
    order = Window.partitionBy("_context", "_side").orderBy(digest(seed, "pick", F.col("_key")), "_key", "_response", "_score")
    first = fetched.withColumn("_place", F.row_number().over(order)).where("_place = 1")
    # 'bad' comes before 'good'; a context has one row of either by now.
    other = F.lead(F.struct("_response", "_score")).over(Window.partitionBy("_context").orderBy("_side"))
    return first.withColumn("_good", other).where("_side = 'bad'").select(
        F.col("_context").alias(context), F.col("_good._response").alias("good_response"), F.col("_response").alias("bad_response"),
        F.col("_good._score").alias("good_score"), F.col("_score").alias("bad_score"))


def preference_examples(pairs: DataFrame, context: str = "context") -> DataFrame:
    """Two labelled texts per pair: context and response joined by a blank, 1.0 good, 0.0 bad."""
    example = lambda side, label: F.struct(
        F.concat(F.col(context), F.lit(" "), F.col(f"{side}_response")).alias("text"), F.lit(label).alias("label")
    )
    return pairs.select(F.inline(F.array(example("good", 1.0), example("bad", 0.0))))


def sft_sequences(df: DataFrame, key: str, context: str, response: str, vocab: DataFrame,
                  max_length: int = MAX_LENGTH, shift: bool = False) -> DataFrame:
    """``key, input_ids, target_ids``: BOS context SEP response EOS with the context masked.

    ``vocab`` must hold the separator (``with_separator``). Targets stand at the position of
    the input token itself; ``shift=True`` moves them to the preceding position, as
    next-token training needs.
    """
    head = lambda c: words(F.col(c), max_length)  # later words are cut in any case
    rows = word_ids(
        df.select(key, head(context).alias("ctx"), head(response).alias("resp")), ["ctx", "resp"], vocab
    ).withColumn("sep", vocab.where(F.col("token") == SEP_TOKEN).select(F.max("id")).scalar())
    inputs = F.concat(F.array(F.lit(BOS)), "ctx", F.array("sep"), "resp", F.array(F.lit(EOS)))
    targets = F.concat(F.array_repeat(F.lit(IGNORE), F.size("ctx") + 2), F.col("resp"), F.array(F.lit(EOS)))
    cut = rows.select(
        key, F.slice(inputs, 1, max_length).alias("input_ids"), F.slice(targets, 1, max_length).alias("target_ids")
    )
    if not shift:
        return cut
    n = F.size("input_ids")
    return cut.select(
        key,
        F.slice(F.col("input_ids"), F.lit(1), n - 1).alias("input_ids"),
        F.slice(F.col("target_ids"), F.lit(2), n - 1).alias("target_ids"),
    )
