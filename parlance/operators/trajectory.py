"""Logged interactions: step rules, rewards, returns, state features, policy metrics, value fit.

A transition table has one row per step: ``episode, turn`` (0, 1, 2, ...), the state before
the step (``customer_segment, product_category, satisfaction, mentioned_issue,
asked_about_price``), ``action`` and the outcome (``purchased, escalated, satisfaction_after``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions.arithmetic import dot
from parlance.operators.sequences import best_before, discounted_returns

# Action names by id, rule tables, reward weights, feature names.
ACTION_NAMES = [
    "recommend_budget",
    "recommend_premium",
    "answer_faq",
    "offer_10%_discount",
    "offer_20%_discount",
    "escalate_to_human",
]
# (action, condition, mean change of satisfaction); the first matching row counts
SATISFACTION_RULES = [
    (0, "asked_about_price", 0.2),
    (0, None, 0.05),
    (1, "vip", 0.25),
    (1, "mentioned_issue", 0.2),
    (1, None, 0.1),
    (2, None, 0.1),
    (3, "mentioned_issue", 0.3),
    (3, None, 0.15),
    (4, "mentioned_issue", 0.4),
    (4, None, 0.25),
    (5, "frustrated", 0.1),
    (5, None, -0.1),
]
# (action, condition, factor on satisfaction); other actions never sell
PURCHASE_RULES = [(0, None, 0.8), (1, "vip", 0.7), (1, None, 0.5)]
FRUSTRATED_BELOW = 0.4
GAIN_WEIGHT, PURCHASE_WEIGHT, ESCALATION_WEIGHT = 0.5, 0.35, -0.15
MODEL_WEIGHT = 0.5
MAX_TURNS = 10
LEAVES_BELOW = 0.2
FEATURES = [
    "satisfaction", "is_vip", "is_regular", "Electronics", "Clothing", "Home", "Sports",
    "mentioned_issue", "asked_price", "turn_progress",
]


def action_name(action: Column) -> Column:
    """Name of an action id, NULL for an unknown one."""
    names = F.array(*[F.lit(n) for n in ACTION_NAMES])
    return F.when(action >= 0, F.try_element_at(names, action.cast("int") + 1))


def _first_match(rules: list[tuple], conditions: dict[str, Column], default: float) -> Column:
    chain = F
    for action, condition, value in rules:
        applies = F.col("action") == action
        if condition is not None:
            applies = applies & conditions[condition]
        chain = chain.when(applies, F.lit(value))
    return chain.otherwise(F.lit(default))


def _conditions() -> dict[str, Column]:
    return {
        "vip": F.col("customer_segment") == "vip",
        "mentioned_issue": F.col("mentioned_issue"),
        "asked_about_price": F.col("asked_about_price"),
        "frustrated": F.col("satisfaction") < FRUSTRATED_BELOW,
    }


def satisfaction_delta() -> Column:
    """Expected change of satisfaction by action and state."""
    return _first_match(SATISFACTION_RULES, _conditions(), 0.0)


def purchase_probability(satisfaction: Column) -> Column:
    """Chance of a purchase at the satisfaction reached after the action."""
    return satisfaction * _first_match(PURCHASE_RULES, _conditions(), 0.0)


def step_reward(before: Column, after: Column, purchased: Column, escalated: Column) -> Column:
    """Weighted satisfaction gain, purchase bonus and escalation cost."""
    flag = lambda c: F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))
    return (
        F.lit(GAIN_WEIGHT) * (after - before)
        + F.lit(PURCHASE_WEIGHT) * flag(purchased)
        + F.lit(ESCALATION_WEIGHT) * flag(escalated)
    )


def combined_reward(reward: Column, model_score: Column) -> Column:
    return reward + F.lit(MODEL_WEIGHT) * model_score


def advantage(reward: Column, value: Column) -> Column:
    """Reward above the estimated value of the state."""
    return reward - value


def is_terminal(turn_after: Column, purchased: Column, escalated: Column, satisfaction_after: Column,
                max_turns: int = MAX_TURNS) -> Column:
    """Whether a step ends its episode."""
    return (turn_after >= max_turns) | purchased | escalated | (satisfaction_after < F.lit(LEAVES_BELOW))


def until_terminal(steps: DataFrame, ends: Column, max_turns: int | None = None) -> DataFrame:
    """The steps of each episode up to its first terminal one."""
    flagged = steps.withColumn("_ends", ends.cast("int"))
    earlier = best_before(flagged, "episode", "turn", "_ends", "_ended", max_turns=max_turns)
    return earlier.where(F.coalesce("_ended", F.lit(0)) == 0).drop("_ends", "_ended")


def state_features() -> Column:
    """The ten features of the state before the step; segment 'new' is all zeros."""
    one = lambda c: F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))
    segment, category = F.col("customer_segment"), F.col("product_category")
    return F.array(
        F.col("satisfaction").cast("double"),
        one(segment == "vip"), one(segment == "regular"),
        *[one(category == c) for c in FEATURES[3:7]],
        one(F.col("mentioned_issue")), one(F.col("asked_about_price")),
        F.col("turn") / F.lit(float(MAX_TURNS)),
    )


def value_training_set(steps: DataFrame, gamma: float = 0.99, max_turns: int | None = None) -> DataFrame:
    """Each step with its features and its discounted return."""
    returns = discounted_returns(steps, "episode", "turn", "reward", gamma, max_turns=max_turns)
    return returns.withColumn("features", state_features())


def policy_metrics(steps: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Episode reward (mean, population deviation), purchase and escalation rate, turns per episode."""
    by = by or []
    count = lambda c: F.sum(F.col(c).cast("int"))
    episodes = steps.groupBy(*by, "episode").agg(
        F.sum("reward").alias("reward"), count("purchased").alias("purchased"),
        count("escalated").alias("escalated"), F.count(F.lit(1)).alias("turns"),
    )
    n = F.count(F.lit(1))
    return episodes.groupBy(*by).agg(
        n.alias("episodes"),
        F.avg("reward").alias("avg_reward"),
        F.stddev_pop("reward").alias("std_reward"),
        F.try_divide(F.sum("purchased"), n).alias("purchase_rate"),
        F.try_divide(F.sum("escalated"), n).alias("escalation_rate"),
        F.avg("turns").alias("avg_turns"),
    )


def first_step_evaluation(steps: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The same rates from the first step of each episode only."""
    rate = lambda c: F.avg(F.col(c).cast("double"))
    return steps.where(F.col("turn") == 0).groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("episodes"),
        F.avg("reward").alias("avg_reward"),
        rate("purchased").alias("purchase_rate"),
        rate("escalated").alias("escalation_rate"),
    )


def gram_matrix(df: DataFrame, features: str = "features", target: str = "discounted_return",
                width: int = len(FEATURES)) -> DataFrame:
    """``i, j, value`` (i <= j) of the features' product sums; ``j = width`` is the target column.

    One aggregation with partial sums per task; the result has a fixed number of rows.
    """
    flat = df.select(
        *[F.col(features)[i].alias(f"x{i}") for i in range(width)], F.col(target).alias(f"x{width}")
    )
    cells = [(i, j) for i in range(width) for j in range(i, width + 1)]
    sums = flat.agg(*[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i, j in cells])
    entry = lambda i, j: F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"s{i}_{j}").alias("value"))
    return sums.select(F.inline(F.array(*[entry(i, j) for i, j in cells])))


def fit_value_weights(df: DataFrame, names: list[str] = FEATURES, features: str = "features",
                      target: str = "discounted_return") -> DataFrame:
    """``feature, weight``: least squares without intercept, minimum norm if rank-deficient.

    The sums are distributed; only the k x (k+1) matrix (65 numbers) reaches the driver.
    """
    k = len(names)
    xtx, xty = np.zeros((k, k)), np.zeros(k)
    for i, j, value in gram_matrix(df, features, target, k).collect():
        if j == k:
            xty[i] = value
        else:
            xtx[i, j] = xtx[j, i] = value
    weights = np.linalg.pinv(xtx, hermitian=True) @ xty
    return df.sparkSession.createDataFrame(
        [(name, float(w)) for name, w in zip(names, weights)], "feature string, weight double"
    )


def value_score(weights: list[float], features: str = "features") -> Column:
    return dot(F.col(features), weights)


def fit_quality(df: DataFrame, prediction: Column, target: str = "discounted_return") -> DataFrame:
    """``n, mse, r2`` in one pass; the target's spread is a one-pass variance."""
    y = F.col(target)
    squared = (prediction - y) * (prediction - y)
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(squared).alias("mse"),
        (F.lit(1.0) - F.try_divide(F.avg(squared), F.var_pop(y))).alias("r2"),
    )
