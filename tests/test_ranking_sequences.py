import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from parlance.operators import ranking, sequences


def order_of(ids, seed=42):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


@pytest.mark.parametrize("partitions", [1, 16])
def test_hash_rank_is_the_global_order(spark, partitions):
    df = spark.range(3000).repartition(partitions)
    got = {r["id"]: r["rank"] for r in ranking.hash_rank(df, "id").collect()}
    assert got == {i: n for n, i in enumerate(order_of(range(3000)))}


@pytest.mark.parametrize("n,ratio", [(0, 0.8), (1, 0.8), (7, 0.8), (1000, 0.8), (1000, 0.333), (50, 0.0), (50, 1.0)])
def test_hash_split_size_and_members(spark, n, ratio):
    df = spark.range(n).repartition(5)
    train = {r["id"] for r in ranking.hash_split(df, "id", ratio).where("split = 'train'").collect()}
    assert train == set(order_of(range(n))[: int(n * ratio)])


def test_hash_split_keeps_copies_together(spark):
    # one key holds a third of the rows
    df = spark.range(600).select(F.when(F.col("id") < 200, F.lit(7)).otherwise(F.col("id")).alias("id"))
    split = ranking.hash_split(df, "id", 0.5)
    assert split.count() == 600
    assert split.groupBy("id").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    assert split.where("split = 'train'").count() <= 300


def test_threshold_split(spark):
    df = spark.range(20000).select("id", ranking.threshold_split(F.col("id")).alias("split"))
    assert df.where("split = 'train'").count() == pytest.approx(16000, rel=0.02)


def test_ordered_rank_and_split_with_ties(spark):
    # a third of the rows share one score
    data = [(i, 1.0 if i % 3 == 0 else float((i * 37) % 101)) for i in range(999)]
    df = spark.createDataFrame(data, "id long, score double").repartition(9)
    want = [i for i, _ in sorted(data, key=lambda x: (-x[1], x[0]))]
    order = [("score", False), ("id", True)]
    ranks = {r["id"]: r["rank"] for r in ranking.ordered_rank(df, order).collect()}
    assert ranks == {i: n for n, i in enumerate(want)}
    train = {r["id"] for r in ranking.ordered_split(df, order).where("split = 'train'").collect()}
    assert train == set(want[: int(999 * 0.8)])


@pytest.mark.parametrize("n", [0, 1, 5])
def test_ordered_split_of_small_tables(spark, n):
    split = ranking.ordered_split(spark.range(n), [("id", True)], 0.5)
    assert sorted(r["id"] for r in split.where("split = 'train'").collect()) == list(range(n // 2))
    assert split.count() == n


def test_number_turns_with_a_hot_group(spark):
    data = [(0 if i % 3 == 0 else i % 50 + 1, (i * 7919) % 3001) for i in range(3000)]
    df = spark.createDataFrame(data, "g long, t long").repartition(11)
    seen, want = {}, {}
    for g, t in sorted(data):
        want[(g, t)] = seen.get(g, 0)
        seen[g] = want[(g, t)] + 1
    assert {(r["g"], r["t"]): r["turn"] for r in ranking.number_turns(df, "g", ["t"]).collect()} == want


@pytest.mark.parametrize("values", [
    [1.0, 2.0, 4.0], [4.0, 1.0], [5.0], [1.0] * 40 + [2.0] * 39 + [None], [float(i * 31 % 97) for i in range(500)],
])
def test_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(6)
    got = ranking.median_of(df, "x").collect()
    assert len(got) == 1 and got[0][0] == statistics.median(v for v in values if v is not None)


def test_median_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert [r[0] for r in ranking.median_of(df, "x").collect()] == [None]


def episodes(seed, lengths):
    rng = random.Random(seed)
    return [(e, t, round(rng.uniform(-1, 1), 2)) for e, n in enumerate(lengths) for t in range(n)]


def returns_of(data, gamma):
    out, by = {}, {}
    for e, t, r in data:
        by.setdefault(e, {})[t] = r
    for e, rewards in by.items():
        total = 0.0
        for t in sorted(rewards, reverse=True):
            total = rewards[t] + gamma * total
            out[(e, t)] = total
    return out


@pytest.mark.parametrize("gamma,options", [
    (0.99, {}), (0.99, {"chunk": 4}), (0.5, {"chunk": 3}), (1.0, {"chunk": 5}), (1.0, {}), (0.0, {}),
    (0.99, {"max_turns": 64}), (1.0, {"max_turns": 64}),
])
def test_discounted_returns(spark, gamma, options):
    data = episodes(1, [1, 2, 10, 57])
    df = spark.createDataFrame(data, "e long, t int, r double").repartition(7)
    got = sequences.discounted_returns(df, "e", "t", "r", gamma, "g", **options).collect()
    want = returns_of(data, gamma)
    assert {(r["e"], r["t"]): r["g"] for r in got} == {k: pytest.approx(v, abs=1e-9) for k, v in want.items()}


def test_returns_example_and_long_episode(spark):
    df = spark.createDataFrame([(0, t, 1.0) for t in range(3)], "e long, t int, r double")
    got = [r["g"] for r in sequences.discounted_returns(df, "e", "t", "r", 0.99, "g").orderBy("t").collect()]
    assert got == pytest.approx([2.9701, 1.99, 1.0])
    # far beyond the turn at which gamma^t leaves the double range
    long = spark.range(2000).select(F.lit(0).alias("e"), F.col("id").alias("t"), F.lit(1.0).alias("r"))
    first = sequences.discounted_returns(long, "e", "t", "r", 0.5, "g").where("t = 0 or t = 1990").orderBy("t").collect()
    assert [r["g"] for r in first] == pytest.approx([2.0, 2.0 - 0.5**9])


def test_bound_is_enforced(spark):
    df = spark.createDataFrame([(0, t, 1.0) for t in range(3)], "e long, t int, r double")
    with pytest.raises(Exception, match="turn outside"):
        sequences.discounted_returns(df, "e", "t", "r", max_turns=2).collect()
    with pytest.raises(ValueError):
        sequences.discounted_returns(df, "e", "t", "r", 1.5)


@pytest.mark.parametrize("options", [{}, {"chunk": 4}, {"max_turns": 64}])
def test_previous_value_and_best_before(spark, options):
    data = episodes(2, [1, 3, 33])
    df = spark.createDataFrame(data, "e long, t int, r double").repartition(5)
    value = {(e, t): r for e, t, r in data}
    got = sequences.previous_value(df, "e", "t", "r", 0.55, "p", **options).collect()
    assert {(r["e"], r["t"]): r["p"] for r in got} == {(e, t): value.get((e, t - 1), 0.55) for e, t in value}
    got = sequences.best_before(df, "e", "t", "r", "b", **options).collect()
    best = lambda e, t: max((value[(e, s)] for s in range(t)), default=None)
    assert {(r["e"], r["t"]): r["b"] for r in got} == {(e, t): best(e, t) for e, t in value}


def test_previous_value_keeps_null(spark):
    df = spark.createDataFrame([(0, 0, None), (0, 1, 2.0)], "e long, t int, r double")
    got = sequences.previous_value(df, "e", "t", "r", 9.0, "p").orderBy("t").collect()
    assert [r["p"] for r in got] == [9.0, None]
