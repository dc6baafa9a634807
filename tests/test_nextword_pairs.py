"""Distinct pairs of a sequence, counted in place."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks.catalog import QUERIES
from parlance.operators import nextword


def test_distinct_pairs_and_perplexity(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randrange(6) for _ in range(n)]) for i, n in enumerate([0, 1, 2, 3, 50, 400])] + [(9, None), (10, [3] * 1000)]
    df = spark.createDataFrame(rows, "id int, ids array<int>")
    got = {(r.id, r.prev, r.next): r.n for r in nextword.distinct_pairs(df, "id").collect()}
    assert got == {(i, a, b): n for i, ids in rows for (a, b), n in Counter(zip(ids or [], (ids or [])[1:])).items()}
    model = nextword.bigram_model(df, 6)
    scored = {r.id: (r.tokens, r.nll) for r in nextword.sequence_perplexity(df, "id", model, 6).collect()}
    tokens = nextword.token_pairs(df.where("ids IS NOT NULL"), "id")
    plain = nextword._with_cost(tokens, model, 6, nextword.SMOOTHING).groupBy("id").agg(F.count("*").alias("t"), F.avg("cost").alias("c")).collect()
    assert scored == {r.id: (r.t, pytest.approx(r.c)) for r in plain}


def _sequences(spark):
    rng = random.Random(2)
    word = lambda: min(rng.randrange(1, 30), rng.randrange(1, 30))
    rows = [(i % 40 if i % 9 else None, [word() for _ in range(n)]) for i, n in enumerate([0, 1, 2, 3, 700] + [60] * 50)] + [(7, None)]
    return spark.createDataFrame(rows, "id int, ids array<int>")


@pytest.mark.parametrize("held", [0, 40, 10_000])
def test_perplexity_with_any_head_of_the_model(spark, monkeypatch, held):
    monkeypatch.setattr(nextword, "HEAD_PAIRS", held)
    df = _sequences(spark)
    model = nextword.bigram_model(df.where("id % 2 = 0"), 30)  # many pairs of the others are unseen
    head = nextword.frequent_pairs(model)
    size = head.count()
    assert size <= held and (size > 0) == (held > 0)
    assert size == 0 or head.agg(F.min("n")).first()[0] > (model.join(head, ["prev", "next"], "left_anti").agg(F.max("n")).first()[0] or 0)
    scored = {r.id: (r.tokens, r.nll, r.perplexity) for r in nextword.sequence_perplexity(df, "id", model, 30).collect()}
    prob = {(r.prev, r.next): r.probability for r in model.collect()}
    total = {r.prev: r.prev_n for r in model.collect()}
    costs = {}
    for i, ids in df.collect():
        for a, b in zip(ids or [], (ids or [])[1:]):
            costs.setdefault(i, []).append(-math.log(prob.get((a, b), 0.1 / (total.get(a, 0) + 3))))
    mean = {i: sum(c) / len(c) for i, c in costs.items()}
    assert scored == {i: (len(costs[i]), pytest.approx(m), pytest.approx(math.exp(m))) for i, m in mean.items()}


def test_frequent_pairs_are_summed_before_they_are_shuffled(spark, monkeypatch):
    df = _sequences(spark)
    model = nextword.bigram_model(df, 30)
    keys = nextword.token_pairs(df, "id").select("id").distinct().count()
    gathered = nextword.gathered_pairs(df, "id", nextword.frequent_pairs(model))
    assert gathered.count() == keys and gathered.where("NOT found OR next IS NOT NULL").count() == 0
    assert gathered.select("prev").distinct().count() > keys / 2  # the sums do not meet in one task of the join
    monkeypatch.setattr(nextword, "HEAD_PAIRS", 40)
    gathered = nextword.gathered_pairs(df, "id", nextword.frequent_pairs(model))
    found = {r.found: r.n for r in gathered.groupBy("found").agg(F.sum("n").alias("n")).collect()}
    assert set(found) == {True, False} and sum(found.values()) == nextword.token_pairs(df, "id").count()
    plan = nextword.sequence_perplexity(df, "id", model, 30)._jdf.queryExecution().optimizedPlan().toString()
    assert "array_sort" not in plan


def test_bigram_perplexity_tokenizes_texts_once(spark, tmp_path):
    texts = [(1, "a b a b"), (1, "b a"), (None, "a c"), (2, ""), (3, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    scored = QUERIES["bigram_perplexity"](spark, str(tmp_path))
    assert "split(" not in scored._jdf.queryExecution().optimizedPlan().toString()  # reads the written ids
    assert {r.doc_id: r.tokens for r in scored.collect()} == {1: 8, None: 3, 2: 1}
