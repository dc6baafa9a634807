import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.operators import pairs, scorer, trainlog, trajectory
from parlance.sources import conversations as conv


@pytest.fixture(scope="module")
def sft(spark):
    return pairs.sft_pairs(conv.generate_range(spark, 3000), "id").cache()


def test_pairs_follow_the_rules(spark, sft):
    for r in sft.limit(200).collect():
        sentiment = r["context"].split("Sentiment: ")[1].split(",")[0]
        category = r["context"].split("Category: ")[1].split(",")[0]
        assert any(p in r["response"] for p in pairs.PRODUCTS[category])
        starts = [t.split("{")[0] for t in pairs.RESPONSE_TEMPLATES[sentiment]]
        assert any(r["response"].startswith(s) for s in starts)
        assert 2.0 <= r["quality_score"] <= 5.0 and "{" not in r["response"]
    mean = sft.where(F.contains("context", F.lit("Sentiment: neutral"))).agg(F.avg("quality_score")).first()[0]
    assert mean == pytest.approx(3.5, abs=0.03)
    assert sft.count() == 3000 and pairs.sft_pairs(conv.generate_range(spark, 50), "id", n_pairs=7).count() == 7


def test_unknown_keys(spark):
    df = spark.createDataFrame([(1, "Toys", "neutral"), (2, "Home", "odd")], "id long, product_category string, sentiment string")
    df = df.withColumns({"outcome": F.lit("o"), "conversation_text": F.lit("m")})
    got = {r["id"]: r["response"] for r in pairs.sft_pairs(df, "id").collect()}
    assert got[1] is None
    assert any(got[2].startswith(t.split("{")[0]) for t in pairs.RESPONSE_TEMPLATES["neutral"])


def test_top_n(spark, sft):
    data = [(r["id"], r["quality_score"]) for r in sft.collect()]
    want = {i for i, _ in sorted(data, key=lambda x: (-x[1], x[0]))[:500]}
    good = lambda df: {r["id"] for r in df.where("is_good").collect()}
    assert good(pairs.top_n_label(sft, "id")) == want
    assert pairs.top_n_label(sft, "id", n=5000).where("is_good").count() == 3000
    assert pairs.top_n_label(sft, "id", n=0).where("is_good").count() == 0
    averages = {r["label"]: (r["n"], r["avg_score"]) for r in pairs.label_averages(pairs.top_n_label(sft, "id")).collect()}
    scores = dict(data)
    assert averages["good"] == (500, pytest.approx(np.mean([scores[i] for i in want])))
    assert averages["all"] == (3000, pytest.approx(np.mean(list(scores.values()))))


def test_band_edges(spark):
    df = spark.createDataFrame([(4.0,), (3.5,), (3.49,), (3.99,)], "s double")
    assert [r[0] for r in df.select(pairs.score_band(F.col("s"))).collect()] == ["good", None, "bad", None]


def test_preferences(spark):
    data = [(1, "x", "g1", 4.5), (2, "x", "b1", 3.0), (3, "x", "m", 3.7), (4, "y", "g2", 4.0), (5, "z", "b2", 1.0), (6, "x", "g3", 4.1)]
    df = spark.createDataFrame(data, "id long, context string, response string, quality_score double")
    got = pairs.preference_pairs(df, "id").collect()
    assert len(got) == 1 and got[0]["context"] == "x" and got[0]["bad_response"] == "b1"
    assert got[0]["good_response"] in ("g1", "g3") and got[0]["good_score"] in (4.5, 4.1)
    assert [r[0] for r in pairs.contexts_with_both(df).collect()] == ["x"]
    assert [tuple(r) for r in pairs.first_contexts(df, "id", n=2).collect()] == [("x", 1), ("y", 4)]
    assert pairs.preference_pairs(df.where("id > 3"), "id").count() == 0
    assert pairs.preference_pairs(df, "id", n_contexts=1).count() == 1
    examples = pairs.preference_examples(pairs.preference_pairs(df, "id")).collect()
    assert {r["label"]: r["text"].split()[0] for r in examples} == {1.0: "x", 0.0: "x"}


STEP = "episode long, turn int, customer_segment string, product_category string, satisfaction double, mentioned_issue boolean, asked_about_price boolean, action int, purchased boolean, escalated boolean, satisfaction_after double"


def step(episode=0, turn=0, segment="new", category="Home", before=0.5, issue=False, price=False, action=2,
         bought=False, escalated=False, after=0.6):
    return (episode, turn, segment, category, before, issue, price, action, bought, escalated, after)


@pytest.mark.parametrize("values,delta,sells", [
    (dict(action=0, price=True), 0.2, 0.8), (dict(action=0), 0.05, 0.8),
    (dict(action=1, segment="vip", issue=True), 0.25, 0.7), (dict(action=1, issue=True), 0.2, 0.5), (dict(action=1), 0.1, 0.5),
    (dict(action=2), 0.1, 0), (dict(action=3, issue=True), 0.3, 0), (dict(action=3), 0.15, 0),
    (dict(action=4, issue=True), 0.4, 0), (dict(action=4), 0.25, 0),
    (dict(action=5, before=0.39), 0.1, 0), (dict(action=5, before=0.4), -0.1, 0),
])
def test_step_rules(spark, values, delta, sells):
    df = spark.createDataFrame([step(**values)], STEP)
    got = df.select(trajectory.satisfaction_delta(), trajectory.purchase_probability(F.lit(1.0))).first()
    assert tuple(got) == (delta, sells)


def test_rewards_and_terminal_steps(spark):
    df = spark.createDataFrame([step(bought=True, after=0.95), step(escalated=True, after=0.4), step(after=0.1), step(turn=9)], STEP)
    reward = trajectory.step_reward(*[F.col(c) for c in ("satisfaction", "satisfaction_after", "purchased", "escalated")])
    ends = trajectory.is_terminal(F.col("turn") + 1, F.col("purchased"), F.col("escalated"), F.col("satisfaction_after"))
    got = df.select(reward, ends).collect()
    assert [r[0] for r in got] == pytest.approx([0.575, -0.2, -0.2, 0.05])
    assert all(r[1] for r in got)
    assert spark.createDataFrame([step(turn=8)], STEP).select(ends).first()[0] is False
    names = spark.createDataFrame([(3,), (6,), (-1,)], "a int").select(trajectory.action_name(F.col("a"))).collect()
    assert [r[0] for r in names] == ["offer_10%_discount", None, None]


def test_policy_metrics_on_a_hand_made_log(spark):
    data = [(0, 0, 0.5, False, False), (0, 1, 0.5, True, False), (1, 0, -0.2, False, True), (2, 0, 0.0, False, False)]
    df = spark.createDataFrame(data, "episode long, turn int, reward double, purchased boolean, escalated boolean")
    got = trajectory.policy_metrics(df).collect()[0]
    totals = [1.0, -0.2, 0.0]
    assert (got["avg_reward"], got["std_reward"]) == (pytest.approx(np.mean(totals)), pytest.approx(np.std(totals)))
    assert [got[c] for c in ("purchase_rate", "escalation_rate", "avg_turns")] == pytest.approx([1 / 3, 1 / 3, 4 / 3])
    first = trajectory.first_step_evaluation(df).collect()[0]
    assert [first[c] for c in ("avg_reward", "purchase_rate", "escalation_rate")] == pytest.approx([0.1, 0.0, 1 / 3])


@pytest.mark.parametrize("options", [{}, {"max_turns": 10}])
def test_steps_after_the_end_are_dropped(spark, options):
    data = [(0, t, t in (2, 4)) for t in range(6)] + [(1, t, False) for t in range(3)]
    df = spark.createDataFrame(data, "episode long, turn int, e boolean").repartition(4)
    got = trajectory.until_terminal(df, F.col("e"), **options)
    assert sorted((r["episode"], r["turn"]) for r in got.collect()) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2)]
    assert got.columns == ["episode", "turn", "e"]


def test_features(spark):
    df = spark.createDataFrame([step(turn=3, segment="vip", category="Electronics", before=0.8), step(segment="new", category="Sports", issue=True, price=True, before=0.3, turn=1)], STEP)
    got = [r[0] for r in df.select(trajectory.state_features()).collect()]
    assert got[0] == [0.8, 1, 0, 1, 0, 0, 0, 0, 0, 0.3]
    assert got[1] == [0.3, 0, 0, 0, 0, 0, 1, 1, 1, 0.1]
    assert df.select(F.size(trajectory.state_features())).first()[0] == len(trajectory.FEATURES)


@pytest.mark.parametrize("deficient", [False, True])
def test_least_squares(spark, deficient):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=400), np.ones(400), rng.normal(size=400)])
    if deficient:
        x = np.column_stack([x, x[:, 0] + x[:, 2]])
    y = x[:, 0] * 2 + 3 - x[:, 2] + (rng.normal(size=400) * 0.1 if deficient else 0)
    df = spark.createDataFrame([(list(map(float, a)), float(b)) for a, b in zip(x, y)], "features array<double>, g double").repartition(5)
    names = [f"f{i}" for i in range(x.shape[1])]
    weights = {r["feature"]: r["weight"] for r in trajectory.fit_value_weights(df, names, target="g").collect()}
    want = np.linalg.lstsq(x, y, rcond=None)[0]
    assert [weights[n] for n in names] == pytest.approx(want, abs=1e-8)
    if not deficient:
        assert want == pytest.approx([2, 3, -1])
    fit = trajectory.fit_quality(df, trajectory.value_score([float(w) for w in want]), "g").collect()[0]
    residual = x @ want - y
    assert fit["mse"] == pytest.approx(np.mean(residual**2), abs=1e-12)
    assert fit["r2"] == pytest.approx(1 - np.sum(residual**2) / np.sum((y - y.mean()) ** 2))


def test_losses(spark, rows):
    log = spark.createDataFrame([(0, "t", 1.0), (0, "t", 3.0), (1, "t", 4.0)], "epoch int, split string, loss double")
    got = {r["epoch"]: r for r in trainlog.loss_perplexity(log, ["epoch"]).collect()}
    assert got[0]["perplexity"] == pytest.approx(math.exp(2)) and got[0]["target_met"] and not got[1]["target_met"]
    tokens = spark.createDataFrame([(0, 5, 1.0), (0, 0, 9.0), (0, 6, 2.0), (1, 0, 3.0)], "b int, target int, nll double")
    assert rows(trainlog.masked_token_loss(tokens, ["b"])) == [(0, 2, 1.5), (1, 0, None)]
    assert rows(trainlog.masked_token_loss(tokens.replace(0, -100, "target"), ["b"], ignore=-100)) == [(0, 2, 1.5), (1, 0, None)]
    batches = spark.createDataFrame([(0, b, float(b)) for b in range(1, 48)], "epoch int, batch int, loss double")
    got = rows(trainlog.trailing_loss(batches))
    assert got == [(0, 20, pytest.approx(10.5)), (0, 40, pytest.approx(30.5))]


def test_checkpoints(spark):
    history = list(enumerate([0.0, 0.6, 0.6, 0.5, 0.7, 0.9, 0.85]))
    df = spark.createDataFrame(history, "epoch int, accuracy double")
    got = trainlog.best_checkpoints(df).orderBy("epoch").collect()
    assert [(r["epoch"], r["target_met"]) for r in got] == [(1, False), (4, False), (5, True)]


def test_preference_scores_and_ppo(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 0.0), (2.0, 1.0), (-800.0, 0.0), (800.0, 0.0)], "score double, label double")
    assert trainlog.preference_accuracy(df).collect()[0]["accuracy"] == pytest.approx(0.6)
    want = np.mean([math.log(2), math.log(2), math.log1p(math.exp(-2)), 0, 800])
    assert trainlog.preference_bce(df).collect()[0]["bce"] == pytest.approx(want)
    steps = spark.createDataFrame([(0.0, 0.5, 1.0), (0.0, -1.0, -2.0)], "old_logp double, new_logp double, advantage double")
    assert trainlog.ppo_objective(steps).collect()[0]["ppo_loss"] == pytest.approx(0.2)
    reward = spark.range(1).select(trajectory.combined_reward(F.lit(0.3), F.lit(0.1)), trajectory.advantage(F.lit(0.3), F.lit(0.5)))
    assert list(reward.first()) == pytest.approx([0.35, -0.2])


def test_scorer_separates_clear_cases(spark):
    df = spark.range(400).select(
        "id", (F.col("id") % 2).cast("double").alias("label"),
        F.concat(F.when(F.col("id") % 2 == 1, F.lit("great fine ")).otherwise(F.lit("bad poor ")), F.lit("x"), F.col("id").cast("string")).alias("text"),
    )
    scored = scorer.preference_scores(df.where("id < 300"), df.where("id >= 300"), dimensions=1 << 10)
    assert scored.count() == 100
    assert trainlog.preference_accuracy(scored).collect()[0]["accuracy"] >= trainlog.ACCURACY_TARGET


def test_scorer_keeps_missing_texts(spark):
    df = spark.createDataFrame([("good", 1.0), ("bad", 0.0), (None, 1.0), (None, 0.0)], "text string, label double")
    assert scorer.preference_scores(df, df, dimensions=16).count() == 4


def test_scorer_is_the_minimum_of_its_objective(spark):
    import numpy as np

    from parlance.operators import scorer

    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3))
    y = (rng.random(300) < 1 / (1 + np.exp(-(0.4 + x @ [1.0, -2.0, 0.3])))).astype(float)
    names = ["a", "b", "c"]
    df = spark.createDataFrame([(float(t), *map(float, r)) for t, r in zip(y, x)], "label double, a double, b double, c double")
    w = np.zeros(4)
    rows = np.column_stack((np.ones(300), x))
    penalty = np.diag([0.0, 0.01, 0.01, 0.01])
    for _ in range(30):  # iteratively reweighted least squares
        p = 1 / (1 + np.exp(-rows @ w))
        w -= np.linalg.solve(rows.T @ (rows * (p * (1 - p))[:, None]) / 300 + penalty, rows.T @ (p - y) / 300 + penalty @ w)
    got = {r.feature: r.weight for r in scorer.fit(df, names).collect()}
    assert [got[c] for c in ["bias", *names]] == pytest.approx(w.tolist(), abs=1e-5)
    scored = scorer.fitted_scores(df, df, names).collect()
    assert [r.score for r in scored] == pytest.approx([w[0] + w[1] * r.a + w[2] * r.b + w[3] * r.c for r in scored], abs=1e-4)


@pytest.mark.parametrize("chunk", [1, 3, 20, 1 << 16])
@pytest.mark.parametrize("every", [1, 2, 20])
def test_trailing_loss_over_chunks(spark, chunk, every):
    import random

    rng = random.Random(chunk * 100 + every)
    numbers = sorted(rng.sample(range(-40, 400), 150)) + [1000, 1020, 5000, 5019, 5040]
    rows = [(e, b, rng.choice([None, rng.random()])) for e in (0, None) for b in numbers] + [(0, None, 7.0)]
    df = spark.createDataFrame(rows, "epoch int, batch int, loss double").repartition(4)
    got = {(r.epoch, r.batch): r.avg_loss for r in trainlog.trailing_loss(df, every=every, chunk=chunk).collect()}
    want = {}
    for e in (0, None):
        own = sorted((r for r in rows if r[0] == e), key=lambda r: (r[1] is not None, r[1] or 0))
        for i, (_, b, _) in enumerate(own):
            if b is not None and b % every == 0:
                last = [x for _, _, x in own[max(0, i + 1 - every) : i + 1] if x is not None]
                want[e, b] = sum(last) / len(last) if last else None
    assert got == {k: v if v is None else pytest.approx(v) for k, v in want.items()}


def test_preference_pick_of_repeated_and_missing_keys(spark):
    import hashlib

    rows = [("hot", i, "good" if i % 3 else "bad", f"r{i}") for i in range(300)] + [(None, 5, "good", "x"), (None, 6, "bad", "y"), ("one", 7, "good", "z")]
    rows += [("twin", 9, "good", b) for b in "cab"] + [("twin", 9, "bad", b) for b in "fe"] + [("odd", None, "good", "n"), ("odd", 2, "bad", None)]
    df = spark.createDataFrame(rows, "context string, id int, side string, response string").withColumn("quality_score", F.lit(1.0)).repartition(5)
    got = {r.context: (r.good_response, r.bad_response) for r in pairs.preference_pairs(df, "id", band=F.col("side")).collect()}
    pick = lambda side: min(((hashlib.md5(f"42:pick:{i}".encode()).hexdigest(), i, r) for c, i, s, r in rows if c == "hot" and s == side))[2]
    assert got["hot"] == (pick("good"), pick("bad")) and got[None] == ("x", "y") and got["twin"] == ("a", "e") and "one" not in got
