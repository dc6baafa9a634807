"""Inputs that the given tables do not hold: NULL groups, missing scores, gaps in turns, wide integers, time zones."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

import checks.catalog  # noqa: F401
from checks import awkward
from parlance.functions.arithmetic import clip
from parlance.functions.hashing import row_fingerprint
from parlance.operators import cleaning, largevocab, pairs, ranking, rebalance, sequences, trainlog, vocabulary

NAN = float("nan")


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(None, 1, 5.0), (None, 2, 7.0), ("a", 1, 1.0), ("a", 2, 2.0)], "g string, t int, x double")
    numbered = ranking.number_turns(df, "g", ["t"]).collect()
    assert sorted((r.g or "", r.t, r.turn) for r in numbered) == [("", 1, 0), ("", 2, 1), ("a", 1, 0), ("a", 2, 1)]
    for options in ({"chunk": 2}, {"chunk": 1}, {"max_turns": 9}):
        best = sequences.best_before(df, "g", "t", "x", "b", **options).collect()
        assert sorted((r.g or "", r.t, r.b) for r in best if r.t == 2) == [("", 2, 5.0), ("a", 2, 1.0)] and len(best) == 4
        before = sequences.previous_value(df, "g", "t", "x", -1.0, "p", **options).collect()
        assert sorted((r.g or "", r.t, r.p) for r in before) == [("", 1, -1.0), ("", 2, 5.0), ("a", 1, -1.0), ("a", 2, 1.0)]
    returns = sequences.discounted_returns(df, "g", "t", "x", 1.0, chunk=2).collect()
    assert sorted((r.g or "", r.discounted_return) for r in returns) == [("", 7.0), ("", 12.0), ("a", 2.0), ("a", 3.0)]


@pytest.mark.parametrize("options", [{"chunk": 4}, {"chunk": 1}, {"max_turns": 10}, {}])
def test_previous_value_over_gaps(spark, options):
    df = spark.createDataFrame([(1, t, float(t)) for t in (0, 1, 2, 4, 5, 9)], "g int, t int, x double")
    got = {r.t: r.p for r in sequences.previous_value(df, "g", "t", "x", -1.0, "p", **options).collect()}
    assert got == {0: -1.0, 1: 0.0, 2: 1.0, 4: 2.0, 5: 4.0, 9: 5.0}


@pytest.mark.parametrize("gamma, options", [(1.0, {}), (1.0, {"chunk": 8}), (0.9, {"chunk": 3}), (0.99, {}), (0.999, {"chunk": 5}), (0.5, {"chunk": 1})])
def test_returns_over_gaps(spark, gamma, options):
    turns = [0, 1, 7, 20, 21, 300, 140_000]
    df = spark.createDataFrame([(1, t, float(i + 1)) for i, t in enumerate(turns)], "g int, t int, x double")
    got = {r.t: r.discounted_return for r in sequences.discounted_returns(df, "g", "t", "x", gamma, **options).collect()}
    for t in turns:
        want = sum((i + 1) * gamma ** (u - t) for i, u in enumerate(turns) if u >= t)
        assert got[t] == pytest.approx(want, rel=1e-9)


def test_a_long_group_takes_linear_time(spark):
    df = spark.range(100_000).select(F.lit(1).alias("g"), F.col("id").alias("t"), F.lit(1.0).alias("x"))
    got = sequences.discounted_returns(df, "g", "t", "x", 1.0).agg(F.max("discounted_return"), F.min("discounted_return")).first()
    assert tuple(got) == (100_000.0, 1.0)


def test_max_turns_beyond_a_chunk_is_enforced(spark):
    df = spark.createDataFrame([(1, 500_000, 1.0)], "g int, t int, x double")
    with pytest.raises(Exception, match="turn outside"):
        sequences.discounted_returns(df, "g", "t", "x", 0.99, max_turns=100_000).collect()


def test_missing_scores_come_last(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 4.0), (3, None), (4, 3.0), (5, NAN)], "id int, quality_score double")
    for n in range(7):
        got = {r.id for r in pairs.top_n_label(df, "id", n=n).where("is_good").collect()}
        assert got == set([1, 2, 4, 3, 5][:n])
    halves = spark.createDataFrame([(i, None if i % 2 else float(i)) for i in range(10)], "id int, x double")
    split = ranking.ordered_split(halves, [("x", True), ("id", True)]).collect()
    assert sorted(r.id for r in split if r.split == "val") == [7, 9]


def test_nan_is_no_score(spark):
    df = spark.createDataFrame([(1, NAN, 0.0), (2, 4.5, 1.0), (3, 1.0, 1.0)], "epoch int, accuracy double, label double")
    assert [r[0] for r in df.select(pairs.score_band(F.col("accuracy"))).collect()] == [None, "good", "bad"]
    assert math.isnan(df.select(clip(F.col("accuracy"), 0.0, 2.0)).first()[0])
    assert [r.epoch for r in trainlog.best_checkpoints(df).orderBy("epoch").collect()] == [2]
    assert trainlog.preference_accuracy(df, score="accuracy").first()["accuracy"] == 1.0


def test_gapped_log_keeps_every_event(spark):
    views = awkward.Views(spark, "/root/testdata/sf0.001")
    assert "trailing_loss_gaps_whole" in awkward.SQL
    log = awkward._gapped_log(views)
    n, least, most = log.agg(F.countDistinct("batch"), F.min("batch"), F.max("batch")).first()
    assert n == log.count() == views.table("events").count() and n < 0.8 * (most - least)


def test_trailing_loss_counts_logged_rows(spark):
    rows = [(0, b, float(b)) for b in list(range(1, 20)) + [21, 40]] + [(None, b, 1.0) for b in range(1, 41)]
    df = spark.createDataFrame(rows, "epoch int, batch int, loss double")
    got = {(r.epoch, r.batch): r.avg_loss for r in trainlog.trailing_loss(df).collect()}
    assert got == {(0, 40): pytest.approx((sum(range(2, 20)) + 61) / 20), (None, 20): 1.0, (None, 40): 1.0}


def test_wide_integers_survive_imputing(spark):
    df = spark.createDataFrame([(9007199254740993, 1.0), (9007199254740992, None)], "id bigint, x double")
    got = cleaning.impute_missing(df)
    assert got.schema["id"].dataType.simpleString() == "bigint"
    assert sorted(r.id for r in got.collect()) == [9007199254740992, 9007199254740993]


def test_fingerprints_do_not_depend_on_the_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame([(1699160400,), (1699164000,)], "s bigint").select(
            F.timestamp_seconds("s").alias("t"), F.array(F.timestamp_seconds("s")).alias("a"))
        assert df.select(row_fingerprint(df, ["t"])).distinct().count() == 2
        assert df.select(row_fingerprint(df, ["a"])).distinct().count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("head", [2, 5, 40, 10_000])
def test_a_vocabulary_beyond_the_limit_is_joined(spark, monkeypatch, head):
    words = [f"w{i}" for i in range(60)]
    texts = [None, "", "w1 w1 nowhere w59", " ".join(words * 3), "nowhere", "w40 w41\tw40"] + [f"w{i} x{i} w{i % 7}" for i in range(80)]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "id int, text string, key string").repartition(3)
    vocab = vocabulary.with_separator(vocabulary.build_vocab(df, "text", 64))
    small = {r.id: r.ids for r in vocabulary.encode(df, "id", "text", vocab, max_length=None, keep=("key",)).collect()}
    pairs_small = sorted(map(str, pairs.sft_sequences(df, "id", "text", "text", vocab).collect()))
    texts_small = sorted(map(str, vocabulary.decode(vocabulary.encode(df, "id", "text", vocab), "id", "ids", vocab).collect()))
    monkeypatch.setattr(vocabulary, "MAX_LOOKUP", 10)
    monkeypatch.setattr(vocabulary, "HEAD", head)
    assert sorted(map(tuple, vocabulary.build_vocab(df, "text", 64).collect())) == sorted(map(tuple, vocab.where("token != '<SEP>'").collect()))
    assert {r.id: r.ids for r in vocabulary.encode(df, "id", "text", vocab, max_length=None, keep=("key",)).collect()} == small
    assert sorted(map(str, pairs.sft_sequences(df, "id", "text", "text", vocab).collect())) == pairs_small
    encoded = vocabulary.encode(df, "id", "text", vocab)
    assert sorted(map(str, vocabulary.decode(encoded, "id", "ids", vocab).collect())) == texts_small
    beyond = spark.createDataFrame([(1, [4, 999_999, 0, 3, 1, None])], "id int, ids array<int>")
    assert vocabulary.decode(beyond, "id", "ids", vocab).first().text.split(" ")[1:] == ["<UNK>"] * 2


@pytest.mark.parametrize("large", [0, 64, 8_000_000])
def test_a_vocabulary_whose_hashes_travel(spark, monkeypatch, large):
    texts = [None, "", "w1 w1 nowhere w59", "W3 é\u00a0日本 w3", "nowhere"] + [f"w{i} x{i} w{i % 7} a{i % 2}" for i in range(80)]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate([*texts, *texts[-5:]])], "id int, text string, key string").repartition(3)
    counts = Counter(w for r in df.collect() if r.text for w in r.text.lower().split())
    top = sorted(counts, key=lambda w: (-counts[w], w))
    monkeypatch.setattr(vocabulary, "MAX_LOOKUP", 10)
    monkeypatch.setattr(vocabulary, "HEAD", 20)
    monkeypatch.setattr(largevocab, "LARGE", large)
    monkeypatch.setattr(largevocab, "CHUNK", 50)
    monkeypatch.setattr(largevocab, "SPARE", 10)
    for n in (30, 60, 1000):  # ties at the end, words that occur once, more than there are
        vocab = vocabulary.build_vocab(df, "text", n)
        assert vocab._frozen == (n <= large)  # found by hashes
        ids = {w: i for i, w in enumerate([*vocabulary.SPECIAL_TOKENS, *top][:n])}
        assert {r.token: r.id for r in vocab.collect()} == ids and {r.token: r["count"] for r in vocab.where("id > 3").collect()} == {w: counts[w] for w in [*ids][4:]}
        encoded = vocabulary.encode(df, "id", "text", vocab, max_length=None, keep=("key",))
        want = sorted((r.id, "k", [2, *[ids.get(w, 1) for w in r.text.lower().split()], 3]) for r in df.collect() if r.text is not None)
        assert sorted(map(tuple, encoded.collect())) == want
        monkeypatch.setattr(largevocab, "GROUP", n)
        decoded = sorted(map(tuple, vocabulary.decode(encoded, "id", "ids", vocab).collect()))
        assert decoded == sorted((i, " ".join([*ids][w] if w != 1 else "<UNK>" for w in ws[1:-1])) for i, _, ws in want)
    beyond = spark.createDataFrame([(1, [4, 999_999, -5, 0, 3, 1, None]), (2, None), (3, [])], "id int, ids array<int>")
    assert [r.text for r in vocabulary.decode(beyond, "id", "ids", vocab).orderBy("id").collect()] == [f"{top[0]} <UNK> <UNK> <UNK>", None, ""]


def test_no_word_is_shuffled_with_a_large_vocabulary(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"w{i} x{i} w{i % 7}") for i in range(80)], "id int, text string")
    monkeypatch.setattr(vocabulary, "MAX_LOOKUP", 10)
    vocab = vocabulary.build_vocab(df, "text", 64)
    encoded = vocabulary.encode(df, "id", "text", vocab)
    for found in (encoded, vocabulary.decode(encoded, "id", "ids", vocab)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Generate" not in plan and "Aggregate" not in plan


def test_words_that_share_a_hash(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a b b c"), (2, "c c d e e e e")], "id int, text string")
    monkeypatch.setattr(vocabulary, "MAX_LOOKUP", 1)
    names = largevocab._names
    few = lambda ws, seed: F.transform(names(ws, seed), lambda h: h.bitwiseAND(F.lit(3 << 61)))
    monkeypatch.setattr(largevocab, "_names", few)  # four names for five words: none of the hashes will do
    assert largevocab.top_words(df, "text", 5) is None
    want = [(4, "e", 4), (5, "c", 3), (6, "b", 2), (7, "a", 1), (8, "d", 1)]
    assert sorted(map(tuple, vocabulary.build_vocab(df, "text", 9).where("id > 3").collect())) == want
    monkeypatch.setattr(largevocab, "_names", lambda ws, seed: few(ws, seed) if seed == 0 else names(ws, seed))
    assert [r.token for r in largevocab.top_words(df, "text", 5).orderBy("rank").collect()] == ["e", "c", "b", "a", "d"]


def test_rebalancing(spark):
    rows = [(i, "big") for i in range(600)] + [(1000 + i, "small") for i in range(45)] + [(2000 + i, None) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, label string")
    weights = {r.label: (r.n, r.weight) for r in rebalance.class_weights(df, "label").collect()}
    assert weights["small"] == (45, pytest.approx(845 / (3 * 45))) and weights[None][0] == 200
    for target, want in ((None, 600), (100, 100)):
        counts = {r.label: r["count"] for r in rebalance.oversample(df, "id", "label", target).groupBy("label").count().collect()}
        assert counts["big"] == 600 and abs(counts["small"] - want) <= 30 and counts[None] == max(200, want)
    reference = spark.createDataFrame([("small",)] * 10 + [(None,)] * 30 + [("other",)], "label string")
    counts = {r.label: r["count"] for r in rebalance.stratified_match(df, reference, "id", "label").groupBy("label").count().collect()}
    assert set(counts) == {"small", None} and counts[None] == pytest.approx(135, abs=35) and counts["small"] == 45
    assert rebalance.oversample(df.where("false"), "id", "label").count() == 0


def test_one_row_against_many(spark, monkeypatch):
    df = spark.createDataFrame([(1, "rare"), (2, "many"), (3, "many")], "id int, label string")
    copies = rebalance.oversample(df, "id", "label", 3_000_000)
    found = {r.id: (r.n, r.first, r.last, r.other) for r in copies.groupBy("id").agg(
        F.count("*").alias("n"), F.min("copy").alias("first"), F.max("copy").alias("last"), F.countDistinct("copy").alias("other")).collect()}
    assert found == {1: (3_000_000, 0, 2_999_999, 3_000_000), 2: (1_500_000, 0, 1_499_999, 1_500_000), 3: (1_500_000, 0, 1_499_999, 1_500_000)}
    assert copies.schema["copy"].dataType.simpleString() == "bigint"
    monkeypatch.setattr(rebalance, "RUN", 7)
    small = rebalance.oversample(df, "id", "label", 100).groupBy("id").agg(F.sort_array(F.collect_list("copy")).alias("c")).collect()
    assert {r.id: r.c for r in small} == {1: list(range(100)), 2: list(range(50)), 3: list(range(50))}


@pytest.mark.parametrize("largest", [3, 1 << 20])
def test_turns_of_repeated_keys(spark, largest):
    rows = [(g, t) for g in (None, 1, 2) for t in [0, 0, 0, 5, 7, None, None, *range(20, 300 if g == 1 else 24)]]
    df = spark.createDataFrame([(g, t, i) for i, (g, t) in enumerate(rows)], "g int, t int, id int").repartition(6)
    got = ranking.number_turns(df, "g", ["t"], largest=largest)
    assert got.schema["turn"].dataType.simpleString() == "bigint"
    for g in (None, 1, 2):
        own = sorted((r for r in got.collect() if r.g == g), key=lambda r: r.turn)
        assert [r.turn for r in own] == list(range(len(own))) and len(own) == sum(x == g for x, _ in rows)
        assert [r.t for r in own] == sorted((t for x, t in rows if x == g), key=lambda t: (t is not None, t or 0))
