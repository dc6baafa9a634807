from collections import Counter

import pytest
from pyspark.sql import functions as F

from parlance.functions import text as tx
from parlance.operators import batching, nextword, pairs, vocabulary
from parlance.plans.training_data import prepare_texts

TEXTS = ["The cat the dog", "  a\tcat\nsat ", "", "dog dog dog bird\x1cend", None, "ÉTÉ été"]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string").repartition(3)


def test_words_split_like_python(spark, texts):
    got = {r["id"]: r["w"] for r in texts.select("id", tx.words(F.col("text")).alias("w")).collect()}
    assert got == {i: (None if t is None else t.lower().split()) for i, t in enumerate(TEXTS)}


def test_vocabulary_order(spark, texts):
    counts = Counter(w for t in TEXTS if t for w in t.lower().split())
    want = ["<PAD>", "<UNK>", "<BOS>", "<EOS>"] + [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))]
    vocab = vocabulary.build_vocab(texts, "text")
    assert [r["token"] for r in vocab.orderBy("id").collect()] == want
    assert [r["id"] for r in vocab.orderBy("id").collect()] == list(range(len(want)))
    small = vocabulary.build_vocab(texts, "text", size=6)
    assert [r["token"] for r in small.orderBy("id").collect()] == want[:6]


def test_separator_is_added_once(spark, texts):
    vocab = vocabulary.build_vocab(texts, "text")
    once = vocabulary.with_separator(vocab)
    assert once.count() == vocab.count() + 1
    assert once.where("token = '<SEP>'").collect()[0]["id"] == vocab.count()
    assert vocabulary.with_separator(once).count() == once.count()


def test_encode_decode(spark, texts):
    vocab = vocabulary.build_vocab(texts, "text", size=7)
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    encoded = vocabulary.encode(texts, "id", "text", vocab)
    got = {r["id"]: r["ids"] for r in encoded.collect()}
    want = {i: [2] + [ids.get(w, 1) for w in t.lower().split()] + [3] for i, t in enumerate(TEXTS) if t is not None}
    assert got == want
    decoded = {r["id"]: r["text"] for r in vocabulary.decode(encoded, "id", "ids", vocab).collect()}
    tokens = {n: t for t, n in ids.items()}
    assert decoded == {i: " ".join(tokens[n] for n in s if n not in (0, 2, 3)) for i, s in want.items()}


def test_two_truncations(spark):
    long = spark.createDataFrame([(0, " ".join(["w"] * 300))], "id long, text string")
    vocab = vocabulary.build_vocab(long, "text")
    cut = vocabulary.encode(long, "id", "text", vocab).collect()[0]["ids"]
    kept = vocabulary.encode(long, "id", "text", vocab, keep_eos=True).collect()[0]["ids"]
    whole = vocabulary.encode(long, "id", "text", vocab, max_length=None).collect()[0]["ids"]
    assert (len(cut), cut[-1], len(kept), kept[-1], len(whole)) == (256, 4, 256, 3, 302)


def test_unknown_id_decodes_to_unk(spark, texts):
    vocab = vocabulary.build_vocab(texts, "text")
    df = spark.createDataFrame([(0, [2, 999, 4, 3, 0])], "id long, ids array<int>")
    first = vocab.where("id = 4").collect()[0]["token"]
    assert vocabulary.decode(df, "id", "ids", vocab).collect()[0]["text"] == f"<UNK> {first}"


def test_next_token_pairs(spark, rows):
    df = spark.createDataFrame([(0, [2, 7, 8, 3]), (1, [2])], "id long, ids array<int>")
    assert rows(batching.next_token_pairs(df)) == [(0, [2, 7, 8], [7, 8, 3])]


@pytest.mark.parametrize("partitions", [1, 16])
def test_batches(spark, partitions):
    df = spark.range(103).select(
        "id", F.array_repeat(F.lit(9), (F.col("id") % 7 + 1).cast("int")).alias("input_ids")
    ).withColumn("target_ids", F.col("input_ids")).repartition(partitions)
    got = batching.pad_response_batches(df, "id").collect()
    assert len(got) == 103
    by_batch = {}
    for r in got:
        by_batch.setdefault(r["batch_id"], []).append(r)
    assert sorted(len(b) for b in by_batch.values()) == [7] + [16] * 6
    for batch in by_batch.values():
        longest = max(r["id"] % 7 + 1 for r in batch)
        for r in batch:
            n = r["id"] % 7 + 1
            assert r["input_ids"] == [9] * n + [0] * (longest - n)
            assert r["target_ids"] == [9] * n + [-100] * (longest - n)
    cheap = batching.pad_response_batches(df, "id", keys=spark.range(103)).collect()
    assert sorted(map(repr, cheap)) == sorted(map(repr, got))
    with pytest.raises(Exception, match="keys holds other rows"):
        batching.pad_response_batches(df, "id", keys=spark.range(400).select((F.col("id") % 103).alias("id"))).collect()
    ordered = batching.pad_batches(df, "id", {"input_ids": 0}, 10, order=[("id", True)]).collect()
    assert all(r["batch_id"] == r["id"] // 10 for r in ordered)


def test_masked_sequences(spark):
    df = spark.createDataFrame([(0, "a b", "c d"), (1, "a", "zzz"), (2, " ".join(["a"] * 300), "c")], "id long, x string, y string")
    vocab = vocabulary.with_separator(vocabulary.build_vocab(df.where("id = 0").selectExpr("x || ' ' || y as t"), "t"))
    ids = {r["token"]: r["id"] for r in vocab.collect()}
    got = {r["id"]: r for r in pairs.sft_sequences(df, "id", "x", "y", vocab).collect()}
    a, b, c, d, sep = (ids[t] for t in ("a", "b", "c", "d", "<SEP>"))
    assert got[0]["input_ids"] == [2, a, b, sep, c, d, 3]
    assert got[0]["target_ids"] == [-100] * 4 + [c, d, 3]
    assert got[1]["input_ids"] == [2, a, sep, 1, 3]
    assert got[2]["input_ids"] == [2] + [a] * 255 and got[2]["target_ids"] == [-100] * 256
    shifted = {r["id"]: r for r in pairs.sft_sequences(df, "id", "x", "y", vocab, shift=True).collect()}
    assert shifted[0]["input_ids"] == [2, a, b, sep, c, d] and shifted[0]["target_ids"] == [-100] * 3 + [c, d, 3]


def test_two_decimals_like_printf(spark):
    values = [i / 1000 for i in range(0, 1001)] + [i / 10000 for i in range(0, 10000, 7)] + [0.125, 0.165, 0.145, 0.995]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(tx.two_decimals(F.col("x"))).collect()]
    assert got == [f"{v:.2f}" for v in values]


def test_response_extraction_and_preview(spark):
    df = spark.createDataFrame([("Category: A", "category: a  the reply \n")], "c string, g string")
    got = df.select(tx.extract_response(F.col("g"), F.col("c")), tx.preview(F.col("c"), 4)).first()
    assert tuple(got) == ("the reply", "Cate...")


def test_next_word_statistics(spark):
    sequences = {0: [2, 4, 5, 4, 5, 3], 1: [2, 4, 4, 3], 2: [2, 6, 3]}
    df = spark.createDataFrame(list(sequences.items()), "id long, ids array<int>")
    train, size, k = df.where("id < 2"), 7, 0.1
    pairs_ = Counter((a, b) for i in (0, 1) for a, b in zip(sequences[i], sequences[i][1:]))
    prev = Counter()
    for (a, _), n in pairs_.items():
        prev[a] += n
    prob = lambda a, b: (pairs_[(a, b)] + k) / (prev[a] + k * size)
    model = nextword.bigram_model(train, size, k)
    assert {(r["prev"], r["next"]): r["probability"] for r in model.collect()} == {
        p: pytest.approx(prob(*p)) for p in pairs_
    }
    import math

    nll = {i: sum(-math.log(prob(a, b)) for a, b in zip(s, s[1:])) / (len(s) - 1) for i, s in sequences.items()}
    got = {r["id"]: r["nll"] for r in nextword.sequence_perplexity(df, "id", model, size, k).collect()}
    assert got == {i: pytest.approx(x) for i, x in nll.items()}
    total = sum(nll[i] * (len(s) - 1) for i, s in sequences.items()) / sum(len(s) - 1 for s in sequences.values())
    assert nextword.corpus_perplexity(df, model, size, k).collect()[0]["nll"] == pytest.approx(total)
    top = {(r["prev"], r["rank"]): r["next"] for r in nextword.next_token_topk(model, 1).collect()}
    assert top[(2, 1)] == 4 and top[(4, 1)] == 5 and top[(5, 1)] == 3


def test_prepared_texts(spark):
    df = spark.range(50).select("id", F.concat(F.lit("word"), (F.col("id") % 5).cast("string")).alias("text"))
    prepared = prepare_texts(df, "id", "text")
    counts = {r["split"]: r["count"] for r in prepared.examples.groupBy("split").count().collect()}
    assert counts == {"train": 40, "val": 10}
    assert prepared.vocab.agg(F.sum("count")).collect()[0][0] == 40


def test_encoding_is_one_narrow_projection(spark, texts):
    from parlance.session import freeze

    vocab = freeze(vocabulary.build_vocab(texts, "text"))
    flat = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = vocabulary.encode(flat, "doc_id", "text", vocab)._jdf.queryExecution().optimizedPlan().toString()
    main = plan.split("Subquery")[0]
    assert "_lookup" not in main and "Exchange" not in main
    sequences = pairs.sft_sequences(
        flat.withColumn("r", F.col("source")), "doc_id", "text", "r", vocabulary.with_separator(vocab)
    )
    assert "AS _lookup" not in sequences._jdf.queryExecution().optimizedPlan().toString()
