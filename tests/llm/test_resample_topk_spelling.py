"""Importance resampling, exact top-k search and spelling variants against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parlance.llm import exact_topk, resampling, spelling
from parlance.llm.queries import QUERIES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- resampling


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def plain_resample(docs, target, longest, buckets, min_words, percent):
    def features(text):
        words = plain_words(text)
        return [zlib.crc32(" ".join(words[i : i + k]).encode()) % buckets for k in range(1, longest + 1) for i in range(len(words) - k + 1)]

    s, t = (Counter(b for x in texts for b in features(x)) for texts in ([x for _, x in docs], target))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        own = [gain[b] for b in features(text)]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(plain_words(text))))
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    drawn = len(able) * percent // 100
    ranked = [(*r[:4], k if k <= drawn else None) for k, r in enumerate(able, 1)]
    return sorted(ranked + [(*r[:4], None) for r in rows if r[4] < min_words], key=repr)


def corpus():
    rng = random.Random(4)
    names = ["Ähre", "word", "B2", "ß日", "x", "stop", "THE", "the"]
    lines = [" ".join(rng.choice(names) for _ in range(rng.randint(0, 9))) for _ in range(60)] + ["", "  ", "...", "one\ttwo;three\r"]
    docs = [(i, rng.choice(["\n", "\n\n"]).join(rng.choice(lines) for _ in range(rng.randint(1, 8)))) for i in range(150)]
    hot = "a line that a third of all documents hold"
    docs += [(1000 + i, f"{hot}\n{rng.choice(lines)}") for i in range(80)]
    return docs + [(None, None), (2000, ""), (2001, "\n\n"), (7, docs[7][1]), (7, docs[7][1]), (None, hot), (-5, "long " * 30_000)]


@pytest.mark.parametrize("longest, buckets, percent", [(1, 10_000, 10), (3, 97, 50), (2, 10_000, 100)])
def test_resampling_equals_plain_python(spark, longest, buckets, percent):
    docs, target = corpus(), ["stop the word", None, "", "B2 x x\nx B2 stop"]
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id bigint, text string, rank int, line string").repartition(5)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(table, goal, longest, buckets, 5, percent).collect()
    assert sorted(map(tuple, got), key=repr) == plain_resample(docs, target, longest, buckets, 5, percent)


def test_segments_are_counted_once(spark):
    docs = spark.createDataFrame([(i, "same line\nsame line\nown %d" % i) for i in range(30)], "doc_id bigint, text string")
    found = {(r.occurrences, r.n_words, len(r.buckets)) for r in resampling.segments(docs, F.col("text")).collect()}
    assert found == {(60, 2, 2), (1, 2, 2)} and resampling.segments(docs, F.col("text")).count() == 31


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    some = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    assert resampling.resample(none, some).count() == 0
    assert [tuple(r)[:3] for r in resampling.resample(some, none, min_words=1, percent=100).collect()] == [(1, 3, -693)]  # ln(10003 / 20000)


# ---------------------------------------------------------------- top-k


def plain_top_k(rows, k, is_query):
    usable = [(r, i, [math.floor(256 * x) for x in v]) for r, (i, v) in enumerate(rows)
              if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for r, i, q in usable:
        if is_query(i):
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j is None, j or 0) for other, j, v in usable if other != r)
            out += [(i, rank, None if none else j, -s) for rank, (s, none, j) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def search(spark, rows, k=5, **options):
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id bigint, embedding array<double>, rid int").repartition(4)
    got = exact_topk.exact_top_k(table, F.col("vec_id") % 7 == 0, k, **options).collect()
    assert {r.rank for r in got} <= set(range(1, k + 1))
    return sorted(map(tuple, got), key=repr)


def vectors(n, dims, seed=1, spread=1.0):
    made = np.random.default_rng(seed).normal(0, spread, (n, dims))
    return [(i, v.tolist()) for i, v in enumerate(made / np.linalg.norm(made, axis=1, keepdims=True))]


@pytest.mark.parametrize("k, dims, chunk", [(5, 16, exact_topk.CHUNK), (1, 3, 20), (40, 8, 10)])
def test_search_equals_plain_python(spark, k, dims, chunk):
    rows = vectors(400, dims)
    assert search(spark, rows, k, chunk=chunk) == plain_top_k(rows, k, lambda i: i is not None and i % 7 == 0)


def test_search_over_copies_ties_and_odd_vectors(spark):
    hot, nan = [0.5, -0.25, 0.125, 0.0], float("nan")
    rows = [(i, hot) for i in range(300)] + [(1000 + i, v) for i, v in vectors(60, 4)] + [(2100 + i, [0.0] * 4) for i in range(30)]
    rows += [(7, hot), (7, hot), (None, hot), (None, [4.0, -2.0, 1.0, 0.0]), (700, [0.5]), (707, []), (3000, None), (3003, [nan, 0.0, 0.0, 0.0]), (3010, [None, 1.0, 1.0, 1.0]), (3017, [math.inf, 0.0, 0.0, 0.0])]
    rows += [(5000 + i, [1.0 if i % 2 else -1.0, 0.0, 0.0, 0.0]) for i in range(70)]  # many equal products of different queries
    assert search(spark, rows) == plain_top_k(rows, 5, lambda i: i is not None and i % 7 == 0)


def test_search_with_wide_cells(spark):
    rows = [(i, [1000 * x for x in v]) for i, v in vectors(300, 6, spread=50)] + [(7000, [0.0] * 6)]
    assert search(spark, rows, 3) == plain_top_k(rows, 3, lambda i: i % 7 == 0)


def test_few_vectors(spark):
    assert search(spark, []) == [] and search(spark, [(7, [1.0])]) == [] and search(spark, [(1, [1.0]), (2, None)]) == []
    assert search(spark, [(7, [1.0]), (1, [0.5])]) == [(7, 1, 1, 256 * 128)]
    with pytest.raises(ValueError):
        search(spark, [(7, [1e9, 1.0])])


def test_tasks_let_go_of_candidates(spark, monkeypatch):
    queries = np.array([[3.0, -2.0], [0.0, 0.0]])
    best = exact_topk._Best(np.array([100, 101]), queries, np.array([4, 4]), 2)
    rng = np.random.default_rng(0)
    true = rng.integers(-50, 50, (500, 2))
    corners = (true + 52) // 4 * 4 - 52
    found = []
    for at in range(0, 500, 50):
        best.see(np.arange(at, at + 50), np.arange(at, at + 50)[::-1].copy(), corners[at : at + 50])
        if at % 100:
            best.prune()
        if at == 250:
            found += best.batch().to_pylist()
    found += best.batch().to_pylist()
    assert all(r["least"] <= true[r["rid"]] @ [3, -2] <= r["most"] for r in found if r["query"] == 100)
    wanted = sorted(true @ np.array([3, -2]))[-2]
    assert {i for i in range(500) if true[i] @ [3, -2] >= wanted} <= {r["rid"] for r in found if r["query"] == 100}
    assert {49, 48} <= {r["rid"] for r in found if r["query"] == 101} or len([r for r in found if r["query"] == 101]) == 4


# ---------------------------------------------------------------- spelling


def edits(word, letters):
    cuts = {word[:i] + word[i + 1 :] for i in range(len(word))}
    swaps = {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    puts = {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return (cuts | swaps | puts) - {word}


def plain_variants(counts, ratio):
    letters = sorted({c for w in counts for c in w})
    form, near = {}, {}
    for w, n in counts.items():
        near[w] = edits(w, letters) & set(counts)
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted(((w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()), key=repr)


def drawn_counts(seed, size, letters, longest):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(size)}
    return {w: int(5 * 3 ** (rng.random() * 6)) for w in sorted(words)}


@pytest.mark.parametrize("counts", [
    drawn_counts(1, 500, "ab", 9), drawn_counts(2, 900, "abcéÿ日", 5), {"a" * 70: 5, "a" * 71: 50, "a" * 64: 9, "a" * 65: 100, "a" * 69 + "b": 700},
    {"alone": 7}, {"x" * 3000: 5, "x" * 1500 + "y" + "x" * 1499: 30}, {"chain1": 5, "chain12": 25, "chain123": 125, "chain1234": 700, "chaim12": 25}])
def test_variants_equal_plain_python(spark, counts):
    vocab = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    assert sorted(map(tuple, spelling.variants(vocab, ratio=5).collect()), key=repr) == plain_variants(counts, 5)


def test_a_full_filter_costs_no_correctness(spark, monkeypatch):
    counts = drawn_counts(3, 400, "abc", 7)
    vocab = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    assert sorted(map(tuple, spelling.variants(vocab, ratio=2, max_bytes=64).collect()), key=repr) == plain_variants(counts, 2)


def test_filter_knows_its_words_and_little_else(spark):
    rng = random.Random(6)
    words = sorted({"".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(4000)})
    shards, table = spelling.build_filter(spark.createDataFrame([(w,) for w in words], "word string"))
    hashes = spelling._codes(words) @ spelling._powers(9)
    assert len(spelling._known(table, shards, 9, hashes)) == len(words)
    others = np.random.default_rng(0).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    assert len(spelling._known(table, shards, 9, others)) < 400
    assert table.nbytes <= spelling.BITS * len(words) / 8 + 64


def test_odd_vocabularies(spark):
    none = spark.createDataFrame([], "word string, n bigint")
    assert spelling.variants(none).count() == 0
    odd = spark.createDataFrame([(None, 5), ("", 9), ("wordly", 5)], "word string, n bigint")
    assert [tuple(r) for r in spelling.variants(odd).collect()] == [("wordly", None, "wordly", 5, 0, None)]
    with pytest.raises(ValueError):
        spelling.variants(odd, ratio=1)


def test_spelling_query_on_odd_documents(spark, tmp_path):
    texts = [None, "", "Zürich ZÜRICH zürich×÷", "colour " * 40 + "color " * 6 + "COLOUR", "colours-colour's" * 9, "short and tall", "word" * 5000]
    docs = [(i, t, "x") for i, t in enumerate(texts * 30)] + [(None, "colour Zürich", "x")] * 3
    spark.createDataFrame(docs, "doc_id bigint, text string, word string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = Counter()
    for doc_id, text, _ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    got = QUERIES["op13_spelling"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_variants(counts, 5)


@pytest.mark.parametrize("name", ["op11_resample", "op12_exact_topk", "op13_spelling"])
def test_queries_equal_their_sql(spark, name):
    from checks.compare import compare, connect

    ok, note = compare(spark, connect("/root/testdata/sf0.001"), "/root/testdata/sf0.001", name)
    assert ok, note
