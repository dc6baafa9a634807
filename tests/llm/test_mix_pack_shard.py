"""Mixing, packing and sharding: their laws on small and awkward tables."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from parlance.llm import mixing, packing, sharding
from parlance.llm.common import WORD, word_count
from parlance.llm.queries import QUERIES


def mixed(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, size bigint, tilt string")
    return mixing.mix(docs, F.col("size"), **options).select(
        F.col("_row.doc_id").alias("doc_id"), F.col("_row.source").alias("source"), "size", "source_size", "target", "copies", "rate").collect()


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        stopped = {s for s in free if level * weight[s] > cap * sizes[s]}
        if not stopped:
            return target | {s: level * weight[s] for s in free}
        for s in stopped:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= stopped
    return target


def test_mix_meets_targets(spark):
    rng = random.Random(5)
    names = ["b", "a", None, "ä", "Z", ""]
    rows = [(i, names[i % 6] if i % 3 else "hot", int(rng.lognormvariate(4, 1)) if i % 50 else 0, "x") for i in range(3000)]
    rows += [(1, "a", 40, "x"), (1, "a", 40, "x"), (None, "a", 7, "x"), (5000, "a", 20_000, "x")]
    got = mixed(spark, rows)
    assert len(got) == len(rows)
    sizes = {}
    for _, s, n, _ in rows:
        sizes[s] = sizes.get(s, 0) + n
    want = plain_targets(sizes)
    for s, size in sizes.items():
        here = [r for r in got if r.source == s]
        assert {r.source_size for r in here} == {size}
        assert here[0].target == pytest.approx(want[s])
        taken = sum(r.size * r.copies for r in here)
        assert abs(taken - want[s]) <= max(0.005 * want[s], 60)
        assert sum(r.size * r.rate for r in here) == pytest.approx(want[s], rel=1e-6)
    assert all(0 <= r.copies <= 2 for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixed(spark, list(reversed(rows)))))


@pytest.mark.parametrize("rows", [[], [(1, None, 0, "x")], [(1, "a", None, "x"), (2, "b", 5, "x")], [(1, "a", 10, "x")]])
def test_mix_of_little(spark, rows):
    got = mixed(spark, rows)
    assert len(got) == len(rows)
    assert all(r.copies in (0, 1, 2) and r.target <= 2 * r.source_size for r in got)


def test_word_count(spark):
    texts = [None, "", " \t\x0b\x0c\r\n", "a", " a\u00a0b c\x1cd ", "é\nü"]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(word_count(F.col("text"))).collect()
    assert [r[0] for r in got] == [0, 0, 0, 1, 2, 2]
    assert WORD


TEXTS = [None, "", "a", "<|endoftext|> x", "the quick brown fox " * 3000, "x" * 30_000, " " * 5000 + "end", "né 日本語 ☃ 😀 don't I'LL 12345 ... \u00a0\u2003z",
         "\n\n\n a\n  b", "word " * 400] + ["some text of length %d " % i * (i % 60) for i in range(300)]


def test_packing_is_an_exact_cover(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x"), (None, "no id", "x")],
                                 "doc_id bigint, text string, ids string").repartition(3)
    got = packing.pack(docs, lookahead=64).collect()
    json = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    json.encode_special_tokens = True
    for i, text in enumerate(TEXTS):
        pieces = sorted((r for r in got if r.doc_id == i), key=lambda r: r.piece)
        if i == 3:
            pieces = pieces[:1]
        ids = json.encode(text or "", add_special_tokens=False).ids + [0]
        assert [r.start for r in pieces] == [s for s, _ in packing.pieces_of(len(ids), 2048)]
        assert np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist() == ids
        assert all(r.length == len(r.ids) // 4 == 2048 for r in pieces[1:])
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 2048
    assert len(places) <= 1.1 * -(-sum(r.length for r in got) // 2048) + 3


def test_packing_needs_few_sequences():
    lengths = sorted((int(x) for x in np.random.default_rng(1).integers(1, 2048, 5000)), reverse=True)
    room = packing.OpenSequences(2048, 0)
    for n in lengths:
        room.place(n)
    assert room.next_id <= 1.03 * sum(lengths) / 2048


def test_packing_brings_clustered_lengths_together(spark):
    # A document of n tokens, with its end; every partition holds documents of one length.
    texts = [" ".join(["a"] * (n - 1)) for n in [1100] * 64 + [900] * 64]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for parts in (1, 16, 64):
        got = packing.pack(docs.repartitionByRange(parts, "doc_id"), ids=F.crc32("ids").alias("crc")).collect()
        assert sorted((r.doc_id, r.length) for r in got) == [(i, 1100 if i < 64 else 900) for i in range(128)]
        assert len({r.sequence_id for r in got}) == 64


def test_groups_follow_the_size_of_texts(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("some words " * 400).alias("text"))
    assert packing.groups_for(docs, lookahead=1000) == 2
    assert packing.groups_for(docs.repartition(50), lookahead=1000) == 2
    got = packing.pack(docs, lookahead=1000, ids=F.crc32("ids").alias("crc"))
    found = got.groupBy(F.shiftright("sequence_id", 40).alias("g")).count().collect()
    assert len(found) == 2 and all(abs(r["count"] - 2500) <= 8 for r in found)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, got.collect()))


def test_long_texts_in_parts():
    tokenizer = packing.load_tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(2)
    text = "".join(rng.choice(["a", "bc", " ", "  ", "\n", "1", "'s", "é", ".", "日"]) for _ in range(5000))
    for part in (1, 7, 100):
        assert packing.encode(tokenizer, text, part).tolist() == tokenizer.encode_ordinary(text)


MARK = "<|endoftext|>"
MARKED = ["end <|endoftext|> x", MARK, MARK * 3, f"a{MARK}b \n {MARK}  c", f"  {MARK}\n", f"<|endoftext| >{MARK[:-1]}", "no mark", None, f"x {MARK} " * 900]


def test_ids_are_those_of_the_json_as_loaded():
    json = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert {t.content: i for i, t in json.get_added_tokens_decoder().items()} == packing.ADDED
    tokenizer = packing.load_tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), packing.ADDED)
    rng = random.Random(3)
    drawn = ["".join(rng.choice([MARK, "a", "bc", " ", "  ", "\n", "1", "'s", "é", "<|", "|>"]) for _ in range(60)) for _ in range(300)]
    for text in MARKED + drawn:
        for part in (7, packing.PART):
            assert packing.encode(tokenizer, text, part).tolist() == json.encode(text or "", add_special_tokens=False).ids
    with pytest.raises(ValueError):
        packing.load_tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), {"two words": 50256})


def blanks(n, kinds, seed=5):
    rng = random.Random(seed)
    return "".join(rng.choice(kinds) for _ in range(n))


LONG_BLANKS = [" " * 1_000_000, "\n" * 1_000_000 + "end", f"a{' ' * 2_000_000} b", f"x {chr(10) * 5_000_000}{MARK} y", "\t" * 1_200_000 + MARK,
               blanks(1_100_000, " \n\t") + "é", f"{' ' * 70_000}1{' ' * 70_000}'s{chr(0x3000) * 70_000}", "z" * 2_000_000, blanks(1_000_000, " \x1c\u200b")]


def test_long_runs_of_blanks():
    json = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer = packing.load_tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), packing.ADDED)
    for text in LONG_BLANKS:
        assert packing.encode(tokenizer, text).tolist() == json.encode(text, add_special_tokens=False).ids
    for seed in range(300):
        text = blanks(40, [" ", "  ", "\n", "\t\u3000", "\x85", "\x1c", "\u200b", "a", "'s", "1", ".", MARK], seed)
        for long_blank in (1, 2, 3, 5):
            assert packing.encode(tokenizer, text, 7, long_blank).tolist() == json.encode(text, add_special_tokens=False).ids


def naive_place(lengths, capacity):
    """Sum of squares written out: every choice is tried and the whole sum taken each time."""
    gaps, made = [], []
    for n in lengths:
        best = None
        for gap in sorted({g for g in gaps if n <= g < capacity}):
            after = Counter(g for g in gaps if 0 < g < capacity)
            after[gap] -= 1
            if gap > n:
                after[gap - n] += 1
            total = sum(k * k for k in after.values())
            if best is None or total < best[0]:
                best = (total, gap)
        if best is None:
            gaps.append(capacity - n)
            made.append(0)
        else:
            at = max(i for i, g in enumerate(gaps) if g == best[1])
            made.append(capacity - gaps[at])
            gaps[at] -= n
    return made, len(gaps)


def test_place_is_the_sum_of_squares_rule():
    rng = random.Random(8)
    for capacity in (10, 37):
        for _ in range(40):
            lengths = [rng.randint(1, capacity) for _ in range(60)]
            room = packing.OpenSequences(capacity, 0)
            offsets = [room.place(n)[1] for n in lengths]
            wanted, n = naive_place(lengths, capacity)
            assert room.next_id == n and offsets == wanted


def test_pack_queries_give_the_ids_of_the_json(spark, tmp_path):
    json = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = MARKED + LONG_BLANKS[:4]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, text in enumerate(texts):
        ids = np.array(json.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(i, k, at, n, zlib.crc32(ids[at : at + n].tobytes())) for k, (at, n) in enumerate(packing.pieces_of(len(ids), 2048))]
    for got in (QUERIES["op5_pack"](spark, str(tmp_path)), corpus_pipeline.pack_sequences(spark, docs, str(tmp_path))):
        assert sorted(tuple(r)[:5] for r in got.collect()) == want


def test_packing_of_nothing(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def sharded(spark, rows, n):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, shard string")
    return sharding.shard_by_bytes(docs, n).select(
        F.col("_row.doc_id").alias("doc_id"), F.col("_row.text").alias("text"), "size", "shard", "slot").collect()


@pytest.mark.parametrize("n", [1, 3, 8])
def test_shards_are_even_and_gapless(spark, n):
    rng = random.Random(n)
    rows = [(i, "w" * int(rng.lognormvariate(5, 1))) for i in range(1500)] + [(2000 + i, "the same hot text " * 20) for i in range(700)]
    rows += [(None, "no id"), (1, None), (2, "")]
    got = sharded(spark, rows, n)
    assert sorted(map(str, ((r.doc_id, r.text) for r in got))) == sorted(map(str, rows))
    assert all(r.size == len((r.text or "").encode()) + 1 for r in got)
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(n)]
    mean = sum(sizes) / n
    assert max(abs(s - mean) for s in sizes) <= 0.002 * mean + 2 * max(r.size for r in got)
    for s in range(n):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    # Only a text too heavy for one shard's tolerance, or one at a boundary, is divided.
    divided = {t for t in {r.text for r in got} if len({r.shard for r in got if r.text == t}) > 1}
    assert len(divided) <= n


def test_repeated_rows_and_nothing(spark):
    got = sharded(spark, [(1, "a")] * 20, 4)
    assert sorted((r.shard, r.slot) for r in got) == [(got[0].shard, k) for k in range(20)]
    assert sharded(spark, [], 4) == []
    assert zlib.crc32(b"") == 0


def test_only_a_large_group_of_equal_texts_is_divided(spark):
    rng = random.Random(12)
    rows = [(i, "".join(rng.choice("abc") for _ in range(200))) for i in range(4000)]
    rows += [(10_000 + 10 * g + k, f"copied text {g} " * 20) for g in range(300) for k in range(3)]  # a third of a hundredth of a shard each
    rows += [(50_000 + i, "hot " * 60) for i in range(2500)]
    got = sharded(spark, rows, 8)
    where = {}
    for r in got:
        where.setdefault(r.text, set()).add(r.shard)
    assert [t for t, s in where.items() if len(s) > 1] == ["hot " * 60]
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 0.01 * sum(sizes) / 8


def test_tasks_follow_the_bytes(spark, monkeypatch):
    monkeypatch.setattr(sharding, "TASK_BYTES", 1000)
    monkeypatch.setattr(sharding, "ROWS_PER_PART", 10)
    docs = spark.createDataFrame([(i, f"text {i} " * 9) for i in range(900)], "doc_id bigint, text string")
    got = sharding.shard_by_bytes(docs, 4)
    assert got.rdd.getNumPartitions() > 30 and got.count() == 900
    for s in range(4):
        assert sorted(r.slot for r in got.where(F.col("shard") == s).collect()) == list(range(got.where(F.col("shard") == s).count()))


def test_splitters_are_those_of_a_sort(spark):
    rng = random.Random(7)
    rows = spark.createDataFrame([(i, "t" * rng.randint(1, 400)) for i in range(3000)], "doc_id bigint, text string")
    keyed = rows.select(sharding.size_of(F.col("text")).alias("size"), *[c.alias(n) for n, c in sharding._keys(F.concat("text", "doc_id"), F.col("doc_id")).items()])
    ordered = sorted((((r.key1 + 2**63) << 64) + r.key2 + 2**63, r["size"]) for r in keyed.collect())
    total = sum(n for _, n in ordered)
    for tolerance in (0.001, 0.0):
        for j, key in enumerate(sharding.find_splitters(keyed, 8, tolerance), 1):
            below = sum(n for k, n in ordered if k < key)
            best = min(abs(sum(n for _, n in ordered[:i]) - total * j / 8) for i in range(len(ordered) + 1)) if not tolerance else 0
            assert abs(below - total * j / 8) <= max(tolerance * total / 8, best) + (200 if tolerance else 1e-6)


def test_rates_are_those_of_a_scalar_solver(spark):
    import math

    rng = random.Random(3)
    rows = [(i, "ab"[i % 3 == 0], int(rng.lognormvariate(4, 1.5)) + 1, "") for i in range(900)]
    got = mixed(spark, rows)
    for source in "ab":
        own = [r for r in got if r.source == source]
        target, mean = own[0].target, own[0].source_size / len(own)
        low, high = -100.0, 100.0
        for _ in range(200):
            tilt = (low + high) / 2
            words = sum(r.size * math.exp(min(math.log(2), tilt * r.size / mean)) for r in own)
            low, high = (tilt, high) if words < target else (low, tilt)
        for r in own:
            assert r.rate == pytest.approx(math.exp(min(math.log(2), tilt * r.size / mean)), rel=1e-5, abs=1e-9)


def test_an_unsolved_mix_is_an_error(spark):
    docs = spark.createDataFrame([(i, "a" if i % 2 else "b", i + 1) for i in range(50)], "doc_id bigint, source string, size bigint")
    counts = docs.groupBy("source", "size").count().withColumnRenamed("count", "n")
    targets = mixing.source_targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")))
    with pytest.raises(RuntimeError):
        mixing.solve_tilts(counts, targets, max_steps=1)
