"""Quality rules, token counts, toxicity, language and chat formatting."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parlance.llm import chat, language_id, quality_rules, token_counts, toxicity
from parlance.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text):
    words = WORDS.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    marked = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i : i + 3])] > 1}
    lines = [l for l in (text or "").split("\n") if WORDS.search(l)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked))


def test_quality_rules(spark):
    rng = random.Random(1)
    own = lambda n: " ".join("".join(rng.choices("abcdefghij", k=9)) for _ in range(n))
    license_line = "Licensed under the terms of 2024, see the notice in this very file"
    texts = [None, "", " \n\t\n", "a a a a a a", "a b c a b c", "😀 é #*|\r\n\r\nx\x0by", "same\nsame\n same\n\nsame", own(60), own(20_000), "z " * 4000]
    docs = [(i, t, "h", "q") for i, t in enumerate(texts)]
    docs += [(100 + i, license_line.replace("2024", str(i)) + "\n" + own(60), "h", "q") for i in range(25)]
    docs += [(200 + i, "\n".join([license_line.upper()] * 5 + [own(10)]), "h", "q") for i in range(3)]
    docs += [(300 + i, license_line + "\n" + own(60), None, "q") for i in range(20)]
    docs += [(7, texts[7], "h", "q")]
    rows = spark.createDataFrame(docs, "doc_id bigint, text string, source string, lines string")
    got = quality_rules.apply_rules(rows).collect()
    assert len(got) == len(docs)
    by_id = {r.doc_id: r for r in got}
    for i, text, _, _ in docs:
        r = by_id[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_measures(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    assert all(by_id[100 + i].n_removed_words == 13 and by_id[100 + i].kept for i in range(25))
    assert all(by_id[200 + i].n_removed_words == 65 and not by_id[200 + i].kept for i in range(3))
    assert all(by_id[300 + i].n_removed_words == 0 for i in range(20))
    assert by_id[7].kept and by_id[8].kept and not by_id[9].kept
    assert quality_rules.apply_rules(rows.where("false")).count() == 0


def plain_tokens(word, scores):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        best.append(max(((best[s][0] + scores[word[s:end]], best[s][1] - 1) for s in range(end) if word[s:end] in scores), default=(-1e300, 0)))
    return -best[-1][1]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(alphabet="abcd", max_size=9), max_size=12), st.integers(1, 40))
def test_trie_counts_as_plain_programming(words, max_nodes):
    scores = {c.encode(): -2.0 - k / 7 for k, c in enumerate("abcd")} | {b"ab": -3.1, b"abc": -4.0, b"cd": -2.5, b"bcd": -4.4, b"aaaa": -5.0}
    trie = token_counts.ForwardTrie(scores, max_nodes)
    got = [trie.count_all([[w]])[0] for w in words]
    assert got == [plain_tokens(w.encode(), scores) for w in words]


def test_token_counts(spark):
    texts = [None, "", "a", "the cat sat on the mat", "x" * 3000, "né 日本 😀", "the " * 5000]
    rows = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(None, "a", 0), (2, "a", 0)], "doc_id bigint, text string, n_tokens int")
    got = token_counts.token_counts(rows, max_nodes=50).collect()
    assert len(got) == 9
    scores = token_counts.zipf_scores(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    import regex

    split = regex.compile(public_tokenizers.PATTERN).findall
    for r in got:
        if r.doc_id is not None and r.doc_id not in (4, 6):
            words = split(texts[r.doc_id] or "")
            assert (r.n_pretokens, r.n_tokens) == (len(words), sum(plain_tokens(w.encode(), scores) for w in words))
    assert token_counts.token_counts(rows.where("false")).count() == 0


def test_a_task_keeps_no_long_pretokens(monkeypatch):
    scores = {bytes([b]): -5.0 for b in range(256)} | {"日本".encode(): -1.0}
    trie = token_counts.ForwardTrie(scores, 50)
    long_words = ["日本" * 60 + chr(0x4E00 + i) for i in range(500)]
    assert trie.count_all([long_words, ["日本"]]) == [500 * 63, 1]
    assert trie.terminal == {"日本": 1} and len(trie.score) == 7
    monkeypatch.setattr(token_counts, "MAX_KEPT", 100)
    for i in range(50):
        assert trie.count_all([["x" * 9 + str(i)]])[0] in (10, 11)
        assert trie.kept <= 100 + 11 and len(trie.terminal) <= 12


@pytest.fixture(scope="module")
def toxic_docs(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split())
    rows = []
    for i in range(600):
        sentences = [" ".join(word() for _ in range(8)) for _ in range(rng.randint(1, 12))]
        toxic = i % 5 == 0
        if toxic:
            sentences[rng.randrange(len(sentences))] = f"you {word()} Scoundrel{rng.choice(['s', 'ly', ''])} {word()}"
        rows.append((i, ". ".join(sentences) + ".", int(toxic)))
    return rows


def test_toxicity(spark, toxic_docs):
    odd = [(None, "alpha"), (7001, None), (7002, ""), (7003, "..."), (7004, "beta " * 50_000)]
    docs = spark.createDataFrame([(i, t, 9, 1, i) for i, t in [(i, t) for i, t, _ in toxic_docs] + odd],
                                 "doc_id bigint, text string, score int, label int, labelled bigint")
    labels = spark.createDataFrame([(i, y) for i, _, y in toxic_docs] + [(None, 1), (3, None), (4, 0)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels, F.col("doc_id") % 3 != 1)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [(i, t, y) for i, t, y in toxic_docs if i % 3 == 1]
    assert sum(got[i].predicted == y for i, _, y in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got.values())
    assert got[7001].score == got[7002].score == got[7003].score == 0 and got[7004].predicted == 0
    for i, text, y in held:
        if y and got[i].predicted:
            assert [text[s.start : s.end].count("Scoundrel") for s in got[i].offending] == [1]
    assert toxicity.score(docs.where("false"), model).count() == 0


def test_scores_are_noisy_or_written_out(spark, toxic_docs):
    docs = spark.createDataFrame([(i, t) for i, t, _ in toxic_docs[:200]], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in toxic_docs], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    for r in toxicity.score(docs, model).collect():
        clean = 1.0
        for sentence in re.split(r"[.!?\n]", toxic_docs[r.doc_id][1]):
            words = re.findall(r"[^\W_]+", sentence.lower())
            if words:
                z = model.bias + sum(model.weights.get(f, 0.0) for w in words for f in ["=" + w, *(w[:k] for k in range(3, min(7, len(w)) + 1))])
                clean *= 1 - 1 / (1 + 2.718281828459045 ** -z)
        assert r.score == pytest.approx(1 - clean, abs=1e-9)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    assert [r.predicted for r in toxicity.score(docs, model).collect()] == [0]


def test_gradient_is_that_of_the_likelihood(spark):
    import numpy as np

    rows = [(1, 2, [1, 2], [0, 1, 1]), (0, 1, [2], [0, 2]), (1, 0, [1], [2]), (0, 3, [], [])]
    bags = spark.createDataFrame(rows, "label int, plain bigint, lengths array<int>, places array<int>")
    w, b = np.array([0.4, -0.3, 0.9]), -0.7

    def likelihood(x):
        total, bias = 0.0, x[-1]
        for label, plain, lengths, places in rows:
            z, at = [bias] * plain, 0
            for n in lengths:
                z.append(bias + sum(x[p] for p in places[at : at + n]))
                at += n
            none = float(np.prod([1 - 1 / (1 + np.exp(-v)) for v in z]))
            total += np.log(1 - none if label else none)
        return total

    of_weights, of_bias, n = toxicity._gradient(bags, w, b)
    x = np.append(w, b)
    steps = [(likelihood(x + e) - likelihood(x - e)) / 2e-6 for e in np.eye(4) * 1e-6]
    assert n == 4 and np.allclose(np.append(of_weights, of_bias), steps, atol=1e-5)


LANGUAGES = {"one": "die der und nicht sich eine werden auch", "two": "the of and which have been other there", "three": "les des une que pour dans avec sont"}


def test_language(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        lang = list(LANGUAGES)[i % 3]
        rows.append((i, " ".join(rng.choices(LANGUAGES[lang].split(), k=rng.randint(15, 60))), lang, "p"))
    rows += [(900, None, "one", "p"), (901, "", "two", "p"), (902, "123 !?", "two", "p"), (903, "the of and " * 20_000, None, "p"), (904, "zz", "und", "p"), (None, "und die", None, "p")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, lang_pred string")
    learned = language_id.learn_dictionaries(docs.where("doc_id % 4 != 2"), F.col("text"), F.col("lang"), F.col("doc_id"))
    assert set(learned) == set(LANGUAGES)
    got = {r.doc_id: r for r in language_id.identify(docs, learned).select("_row.doc_id", "lang_pred", "score", "rejected").collect()}
    assert len(got) == len(rows)
    held = [r for r in rows if r[0] is not None and r[0] < 300 and r[0] % 4 == 2]
    assert sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.98 * len(held)
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and all(got[i].rejected for i in (900, 901, 902))
    assert got[903].lang_pred == "two" and not got[903].rejected
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language_id.identify(docs.where("false"), learned).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs, {}).collect()} == {"und"}


def test_sizes_are_those_of_zstandard(spark):
    """The query's operator against the method written out: a dictionary per language, blocks, the smallest sum."""
    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learned = language_id.learn_dictionaries(docs, F.col("text"), F.col("lang"), F.col("doc_id"))
    got = {r.doc_id: r for r in language_id.identify(docs, learned).select("_row.doc_id", "lang_pred", "score").collect()}

    def size(content, block, text):
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        tool = zstandard.ZstdCompressor(level=language_id.LEVEL, dict_data=words, write_content_size=False, write_dict_id=False)
        return sum(len(tool.compress(text[at : at + block])) for at in range(0, len(text), block))

    for r in docs.limit(60).collect():
        if not any(c.isalpha() for c in r.text or ""):
            assert got[r.doc_id].lang_pred == "und"
            continue
        text = language_id.plain(r.text)
        sums = {lang: size(content, language_id.BLOCK, text) for lang, content in learned.items()}
        first, second = sorted(sums.values())[:2]
        if 1 - first / second < language_id.CLEAR:
            sums = {lang: n + size(learned[lang], language_id.SMALL_BLOCK, text) for lang, n in sums.items()}
            first, second = sorted(sums.values())[:2]
        assert got[r.doc_id].lang_pred == min(sums, key=sums.get) and got[r.doc_id].score == pytest.approx(max(0, 1 - first / second))


@pytest.mark.parametrize("unlearned", ["en", "es"])
def test_a_language_that_was_not_learned_is_rejected(spark, tmp_path, unlearned):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = docs.withColumn("label", F.col("lang")).withColumn("lang", F.when(F.col("lang") != unlearned, F.col("lang")))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op10_language"](spark, str(tmp_path)).join(docs.select("doc_id", "label"), "doc_id").collect()
    strange = [r for r in found if r.label == unlearned]
    held = [r for r in found if r.label != unlearned and r.held_out]
    assert sum(r.rejected for r in strange) >= 0.9 * len(strange) > 50
    assert sum(not r.rejected and r.lang_pred == r.label for r in held) >= 0.95 * len(held) > 50


def test_the_cut_parts_known_from_unknown():
    scored = [("a", True, 0.5), ("a", True, 0.3), ("a", False, 0.1), ("a", False, 0.02), ("b", True, 0.4), ("b", False, 0.0)]
    assert language_id.parting(scored) == 0.2
    assert language_id.parting([]) == language_id.parting([("a", True, 0.5)]) == language_id.MARGIN
    assert language_id.parting([("a", True, 0.5), ("a", False, 0.5)]) == language_id.MARGIN


def test_margin_of_few(spark):
    assert language_id.learn_margin(spark, {}) == language_id.MARGIN
    assert language_id.learn_margin(spark, {"a": ["le chat"], "b": ["the cat"]}) == language_id.MARGIN
    assert language_id.learn_margin(spark, {"a": ["le chat"], "b": ["the cat"], "c": ["die katze"]}) == language_id.MARGIN


@settings(deadline=None, max_examples=200)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a</s>", "\\[INST]", ""]),
                          st.text(alphabet=st.sampled_from(list("\\<>/s[]INST ab\n😀")), max_size=30)
                          | st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "\\", "x"]), max_size=6).map("".join)), max_size=6))
def test_format_is_reversible(turns):
    text, spans = chat.format_turns(turns)
    assert chat.read_turns(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_conversations_by_turn(spark):
    rows = [(1, 2, "assistant", None), (1, 1, "user", "hi </s>"), (2, 5, "assistant", "a"), (2, 5, "assistant", "a"), (2, None, None, "x"),
            (None, 0, "user", "q"), (3, 0, "user", "long " * 50_000)] + [(4, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(100)]
    table = spark.createDataFrame([(*r, 0) for r in rows], "conv_id bigint, turn bigint, role string, text string, score int")
    got = {r.conv: r for r in chat.conversations(chat.linear_threads(table)).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    assert chat.read_turns(got[1].formatted) == [("user", "hi </s>"), ("assistant", "")]
    assert chat.read_turns(got[2].formatted) == [("", "x"), ("assistant", "a"), ("assistant", "a")]
    assert [t for _, t in chat.read_turns(got[4].formatted)] == [f"t{i}" for i in range(100)]
    assert chat.conversations(chat.linear_threads(table.where("false"))).count() == 0
    assert hashlib.sha256(got[1].formatted.encode()).hexdigest()


def test_ids_of_conversations_may_be_texts(spark):
    rows = [(c, i, r, f"{r} {c!r}") for c in ("", None, "a:1", "a") for i, r in enumerate(("user", "assistant"))] + [("a", None, "user", "first"), ("a", None, "user", "first")]
    table = spark.createDataFrame(rows, "conv_id string, turn bigint, role string, text string")
    got = {r.conv: chat.read_turns(r.formatted) for r in chat.conversations(chat.linear_threads(table)).collect()}
    assert set(got) == {"", None, "a:1", "a"}
    for c in ("", None, "a:1"):
        assert got[c] == [("user", f"user {c!r}"), ("assistant", f"assistant {c!r}")]
    assert got["a"] == [("user", "first")] * 2 + [("user", "user 'a'"), ("assistant", "assistant 'a'")]


def test_trees_rank_branches(spark):
    rng = random.Random(9)
    rows = [("n0", None, 0.0)] + [(f"n{i}", f"n{rng.randrange(max(0, i - 6), i)}", rng.random()) for i in range(1, 80)]
    rows += [("r", None, None), ("r1", "r", 1.0), ("r2", "r", 1.0), ("lost", "gone", 3.0)]
    table = spark.createDataFrame([(n, p, s, "c", "user", n) for n, p, s in rows], "node string, parent string, score double, conv string, role string, text string")
    got = chat.best_paths(table, n_best=2).collect()
    parent, score = {n: p for n, p, _ in rows}, {n: s or 0.0 for n, _, s in rows}
    want = set()
    trees = {}
    for leaf in set(parent) - set(parent.values()):
        path = [leaf]
        while parent.get(path[-1]) in parent:
            path.append(parent[path[-1]])
        trees.setdefault(path[-1], []).append((-sum(score[n] for n in path) / len(path), leaf, path))
    for root, branches in trees.items():
        for rank, (_, leaf, path) in enumerate(sorted(branches, key=lambda b: (round(b[0], 12), b[1]))[:2], 1):
            want |= {(root, leaf, rank, n, h) for h, n in enumerate(path)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_circles_are_an_error(spark):
    table = spark.createDataFrame([("a", "b", 0.0), ("b", "a", 0.0)], "node string, parent string, score double")
    with pytest.raises(ValueError):
        chat.best_paths(table, max_rounds=5)
