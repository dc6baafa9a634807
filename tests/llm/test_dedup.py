"""Exact and near duplicates against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from parlance.llm import components, exact_dedup, simhash_dedup

SCHEMA = "doc_id bigint, text string, source string, sha string, keep_id int, id string, _row string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "s", "x", 1, "y", "z") for i, t in rows], SCHEMA)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


ROWS = [
    (1, "Same text"), (2, "same TEXT"), (9, "SAME text"), (3, "Ä"), (4, "ä"), (5, None), (6, ""), (7, " "), (8, "x" * 200_000),
    (10, "x" * 200_000), (11, "alone"), (12, "twice"), (12, "twice"), (None, "no id"), (None, "no id"), (13, "mixed"), (None, "Mixed"),
] + [(100 + i, "hot") for i in range(200)]


@pytest.mark.parametrize("max_blocks", [1, 64])
def test_marks_every_row(spark, max_blocks):
    got = exact_dedup.mark_duplicates(table(spark, ROWS), max_blocks=max_blocks).collect()
    groups = {}
    for i, t in ROWS:
        groups.setdefault(lowered(t), []).append(i)
    want = sorted(((i, max((j for j in groups[lowered(t)] if j is not None), default=None), len(groups[lowered(t)]),
                    hashlib.sha256(lowered(t).encode()).hexdigest()) for i, t in ROWS), key=str)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_drop_keeps_rows_and_columns(spark):
    docs = table(spark, ROWS)
    got = exact_dedup.drop_duplicates(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted(lowered(r.text) for r in rows) == sorted({lowered(t) for _, t in ROWS})
    by_text = {lowered(r.text): r.doc_id for r in rows}
    assert by_text["same text"] == 9 and by_text["hot"] == 299 and by_text["mixed"] == 13 and by_text["no id"] is None


def test_empty_tables(spark):
    empty = table(spark, ROWS).where("false")
    assert exact_dedup.mark_duplicates(empty).count() == 0
    assert exact_dedup.drop_duplicates(empty).count() == 0
    assert simhash_dedup.near_duplicates(empty, 4, 4).count() == 0
    assert simhash_dedup.drop_near_duplicates(empty, 4, 4).columns == empty.columns


def plain_fingerprint(text, n):
    words = lowered(text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, radius):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("text", [None, "", " \n", "one", "One two THREE", "a b c d", "a b c d e a b c d", "ä\u00a0b c\x1cd é f", "w " * 3000])
def test_fingerprint(text):
    got = simhash_dedup.fingerprint(None if text is None else text.encode(), 4)
    assert got % (1 << 64) == plain_fingerprint(text, 4)


def test_votes_in_parts(monkeypatch):
    text = " ".join(random.Random(1).choices("abcdefgh", k=999))
    monkeypatch.setattr(simhash_dedup, "VOTES_AT_ONCE", 100)
    assert simhash_dedup.fingerprint(text.encode(), 4) % (1 << 64) == plain_fingerprint(text, 4)


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_every_pair(radius):
    masks, rng = simhash_dedup.covering_masks(radius), random.Random(radius)
    for _ in range(2000):
        difference = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not difference & m for m in masks)


@pytest.mark.parametrize("radius, dense", [(4, 1 << 15), (4, 2), (3, 2), (3, 50)])
def test_links_give_the_components(spark, radius, dense):
    rng = random.Random(7)
    values = []
    for _ in range(12):  # chains and clouds around centres, some of them near each other
        at = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 20])):
            values.append(at)
            at ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, radius + 1)))
    values = sorted(set(values))
    nodes = spark.createDataFrame([(simhash_dedup._signed(v),) for v in values], "fp bigint")
    links = simhash_dedup.near_links(nodes, radius, dense)
    found = {r.node: r.root for r in components.components(links).collect()}
    got = [found.get(simhash_dedup._signed(v), simhash_dedup._signed(v)) for v in values]
    want = plain_components(values, radius)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_near_duplicates_of_rows(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [rng.choice(words) for _ in range(300)]
    rows = [(5, None), (6, ""), (None, "  ")]
    for i in range(40):
        copy = list(base)
        copy[rng.randrange(300)] = "changed"
        rows.append((100 + i, " ".join(copy)))
        rows.append((1000 + i, " ".join(rng.choice(words) for _ in range(50))))
    rows.append((100, rows[3][1]))
    got = simhash_dedup.near_duplicates(table(spark, rows), 4, 4).collect()
    values = [plain_fingerprint(t, 4) for _, t in rows]
    roots = plain_components(values, 4)
    least = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = sorted(((i, v, least.get(r)) for (i, _), v, r in zip(rows, values, roots)), key=str)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == want
    left = {r.doc_id for r in simhash_dedup.drop_near_duplicates(table(spark, rows), 4, 4).collect()}
    assert {i for i, _, c in want if i == c} <= left | {None}
    assert not {i for i, _, c in want if i is not None and i != c} & left


def test_one_document_of_each_group_stays(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(4)]
    near = [t + " end" for t in texts]
    rows = [
        (1, texts[0]), (None, near[0]),  # a copy without an id goes
        (2, texts[1]), (2, near[1]), (2, texts[2]),  # copies and another text share an id
        (None, texts[3]), (None, near[3]),  # no ids at all
        (7, "w1 w2"), (7, "w1 w2"),  # one document, twice
    ]
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id bigint, text string, gone int, root int, known int")
    values = [plain_fingerprint(t, 4) for _, t in rows]
    roots = plain_components(values, 4)
    assert roots[0] == roots[1] and roots[2] == roots[3] != roots[4] and roots[5] == roots[6]
    got = simhash_dedup.drop_near_duplicates(docs, 4, 4)
    assert got.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in got.collect()]
    assert len(kept) == 6 and kept.count((7, "w1 w2")) == 2 and (1, texts[0]) in kept and (2, texts[2]) in kept
    assert sum(k in kept for k in rows[2:4]) == 1 and sum(k in kept for k in rows[5:7]) == 1


def test_long_chain_has_one_root(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (7, 7)], "a bigint, b bigint")
    found = components.components(links).collect()
    assert {r.node: r.root for r in found} == {i: 0 for i in range(1, 201)}


def test_forest_links_only_near_nodes():
    nodes = np.array([0, 1, 3, 255, 254, 15 << 40], np.int64)
    assert sorted(simhash_dedup._forest(nodes, 1)) == [(0, 1), (1, 3), (255, 254)]
