"""Spelling variants by Bloom-guided neighbourhoods.

Two words are near if one edit, a character put in, taken out or replaced, makes one of the other. Every word's
edits are generated and looked up in blocked Bloom filters of the vocabulary, one for each length of words, that
travel to every task; only edits that the filter knows are written out, shuffled and joined with the vocabulary
itself, which removes what the filter wrongly let pass. A character put in is one taken out as seen from the
other word, and of two words that differ by a replaced character only the smaller character is replaced, so
every pair is found once.

Words are hashed by a polynomial in their code points modulo 2^64, so the hash of an edit follows from prefix sums
of the word's own, for whole matrices of words at once; a string is made of an edit only when the filter knows it.

The filters have ``BITS`` bits a word, up to ``MAX_BYTES`` in all. Beyond, more edits pass that are not words: they
cost shuffle, not correctness.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import written

LANES = 8  # a block of the filter has eight words of 64 bits, and a key sets one bit in each
BITS = 24
MAX_BYTES = 32 << 20
LONGEST = 64  # longer words share the filter of this length
MAX_ALPHABET = 4096
PROBES = 1 << 16  # edits looked up at once
MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
_PRIME = 0x9E3779B97F4A7C15
_BACK = pow(_PRIME, -1, 1 << 64)
_WORD = "word string, n bigint, other string"


def vocabulary(occurrences: DataFrame, word: Column, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n of the words with enough characters and occurrences; counted per task before the shuffle."""
    counted = occurrences.select(word.alias("word")).where(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def _codes(words: list[str]) -> np.ndarray:
    """Words of one length as rows of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1).astype(np.uint64)


def _powers(length: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(max(0, length - 1), _PRIME, np.uint64))), dtype=np.uint64)[:length]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def by_length(words: list[str]) -> dict[int, list[int]]:
    found: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        found.setdefault(len(w), []).append(i)
    return found


class Shards:
    """Where each length's filter begins, and how many blocks (a power of two) it has."""

    def __init__(self, sizes: dict[int, int], bits: int = BITS, max_bytes: int = MAX_BYTES):
        per_word = min(float(bits), 8.0 * max_bytes / max(1, sum(sizes.values())))
        self.first, self.blocks, at = {}, {}, 0
        for length, n in sorted(sizes.items()):
            blocks = 1
            while blocks * 64 * LANES * 2 <= n * per_word:  # a power of two, within what was allowed
                blocks *= 2
            self.first[length], self.blocks[length], at = at, blocks, at + blocks
        self.total = at

    def places(self, length: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block of each key, and the hash whose parts name a bit in each lane."""
        shard = min(length, LONGEST)
        mixed = _mixed(hashes + np.uint64(length))
        return np.int64(self.first[shard]) + (mixed & np.uint64(self.blocks[shard] - 1)).astype(np.int64), _mixed(mixed)

    def has(self, length: int) -> bool:
        return min(length, LONGEST) in self.first


def _bit(lanes: np.ndarray, lane: int) -> np.ndarray:
    return np.uint64(1) << ((lanes >> np.uint64(6 * lane)) & np.uint64(63))


def build_filter(vocab: DataFrame, max_bytes: int = MAX_BYTES) -> tuple[Shards, np.ndarray]:
    """The shards and their bits, at most ``max_bytes`` (and a block for each length); blocks are joined in the cluster."""
    length = F.least(F.length("word"), F.lit(LONGEST)).alias("length")
    shards = Shards({r["length"]: r["count"] for r in vocab.groupBy(length).count().collect()}, max_bytes=max_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            for n, which in by_length(words).items():
                codes = _codes([words[i] for i in which])
                blocks, lanes = shards.places(n, codes @ _powers(n))
                # Each lane is a number whose set bits are joined by OR.
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks), *[pa.array(_bit(lanes, k).view(np.int64)) for k in range(LANES)]], ["block", *_LANES])

    set_bits = vocab.select("word").mapInArrow(run, "block bigint, " + ", ".join(f"{c} bigint" for c in _LANES))
    joined = set_bits.groupBy("block").agg(*[F.bit_or(c).alias(c) for c in _LANES]).toArrow()
    table = np.zeros((max(1, shards.total), LANES), np.uint64)
    at = joined.column("block").to_numpy()
    for k, c in enumerate(_LANES):
        table[at, k] = joined.column(c).to_numpy().view(np.uint64)
    return shards, table


_LANES = [f"lane{k}" for k in range(LANES)]


def _known(table: np.ndarray, shards: Shards, length: int, hashes: np.ndarray) -> np.ndarray:
    """Indices of the hashes that the filter of that length knows; lane after lane, on what is left."""
    blocks, lanes = shards.places(length, hashes)
    left = np.arange(len(hashes))
    for k in range(LANES):
        left = left[table[blocks[left], k] & _bit(lanes[left], k) != 0]
    return left


def probe(words: list[str], alphabet: np.ndarray, shards: Shards, table: np.ndarray) -> Iterator[tuple[list[int], list[str]]]:
    """Word numbers and their edits that the filters know: one character taken out, or replaced by a larger one."""
    for n, which in by_length(words).items():
        rows = max(1, PROBES // (n * (len(alphabet) + 1)))
        for at in range(0, len(which), rows):
            part = which[at : at + rows]
            codes, powers = _codes([words[i] for i in part]), _powers(n)
            terms = codes * powers
            total = terms.sum(1, dtype=np.uint64)
            if n > 1 and shards.has(n - 1):
                upto = np.cumsum(terms, 1, dtype=np.uint64)
                gone = upto - terms + (total[:, None] - upto) * np.uint64(_BACK)
                # Of equal characters in a row only the last is taken out: the edits of a word are distinct.
                last = np.concatenate((codes[:, 1:] != codes[:, :-1], np.ones((len(part), 1), bool)), 1)
                row, where = np.nonzero(last)
                found = _known(table, shards, n - 1, gone[row, where])
                yield [part[i] for i in row[found]], [words[part[i]][:j] + words[part[i]][j + 1 :] for i, j in zip(row[found], where[found])]
            step = max(1, PROBES // max(1, len(part) * len(alphabet)))
            for begin in range(0, n, step):  # a very long word alone is taken in steps
                here = slice(begin, begin + step)
                larger = alphabet[None, None, :] > codes[:, here, None]
                row, where, letter = np.nonzero(larger)
                change = (alphabet[letter] - codes[row, where + begin]) * powers[where + begin]
                found = _known(table, shards, n, total[row] + change)
                yield [part[i] for i in row[found]], [
                    words[part[i]][: j + begin] + chr(int(alphabet[c])) + words[part[i]][j + begin + 1 :]
                    for i, j, c in zip(row[found], where[found], letter[found])]


def near_words(vocab: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """word, n, other, other_n of every pair of words one edit apart, in both directions."""
    letters = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).where("letter != ''").distinct()
    alphabet = [ord(r["letter"]) for r in letters.limit(MAX_ALPHABET + 1).collect()]
    if len(alphabet) > MAX_ALPHABET:
        raise ValueError(f"a vocabulary of more than {MAX_ALPHABET} different characters")
    shards, table = build_filter(vocab, max_bytes)
    shared = vocab.sparkSession.sparkContext.broadcast((np.array(sorted(alphabet), np.uint64), shards, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column(0).to_pylist(), batch.column(1)
            for which, others in probe(words, *shared.value):
                if which:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(which)), counts.take(pa.array(which)), pa.array(others, pa.string())], ["word", "n", "other"])

    known = vocab.select("word", "n").mapInArrow(run, _WORD)
    pairs = known.join(vocab.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    both = F.array(F.struct("word", "n", "other", "other_n"),
                   F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return pairs.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of the words that have a form. Every form is so much more frequent than its word that chains are short; pointers are doubled."""
    step = written(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        above = step.select(F.col("word").alias("root"), F.col("root").alias("higher"))
        moved = written(step.join(above, "root", "left").select("word", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")), "roots")
        step = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return step


def variants(vocab: DataFrame, ratio: int = RATIO, max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``vocab`` has distinct words and their counts; rows with a NULL or empty word are left out. A word's form is its near
    word of the largest count, ties to the smallest in code-point order, if that count is at least ``ratio`` (2
    or more) times the word's; else NULL. Its root is the end of the chain of forms, or the word itself. Words of any length are
    compared whole. An empty vocabulary gives no rows. Words have at most 90 * length neighbours over an
    alphabet of 90, so no group is large.
    """
    if ratio < 2:
        raise ValueError("a ratio below 2 allows circles of forms")
    vocab = written(vocab.where("word != ''").select("word", F.col("n").cast("bigint").alias("n")), "vocabulary")
    near = near_words(vocab, max_bytes).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best"))
    joined = vocab.join(written(near, "near"), "word", "left")
    much = -F.col("best.minus") >= F.lit(ratio) * F.col("n")
    forms = written(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(much, F.col("best.other")).alias("form"), F.when(much, -F.col("best.minus")).alias("form_n")), "forms")
    return forms.join(roots(forms), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
