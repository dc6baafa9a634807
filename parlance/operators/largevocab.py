"""Vocabularies of millions of tokens: counted by hash, and looked up where the texts are.

A word that is one of a billion costs a row of some 50 bytes in a shuffle of words. Here each task sorts the 64-bit
names of its words and sends their differences, five or six bytes a word; only the words that are frequent enough are
then sought in the texts, and each is written by the documents of one tag, not by all that hold it. Tasks look words
up in sorted hashes, so neither texts nor words are shuffled or written.
These operators run Python in tasks, batch by batch; only hashes, ids and sought words go there.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.functions.text import words
from parlance.session import ensure_checkpoint_dir, sent

LARGE = 8_000_000  # tokens of a vocabulary whose hashes travel; some 160 MB in every Python task
CHUNK = 1 << 23  # words that a task sorts at once
BUCKETS = 1 << 10  # ranges of hashes, counted each by itself
SPARE = 3  # as many candidates as that for each token asked for, ties at the end among them
SEEDS = (0, 1, 2)  # hashes that are tried until no two words share one that counts
_TAG = np.uint64(0xFF)  # the low bits of a name hold a tag of the document, so that the smallest is kept by sorting
_SUM = 1 << 62
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
GROUP = 4 << 20  # bytes of texts that are joined at once
_PARTS = 6  # bits of a name, or 2 ** bits ranges of ids, that are packed as one

Packed = tuple  # (number, packed columns ...) of a range


# ---------------------------------------------------------------- numbers as bytes


def _pack(numbers: np.ndarray) -> bytes:
    """Compressed byte by byte of the numbers, so that high bytes, which hardly differ, cost nothing."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), numbers.itemsize).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(content: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = pa.decompress(bytes(content), n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(kind).reshape(n)


def _pack_sorted(keys: np.ndarray) -> bytes:
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_sorted(content: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(content, n, np.uint64), dtype=np.uint64)


def _filled(ranges: list[Packed], columns: dict[int, Any], spare: int = 0) -> list[np.ndarray]:
    """Columns of all ranges, each as one array with ``spare`` zeros at its end; column 1 is of sorted numbers.

    Ranges are let go one by one, so that a table is never in memory both packed and unpacked.
    """
    size = sum(n for n, *_ in ranges)
    found, at = [np.zeros(size + spare, kind) for kind in columns.values()], 0
    for i, row in enumerate(ranges):
        ranges[i], n = None, row[0]
        for whole, (c, kind) in zip(found, columns.items()):
            whole[at : at + n] = _unpack_sorted(row[c], n) if kind is np.uint64 else _unpack(row[c], n, kind)
        at += n
    return found


def _taken(shared: Broadcast) -> Any:
    """What was sent to a task, which does not stay in the Python process: a later task reads it from its executor again."""
    pa.default_memory_pool().release_unused()
    value = shared.value
    vars(shared).pop("_value", None)
    return value


class Positions:
    """Where a hash stands in sorted distinct ones: its leading bits tell the few places where it can be."""

    def __init__(self, keys: np.ndarray):
        self.keys, bits = keys, max(1, len(keys).bit_length() - 2)  # some three or four hashes begin alike
        self.shift = np.uint64(64 - bits)
        edges = np.arange(1, 1 << bits, dtype=np.uint64) << self.shift
        self.starts = np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)])).astype(np.int32)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each, or -1."""
        top = (wanted >> self.shift).astype(np.int64)
        at, end = self.starts[top], self.starts[top + 1]
        found, left = np.full(len(wanted), -1, np.int32), np.flatnonzero(at < end)
        while len(left):
            here, sought = at[left], wanted[left]
            there = self.keys[here]
            same = there == sought
            found[left[same]] = here[same]
            on = (there < sought) & (here + 1 < end[left])
            left = left[on]
            at[left] += 1
        return found


def _flat(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def _relisted(lists: pa.Array, values: pa.Array) -> pa.Array:
    """Lists of the same lengths and NULLs as those the values were found for."""
    offsets = np.concatenate(([0], np.cumsum(_lengths(lists)))).astype(np.int32)
    missing = np.append(lists.is_null().to_numpy(zero_copy_only=False), False)
    return pa.ListArray.from_arrays(pa.array(offsets, mask=missing), values)


# ---------------------------------------------------------------- the most frequent words


def _names(ws: Column, seed: int) -> Column:
    return F.transform(ws, lambda w: F.xxhash64(F.lit(seed), w))


def _second(word: Column) -> Column:
    """Another hash, not below 0, by which words that share a name are told apart."""
    return F.hash(word).bitwiseAND(F.lit(0x7FFFFFFF))


def _tag(text: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit(0xFF)).cast("bigint")


def _tagged(names: pa.Array, tags: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    each = np.repeat(tags.to_numpy(zero_copy_only=False).astype(np.uint64), _lengths(names))
    return _flat(names).view(np.uint64) & ~_TAG, each


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where another name begins in sorted keys."""
    names = keys >> np.uint64(8)
    return np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of up to ``CHUNK`` words at a time each name with its smallest tag and count, by range of names."""
    held, n = [], 0
    for batch in batches:
        names, tags = _tagged(batch.column(0), batch.column(1))
        held.append(names | tags)
        n += len(names)
        if n >= CHUNK:
            yield from _ranges(held)
            held, n = [], 0
    if n:
        yield from _ranges(held)


def _ranges(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    keys = np.concatenate(held)
    held.clear()
    keys.sort()
    starts = _runs(keys)
    counts, keys = np.diff(np.append(starts, len(keys))).astype(np.uint32), keys[starts]
    width = np.uint64(64 - (BUCKETS - 1).bit_length())
    edges = np.searchsorted(keys, np.arange(BUCKETS, dtype=np.uint64) << width).tolist() + [len(keys)]
    full = [b for b in range(BUCKETS) if edges[b] < edges[b + 1]]
    of = lambda f, a: [f(a[edges[b] : edges[b + 1]]) for b in full]
    yield pa.RecordBatch.from_arrays([
        pa.array(full, pa.int32()), pa.array(of(len, keys), pa.int32()),
        pa.array(of(_pack_sorted, keys), pa.binary()), pa.array(of(_pack, counts), pa.binary()),
    ], ["bucket", "n", "keys", "counts"])


def _merged(limit: int):
    """A range of names: how many words have which count, and the names of the most frequent, at most ``limit``."""

    def run(table: pa.Table) -> pa.Table:
        parts = [c.to_pylist() for c in table.select(["n", "keys", "counts"]).columns]
        keys = np.concatenate([_unpack_sorted(k, n) for n, k, _ in zip(*parts)])
        counts = np.concatenate([_unpack(c, n, np.uint32) for n, _, c in zip(*parts)]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = _runs(keys)
        keys, counts = keys[starts], np.add.reduceat(counts, starts)
        values, many = np.unique(counts, return_counts=True)
        few = np.flatnonzero(np.cumsum(many[::-1])[::-1] <= limit)  # counts that so many words reach
        least = 0 if len(keys) <= limit else int(values[few[0]]) if len(few) else int(values[-1]) + 1
        kept = counts >= least
        return pa.table({
            "bucket": pa.array([table["bucket"][0].as_py()], pa.int32()), "n": pa.array([int(kept.sum())], pa.int32()),
            "keys": pa.array([_pack_sorted(keys[kept])], pa.binary()), "counts": pa.array([_pack(counts[kept])], pa.binary()),
            "least": pa.array([least], pa.int64()), "values": pa.array([values.tolist()], pa.list_(pa.int64())),
            "many": pa.array([many.tolist()], pa.list_(pa.int64())),
        })

    return run


@contextmanager
def _shuffles_go(spark: SparkSession):
    """The shuffle files of what runs inside go when it has run."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def _candidates(df: DataFrame, text: str, n: int, seed: int) -> list[Packed] | None:
    """Names (with tags) and counts of all words that are as frequent as the n-th, by range of names, or None if they are too many."""
    named = df.select(_names(words(F.col(text)), seed).alias("names"), _tag(F.col(text)).alias("tag"))
    with _shuffles_go(df.sparkSession):
        chunks = sent(named).mapInArrow(_counted, "bucket int, n int, keys binary, counts binary")
        merged = chunks.groupBy("bucket").applyInArrow(
            _merged(SPARE * n // BUCKETS + 1000),
            "bucket int, n int, keys binary, counts binary, least bigint, values array<bigint>, many array<bigint>")
        ranges = sorted(merged.collect(), key=lambda r: r.bucket)  # a few bytes for a candidate
    total = Counter()
    for r in ranges:
        total.update(dict(zip(r["values"], r["many"])))
    threshold, reached = 1, 0
    for value in sorted(total, reverse=True):
        threshold, reached = value, reached + total[value]
        if reached >= n:
            break
    if reached > SPARE * n or any(r.least > threshold for r in ranges):
        return None
    for at, r in enumerate(ranges):  # one after the other, so that the driver never holds them all unpacked
        own = _unpack(r["counts"], r["n"], np.int64)
        kept = _unpack_sorted(r["keys"], r["n"])[own >= threshold]
        ranges[at] = len(kept), _pack_sorted(kept), _pack(own[own >= threshold])
    return ranges


def _sought(df: DataFrame, text: str, seed: int, candidates: list[Packed]) -> tuple[DataFrame, str]:
    """``token, count`` of the candidates, perhaps repeated, and a row per task that sums up what it met of them."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(candidates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, frequent = _filled(_taken(shared), {1: np.uint64, 2: np.int64})
        tag_of, written, met = (known & _TAG).astype(np.uint8), np.zeros(len(known), bool), 0
        known &= ~_TAG
        place = Positions(known)
        as_rows = lambda tokens, count, total: pa.RecordBatch.from_arrays(
            [tokens, pa.array(count, pa.int64()), pa.array(total, pa.int64())], ["token", "count", "met"])
        for batch in batches:
            names, tags = _tagged(batch.column(0), batch.column(1))
            at = place.find(names)
            hit = np.flatnonzero(at >= 0)
            met += int(_flat(batch.column(2))[hit].sum(dtype=np.int64))
            hit = hit[(tag_of[at[hit]] == tags[hit]) & ~written[at[hit]]]
            own, first = np.unique(at[hit], return_index=True)
            written[own] = True
            tokens = batch.column(3).flatten().take(pa.array(hit[first])).cast(pa.string())
            yield as_rows(tokens, frequent[own], np.zeros(len(own), np.int64))
        yield as_rows(pa.array([None], pa.string()), [0], [met % _SUM])

    listed = df.select(F.col(text), words(F.col(text)).alias("ws"))
    parts = listed.select(_names(F.col("ws"), seed).alias("names"), _tag(F.col(text)).alias("tag"), F.transform("ws", _second).alias("second"), "ws")
    try:
        return _written(sent(parts).mapInArrow(run, "token string, count bigint, met bigint"), "sought")
    finally:
        shared.destroy()


def top_words(df: DataFrame, text: str, n: int) -> DataFrame | None:
    """``token, count, rank`` (from 0) of the n most frequent words, equal counts by token; NULL texts hold none.

    Words are counted by 56 bits of hash. That no candidate shares its hash with another word is then checked on the
    words themselves, by a sum of other hashes over all their occurrences; if one does, another hash is tried. The texts
    must be the same whenever they are read. None if no hash will do, or too many words have the count of the n-th.
    """
    spark = df.sparkSession
    for seed in SEEDS if n > 0 else ():
        found = _candidates(df, text, n, seed)
        if found is None:
            return None
        sought, folder = _sought(df, text, seed, found)
        try:
            placed = _placed(sought.where(F.col("token").isNotNull()).select("token", "count"))
            met = sum(r.met for r in sought.where(F.col("token").isNull()).select("met").collect()) % _SUM
        finally:
            _delete(spark, folder)
        expected = F.sum((F.col("count") * _second(F.col("token")).cast("decimal(19,0)")).cast("decimal(38,0)"))
        there = placed.agg(F.count(F.lit(1)).alias("n"), expected.alias("met")).first()
        if there.n == sum(n for n, *_ in found) and int(there.met or 0) % _SUM == met:
            return _ranked(placed).where(F.col("rank") < n)
    return None


def _placed(counts: DataFrame) -> DataFrame:
    """Distinct rows in order, with their partition and their place in it, written once."""
    order = [F.col("count").desc(), F.col("token").asc()]
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    with _shuffles_go(counts.sparkSession):
        rows = counts.repartitionByRange(*order).dropDuplicates().sortWithinPartitions(*order)
        return _written(rows.select("token", "count", F.spark_partition_id().alias("_pid"), place.alias("_pos")), "words")[0]


def _ranked(placed: DataFrame) -> DataFrame:
    sizes, before = sorted(map(tuple, placed.groupBy("_pid").count().collect())), 0  # one row per partition
    offsets = []
    for part, size in sizes:
        offsets.append((part, before))
        before += size
    offsets = placed.sparkSession.createDataFrame(offsets, "_pid int, _offset bigint")
    return placed.join(F.broadcast(offsets), "_pid").select("token", "count", (F.col("_offset") + F.col("_pos")).alias("rank"))


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a table to the shared folder, compressed, and read it back; and where it is."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


# ---------------------------------------------------------------- words to ids and back


def _packed_ranges(rows: DataFrame, pack, kind: str) -> list[Packed]:
    """One value for each ``part`` of the table, in order, packed in the tasks."""
    with _shuffles_go(rows.sparkSession):
        found = rows.groupBy("part").applyInArrow(pack, f"part bigint, n bigint, {kind}").collect()
    return [tuple(r)[1:] for r in sorted(found, key=lambda r: r.part)]


def _pack_names(table: pa.Table) -> pa.Table:
    """Second hashes and ids of tokens in the order of their first; none of either if two share the first."""
    names = table["name"].to_numpy().view(np.uint64)
    order = np.argsort(names)
    names = names[order]
    of = lambda c: b"" if (names[1:] == names[:-1]).any() else _pack(table[c].to_numpy()[order])
    return pa.table({"part": table["part"][:1], "n": pa.array([len(names)], pa.int64()), "names": pa.array([_pack_sorted(names)], pa.binary()),
                     "seconds": pa.array([of("second")], pa.binary()), "ids": pa.array([of("id")], pa.binary())})


def id_finder(vocab: DataFrame, unknown: int):
    """Arrays of words to arrays of ids, by 96 bits of hash of each; None if two tokens share the first 64."""
    name = F.xxhash64("token")
    rows = vocab.select(F.shiftrightunsigned(name, 64 - _PARTS).alias("part"), name.alias("name"), F.hash("token").alias("second"), F.col("id").cast("int").alias("id"))
    packed = _packed_ranges(rows, _pack_names, "names binary, seconds binary, ids binary")
    if not all(seconds for _, _, seconds, _ in packed):
        return None
    shared = vocab.sparkSession.sparkContext.broadcast(packed)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        names, second, ids = _filled(_taken(shared), {1: np.uint64, 2: np.int32, 3: np.int32}, spare=1)
        ids[-1] = unknown
        place = Positions(names[:-1])
        for wanted, check in batches:
            at = place.find(_flat(wanted).view(np.uint64))
            at[second[at] != _flat(check)] = -1  # the last place is that of unknown words
            yield _relisted(wanted, pa.array(ids[at]))

    # Said to be nondeterministic, so that a condition on the ids is not a second call.
    find = F.arrow_udf(run, "array<int>").asNondeterministic()
    return lambda ws: find(F.transform(ws, lambda w: F.xxhash64(w)), F.transform(ws, lambda w: F.hash(w)))


def _pack_tokens(table: pa.Table) -> pa.Table:
    """Lengths and contents of tokens in the order of their ids."""
    tokens = table["token"].take(pc.array_sort_indices(table["id"])).to_pylist()
    content = [t.encode() for t in tokens]
    whole = b"".join(content)
    return pa.table({"part": table["part"][:1], "n": pa.array([len(tokens)], pa.int64()),
                     "lengths": pa.array([_pack(np.array([len(c) for c in content], np.int32))], pa.binary()),
                     "bytes": pa.array([len(whole)], pa.int64()), "content": pa.array([pa.compress(whole, codec="zstd", asbytes=True)], pa.binary())})


def _inside(ids: np.ndarray, n: int) -> np.ndarray:
    """Ids from 0 to n - 1 as they are, all others as n."""
    return np.where((ids < 0) | (ids > n), n, ids)


def _grouped(lists: pa.Array, size: Callable[[np.ndarray], np.ndarray]) -> Iterator[pa.Array]:
    """Successive lists whose entries add up to about ``GROUP`` by their sizes, or single ones."""
    upto = np.concatenate(([0], np.cumsum(size(_flat(lists)) + np.int64(1))))[np.concatenate(([0], np.cumsum(_lengths(lists))))]
    at = 0
    while at < len(lists):
        end = max(at + 1, int(np.searchsorted(upto, upto[at] + GROUP, "right")) - 1)
        yield lists.slice(at, end - at)
        at = end


def text_finder(vocab: DataFrame, unknown: str):
    """Arrays of ids to texts, tokens joined by blanks; the tokens in id order are an array indexed by id."""
    width = max(1, LARGE >> _PARTS)
    rows = vocab.select(F.floor(F.col("id") / width).alias("part"), F.col("id"), F.coalesce("token", F.lit(unknown)).alias("token"))
    shared = vocab.sparkSession.sparkContext.broadcast(_packed_ranges(rows, _pack_tokens, "lengths binary, bytes bigint, content binary"))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ranges, last = _taken(shared), unknown.encode()
        content, at = np.empty(sum(size for _, _, size, _ in ranges) + len(last), np.uint8), 0
        for i, (n, packed, size, whole) in enumerate(ranges):
            content[at : at + size] = np.frombuffer(pa.decompress(bytes(whole), size, codec="zstd"), np.uint8)
            ranges[i], at = (n, packed), at + size
        del packed, whole
        content[at:] = np.frombuffer(last, np.uint8)
        (lengths,) = _filled(ranges, {1: np.int32}, spare=1)
        lengths[-1], n = len(last), len(lengths) - 1
        ends = np.zeros(n + 2, np.int64)
        np.cumsum(lengths, out=ends[1:])
        small = ends[-1] < 1 << 31
        ends = ends.astype(np.int32) if small else ends
        tokens = (pa.StringArray if small else pa.LargeStringArray).from_buffers(n + 1, pa.py_buffer(ends), pa.py_buffer(content))
        blank = pa.scalar(" ", tokens.type)
        pa.default_memory_pool().release_unused()
        for ids in batches:
            texts = [pa.array([], pa.string())]
            for some in _grouped(ids, lambda flat: lengths[_inside(flat, n)]):
                texts.append(pc.binary_join(_relisted(some, tokens.take(pa.array(_inside(_flat(some), n)))), blank).cast(pa.string()))
            yield pa.concat_arrays(texts)

    return F.arrow_udf(run, "string")
