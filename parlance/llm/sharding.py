"""Shards of near equal bytes by histogram sort, in DataFrame functions only.

Rows are ordered by a 128-bit key: a hash of the text, then a hash of the id. Between two shards
stands a splitter. Candidate boundaries cut the range in which a splitter must lie into equal
parts; one pass sums the exact bytes between them for all splitters at once, and the part that
holds the wanted position is cut again, until a boundary is within the tolerance. Then the rows are
exchanged once, to their final places.

The text's hash comes first, so a splitter stands between two texts: equal texts share a shard unless
they are more than ``GROUP`` of one, a hundredth. Only such a group is divided, by the ids' hash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parlance.llm.common import column, packed, written

DIGIT_BITS = 12
KEY_BITS = 128
TOLERANCE = 0.001
GROUP = 0.01
ROWS_PER_PART = 4096
TASK_BYTES = 128 << 20  # text that one task of the exchange is given, if the session's partitions would give it more
_SIGN = 1 << 63


@dataclass
class Splitter:
    """The wanted bytes below it, and the range it is known to lie in: all keys that begin with ``bits`` bits of ``prefix``."""

    target: float
    prefix: int = 0
    bits: int = 0
    below: int = 0
    key: int | None = None


def size_of(text: Column) -> Column:
    """UTF-8 bytes plus one for the end of the text."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def _keys(text: Column, id_col: Column) -> dict[str, Column]:
    first = F.xxhash64(F.coalesce(text, F.lit("")))
    return {"key1": first, "key2": F.xxhash64(id_col, first)}


def _bits(at: int, n: int) -> Column:
    """``n`` bits of the key from bit ``at`` on; a digit never crosses the two halves."""
    half = F.col("key1" if at < 64 else "key2").bitwiseXOR(F.lit(-_SIGN))
    return F.shiftrightunsigned(half, 64 - at % 64 - n).bitwiseAND(F.lit((1 << n) - 1))


def _begins_with(prefix: int, bits: int) -> Column:
    condition = F.lit(True)
    if bits >= 64:
        condition = condition & (F.col("key1") == (prefix >> (bits - 64)) - _SIGN)
    n = bits % 64
    if n:
        half = F.col("key1" if bits < 64 else "key2").bitwiseXOR(F.lit(-_SIGN))
        condition = condition & (F.shiftrightunsigned(half, 64 - n) == prefix & ((1 << n) - 1))
    return condition


def find_splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[int]:
    """Keys, as unsigned 128-bit numbers, at which shards 1, 2, ... begin. ``rows`` has size, key1, key2.

    A pass brings at most shards * 2^DIGIT_BITS sums to the driver, however many rows there are.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    splitters = [Splitter(total * j / shards) for j in range(1, shards)]
    allowed, whole = tolerance * total / shards, GROUP * total / shards
    while any(s.key is None for s in splitters):
        open_ranges = sorted({(s.prefix, s.bits) for s in splitters if s.key is None})
        at = open_ranges[0][1]  # all open ranges are equally deep
        n = min(DIGIT_BITS, 64 - at % 64)
        which = F.lit(None).cast("int")
        for i, (prefix, bits) in enumerate(open_ranges):
            which = F.when(_begins_with(prefix, bits), F.lit(i)).otherwise(which)
        sums = rows.withColumn("range", which).where("range IS NOT NULL").groupBy("range", _bits(at, n).alias("digit")).agg(
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
        histograms: dict[int, list] = {}
        for row in sorted(sums, key=lambda r: (r["range"], r["digit"])):
            histograms.setdefault(row["range"], []).append(row)
        for s in splitters:
            if s.key is None:
                _refine(s, histograms.get(open_ranges.index((s.prefix, s.bits)), []), n, allowed, whole)
    return [s.key for s in splitters]


def _refine(s: Splitter, histogram: list, n: int, allowed: float, whole: float) -> None:
    """Settle on a boundary near enough, or go on inside the part where the target lies; not inside a small group of equal texts."""
    below, depth = s.below, s.bits + n
    for row in histogram:
        upto = below + row["bytes"]
        if upto >= s.target:
            prefix = s.prefix << n | row["digit"]
            lower_is_nearer = s.target - below <= upto - s.target
            nearest = min(s.target - below, upto - s.target)
            if nearest <= allowed or row["n"] == 1 or depth == KEY_BITS or depth == 64 and row["bytes"] <= whole:
                s.key = (prefix if lower_is_nearer else prefix + 1) << (KEY_BITS - depth)
            s.prefix, s.bits, s.below = prefix, depth, below
            return
        below = upto
    s.key = (s.prefix + 1) << (KEY_BITS - s.bits) if s.bits else 1 << KEY_BITS


def _shard(splitters: list[int]) -> Column:
    """How many splitters are at or below the row's key."""
    shard = F.lit(0)
    for key in splitters:
        if key >> KEY_BITS:
            continue  # beyond the largest key: nothing lies above
        first, second = (key >> 64) - _SIGN, (key & (2 * _SIGN - 1)) - _SIGN
        above = (F.col("key1") > first) | ((F.col("key1") == first) & (F.col("key2") >= second))
        shard = shard + above.cast("int")
    return shard


def shard_by_bytes(docs: DataFrame, shards: int = 8, tolerance: float = TOLERANCE,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's columns in a struct ``_row`` beside size, shard (from 0) and slot (gapless from 0 in each shard).

    Shard sizes differ from the mean by the tolerance, by half of a group of equal texts that is up to a hundredth of a
    shard, or by the largest row, so a very long text may make its shard larger. A NULL text has no bytes and size 1. Equal
    texts are in one shard unless they are more than that. Rows that repeat id and text have equal keys and so
    share a shard; their slots follow in any order. Extra columns stay in ``_row``. An empty table gives no rows.
    """
    text, doc = column(text_col), column(id_col).cast("bigint")
    narrow = written(docs.select(size_of(text).alias("size"), *[c.alias(n) for n, c in _keys(text, doc).items()]), "keys")
    splitters = find_splitters(narrow, shards, tolerance)
    n, size = narrow.agg(F.count(F.lit(1)), F.sum("size")).first()
    parts = max(1, -(-n // (shards * ROWS_PER_PART)))
    part = F.pmod(F.col("key2"), F.lit(parts))
    # A shard is numbered in parts of bounded size: rows before the part plus the place inside it.
    counts = narrow.groupBy(_shard(splitters).alias("shard"), part.alias("part")).count()
    before = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = written(counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")), "starts")
    rows = packed(docs, size=size_of(text), **_keys(text, doc)).withColumns({"shard": _shard(splitters), "part": part})
    tasks = min((size or 0) // TASK_BYTES, parts * shards)
    if tasks > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        rows = rows.repartition(tasks, "shard", "part")
    place = F.row_number().over(W.partitionBy("shard", "part").orderBy("key1", "key2")) - 1
    placed = rows.withColumn("place", place)
    return placed.join(starts, ["shard", "part"]).select(
        "_row", "size", F.col("shard").cast("int").alias("shard"), (F.col("start") + F.col("place")).alias("slot"))
