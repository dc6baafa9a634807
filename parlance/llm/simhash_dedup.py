"""Near-duplicates by SimHash fingerprints and covering locality-sensitive hashing.

Bit i of the fingerprint belongs to a nonzero vector m(i) of radius + 1 bits. Table v, for each
nonzero v, keeps the bits whose m(i) has an odd product with v. The vectors of at most ``radius``
differing bits span less than the whole space, so some v is orthogonal to all of them: in that
table none of the differing bits is kept and the pair collides. No pair within the radius is lost.

Equal fingerprints are one node from the start. Two nodes alone in a bucket are compared in SQL. A
larger bucket is searched breadth first and yields a spanning forest of its links, never its pairs.
Beyond ``dense`` nodes a bucket is not compared at all: every node goes to the points halfway to
all its possible partners, and nodes that meet at a point are within the radius. That costs
a fixed number of rows a node.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parlance.llm.common import LOWER, ROW, UPPER, column, packed, sent, unpacked, written
from parlance.llm.components import components

BITS = 64
SEED = 42
DENSE = 1 << 15
VOTES_AT_ONCE = 1 << 16
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of the UTF-8 text's word shingles, as a signed number; zero without a word.

    bytes.split parts words at the ASCII white space and nowhere else.
    """
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words))) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    votes, n = np.zeros(BITS, np.int64), len(words) - k + 1
    for at in range(0, n, VOTES_AT_ONCE):
        to = min(n, at + VOTES_AT_ONCE)
        hashes = np.fromiter((
            xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[at:to].tolist(), ends[at + k - 1 : to + k - 1].tolist())
        ), np.dtype("<u8"), to - at)
        votes += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, twin, fp) of every row; texts are read whole, as bytes. ``twin`` is a hash that tells apart texts that share an id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.int64())], ["id", "twin", "fp"])

    given = docs.select(
        column(id_col).cast("bigint").alias("id"), F.xxhash64(column(text_col)).alias("twin"), column(text_col).cast("binary").alias("text"))
    return sent(given).mapInArrow(run, "id bigint, twin bigint, fp bigint")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def covering_masks(radius: int) -> list[int]:
    """The kept bits of each table; the vectors m(i) go round, so every table keeps about half the bits."""
    vectors = (1 << radius + 1) - 1
    return [
        sum(1 << i for i in range(BITS) if ((i % vectors + 1) & v).bit_count() & 1) for v in range(1, vectors + 1)
    ]


def _forest(nodes: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within the radius, breadth first."""
    links, rest = [], nodes.view(np.uint64)
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            at = front.pop()
            near = np.bitwise_count(rest ^ at) <= radius
            if near.any():
                found, rest = rest[near], rest[~near]
                links += [(int(at), int(x)) for x in found]
                front += list(found)
    return links


def _linked_buckets(rows: DataFrame, radius: int) -> DataFrame:
    """Links inside buckets of bounded size; rows (table, key, fp) are brought together and sorted by bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        label = None

        def closed() -> Iterator[pa.RecordBatch]:
            links = _forest(np.concatenate(held), radius) if held else []
            if links:
                both = np.array(links, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            tables, keys, nodes = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            cuts = np.flatnonzero((tables[1:] != tables[:-1]) | (keys[1:] != keys[:-1])) + 1
            for part in np.split(np.arange(len(nodes)), cuts):
                here = (int(tables[part[0]]), int(keys[part[0]]))
                if here != label:
                    yield from closed()
                    held, label = [], here
                held.append(nodes[part])
        yield from closed()

    return rows.repartition("t", "key").sortWithinPartitions("t", "key", "fp").select("t", "key", "fp").mapInArrow(
        run, "a bigint, b bigint")


def _halfway_links(rows: DataFrame, radius: int) -> DataFrame:
    """Links inside buckets of any size, through the points halfway between two nodes.

    Nodes at most ``radius`` bits apart share a point that is at most radius // 2 flips from one
    and the rest of the radius from the other. Only bits that the table leaves out can differ.
    """
    far, close = (radius + 1) // 2, radius // 2
    flips = []
    for t, mask in enumerate(covering_masks(radius)):
        free = [1 << i for i in range(BITS) if not mask >> i & 1]
        flips += [(t, _signed(sum(c)), n <= close) for n in range(far + 1) for c in combinations(free, n)]
    spark = rows.sparkSession
    # A fixed table: some 500 rows for each of the covering tables at radius 4.
    points = F.broadcast(spark.createDataFrame(flips, "t int, flip bigint, close boolean"))
    met = rows.join(points, "t").select("t", F.expr("fp ^ flip").alias("point"), "fp", "close")
    # As many nodes as there are flips meet at a point at most.
    centre = F.min(F.when(F.col("close"), F.col("fp"))).over(W.partitionBy("t", "point"))
    return met.withColumn("b", centre).where("b IS NOT NULL AND fp != b").select(F.col("fp").alias("a"), "b")


def near_links(nodes: DataFrame, radius: int, dense: int = DENSE) -> DataFrame:
    """Links that connect all fingerprints (column fp, distinct) within ``radius`` bits, directly or in steps."""
    masks = F.array(*[F.lit(_signed(m)).cast("bigint") for m in covering_masks(radius)])
    hashed = nodes.select("fp", F.posexplode(masks).alias("t", "mask")).select("t", F.expr("fp & mask").alias("key"), "fp")
    shared = written(hashed.groupBy("t", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"), "buckets")
    pairs = shared.where("n = 2").where(F.bit_count(F.expr("a ^ b")) <= radius).select("a", "b")
    busy = hashed.join(shared.where("n > 2").select("t", "key", "n"), ["t", "key"])
    return (
        pairs.unionAll(_linked_buckets(busy.where(F.col("n") <= dense), radius))
        .unionAll(_halfway_links(busy.where(F.col("n") > dense), radius))
    )


def _grouped(docs: DataFrame, shingle: int, radius: int, id_col: str, text_col: str, dense: int) -> DataFrame:
    """(id, twin, fp, root, component_id) of every row; rows of one component share the root."""
    rows = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    rooted = components(near_links(nodes.select("fp"), radius, dense))
    member = rooted.select(F.col("node").alias("fp"), "root").unionAll(rooted.select(F.col("root").alias("fp"), "root").distinct())
    linked = nodes.join(member, "fp").select("fp", "root", "least")
    smallest = linked.groupBy("root").agg(F.min("least").alias("component"))
    of_linked = written(linked.join(smallest, "root").select("fp", "root", "component"), "members")
    named = nodes.join(of_linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNotNull(), F.col("component")).otherwise(F.col("least")).alias("component_id"))
    return rows.join(written(named, "named"), "fp", "left")


def near_duplicates(docs: DataFrame, shingle: int, radius: int, id_col: str = "doc_id", text_col: str = "text",
                    dense: int = DENSE) -> DataFrame:
    """One row per input row: id, fp (bigint) and component_id, the smallest id reachable over links.

    Fingerprints at most ``radius`` bits apart are linked. A NULL or wordless text has fingerprint
    zero and is linked like any other; a text with fewer words than ``shingle`` is one shingle. Repeated rows
    have one fingerprint. Texts of any length are read whole, and a task needs memory for its longest one. A NULL id is passed over when the smallest is sought. Other columns are
    not read; an empty table gives no rows.
    """
    return _grouped(docs, shingle, radius, id_col, text_col, dense).select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int, radius: int, id_col: str = "doc_id", text_col: str = "text",
                         dense: int = DENSE) -> DataFrame:
    """The input's rows and columns; of each component the document with the smallest id stays, a NULL id last.

    If several texts of the component have that id, the one with the smallest hash stays. Rows that share id and text
    are one document: they stay or go together. NULL and empty texts are near copies of each other; texts may have any
    length; an empty table gives no rows.
    """
    grouped = written(_grouped(docs, shingle, radius, id_col, text_col, dense), "grouped")
    first = grouped.where("id <=> component_id")
    shared = written(first.groupBy("root").agg(F.min("twin").alias("stays"), F.max("twin").alias("other")).where("stays != other"), "shared")
    goes = grouped.where("NOT id <=> component_id").select("id", "twin").unionAll(
        first.join(shared, "root").where("twin != stays").select("id", "twin"))
    known = F.coalesce(F.col("id"), F.lit(-(2**63))).alias("known")
    gone = written(goes.select(known, "twin").distinct(), "dropped")
    rows = packed(docs, id=column(id_col).cast("bigint"), twin=F.xxhash64(column(text_col))).select(ROW, known, "twin")
    return unpacked(rows.join(gone, ["known", "twin"], "left_anti"))
