"""Exact search for the best inner products with a vector-approximation file.

Components become whole numbers. A small file beside the vectors holds, for every component, the number of
the cell that it lies in, one byte each; cells are equally wide between the smallest and the largest
value of their dimension. For a query, the lower corner of a vector's cells gives an inner product, and the
query's own components tell how far the true one may lie below or above it: both bounds follow from
one product of matrices over the small file.

The search has two phases. The first scans the small file, blocks of rows against blocks of queries, and
keeps what may still be among the k best by its bounds. The second reads exact vectors in the order of
their bounds: a first batch for every query, whose k-th score then tells which of the rest must be read
at all. Nothing is approximate in the result.

Queries are numbered and taken in chunks of bounded size; a chunk is broadcast, and the file is scanned once
for each. Of equal vectors, only the k + 1 rows of the smallest ids can be among anyone's k best, so the
others leave before the search: a vector that is copied a million times costs a few rows. Where a query's
bounds have no width, as for a query of zeros, they are the products, and ties are settled by id in the scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parlance.llm.common import column, written
from parlance.operators.ranking import ordered_rank

CELLS = 256  # one byte
SCALE = 256
BLOCK = 1024  # rows of the small file in one block
QUERIES = 256  # queries in one block
CHUNK = 1 << 14  # queries that are broadcast at once
FIRST = 4  # times k vectors are read for each query at first
HELD = 1 << 20  # candidates that a task holds before it lets them go
LAST = (1 << 63) - 1


def quantised(vectors: DataFrame, is_query: Column, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """rid, id, is_query and v, the whole numbers floor(scale * x); NULL vectors and those with NULL, NaN or infinite components are left out."""
    doubles = F.transform(column(vector_col), lambda x: x.cast("double"))
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    whole = F.transform(doubles, lambda x: F.floor(F.lit(float(scale)) * x).cast("bigint"))
    given = vectors.select(column(id_col).cast("bigint").alias("id"), F.coalesce(is_query, F.lit(False)).alias("is_query"), whole.alias("v"), bad.alias("bad"))
    return given.where("NOT coalesce(bad, true)").select(F.monotonically_increasing_id().alias("rid"), "id", "is_query", "v")


def _limits(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest value of every dimension; one row per dimension reaches the driver."""
    found = rows.select(F.posexplode("v").alias("at", "x")).groupBy("at").agg(F.min("x"), F.max("x")).orderBy("at").collect()
    # Components that a shorter vector lacks count as zero.
    low, high = np.array([min(0, r[1]) for r in found], np.int64), np.array([max(0, r[2]) for r in found], np.int64)
    if len(found) * float(max([0, *high, *-low])) ** 2 >= 2.0**52:
        raise ValueError("inner products of these vectors are beyond 52 bits")
    return low, high


def _matrix(vectors: list[list[int]], dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _cells(rows: DataFrame, low: np.ndarray, width: np.ndarray) -> DataFrame:
    """The small file: blocks of row numbers, ids and cells. A NULL id stands behind all others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                rids, ids, vectors = batch.slice(at, BLOCK).columns
                cells = ((_matrix(vectors.to_pylist(), len(low)) - low) // width).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (
                    rids.to_numpy(zero_copy_only=False), ids.fill_null(LAST).to_numpy(zero_copy_only=False), cells)], ["rids", "ids", "cells"])

    return rows.select("rid", "id", "v").mapInArrow(run, "rids binary, ids binary, cells binary")


class _Best:
    """The k largest lower bounds seen so far for each query of a block, and the rows that may still matter."""

    def __init__(self, rids: np.ndarray, vectors: np.ndarray, width: np.ndarray, k: int):
        self.rids, self.vectors, self.k = rids, vectors, k
        # True products lie above the corner's by what positive components may add, below by what negative ones may take.
        self.take = np.minimum(vectors, 0) @ (width - 1)
        self.gap = np.abs(vectors) @ (width - 1)
        self.top = np.full((len(rids), k), -np.inf)
        self.settled = {int(q): np.zeros((3, 0), np.int64) for q in np.flatnonzero(self.gap == 0)}
        self.held: list[np.ndarray] = []

    def see(self, rids: np.ndarray, ids: np.ndarray, corners: np.ndarray) -> None:
        least = self.vectors @ corners.T
        least += self.take[:, None]
        least[self.rids[:, None] == rids[None, :]] = -np.inf
        better = least > self.top[:, :1]
        for q, seen in self.settled.items():  # by product, id and row
            rows = np.flatnonzero((least[q] >= self.top[q, 0]) & np.isfinite(least[q]))
            all_rows = np.concatenate((seen, np.stack((-least[q, rows].astype(np.int64), ids[rows], rids[rows]))), 1)
            self.settled[q] = all_rows[:, np.lexsort(all_rows[::-1])[: self.k]]
        for q in np.flatnonzero(better.any(1)):
            self.top[q] = np.sort(np.concatenate((self.top[q], least[q, better[q]])))[-self.k :]
        q, row = np.nonzero((least + self.gap[:, None] >= self.top[:, :1]) & np.isfinite(least) & (self.gap > 0)[:, None])
        self.held.append(np.stack((q, rids[row], least[q, row].astype(np.int64))))

    def prune(self) -> int:
        """Let go of the rows that other rows have meanwhile overtaken; the number of the rest."""
        found = np.concatenate(self.held or [np.zeros((3, 0), np.int64)], 1)
        self.held = [found[:, found[2] + self.gap[found[0]] >= self.top[found[0], 0]]]
        return self.held[0].shape[1]

    def batch(self) -> pa.RecordBatch:
        self.prune()
        for q, seen in self.settled.items():
            self.held.append(np.stack((np.full(seen.shape[1], q), seen[2], -seen[0])))
            self.settled[q] = seen[:, :0]
        q, rid, least = np.concatenate(self.held, 1)
        self.held = []
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (self.rids[q], rid, least, least + self.gap[q].astype(np.int64))], ["query", "rid", "least", "most"])


def _scan(small: DataFrame, queries: DataFrame, low: np.ndarray, width: np.ndarray, k: int) -> DataFrame:
    """query, rid, least, most: the rows that may be among a query's k best, as far as each task can tell."""
    blocks = queries.groupBy((F.col("number") / QUERIES).cast("bigint").alias("block")).agg(F.collect_list(F.struct("rid", "v")).alias("members"))
    # At most ``CHUNK`` queries in blocks of ``QUERIES``: the stated queries meet the file block by block.
    pairs = small.crossJoin(F.broadcast(blocks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, _Best] = {}
        held = 0
        for batch in batches:
            for rids, ids, cells, block, members in zip(*batch.columns):
                if block.as_py() not in best:
                    found = members.as_py()
                    best[block.as_py()] = _Best(np.array([m["rid"] for m in found], np.int64), _matrix([m["v"] for m in found], len(low)), width, k)
                own = np.frombuffer(rids.as_py(), np.int64)
                corners = np.frombuffer(cells.as_py(), np.uint8).reshape(len(own), len(low)) * width + low
                here = best[block.as_py()]
                here.see(own, np.frombuffer(ids.as_py(), np.int64), corners)
                held += here.held[-1].shape[1]
                if held > HELD:
                    held = sum(b.prune() for b in best.values())
                    if held > HELD // 2:
                        yield from (b.batch() for b in best.values())
                        held = 0
        yield from (b.batch() for b in best.values())

    return pairs.select("rids", "ids", "cells", "block", "members").mapInArrow(run, "query bigint, rid bigint, least bigint, most bigint")


def _scored(found: DataFrame, rows: DataFrame, queries: DataFrame) -> DataFrame:
    """query, rid, id, score: exact vectors are read by row number."""
    pairs = found.select("query", "rid").join(rows, "rid").join(queries.select(F.col("rid").alias("query"), F.col("v").alias("q")), "query")
    products = F.zip_with("v", "q", lambda a, b: F.coalesce(a.cast("bigint") * b, F.lit(0)))
    return pairs.select("query", "rid", "id", F.aggregate(products, F.lit(0).cast("bigint"), lambda s, x: s + x).alias("score"))


def _kth(rows: DataFrame, by: str, k: int) -> DataFrame:
    """query and the k-th largest value; a query with fewer rows is left out."""
    place = F.row_number().over(W.partitionBy("query").orderBy(F.desc(by)))
    first = rows.select("query", by).withColumn("place", place).where(F.col("place") <= k)
    return first.groupBy("query").agg(F.min(by).alias("kth"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k).drop("n")


def _reaching(found: DataFrame, kth: DataFrame) -> DataFrame:
    """The candidates whose upper bound reaches their query's k-th value, if it has one."""
    return found.join(kth, "query", "left").where("kth IS NULL OR most >= kth").drop("kth")


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
                scale: int = SCALE, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank (from 1), id and score of each query's k best rows by inner product of floor(scale * x).

    Queries are the rows for which ``is_query`` holds (NULL: it does not); candidates are all rows but the query's
    own. Ties go to the smaller id, a NULL id last; with fewer than k candidates all are returned. NULL vectors and
    those with NULL, NaN or infinite components take no part. Components that one of two vectors lacks count
    as zero, so an empty vector scores 0. Rows that repeat an id or a vector are rows of their own. Other columns are
    not read; an empty table, or one without queries, gives no rows. Products beyond 52 bits are an error.
    """
    rows = written(quantised(vectors, is_query, id_col, vector_col, scale), "vectors")
    low, high = _limits(rows)
    width = (high - low) // CELLS + 1
    narrow = rows.withColumn("v", F.col("v").cast("array<int>"))
    copy = F.row_number().over(W.partitionBy("v").orderBy(F.col("id").asc_nulls_last(), "rid"))
    able = narrow.select("rid", "id", "v").withColumn("copy", copy).where(F.col("copy") <= k + 1).drop("copy")
    able = written(able.repartition(1 + rows.count() // (8 * BLOCK), "rid"), "able")
    small = written(_cells(able, low, width), "cells")
    asked = narrow.where("is_query").select("rid", F.col("id").alias("query_id"), "v")
    queries = written(ordered_rank(asked, [("rid", True)], "number"), "queries")
    found = None
    for at in range(0, max(1, queries.count()), chunk):
        part = written(_scan(small, queries.where((F.col("number") >= at) & (F.col("number") < at + chunk)), low, width, k), "candidates")
        found = part if found is None else found.unionAll(part)
    found = written(_reaching(found, _kth(found, "least", k)).withColumn(
        "place", F.row_number().over(W.partitionBy("query").orderBy(F.desc("most"), "rid"))), "candidates")
    first = written(_scored(found.where(F.col("place") <= FIRST * k), able, queries), "read")
    rest = _reaching(found.where(F.col("place") > FIRST * k), _kth(first, "score", k))
    read = first.unionAll(_scored(rest, able, queries))
    rank = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "rid"))
    best = read.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.join(queries.select(F.col("rid").alias("query"), "query_id"), "query").select("query_id", "rank", F.col("id").alias(id_col), "score")
