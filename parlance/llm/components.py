"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parlance.llm.common import written


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Links (a, b) between bigint nodes to (node, root), with root < node, for all nodes but the roots.

    The root is the smallest node of its component. Each round joins every link with the
    smallest neighbour of its nodes, found by a combined aggregation; Spark splits the join of a hub. The
    number of rounds grows with the logarithm of the number of nodes. Links are written after each
    round, so a lost executor costs one round; only a count and a checksum reach the driver.
    """
    edges = written(_directed(links.selectExpr("greatest(a, b) AS a", "least(a, b) AS b")), "links")
    signature = None
    for _ in range(max_rounds):
        found = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(found) == signature:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        signature = tuple(found)
        edges = written(_small_star(_large_star(edges)), "links")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _directed(links: DataFrame) -> DataFrame:
    return links.where("a != b").select("a", "b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.select("a", "b").unionAll(edges.selectExpr("b AS a", "a AS b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("a_"), F.least("a", "m").alias("m"))
    linked = both.where("b > a").join(least, F.col("a") == F.col("a_")).selectExpr("b AS a", "m AS b")
    return _directed(linked)


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    smaller = edges.join(least.withColumnRenamed("a", "a_"), F.col("a") == F.col("a_")).selectExpr("b AS a", "m AS b")
    return _directed(smaller.unionAll(least.selectExpr("a", "m AS b")))
