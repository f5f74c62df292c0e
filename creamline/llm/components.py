"""Connected components of an edge table in rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creamline.llm.common import written


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")).first()
    return row.n, row.x


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (a, b) between different nodes; root is the smallest node reachable.

    Every round hangs each node's larger neighbours, then its smaller ones, on its smallest neighbour, until
    nothing changes. A round's edges are written, so that lineage stays short; only two numbers reach the driver.
    The minimum of a node is combined before its shuffle, written and joined back, so that the join of a node with very
    many edges can be split: no node's edges are gathered.
    An empty table of edges gives an empty result.
    """
    now = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    )
    mark = _mark(now)
    while mark[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        below = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(below, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        after = written(small.unionAll(below.select("hi", F.col("m").alias("lo"))).distinct())
        mark, before = _mark(after), mark
        now = after
        if mark == before:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    )
