"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.llm.common import written


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, label): label is the smallest node of the component. edges: (u, v), any direction; loops are ignored;
    rows: a bound of their number, if known.

    Every step is a table in the shared folder. The smallest neighbours are written before they are joined, so that
    both sides of the join are shuffled and AQE can split the rows of a node with very many edges.
    """
    edges = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", rows)
    state = fingerprint(edges)
    while n := state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star", 2 * n)
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "large-star", 2 * n)
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "star", 2 * n)
        small = large.join(least, "u").select("u", "v", "m")
        edges = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = written(edges, "small-star", 2 * n)
        before, state = state, fingerprint(edges)
        if before == state:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")).first()
    return row.n, row.x
