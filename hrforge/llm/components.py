"""Connected components over a table of links (large-star and small-star steps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrforge.llm.common import table

ROUNDS = 60


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect each node's larger (``large``), or smaller, neighbours to its smallest one."""
    if large:
        around = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        around = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    met = around.join(least, "u")
    if large:
        out = met.filter("v > u").select("v", "m")
    else:
        out = met.select("v", "m").unionByName(least.select(F.col("u").alias("v"), "m"))
    return out.filter("v != m").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links(a, b)`` but the roots themselves; a root is the
    smallest node of its component. Each round is written once in the shared folder, and
    the number of rounds grows with the logarithm of the longest path."""
    edges = table(links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(edges)
    for _ in range(ROUNDS):
        if not mark[0]:
            break
        edges = table(_star(_star(edges, True), False), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components not settled in {ROUNDS} rounds")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
