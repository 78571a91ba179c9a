"""Connected components by large-star and small-star steps.

A step connects every node's neighbours to the smallest one of them. The number of steps
grows with the logarithm of the longest path, and several run in one job, so that a chain of
a few dozen links takes two or three jobs, and links that are stars already take none. Only
the test whether any component is not a star yet reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrforge.session import checkpoint_dir

#: Pairs of steps that one job runs, and the most jobs.
PAIRS, JOBS = 2, 40


def _star(links: DataFrame, large: bool) -> DataFrame:
    if large:
        near = links.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                              F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("x")).select("x.*")
    else:
        near = links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
    met = near.join(least, "u")
    # the larger neighbours of u, or all of its (smaller) neighbours and u itself
    moved = met.filter(F.col("v") > F.col("u")).select("v", "low") if large else met.select(
        F.explode(F.array("u", "v")).alias("v"), "low")
    return moved.filter(F.col("v") > F.col("low")).select(F.col("low").alias("a"), F.col("v").alias("b")).distinct()


def _settled(links: DataFrame) -> bool:
    """Is every component a star, that is, does no node have two roots or a root that has one?"""
    ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(0).alias("up")),
                                          F.struct(F.col("b").alias("node"), F.lit(1).alias("up")))).alias("x")).select("x.*")
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("root"))
    return seen.filter((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("root") == 0))).isEmpty()


def component_roots(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b) that is not itself the smallest of its
    component; ``root`` is the smallest one."""
    checkpoint_dir(links.sparkSession)
    links = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for _ in range(JOBS):
        if _settled(links):
            return links.select(F.col("b").alias("node"), F.col("a").alias("root"))
        for _ in range(PAIRS):
            links = _star(_star(links, True), False)
        links = links.checkpoint()
    raise RuntimeError(f"components not settled in {JOBS} jobs")
