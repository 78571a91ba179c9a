"""Set predicates with SQL's null semantics, planned as ordinary shuffle joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_in(df: DataFrame, col: Column, values: DataFrame, value_col: str) -> DataFrame:
    """Rows of ``df`` where ``col NOT IN (SELECT value_col FROM values)`` is TRUE.

    SQL: TRUE when the subquery is empty; otherwise only for a non-null ``col``
    that matches no value, and never once the subquery holds a null. Spark would
    plan NOT IN as a null-aware anti join, which must broadcast the subquery (and
    degrades to a nested-loop join when it is too big). Here the match test is a
    plain left-anti join (sort-merge or hash, chosen by size) and the two null
    rules are uncorrelated EXISTS scalars evaluated once.
    """
    v = values.select(F.col(value_col).alias("_nin_v"))
    empty = ~v.select(F.lit(1)).limit(1).exists()
    has_null = v.filter(F.col("_nin_v").isNull()).select(F.lit(1)).limit(1).exists()
    probe = df.withColumn("_nin_k", col)
    unmatched = probe.join(v.filter(F.col("_nin_v").isNotNull()),
                           probe._nin_k == F.col("_nin_v"), "left_anti")
    keep = empty | (F.col("_nin_k").isNotNull() & ~has_null)
    return unmatched.filter(keep).drop("_nin_k")
