"""The one-unpaid-leave-per-year rule: each approval can raise the year to exceed.

A request is approved when its year exceeds M, and an approval raises M to its start
year if that is later. So M only changes at rows whose request year and start year both
exceed it, and between two such rows nothing depends on earlier decisions. M takes a
later year with every change, so the calendar bounds the number of changes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrforge.session import checkpoint_dir

#: Changes of M that one job looks for.
STEPS = 3


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def year_sequence_fold(df: DataFrame, order: list[str], req_year: str, start_year: str,
                       key: str | None = None) -> DataFrame:
    """``df`` with ``approved``: in ``order`` (within ``key`` if given) approve when
    ``req_year > M``; after an approval ``M = max(M, start_year)``; ``M`` starts at the
    ``_m0`` column (one value per key). ``key=None`` is one global sequence (the rule as
    written); a key restarts it per employee.

    A step finds, for every key at once, the next row that changes M: the first one behind
    the last change whose years both exceed M. That is a minimum, reduced on the map side, so
    a hot key or the one global sequence is no task of its own. Only rows that can still
    change M enter the next step. The changes of a key (at most one per start year) are then
    put beside its rows, and each row compares its year with the M in force at its place.
    """
    k = key or "_all"
    rows = df if key else df.withColumn("_all", F.lit(0))
    rows = _written(rows.withColumn("_place", F.struct(*order)).withColumn(
        "_both", F.when(F.col(req_year).isNotNull() & F.col(start_year).isNotNull(),
                        F.least(req_year, start_year))), "years")

    def one(small: DataFrame) -> DataFrame:
        # a single sequence has one row here, and its rows must not meet in one task
        return small if key else F.broadcast(small)

    def after(candidates: DataFrame, state: DataFrame) -> DataFrame:
        s = state.select(F.col(k).alias("_k"), F.col("_m").alias("_in"), F.col("_at").alias("_from"))
        return (candidates.join(one(s), candidates[k] == s["_k"])
                .filter((F.col("_both") > F.col("_in")) & (F.col("_from").isNull() | (F.col("_place") > F.col("_from"))))
                .drop("_k", "_in", "_from"))

    none = F.lit(None).cast(rows.schema["_place"].dataType)
    start = rows.groupBy(k).agg(F.max("_m0").cast("long").alias("_m")).withColumn("_at", none)
    changes, state, candidates = start, start, rows.select(k, "_place", "_both", F.col(start_year).alias("_to"))
    while state is start or not state.isEmpty():
        found, last = None, state
        for _ in range(STEPS):
            last = (after(candidates, last).groupBy(k).agg(F.min(F.struct("_place", "_to")).alias("_n"))
                    .select(k, F.col("_n._to").cast("long").alias("_m"), F.col("_n._place").alias("_at")))
            found = last if found is None else found.unionByName(last)
        found = _written(found, "years-n")
        changes = changes.unionByName(found)
        latest = found.groupBy(k).agg(F.max("_m").alias("_m"), F.max("_at").alias("_at"), F.count(F.lit(1)).alias("_n"))
        state = latest.filter(F.col("_n") == STEPS).drop("_n")  # the others have found all their changes
        candidates = after(candidates, state)
    in_force = changes.groupBy(F.col(k).alias("_k")).agg(F.collect_list(F.struct("_at", "_m")).alias("_changes"))
    # M rises with every change, so the largest one before the row is the last one
    m = F.array_max(F.transform(F.filter("_changes", lambda c: c["_at"].isNull() | (c["_at"] < F.col("_place"))), lambda c: c["_m"]))
    out = rows.join(one(in_force), rows[k] == in_force["_k"]).withColumn(
        "approved", F.coalesce(F.col(req_year) > m, F.lit(False)))
    return out.select(*df.columns, "approved")
