"""Range tests of one employee's dates, by running extremes over their ends.

The reference's overlap test is four BETWEENs joined by OR: an end of one range
lies in the other range. A range with ``from <= to`` covers its days; a reversed
or half-null range covers none, but its non-null ends still count as points. So a
tested range overlaps some interval when

* one of its ends lies in an interval: of the intervals that start no later, the one that
  reaches furthest reaches it; or
* it covers an end of an interval: the first interval end from its start on is no later
  than its end.

Both are running extremes over the ends of the intervals and of the tested ranges in date
order: a range has two rows however long it is, and no pairs of one employee are formed.
Before rows of an employee meet, both sides are reduced on the map side: intervals to one row
per (employee, end date) and tested ranges to distinct ones. So a hot employee has as many
rows in the window as the calendar has dates and the batch has different ranges, not as many
as it has rows; the flags are then joined back by (employee, from, to).

Several interval tables can be tested at once: their ends are tagged and share one
exchange, one window and one aggregate.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class Intervals(NamedTuple):
    """A table of dated rows per employee, and whether it is tested with the ends of the
    probe swapped."""

    rows: DataFrame
    emp: str
    first: str
    last: str
    swapped: bool = False


def _interval_ends(tables: list[Intervals]) -> DataFrame:
    """(tag, emp, at, reach): the dates on which intervals start or end, and the last day that
    an interval from there on reaches."""
    parts = [t.rows.where(F.col(t.emp).isNotNull()).select(
        F.lit(tag).alias("_tag"), F.col(t.emp).alias("_e"), F.col(t.first).alias("_i"), F.col(t.last).alias("_j"))
        for tag, t in enumerate(tables)]
    ends = F.array(F.struct(F.col("_i").alias("at"), F.when(F.col("_i") <= F.col("_j"), F.col("_j")).alias("reach")),
                   F.struct(F.col("_j").alias("at"), F.lit(None).cast("date").alias("reach")))
    both = reduce(DataFrame.unionByName, parts).select("_tag", "_e", F.explode(ends).alias("_x"))
    return (both.select("_tag", "_e", F.col("_x.at").alias("_at"), F.col("_x.reach").alias("_reach"))
            .where(F.col("_at").isNotNull()).groupBy("_tag", "_e", "_at").agg(F.max("_reach").alias("_reach")))


def overlap_hits(probes: DataFrame, emp: str, first: str, last: str, tables: list[Intervals]) -> DataFrame:
    """(_e, _f, _t, _hit0, _hit1, ...) of the distinct tested ranges that overlap an interval
    of the same employee in at least one of ``tables``. Null employees never match; an
    unknown comparison is not TRUE."""
    tested = probes.where(F.col(emp).isNotNull()).select(
        F.col(emp).alias("_e"), F.col(first).alias("_f"), F.col(last).alias("_t")).distinct()
    ways = []
    for tag, t in enumerate(tables):
        lo, hi = ("_t", "_f") if t.swapped else ("_f", "_t")
        ways += [F.struct(F.lit(tag).alias("_tag"), F.col(end).alias("_at"), F.col(lo).alias("_lo"), F.col(hi).alias("_hi"))
                 for end in (lo, hi)]
    asked = tested.select("_e", "_f", "_t", F.explode(F.array(*ways)).alias("_x")).select("_e", "_f", "_t", "_x.*").where(
        F.col("_at").isNotNull()).withColumn("_asked", F.lit(True))
    rows = asked.unionByName(_interval_ends(tables), allowMissingColumns=True)
    here = Window.partitionBy("_tag", "_e")  # frames end with all rows of the same date
    reached = F.max("_reach").over(here.orderBy("_at"))
    next_end = F.min(F.when(F.col("_asked").isNull(), F.col("_at"))).over(here.orderBy(F.col("_at").desc()))
    rows = rows.withColumn("_reached", reached).withColumn("_next", next_end).where("_asked")
    covers = (F.col("_at") == F.col("_lo")) & (F.col("_lo") <= F.col("_hi")) & (F.col("_next") <= F.col("_hi"))
    hit = F.coalesce(F.col("_reached") >= F.col("_at"), F.lit(False)) | F.coalesce(covers, F.lit(False))
    return rows.where(hit).groupBy("_e", "_f", "_t").agg(
        *[F.max(F.col("_tag") == tag).alias(f"_hit{tag}") for tag in range(len(tables))])


def overlap_flags(probes: DataFrame, emp: str, first: str, last: str, tables: dict[str, Intervals]) -> DataFrame:
    """``probes`` with a boolean column per entry of ``tables``: does the row's range overlap an
    interval of its employee there?"""
    hits = overlap_hits(probes, emp, first, last, list(tables.values()))
    out = probes.join(hits, (probes[emp] == hits["_e"]) & probes[first].eqNullSafe(hits["_f"])
                      & probes[last].eqNullSafe(hits["_t"]), "left")
    flags = [F.coalesce(F.col(f"_hit{i}"), F.lit(False)).alias(name) for i, name in enumerate(tables)]
    return out.select(*[probes[c] for c in probes.columns], *flags)


def overlapping_keys(probes: DataFrame, key: list[str], p_emp: str, p_from: str, p_to: str,
                     intervals: DataFrame, i_emp: str, i_from: str, i_to: str) -> DataFrame:
    """Distinct ``key`` of probe rows with at least one interval of the same
    employee for which the four-way BETWEEN overlap is TRUE."""
    flagged = overlap_flags(probes.select(*dict.fromkeys([*key, p_emp, p_from, p_to])), p_emp, p_from, p_to,
                            {"_overlaps": Intervals(intervals, i_emp, i_from, i_to)})
    return flagged.where("_overlaps").select(*key).distinct()


def drop_points_in_ranges(points: DataFrame, p_emp: str, p_date: str, intervals: DataFrame,
                          i_emp: str, i_from: str, i_to: str) -> DataFrame:
    """Rows of ``points`` whose date lies in no interval of the same employee
    (``date BETWEEN from AND to``)."""
    starts = (intervals.where(F.col(i_emp).isNotNull() & (F.col(i_from) <= F.col(i_to)))
              .groupBy(F.col(i_emp).alias("_e"), F.col(i_from).alias("_at")).agg(F.max(i_to).alias("_reach")))
    asked = points.where(F.col(p_emp).isNotNull() & F.col(p_date).isNotNull()).select(
        F.col(p_emp).alias("_e"), F.col(p_date).alias("_at")).distinct().withColumn("_asked", F.lit(True))
    rows = asked.unionByName(starts, allowMissingColumns=True)
    reached = F.max("_reach").over(Window.partitionBy("_e").orderBy("_at"))
    inside = rows.withColumn("_reached", reached).where(F.col("_asked") & (F.col("_reached") >= F.col("_at")))
    return points.join(inside, (points[p_emp] == inside["_e"]) & (points[p_date] == inside["_at"]), "left_anti")
