"""Decisions whose outcome depends on earlier decisions of the same batch.

An approved leave uses up balance of its employee and books its replacement, and a
refused one does neither, so a request can depend on any earlier one of the same
employee or the same replacement, and through them on a chain of any length. No window
expresses that, and rounds over all requests would need as many as the longest chain has.
``settle_in_order`` therefore splits the batch into parts that cannot touch each other:

1. Links. An employee links its requests only if together they could exceed its balance; a
   replacement links requests whose dates form one unbroken run. Both are windows over
   narrow rows, without a row per day or per pair.
2. Components of these links, in a number of jobs that grows with the logarithm of the
   longest chain (``plans/components.py``).
3. Settlement. Each component is walked once in (request_id, seq) order by one task, which
   holds the balances used and the dates booked so far and nothing else. Requests without
   links, the bulk of a batch, are components of their own, so they are spread over all tasks.

Greedy decisions in a given order are sequential by nature, so a component is one task's
work: its time is in proportion to the largest component of the batch.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hrforge.plans.components import component_roots
from hrforge.session import checkpoint_dir


class Bookings:
    """Dates (as day numbers) on which one replacement is booked."""

    def __init__(self) -> None:
        self.starts: list[int] = []  # disjoint covered runs, in order
        self.ends: list[int] = []
        self.points: list[int] = []  # first and last days of all bookings, in order

    def add(self, first: int | None, last: int | None) -> None:
        for day in (first, last):
            if day is not None:
                insort(self.points, day)
        if first is None or last is None or first > last:
            return
        i, j = bisect_left(self.ends, first), bisect_right(self.starts, last)
        if i < j:
            first, last = min(first, self.starts[i]), max(last, self.ends[j - 1])
        self.starts[i:j], self.ends[i:j] = [first], [last]

    def _covers(self, day: int | None) -> bool:
        if day is None:
            return False
        i = bisect_right(self.starts, day) - 1
        return i >= 0 and self.ends[i] >= day

    def touch(self, first: int | None, last: int | None) -> bool:
        """Does an end of one range lie in the other one, for any booking?"""
        if self._covers(first) or self._covers(last):
            return True
        if first is None or last is None:
            return False
        i = bisect_left(self.points, first)
        return i < len(self.points) and self.points[i] <= last


#: Columns that the walk reads.
_WALK = ["root", "emp_id", "days", "balance", "ample", "replacement", "first", "last"]


def _walk(reversed_range: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, used, unknown, booked = None, {}, set(), {}
        for batch in batches:
            approved = []
            for i, (root, emp, days, balance, ample, who, first, last) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:8]))):
                if root != at:
                    at, used, unknown, booked = root, defaultdict(int), set(), defaultdict(Bookings)
                if not (ample or days is None or emp in unknown) and days > balance - used[emp]:
                    continue
                if who is not None:
                    if booked[who].touch(*((last, first) if reversed_range else (first, last))):
                        continue
                    booked[who].add(first, last)
                if days is None:
                    unknown.add(emp)
                else:
                    used[emp] += days
                approved.append(i)
            yield batch.select(["seq", "request_id", "emp_id", "days", "balance"]).take(pa.array(approved, pa.int64()))

    return run


def _linked(requests: DataFrame) -> DataFrame:
    """``requests`` with ``ample`` (its employee's balance suffices for all) and the ``seq`` that
    the employee (``by_emp``) and the replacement (``by_run``) link the row with."""
    emp, seq = Window.partitionBy("emp_id"), F.col("seq")
    most = F.sum(F.greatest(F.col("days"), F.lit(0))).over(emp)
    ample = F.col("balance").isNull() | (F.coalesce(most, F.lit(0)) <= F.col("balance"))
    low, high = F.least("start_date", "end_date"), F.greatest("start_date", "end_date")
    place = Window.partitionBy("replacement").orderBy("_low", "seq")
    reach = F.max("_high").over(place.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("_low") > reach), seq)
    no_run = F.col("replacement").isNull() | F.col("_low").isNull()
    r = requests.withColumn("ample", ample).withColumn("by_emp", F.when(F.col("ample"), seq).otherwise(F.min("seq").over(emp)))
    r = r.withColumn("_low", low).withColumn("_high", high).withColumn("_opens", opens)
    run = F.last("_opens", ignorenulls=True).over(place.rowsBetween(Window.unboundedPreceding, 0))
    return r.withColumn("by_run", F.when(no_run, seq).otherwise(run)).drop("_low", "_high", "_opens")


def settle_in_order(requests: DataFrame, reversed_range: bool) -> DataFrame:
    """``seq`` and ``balance_after`` of the approved ones of ``requests`` (seq, request_id,
    emp_id, days, balance, replacement, start_date, end_date; ``seq`` identifies a row).

    In (request_id, seq) order a request is approved unless its days exceed what is
    left of the balance, or an earlier approval booked its replacement in an
    overlapping range (``reversed_range``: tested with its ends swapped). Unknown
    days or an unknown balance pass, and leave an unknown balance.

    ``requests`` is read twice, so callers freeze it first. The result is frozen.
    """
    checkpoint_dir(requests.sparkSession)
    linked = _linked(requests)
    links = linked.select(F.explode(F.array("by_emp", "by_run")).alias("a"), F.col("seq").alias("b"))
    roots = component_roots(links)
    rooted = linked.join(roots, linked["seq"] == roots["node"], "left").withColumn("root", F.coalesce("root", "seq"))
    days = [F.unix_date("start_date").alias("first"), F.unix_date("end_date").alias("last")]
    ids = [F.col(c).cast("long").alias(c) for c in ("request_id", "emp_id", "replacement")]
    walked = (rooted.select("root", "days", "balance", "ample", *days, *ids, "seq")
              .repartition("root").sortWithinPartitions("root", "request_id", "seq").select(*_WALK, "seq", "request_id")
              .mapInArrow(_walk(reversed_range), "seq long, request_id long, emp_id long, days int, balance int"))
    # without a balance nothing is added up, so those requests need not come together
    up_to = (Window.partitionBy("emp_id", F.when(F.col("balance").isNull(), F.col("seq")))
             .orderBy("request_id", "seq").rowsBetween(Window.unboundedPreceding, 0))
    left = F.col("balance") - F.sum("days").over(up_to)
    known = ~F.max(F.col("days").isNull()).over(up_to)
    return walked.select("seq", F.when(known, left).cast("int").alias("balance_after")).checkpoint()
