"""The leave ledger: one relation over the five leave subtypes.

``Leave`` is a supertype whose five subtype tables share ``request_id``. The
reference rebuilds ``UNION`` of (emp_ID, request_ID) over the subtypes in several
places; here it is built once, tagged with the subtype ``kind`` and joined to
``Leave``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrforge.functions.dates import overlaps
from hrforge.functions.text import ci_in

# Subtype codes (fixed values).
ANNUAL, ACCIDENTAL, MEDICAL, UNPAID, COMPENSATION = 0, 1, 2, 3, 4
KIND_NAMES = {ANNUAL: "annual", ACCIDENTAL: "accidental", MEDICAL: "medical",
              UNPAID: "unpaid", COMPENSATION: "compensation"}


def subtype_union(annual: DataFrame, accidental: DataFrame, medical: DataFrame,
                  unpaid: DataFrame, compensation: DataFrame,
                  kinds: tuple[int, ...] = (0, 1, 2, 3, 4)) -> DataFrame:
    """Distinct (request_id, emp_id, kind, replacement_emp) over chosen subtypes."""
    parts = []
    for kind, df in ((ANNUAL, annual), (ACCIDENTAL, accidental), (MEDICAL, medical),
                     (UNPAID, unpaid), (COMPENSATION, compensation)):
        if kind not in kinds:
            continue
        repl = F.col("replacement_emp") if "replacement_emp" in df.columns else F.lit(None)
        parts.append(df.select("request_id", "emp_id", F.lit(kind).alias("kind"),
                               repl.cast("bigint").alias("replacement_emp")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # UNION (distinct). Partition on request_id first: the de-duplication and the
    # join to Leave below then reuse that one shuffle on this side.
    return out.repartition("request_id").dropDuplicates()


def leave_ledger(leave: DataFrame, annual: DataFrame, accidental: DataFrame,
                 medical: DataFrame, unpaid: DataFrame, compensation: DataFrame,
                 kinds: tuple[int, ...] = (0, 1, 2, 3, 4)) -> DataFrame:
    """request_id, kind, emp_id, replacement_emp + the Leave columns."""
    subs = subtype_union(annual, accidental, medical, unpaid, compensation, kinds)
    return subs.join(leave, "request_id", "inner").select(
        "request_id", "kind", "emp_id", "replacement_emp", "date_of_request", "start_date",
        "end_date", "num_days", "final_approval_status")


def ledger_from(t, kinds: tuple[int, ...] = (0, 1, 2, 3, 4)) -> DataFrame:
    """Ledger from a table accessor (``hrforge.sources.fixtures.Tables``)."""
    return leave_ledger(t.leave, t.annual_leave, t.accidental_leave, t.medical_leave,
                        t.unpaid_leave, t.compensation_leave, kinds)


def blocking_leaves(ledger: DataFrame, statuses=("approved", "pending")) -> DataFrame:
    """Ledger rows that count for ``Is_On_Leave`` (approved or pending as written)."""
    return ledger.filter(ci_in("final_approval_status", list(statuses)))


def on_leave_ids(ledger: DataFrame, from_date, to_date,
                 statuses=("approved", "pending")) -> DataFrame:
    """Distinct emp_id on leave at some day of a constant range [from, to].

    The range is a literal, so the overlap filter runs before any shuffle and the
    distinct is partially aggregated on the map side: an employee with many leave
    rows shrinks to one row per partition before the exchange.
    """
    return (blocking_leaves(ledger, statuses)
            .filter(overlaps(F.lit(from_date), F.lit(to_date), F.col("start_date"),
                             F.col("end_date")))
            .select("emp_id").where(F.col("emp_id").isNotNull()).distinct())
