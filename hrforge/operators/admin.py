"""Admin batch operators: each returns the table's new snapshot or the rows to add.

Snapshots are built so that only the rows a procedure can touch take part in a
join; untouched rows pass straight through (a filter and a union), so a
month-scoped change does not shuffle years of history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrforge.functions.dates import as_date, duration_minutes, in_month, weekday_name
from hrforge.functions.money import cents, from_cents, hundredths, rounded_quotient
from hrforge.functions.text import ci, ci_eq
from hrforge.operators.flags import flag_on_leave_today, ranked_roles
from hrforge.operators.quality import fill_defaults
from hrforge.operators.ranges import drop_points_in_ranges
from hrforge.operators.setops import not_in
from hrforge.plans.ids import assign_ids, max_id
from hrforge.sources.schemas import SCHEMAS


def _cols(table: str) -> list[str]:
    return [f.name for f in SCHEMAS[table].fields]


def expire_documents(document: DataFrame, as_of) -> DataFrame:
    """status := 'expired' where expiry_date <= as_of."""
    return document.withColumn(
        "status", F.when(F.col("expiry_date") <= as_date(as_of), F.lit("expired"))
        .otherwise(F.col("status")))


def drop_resigned_deductions(deduction: DataFrame, employee: DataFrame) -> DataFrame:
    """Delete deductions of resigned employees (a null emp_id row stays, as with IN)."""
    resigned = employee.filter(ci_eq("employment_status", "resigned")).select(
        F.col("employee_id").alias("_r"))
    return deduction.join(resigned, deduction.emp_id == resigned._r, "left_anti")


def refresh_employment_status(employee: DataFrame, ledger: DataFrame, as_of,
                              mode: str = "as_written") -> DataFrame:
    """onleave when on leave on as_of, else active.

    As written, a pending leave counts as on leave and resigned or notice-period
    staff are turned active too. ``corrected``: only approved leave counts and
    resigned / notice_period rows are left alone.
    """
    statuses = ("approved", "pending") if mode == "as_written" else ("approved",)
    flagged = flag_on_leave_today(employee, ledger, as_of, "employee_id", "_on",
                                  statuses)
    new = F.when(F.col("_on"), F.lit("onleave")).otherwise(F.lit("active"))
    if mode != "as_written":
        new = F.when(ci("employment_status").isin("resigned", "notice_period"),
                     F.col("employment_status")).otherwise(new)
    return flagged.withColumn("employment_status", new).select(*_cols("employee"))


def initiate_attendance(attendance: DataFrame, employee: DataFrame, as_of) -> DataFrame:
    """New 'absent' rows for employees with no attendance row on as_of.

    ``employee_id NOT IN (emp_ids with a row today)`` keeps its null-aware meaning
    (one null emp_id among today's rows means no row qualifies) without a
    broadcast null-aware anti join (see ``setops.not_in``). Ids continue from
    max(attendance_id) in employee order.
    """
    day = as_date(as_of)
    today = attendance.filter(F.col("date") == day).select("emp_id")
    new = not_in(employee, F.col("employee_id"), today, "emp_id").select(
        F.col("employee_id").alias("emp_id"), day.alias("date"),
        F.lit(None).cast("timestamp_ntz").alias("check_in_time"),
        F.lit(None).cast("timestamp_ntz").alias("check_out_time"),
        F.lit(None).cast("int").alias("total_duration"),
        F.lit(None).cast("string").alias("status"))
    new = fill_defaults(new, "attendance")
    new = assign_ids(new, ["emp_id"], "attendance_id", max_id(attendance, "attendance_id"))
    return new.select(*_cols("attendance"))


def upsert_attendance(attendance: DataFrame, checkins: DataFrame, as_of) -> DataFrame:
    """Record check-in/out times for as_of: update the day's row(s) to attended, or
    insert a new attended row when the employee has none.

    ``checkins``: emp_id, check_in_time, check_out_time, seq; the latest seq per
    employee wins. Only as_of's rows meet the batch in a join.
    """
    day = as_date(as_of)
    others = attendance.filter(~(F.col("date") == day) | F.col("date").isNull())
    todays = attendance.filter(F.col("date") == day)
    return _upsert(others, todays, checkins.withColumn("date", day),
                   max_id(attendance, "attendance_id"))


def upsert_attendance_days(attendance: DataFrame, checkins: DataFrame,
                           last_id: int | None = None) -> DataFrame:
    """``Update_Attendance`` for check-ins of any days: checkins carry ``date``.

    Per (emp_id, date) the latest seq wins. Rows of the batch's dates are
    updated (all rows of that employee and day), missing (employee, day) pairs
    are inserted with new ids (ordered by date, employee); other dates pass
    through untouched. The list of touched dates is at most one row per calendar
    day, so it is broadcast. ``attendance`` may be the touched months alone; ``last_id``
    is then the table's largest id.
    """
    days = F.broadcast(checkins.select(F.col("date").alias("_day")).distinct())
    others = attendance.join(days, attendance.date == days._day, "left_anti")
    todays = attendance.join(days, attendance.date == days._day, "left_semi")
    base = max_id(attendance, "attendance_id") if last_id is None else last_id
    return _upsert(others, todays, checkins, base)


def _upsert(others: DataFrame, todays: DataFrame, checkins: DataFrame, base) -> DataFrame:
    latest = (checkins.groupBy("emp_id", "date")
              .agg(F.max(F.struct("seq", "check_in_time", "check_out_time")).alias("_c"))
              .select("emp_id", "date", F.col("_c.check_in_time").alias("_in"),
                      F.col("_c.check_out_time").alias("_out"), F.lit(True).alias("_hit")))
    hit = F.col("_hit").isNotNull()
    updated = (todays.join(latest, ["emp_id", "date"], "left")
               .withColumn("status", F.when(hit, F.lit("attended")).otherwise(F.col("status")))
               .withColumn("check_in_time", F.when(hit, F.col("_in"))
                           .otherwise(F.col("check_in_time")))
               .withColumn("check_out_time", F.when(hit, F.col("_out"))
                           .otherwise(F.col("check_out_time"))))
    updated = updated.withColumn(
        "total_duration", duration_minutes(F.col("check_in_time"), F.col("check_out_time")))
    have = todays.select("emp_id", "date").where(F.col("emp_id").isNotNull())
    inserts = (latest.join(have, ["emp_id", "date"], "left_anti")
               .select("emp_id", "date", F.col("_in").alias("check_in_time"),
                       F.col("_out").alias("check_out_time"),
                       F.lit("attended").alias("status")))
    inserts = inserts.withColumn(
        "total_duration", duration_minutes(F.col("check_in_time"), F.col("check_out_time")))
    inserts = assign_ids(inserts, ["date", "emp_id"], "attendance_id", base)
    cols = _cols("attendance")
    return others.select(*cols).unionByName(updated.select(*cols)).unionByName(
        inserts.select(*cols))


def holiday_dates(holiday: DataFrame) -> DataFrame:
    """Distinct calendar dates covered by any holiday (bounded by the calendar)."""
    return (holiday.filter(F.col("from_date") <= F.col("to_date"))
            .select(F.explode(F.sequence("from_date", "to_date")).alias("_hd")).distinct())


def drop_holiday_attendance(attendance: DataFrame, holiday: DataFrame) -> DataFrame:
    """Delete attendance on any date inside a holiday range.

    Expanding the holidays into dates turns the range test into an equi-join. Ranges are
    cut to the dates that attendance spans, so the broadcast list has at most one row
    per calendar day of that span, however far a holiday's end lies ahead.
    """
    first, last = (attendance.agg(f("date")).scalar() for f in (F.min, F.max))
    near = holiday.filter((F.col("from_date") <= last) & (F.col("to_date") >= first)).select(
        F.greatest("from_date", first).alias("from_date"),
        F.least("to_date", last).alias("to_date"))
    days = F.broadcast(holiday_dates(near))
    return attendance.join(days, attendance.date == days._hd, "left_anti")


def drop_day_off_absences(attendance: DataFrame, employee: DataFrame, as_of,
                          employee_id: int | None = None) -> DataFrame:
    """Delete this month's 'absent' rows that fall on the employee's day off."""
    cand_cond = in_month(F.col("date"), as_of) & ci_eq("status", "absent")
    if employee_id is not None:
        cand_cond = cand_cond & (F.col("emp_id") == F.lit(employee_id))
    cand = attendance.filter(cand_cond)
    rest = attendance.filter(~cand_cond | cand_cond.isNull())
    e = employee.select(F.col("employee_id").alias("_e"), "official_day_off")
    on_day_off = (cand.emp_id == e._e) & (
        F.lower(weekday_name(cand.date)) == ci(e.official_day_off))
    kept = cand.join(e, on_day_off, "left_anti")
    return rest.unionByName(kept)


def drop_leave_attendance(attendance: DataFrame, ledger: DataFrame,
                          employee_id: int | None = None) -> DataFrame:
    """Delete attendance on dates inside the employee's own approved leaves (see ``ranges``)."""
    lv = ledger.filter(ci_eq("final_approval_status", "approved"))
    if employee_id is not None:
        cand = attendance.filter(F.col("emp_id") == F.lit(employee_id))
        rest = attendance.filter(~(F.col("emp_id") == F.lit(employee_id))
                                 | F.col("emp_id").isNull())
    else:
        cand, rest = attendance, None
    kept = drop_points_in_ranges(cand, "emp_id", "date", lv, "emp_id", "start_date", "end_date")
    return kept if rest is None else rest.unionByName(kept)


def append_rows(table: DataFrame, batch: DataFrame, table_name: str, id_col: str,
                order_cols: list[str]) -> DataFrame:
    """INSERT ... VALUES for a batch: defaults filled, ids continue from max(id)."""
    cols = _cols(table_name)
    b = batch
    for f in SCHEMAS[table_name].fields:
        if f.name not in b.columns:
            b = b.withColumn(f.name, F.lit(None).cast(f.dataType))
    b = fill_defaults(b.drop(id_col), table_name)
    b = assign_ids(b, order_cols, id_col, max_id(table, id_col))
    return table.select(*cols).unionByName(b.select(*cols))


def append_replacements(replacements: DataFrame, batch: DataFrame) -> DataFrame:
    """``Replace_Employee`` for a batch (emp1_id, emp2_id, from_date, to_date, seq);
    no overlap check, as in the reference."""
    return append_rows(replacements, batch, "employee_replace_employee", "table_id", ["seq"])


def append_holidays(holiday: DataFrame, batch: DataFrame) -> DataFrame:
    """``Add_Holiday`` for a batch (holiday_name, from_date, to_date, seq)."""
    return append_rows(holiday, batch, "holiday", "holiday_id", ["seq"])


def recompute_salaries(employee: DataFrame, employee_role: DataFrame,
                       role: DataFrame) -> DataFrame:
    """salary = base + (YOE% / 100 x years x base) of the employee's lowest-rank
    role (ties: lowest role name). Employees without a role keep their salary; a
    null percentage or null years gives a null salary, as the UPDATE does.

    Exact: cents = round_half_away(base_cents x (10000 + pct_hundredths x years)
    / 10000).
    """
    rr = ranked_roles(employee_role, role)
    top = (rr.groupBy("emp_id")
           .agg(F.min(F.struct("rank", "role_name", "base_salary", "percentage_yoe"))
                .alias("_t"))
           .select(F.col("emp_id").alias("_e"), F.col("_t.base_salary").alias("_base"),
                   F.col("_t.percentage_yoe").alias("_pct"), F.lit(True).alias("_has")))
    e = employee.join(top, employee.employee_id == top._e, "left")
    num = cents(F.col("_base")) * (F.lit(10000) + hundredths(F.col("_pct"))
                                   * F.col("years_of_experience"))
    new_salary = from_cents(rounded_quotient(num, 10000))
    return e.withColumn("salary", F.when(F.col("_has").isNotNull(), new_salary)
                        .otherwise(F.col("salary"))).select(*_cols("employee"))
