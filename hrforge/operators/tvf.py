"""The inline table functions, evaluated for all employees at once.

Each reference function takes one employee id; here the id becomes an optional
``employee_id`` argument, and without it the function answers for everyone (with
``emp_id`` in the output so rows stay attributable).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrforge.functions.dates import in_month, prev_month_start, weekday_name
from hrforge.functions.text import ci, ci_eq, ci_in
from hrforge.operators.ledger import subtype_union


def _only(df: DataFrame, col: str, employee_id: int | None) -> DataFrame:
    return df if employee_id is None else df.filter(F.col(col) == F.lit(employee_id))


def performance_by_semester(performance: DataFrame, employee: DataFrame, semester: str,
                            employee_id: int | None = None) -> DataFrame:
    """Evaluations for one semester (CHAR(3): compared without trailing blanks)."""
    p = _only(performance, "emp_id", employee_id).filter(ci_eq("semester", semester))
    e = employee.select("employee_id", "first_name", "last_name")
    return p.join(e, p.emp_id == e.employee_id, "inner").select(
        "performance_id", "emp_id", "first_name", "last_name", "rating", "comments",
        "semester")


def attendance_this_month(attendance: DataFrame, employee: DataFrame, as_of,
                          employee_id: int | None = None) -> DataFrame:
    """This month's rows except absences on the employee's own day off.

    ``NOT (status = 'absent' AND weekday = day_off)`` keeps SQL's three-valued
    logic: an absent row of an employee with no day off is dropped too.
    """
    a = _only(attendance, "emp_id", employee_id).filter(in_month(F.col("date"), as_of))
    e = employee.select("employee_id", "official_day_off")
    keep = ~((ci("status") == F.lit("absent"))
             & (F.lower(weekday_name(F.col("date"))) == ci("official_day_off")))
    return a.join(e, a.emp_id == e.employee_id, "inner").filter(keep).select(
        "attendance_id", "emp_id", "date", "check_in_time", "check_out_time",
        "total_duration", "status")


def payroll_last_month(payroll: DataFrame, as_of, employee_id: int | None = None) -> DataFrame:
    """Payroll rows paid in the calendar month before ``as_of``."""
    prev = prev_month_start(as_of)
    return _only(payroll, "emp_id", employee_id).filter(
        in_month(F.col("payment_date"), prev)).select(
        "id", "emp_id", "payment_date", "final_salary_amount", "from_date", "to_date",
        "comments", "bonus_amount", "deductions_amount")


def deductions_from_attendance(deduction: DataFrame, attendance: DataFrame, month: int,
                               employee_id: int | None = None,
                               mode: str = "as_written") -> DataFrame:
    """Attendance-linked deductions of a month number (any year).

    As written the filter reads ``emp AND month AND type='missing days' OR
    type='missing hours'``: the OR arm ignores employee and month. ``corrected``
    parenthesises it. Either way both spellings of each type are accepted (the
    writer uses ``missing_hours``; the reader looked for ``missing hours``).
    """
    days = ci_in("type", ["missing days", "missing_days"])
    hours = ci_in("type", ["missing hours", "missing_hours"])
    emp = F.lit(True) if employee_id is None else F.col("emp_id") == F.lit(employee_id)
    mon = F.month("date") == F.lit(month)
    cond = ((emp & mon & days) | hours) if mode == "as_written" else (emp & mon & (days | hours))
    d = deduction.filter(cond)
    a = attendance.select(F.col("attendance_id").alias("_aid"))
    return d.join(a, d.attendance_id == a._aid, "inner").select(
        "deduction_id", "emp_id", "date", "amount", "type", "status", "attendance_id")


def leave_status_this_month(leave: DataFrame, annual_leave: DataFrame,
                            accidental_leave: DataFrame, as_of,
                            employee_id: int | None = None) -> DataFrame:
    """Annual and accidental requests made this month, with their status."""
    subs = subtype_union(annual_leave, accidental_leave, None, None, None, kinds=(0, 1))
    subs = _only(subs.select("emp_id", "request_id").distinct(), "emp_id", employee_id)
    lv = leave.filter(in_month(F.col("date_of_request"), as_of))
    return subs.join(lv, "request_id", "inner").select(
        "emp_id", "request_id", "date_of_request",
        F.col("final_approval_status").alias("status"))
