"""The reference's scalar helper functions, evaluated set-wise.

Each ``fn(@id, ...) -> BIT`` becomes a boolean column computed by a join over all
probe rows at once, never a per-row UDF (which Catalyst could not see into).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hrforge.functions.dates import earlier_date, later_date
from hrforge.functions.text import ci, ci_eq, ci_in
from hrforge.operators.ledger import COMPENSATION, UNPAID, blocking_leaves, on_leave_ids
from hrforge.operators.ranges import Intervals, overlap_flags

# ---------------------------------------------------------------- logins


def login_attempt_flags(attempts: DataFrame, employee: DataFrame,
                        hr_only: bool = False) -> DataFrame:
    """attempt_id, employee_id, is_valid: does an employee with that id and
    password exist (and, for HR logins, work in the HR department)."""
    emp = employee
    if hr_only:
        emp = emp.filter(ci_eq("dept_name", "HR"))
    keys = (emp.select(F.col("employee_id").alias("_id"), ci("password").alias("_pw"))
            .dropDuplicates().withColumn("_hit", F.lit(True)))
    a = attempts.withColumn("_apw", ci("password"))
    out = a.join(keys, (a.employee_id == keys._id) & (a._apw == keys._pw), "left")
    return out.select("attempt_id", "employee_id",
                      F.coalesce(F.col("_hit"), F.lit(False)).alias("is_valid"))


# ---------------------------------------------------------------- leave overlap


def flag_on_leave_today(probes: DataFrame, ledger: DataFrame, day, emp_col: str,
                        flag: str = "is_on_leave",
                        statuses=("approved", "pending")) -> DataFrame:
    """``Is_On_Leave(emp, day, day)`` for every probe row (constant day)."""
    ids = on_leave_ids(ledger, day, day, statuses).select(
        F.col("emp_id").alias("_leave_emp"), F.lit(True).alias("_leave_hit"))
    out = probes.join(ids, probes[emp_col] == ids._leave_emp, "left")
    return (out.withColumn(flag, F.coalesce(F.col("_leave_hit"), F.lit(False)))
            .drop("_leave_emp", "_leave_hit"))


def on_leave_intervals(ledger: DataFrame, statuses=("approved", "pending")) -> Intervals:
    """The leaves that ``Is_On_Leave`` looks at."""
    return Intervals(blocking_leaves(ledger, statuses), "emp_id", "start_date", "end_date")


def replacing_intervals(replacements: DataFrame, mode: str = "as_written") -> Intervals:
    """The ranges in which an employee replaces someone (as emp2_id).

    As written, the function declares (employee, end, start) but is called with
    (employee, start, end): inside it the range is reversed, so a replacement that
    lies strictly inside the requested range is missed. ``corrected`` uses the
    range the caller meant.
    """
    return Intervals(replacements, "emp2_id", "from_date", "to_date", swapped=mode == "as_written")


def flag_on_leave_range(probes: DataFrame, ledger: DataFrame, emp_col: str, from_col: str,
                        to_col: str, flag: str = "is_on_leave",
                        statuses=("approved", "pending")) -> DataFrame:
    """``Is_On_Leave(emp, from, to)`` with a per-row range, see ``ranges``."""
    return overlap_flags(probes, emp_col, from_col, to_col, {flag: on_leave_intervals(ledger, statuses)})


def replacement_is_free(probes: DataFrame, replacements: DataFrame, emp_col: str,
                        start_col: str, end_col: str, mode: str = "as_written",
                        flag: str = "is_free") -> DataFrame:
    """``checkingifreplacingsomeoneelse``: 1 when the employee is not already a
    replacer in an overlapping range; a null employee gives 0."""
    out = overlap_flags(probes, emp_col, start_col, end_col, {flag: replacing_intervals(replacements, mode)})
    return out.withColumn(flag, F.col(emp_col).isNotNull() & ~F.col(flag))


def flag_replacement(probes: DataFrame, ledger: DataFrame, replacements: DataFrame, emp_col: str,
                     start_col: str, end_col: str, mode: str, on_leave: str, free: str) -> DataFrame:
    """Both tests of a replacement at once: on leave in the range, and free of another
    replacement in it."""
    out = overlap_flags(probes, emp_col, start_col, end_col,
                        {on_leave: on_leave_intervals(ledger), free: replacing_intervals(replacements, mode)})
    return out.withColumn(free, F.col(emp_col).isNotNull() & ~F.col(free))


# ---------------------------------------------------------------- role / employee flags


def flag_dean_or_vice(probes: DataFrame, employee_role: DataFrame, emp_col: str,
                      flag: str = "is_dean_or_vice") -> DataFrame:
    ids = (employee_role.filter(ci_in("role_name", ["Dean", "Vice Dean"]))
           .select(F.col("emp_id").alias("_d")).distinct().withColumn("_hit", F.lit(True)))
    out = probes.join(ids, probes[emp_col] == ids._d, "left")
    return out.withColumn(flag, F.coalesce(F.col("_hit"), F.lit(False))).drop("_d", "_hit")


def part_time(contract: Column) -> Column:
    """``CheckIfPartTime``: 1 only for a part_time contract (unknown -> 0)."""
    return F.coalesce(ci(contract) == F.lit("part_time"), F.lit(False))


def is_male(gender: Column) -> Column:
    return F.coalesce(ci(gender) == F.lit("m"), F.lit(False))


def employee_flags(employee: DataFrame) -> DataFrame:
    """employee_id with the per-employee BIT helpers as boolean columns."""
    pt = part_time(F.col("type_of_contract"))
    return employee.select("employee_id", pt.alias("is_part_time"),
                           (~pt).alias("is_not_part_time"),
                           is_male(F.col("gender")).alias("is_male"))


def request_year(leave: DataFrame) -> DataFrame:
    return leave.select("request_id", F.year("date_of_request").alias("request_year"))


def requester_of(leave: DataFrame, ledger: DataFrame, kind: int) -> DataFrame:
    """request_id -> emp_id of a request of one subtype (null for other kinds)."""
    sub = ledger.filter(F.col("kind") == F.lit(kind)).select(
        "request_id", F.col("emp_id").alias("requester_id"))
    return leave.select("request_id").join(sub, "request_id", "left")


def unpaid_requester(leave: DataFrame, ledger: DataFrame) -> DataFrame:
    return requester_of(leave, ledger, UNPAID)


def compensation_requester(leave: DataFrame, ledger: DataFrame) -> DataFrame:
    return requester_of(leave, ledger, COMPENSATION)


def date_choice(leave: DataFrame, month_first, month_last) -> DataFrame:
    """The two date pickers as used by the unpaid deduction."""
    return leave.select(
        "request_id",
        later_date(F.col("end_date"), F.lit(month_last)).alias("later_date"),
        earlier_date(F.col("start_date"), F.lit(month_first)).alias("earlier_date"))


# ---------------------------------------------------------------- ranked availability


def ranked_roles(employee_role: DataFrame, role: DataFrame) -> DataFrame:
    """emp_id, role_name, rank (case-blind join on role_name)."""
    r = role.select(ci("role_name").alias("_rk"), "rank", "percentage_overtime",
                    "percentage_yoe", "base_salary")
    er = employee_role.withColumn("_rk", ci("role_name"))
    return er.join(r, "_rk", "inner").drop("_rk")


def highest_ranked_available(employee: DataFrame, employee_role: DataFrame, role: DataFrame,
                             blocked_ids: DataFrame, department: str | None = None,
                             role_name: str | None = None,
                             by_department: bool = True) -> DataFrame:
    """``GetHighestRankEmployee``: lowest rank number among employees not on leave.

    With ``by_department`` the answer is given for every department at once
    (department_name, employee_id); ties go to the lowest employee id. The argmin
    is a partial aggregate (min over a struct), so a huge department is reduced on
    the map side before the shuffle.
    """
    e = employee.select("employee_id", "dept_name")
    if department is not None:
        e = e.filter(ci_eq("dept_name", department))
    rr = ranked_roles(employee_role, role)
    if role_name is not None:
        rr = rr.filter(ci_eq("role_name", role_name))
    cand = (e.join(rr, e.employee_id == rr.emp_id, "inner")
            .join(blocked_ids, e.employee_id == blocked_ids.emp_id, "left_anti"))
    best = F.min(F.struct(F.col("rank"), F.col("employee_id"))).alias("_b")
    if by_department:
        agg = cand.groupBy(F.col("dept_name").alias("department_name")).agg(best)
        return agg.select("department_name", F.col("_b.employee_id").alias("employee_id"))
    return cand.agg(best).select(F.col("_b.employee_id").alias("employee_id"))
