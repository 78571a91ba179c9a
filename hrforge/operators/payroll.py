"""Deductions, overtime bonus and the monthly payroll run, for all employees.

Money is exact (see ``hrforge.functions.money``): the reference holds salary,
rate, bonus and deductions in ``DECIMAL(10,10)`` variables, which overflow for any
real salary, so only the exact computation is offered for those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrforge.functions.dates import (as_date, earlier_date, in_month, later_date,
                                     month_end, month_start)
from hrforge.functions.money import cents, from_cents, hundredths, rounded_quotient
from hrforge.functions.text import ci_eq
from hrforge.operators.flags import part_time, ranked_roles
from hrforge.operators.ledger import UNPAID
from hrforge.operators.ranges import drop_points_in_ranges
from hrforge.plans.ids import assign_ids, max_id
from hrforge.plans.outputs import Outputs
from hrforge.sources.schemas import SCHEMAS

FULL_DAY_MINUTES = 480      # fixed values of the reference: 8-hour day,
WORK_DAYS_PER_MONTH = 22    # 22 working days per month


def _deduction_cols() -> list[str]:
    return [f.name for f in SCHEMAS["deduction"].fields]


def _finish_deductions(new: DataFrame, deduction: DataFrame, order: list[str]) -> DataFrame:
    for f in SCHEMAS["deduction"].fields:
        if f.name not in new.columns and f.name != "deduction_id":
            new = new.withColumn(f.name, F.lit(None).cast(f.dataType))
    new = assign_ids(new, order, "deduction_id", max_id(deduction, "deduction_id"))
    return new.select(*_deduction_cols())


def missing_hour_deductions(attendance: DataFrame, employee: DataFrame,
                            deduction: DataFrame, as_of, mode: str = "as_written",
                            all_rows: bool = False) -> DataFrame:
    """``Deduction_hours`` for every employee.

    Per employee, the earliest of this month's attendance rows (by date, then id)
    with total_duration < 480 and no deduction yet pointing at it, charged
    (salary / 22 / 8) x (480 - minutes) / 60, rounded to cents. One row per
    employee per run (``all_rows=True`` charges every such row). The type is
    written ``missing_hours`` (the spelling the CHECK allows). As written
    part-timers are charged too; ``corrected`` skips them.
    """
    day = as_date(as_of)
    att = attendance.filter(in_month(F.col("date"), as_of)
                            & (F.col("total_duration") < FULL_DAY_MINUTES))
    charged = deduction.filter(F.col("attendance_id").isNotNull()).select(
        F.col("attendance_id").alias("_aid"))
    open_rows = att.join(charged, att.attendance_id == charged._aid, "left_anti")
    if not all_rows:
        # argmin per employee as a partial aggregate: map-side reduction first
        open_rows = (open_rows.groupBy("emp_id")
                     .agg(F.min(F.struct("date", "attendance_id", "total_duration")).alias("_f"))
                     .select("emp_id", F.col("_f.attendance_id").alias("attendance_id"),
                             F.col("_f.total_duration").alias("total_duration")))
    emp = employee.select("employee_id", "salary", "type_of_contract")
    if mode != "as_written":
        emp = emp.filter(~part_time(F.col("type_of_contract")))
    rows = open_rows.join(emp, open_rows.emp_id == emp.employee_id, "inner")
    deficit = (F.lit(FULL_DAY_MINUTES) - F.col("total_duration")).cast("bigint")
    amount = from_cents(rounded_quotient(cents(F.col("salary")) * deficit,
                                         WORK_DAYS_PER_MONTH * 8 * 60))
    new = rows.select("emp_id", day.alias("date"), amount.alias("amount"),
                      F.lit("missing_hours").alias("type"), F.lit("pending").alias("status"),
                      F.col("attendance_id").cast("bigint").alias("attendance_id"))
    return _finish_deductions(new, deduction, ["emp_id", "attendance_id"])


def missing_day_deductions(attendance: DataFrame, employee: DataFrame, ledger: DataFrame,
                           deduction: DataFrame, as_of, mode: str = "as_written") -> DataFrame:
    """``Deduction_days`` for every employee.

    salary / 22 (rounded to cents) for each of this month's 'absent' rows not inside
    one of the employee's unpaid leaves. As written any unpaid leave counts
    (approved or not) and rows already charged are charged again; ``corrected``
    counts approved unpaid leave only and skips rows that already have a deduction.
    """
    day = as_date(as_of)
    absent = attendance.filter(in_month(F.col("date"), as_of) & ci_eq("status", "absent"))
    unpaid = ledger.filter(F.col("kind") == F.lit(UNPAID))
    if mode != "as_written":
        unpaid = unpaid.filter(ci_eq("final_approval_status", "approved"))
        charged = deduction.filter(F.col("attendance_id").isNotNull()).select(
            F.col("attendance_id").alias("_aid"))
        absent = absent.join(charged, absent.attendance_id == charged._aid, "left_anti")
    free = drop_points_in_ranges(absent, "emp_id", "date", unpaid, "emp_id", "start_date",
                                 "end_date")
    emp = employee.select("employee_id", "salary")
    rows = free.join(emp, free.emp_id == emp.employee_id, "inner")
    amount = from_cents(rounded_quotient(cents(F.col("salary")), WORK_DAYS_PER_MONTH))
    new = rows.select("emp_id", day.alias("date"), amount.alias("amount"),
                      F.lit("missing_days").alias("type"), F.lit("pending").alias("status"),
                      F.lit(None).cast("bigint").alias("unpaid_id"), "attendance_id")
    return _finish_deductions(new, deduction, ["emp_id", "attendance_id"])


def unpaid_leave_deductions(employee: DataFrame, ledger: DataFrame, deduction: DataFrame,
                            as_of, mode: str = "as_written") -> DataFrame:
    """``Deduction_unpaid`` for every employee.

    Picks one approved unpaid leave per employee (highest request id when several)
    and charges days x ROUND(salary / 22, 2) (null salary -> 0).

    As written: the guard is any deduction dated in this month number (any year,
    any employee) -- if one exists nobody is charged; the day count uses the range
    *widened* to the month (earlier start, later end); the row is dated at the
    leave start. ``corrected``: the guard is an existing deduction for the same
    unpaid leave in this month, the range is clipped to the month (leaves outside
    it give nothing), and the row is dated at the first charged day.
    """
    m0, m1 = month_start(as_of), month_end(as_of)
    first, last = F.lit(m0), F.lit(m1)
    up = ledger.filter((F.col("kind") == F.lit(UNPAID))
                       & ci_eq("final_approval_status", "approved"))
    if mode == "as_written":
        month_no = F.month(F.lit(m0))
        blocked = deduction.filter(F.month("date") == month_no).select(F.lit(1)).limit(1)
        up = up.filter(~blocked.exists())
    else:
        done = deduction.filter(ci_eq("type", "unpaid") & in_month(F.col("date"), as_of)
                                & F.col("unpaid_id").isNotNull()).select(
            F.col("unpaid_id").alias("_done"))
        up = (up.join(done, up.request_id == done._done, "left_anti")
              .filter((F.col("start_date") <= last) & (F.col("end_date") >= first)))
    pick = (up.groupBy("emp_id")
            .agg(F.max(F.struct("request_id", "start_date", "end_date")).alias("_p"))
            .select("emp_id", F.col("_p.request_id").alias("request_id"),
                    F.col("_p.start_date").alias("start_date"),
                    F.col("_p.end_date").alias("end_date")))
    emp = employee.select("employee_id", F.coalesce(F.col("salary"), F.lit(0).cast(
        "decimal(10,2)")).alias("_sal"))
    rows = pick.join(emp, pick.emp_id == emp.employee_id, "inner")
    if mode == "as_written":
        real_start = earlier_date(F.col("start_date"), first)
        real_end = later_date(F.col("end_date"), last)
        dated = F.col("start_date")
    else:
        real_start = later_date(F.col("start_date"), first)
        real_end = earlier_date(F.col("end_date"), last)
        dated = real_start
    days = (F.datediff(real_end, real_start) + 1).cast("bigint")
    daily = rounded_quotient(cents(F.col("_sal")), WORK_DAYS_PER_MONTH)
    amount = from_cents(daily * days)
    new = rows.select("emp_id", dated.alias("date"), amount.alias("amount"),
                      F.lit("unpaid").alias("type"), F.lit("pending").alias("status"),
                      F.col("request_id").alias("unpaid_id"),
                      F.lit(None).cast("bigint").alias("attendance_id"))
    return _finish_deductions(new, deduction, ["emp_id", "unpaid_id"])


def overtime_factor(employee_role: DataFrame, role: DataFrame) -> DataFrame:
    """emp_id, percentage_overtime of the employee's top role (lowest rank number,
    ties by role name)."""
    rr = ranked_roles(employee_role, role)
    return (rr.groupBy("emp_id")
            .agg(F.min(F.struct("rank", "role_name", "percentage_overtime")).alias("_t"))
            .select("emp_id", F.col("_t.percentage_overtime").alias("percentage_overtime")))


def bonus_amount(employee: DataFrame, employee_role: DataFrame, role: DataFrame,
                 attendance: DataFrame, as_of=None, from_date=None, to_date=None,
                 mode: str = "as_written") -> DataFrame:
    """``Bonus_amount`` for every employee: employee_id, bonus_amount.

    rate = salary / 22 / 8; bonus = SUM(rate x overtime% x max(minutes - 480, 0)
    / 100) over the month's attendance, null -> 0. As written the hourly rate is
    multiplied by *minutes*; ``corrected`` converts them to hours. The month is
    as_of's; pass from_date/to_date to use an explicit range instead.
    """
    if from_date is not None:
        rng = F.col("date").between(as_date(from_date), as_date(to_date))
    else:
        rng = in_month(F.col("date"), as_of)
    extra = F.when(F.col("total_duration") > FULL_DAY_MINUTES,
                   F.col("total_duration") - FULL_DAY_MINUTES).otherwise(F.lit(0))
    minutes = (attendance.filter(rng).groupBy("emp_id")
               .agg(F.sum(extra.cast("bigint")).alias("_extra")))
    factor = overtime_factor(employee_role, role)
    e = (employee.select("employee_id", "salary")
         .join(factor, F.col("employee_id") == factor.emp_id, "left").drop("emp_id")
         .join(minutes, F.col("employee_id") == minutes.emp_id, "left").drop("emp_id"))
    num = cents(F.col("salary")) * hundredths(F.col("percentage_overtime")) * F.col("_extra")
    denom = WORK_DAYS_PER_MONTH * 8 * 100 * 100
    if mode != "as_written":
        denom *= 60
    bonus = F.coalesce(from_cents(rounded_quotient(num, denom)),
                       F.lit(0).cast("decimal(10,2)"))
    return e.select("employee_id", bonus.alias("bonus_amount"))


def run_payroll(employee: DataFrame, employee_role: DataFrame, role: DataFrame,
                attendance: DataFrame, deduction: DataFrame, payroll: DataFrame,
                from_date, to_date, as_of, mode: str = "as_written") -> Outputs:
    """``Add_Payroll`` for every employee at once.

    Skips employees that already have a payroll row whose from_date is in the same
    month and year as from_date. final = salary + bonus - SUM(pending deductions
    dated in [from_date, to_date]), kept to one decimal (rounded half away from
    zero); bonus and deductions to two. Returns outputs ``payroll`` (new payroll
    rows) and ``deductions`` (new Deduction snapshot with the counted deductions
    finalized), built on first access; both read the same inputs.
    As written the bonus is the as_of month's, counted in minutes; ``corrected``
    counts overtime hours over from_date..to_date.
    """
    f0, t0 = as_date(from_date), as_date(to_date)
    paid = payroll.filter(in_month(F.col("from_date"), from_date)).select(
        F.col("emp_id").alias("_paid"))
    todo = employee.join(paid, employee.employee_id == paid._paid, "left_anti")
    if mode == "as_written":
        bonus = bonus_amount(todo, employee_role, role, attendance, as_of=as_of)
    else:
        bonus = bonus_amount(todo, employee_role, role, attendance,
                             from_date=from_date, to_date=to_date, mode="corrected")
    in_range = F.col("date").between(f0, t0) & ci_eq("status", "pending")
    ded = (deduction.filter(in_range).groupBy("emp_id")
           .agg(F.sum("amount").alias("_ded")))
    rows = (todo.select("employee_id", "salary")
            .join(bonus, "employee_id", "left")
            .join(ded, F.col("employee_id") == ded.emp_id, "left"))
    ded_amt = F.coalesce(F.col("_ded"), F.lit(0)).cast("decimal(12,2)")
    final = (F.col("salary") + F.col("bonus_amount") - ded_amt).cast("decimal(10,1)")
    new = rows.select(
        as_date(as_of).alias("payment_date"), final.alias("final_salary_amount"),
        f0.alias("from_date"), t0.alias("to_date"), F.lit(None).cast("string").alias("comments"),
        F.col("bonus_amount").cast("decimal(10,2)").alias("bonus_amount"),
        ded_amt.cast("decimal(10,2)").alias("deductions_amount"),
        F.col("employee_id").alias("emp_id"))
    def payroll_rows() -> DataFrame:
        rows_ = assign_ids(new, ["emp_id"], "id", max_id(payroll, "id"))
        return rows_.select(*[f.name for f in SCHEMAS["payroll"].fields])

    # Deductions counted by this run become finalized; the rest pass through.
    run_ids = todo.select(F.col("employee_id").alias("_run"))
    touched = deduction.filter(in_range)
    untouched = deduction.filter(~in_range | in_range.isNull())
    flagged = (touched.join(run_ids, touched.emp_id == run_ids._run, "left")
               .withColumn("status", F.when(F.col("_run").isNotNull(), F.lit("finalized"))
                           .otherwise(F.col("status")))
               .select(*_deduction_cols()))
    return Outputs(payroll=payroll_rows,
                   deductions=lambda: untouched.select(*_deduction_cols()).unionByName(flagged))
