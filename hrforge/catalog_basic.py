"""Catalog: views, table functions, ledger and computed columns."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hrforge.catalog import AS_OF, register
from hrforge.functions.dates import month_end, month_start, prev_month_start
from hrforge.operators import ledger as L
from hrforge.operators import tvf, views
from hrforge.sources.schemas import HR_TABLES, SCHEMAS

# ---------------------------------------------------------------- views


@register("all_employee_profiles", """
select employee_id, first_name, last_name, gender, email, address, years_of_experience,
       official_day_off, type_of_contract, employment_status, annual_balance, accidental_balance
from employee
""")
def _q(t):
    return views.all_employee_profiles(t.employee)


@register("employees_per_department", """
select dept_name as department_name, count(employee_id) as num_employees
from employee group by dept_name
""")
def _q(t):
    return views.employees_per_department(t.employee)


@register("winter_performance", """
select p.performance_id, p.emp_id, e.first_name, e.last_name, p.rating, p.comments, p.semester
from performance p join employee e on p.emp_id = e.employee_id
where p.semester ilike 'W%'
""")
def _q(t):
    return views.winter_performance(t.performance, t.employee)


@register("rejected_medical_leaves", """
select l.request_id, l.date_of_request, l.start_date, l.end_date, l.num_days,
       l.final_approval_status, m.emp_id, m.insurance_status, m.disability_details, m.type
from medical_leave m join leave l on m.request_id = l.request_id
where lower(l.final_approval_status) = 'rejected'
""")
def _q(t):
    return views.rejected_medical_leaves(t.medical_leave, t.leave)


@register("attendance_yesterday", """
select a.attendance_id, a.emp_id, e.first_name, e.last_name, a.date, a.check_in_time,
       a.check_out_time, a.total_duration, a.status
from attendance a join employee e on a.emp_id = e.employee_id
where a.date = date '2024-01-29'
""")
def _q(t):
    return views.attendance_yesterday(t.between("attendance", month_start(AS_OF), AS_OF), t.employee, AS_OF)


# ---------------------------------------------------------------- table functions


@register("performance_by_semester", """
select p.performance_id, p.emp_id, e.first_name, e.last_name, p.rating, p.comments, p.semester
from performance p join employee e on e.employee_id = p.emp_id
where lower(rtrim(p.semester)) = 'w22'
""")
def _q(t):
    return tvf.performance_by_semester(t.performance, t.employee, "W22")


@register("attendance_this_month", """
select a.attendance_id, a.emp_id, a.date, a.check_in_time, a.check_out_time, a.total_duration, a.status
from attendance a join employee e on e.employee_id = a.emp_id
where month(a.date) = 1 and year(a.date) = 2024
  and not (lower(a.status) = 'absent' and lower(dayname(a.date)) = lower(rtrim(e.official_day_off)))
""")
def _q(t):
    return tvf.attendance_this_month(t.between("attendance", month_start(AS_OF), month_end(AS_OF)), t.employee, AS_OF)


@register("payroll_last_month", """
select id, emp_id, payment_date, final_salary_amount, from_date, to_date, comments,
       bonus_amount, deductions_amount
from payroll
where month(payment_date) = 12 and year(payment_date) = 2023
""")
def _q(t):
    first = prev_month_start(AS_OF)
    return tvf.payroll_last_month(t.between("payroll", first, month_end(first)), AS_OF)


@register("deductions_from_attendance", """
select d.deduction_id, d.emp_id, d.date, d.amount, d.type, d.status, d.attendance_id
from deduction d join attendance a on d.attendance_id = a.attendance_id
where (month(d.date) = 1 and lower(d.type) in ('missing days', 'missing_days'))
   or lower(d.type) in ('missing hours', 'missing_hours')
""")
def _q(t):
    return tvf.deductions_from_attendance(t.deduction, t.attendance, 1)


@register("deductions_from_attendance_employee", """
select d.deduction_id, d.emp_id, d.date, d.amount, d.type, d.status, d.attendance_id
from deduction d join attendance a on d.attendance_id = a.attendance_id
where (d.emp_id = 7 and month(d.date) = 1 and lower(d.type) in ('missing days', 'missing_days'))
   or lower(d.type) in ('missing hours', 'missing_hours')
""")
def _q(t):
    return tvf.deductions_from_attendance(t.deduction, t.attendance, 1, employee_id=7)


@register("deductions_from_attendance_employee_corrected", """
select d.deduction_id, d.emp_id, d.date, d.amount, d.type, d.status, d.attendance_id
from deduction d join attendance a on d.attendance_id = a.attendance_id
where d.emp_id = 7 and month(d.date) = 1
  and lower(d.type) in ('missing days', 'missing_days', 'missing hours', 'missing_hours')
""")
def _q(t):
    return tvf.deductions_from_attendance(t.deduction, t.attendance, 1, employee_id=7,
                                          mode="corrected")


@register("deductions_from_attendance_corrected", """
select d.deduction_id, d.emp_id, d.date, d.amount, d.type, d.status, d.attendance_id
from deduction d join attendance a on d.attendance_id = a.attendance_id
where month(d.date) = 1
  and lower(d.type) in ('missing days', 'missing_days', 'missing hours', 'missing_hours')
""")
def _q(t):
    return tvf.deductions_from_attendance(t.deduction, t.attendance, 1, mode="corrected")


@register("leave_status_this_month", """
select s.emp_id, l.request_id, l.date_of_request, l.final_approval_status as status
from leave l join (select emp_id, request_id from annual_leave
                   union select emp_id, request_id from accidental_leave) s
  on l.request_id = s.request_id
where month(l.date_of_request) = 1 and year(l.date_of_request) = 2024
""")
def _q(t):
    return tvf.leave_status_this_month(t.leave, t.annual_leave, t.accidental_leave, AS_OF)


LEDGER_SQL = """
select s.request_id, s.kind, s.emp_id, s.replacement_emp, l.date_of_request, l.start_date,
       l.end_date, l.num_days, l.final_approval_status
from (select request_id, emp_id, 0 as kind, replacement_emp from annual_leave
      union select request_id, emp_id, 1, cast(null as bigint) from accidental_leave
      union select request_id, emp_id, 2, cast(null as bigint) from medical_leave
      union select request_id, emp_id, 3, cast(null as bigint) from unpaid_leave
      union select request_id, emp_id, 4, replacement_emp from compensation_leave) s
join leave l on l.request_id = s.request_id
"""


@register("leave_ledger", LEDGER_SQL)
def _q(t):
    return L.ledger_from(t)


# ---------------------------------------------------------------- computed columns


@register("leave_with_num_days", """
select request_id, start_date, end_date, cast(datediff('day', start_date, end_date) + 1 as integer) as num_days
from leave
""")
def _q(t):
    from hrforge.operators.quality import leave_with_num_days
    return leave_with_num_days(t.leave).select("request_id", "start_date", "end_date",
                                               "num_days")


@register("attendance_with_duration", """
select attendance_id, check_in_time, check_out_time,
       cast(hour(check_out_time)*60 + minute(check_out_time)
            - hour(check_in_time)*60 - minute(check_in_time) as integer) as total_duration
from attendance
""")
def _q(t):
    from hrforge.operators.quality import attendance_with_duration
    return attendance_with_duration(t.attendance).select(
        "attendance_id", "check_in_time", "check_out_time", "total_duration")


@register("fill_defaults", """
select attendance_id, emp_id, date, coalesce(status, 'absent') as status from attendance
""")
def _q(t):
    from hrforge.operators.quality import fill_defaults
    return fill_defaults(t.attendance, "attendance").select(
        "attendance_id", "emp_id", "date", "status")


# ---------------------------------------------------------------- sources / sinks


def _content_sql(name: str) -> str:
    cols = SCHEMAS[name].names
    dates = [f.name for f in SCHEMAS[name].fields if f.dataType == T.DateType()]
    days = " + ".join(f"coalesce(sum(date_diff('day', date '1970-01-01', {c})), 0)" for c in dates) or "0"
    return (f"select '{name}' as table_name, count(*) as n_rows, "
            f"cast({' + '.join(f'count({c})' for c in cols)} as bigint) as n_values, cast({days} as bigint) as sum_days from {name}")


@register("load_tables", "\nunion all\n".join(_content_sql(n) for n in HR_TABLES))
def _q(t):
    """Write every HR table as a typed snapshot in the shared checkpoint folder,
    read each back with the typed loader (holidays via ``load_holidays``); count its
    rows and its values that are not null, and add up its dates (days since 1970)."""
    import uuid

    from hrforge.session import checkpoint_dir
    from hrforge.sources import io

    root = f"{checkpoint_dir(t.spark).rstrip('/')}/snapshots-{uuid.uuid4().hex}"
    for name in HR_TABLES:
        io.write_snapshot(getattr(t, name), root, name, 0)
    loaded = io.load_tables(t.spark, root, 0, [n for n in HR_TABLES if n != "holiday"])
    loaded["holiday"] = io.load_holidays(t.spark, root, 0)
    def content(name: str) -> DataFrame:
        df = loaded[name]
        days = [F.coalesce(F.sum(F.unix_date(f.name).cast("long")), F.lit(0)) for f in df.schema.fields if f.dataType == T.DateType()]
        return df.agg(F.count(F.lit(1)).alias("n_rows"), reduce(add, [F.count(c) for c in df.columns]).alias("n_values"),
                      reduce(add, days, F.lit(0).cast("long")).alias("sum_days")).select(
            F.lit(name).alias("table_name"), "n_rows", "n_values", "sum_days")

    return reduce(DataFrame.unionByName, map(content, HR_TABLES))
