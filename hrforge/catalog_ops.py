"""Catalog: flags, quality, admin, deductions and payroll."""

from __future__ import annotations


from pyspark.sql import functions as F

from hrforge.catalog import AS_OF, LEAVE_DAY, register
from hrforge.functions.dates import month_end, month_start
from hrforge.oracle_sql import (LEDGER, cents, ci, d, from_cents, in_month, next_ids,
                                on_leave_ids, overlap, rq, top_role)
from hrforge.operators import admin, flags, payroll, quality
from hrforge.operators import ledger as L
from hrforge.sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS

M0, M1 = month_start(AS_OF), month_end(AS_OF)

# ---------------------------------------------------------------- logins


@register("login_attempt_flags", f"""
select a.attempt_id, a.employee_id,
       exists(select 1 from employee e where e.employee_id = a.employee_id
              and {ci('e.password')} = {ci('a.password')}) as is_valid
from login_attempts a
""")
def _q(t):
    return flags.login_attempt_flags(t.login_attempts, t.employee)


@register("hr_login_attempt_flags", f"""
select a.attempt_id, a.employee_id,
       exists(select 1 from employee e where e.employee_id = a.employee_id
              and {ci('e.password')} = {ci('a.password')} and {ci('e.dept_name')} = 'hr') as is_valid
from login_attempts a
""")
def _q(t):
    return flags.login_attempt_flags(t.login_attempts, t.employee, hr_only=True)


# ---------------------------------------------------------------- leave / role flags


@register("is_on_leave", f"""
select e.employee_id, e.employee_id in {on_leave_ids(LEAVE_DAY)} as is_on_leave
from employee e
""")
def _q(t):
    return flags.flag_on_leave_today(t.employee.select("employee_id"), L.ledger_from(t),
                                     LEAVE_DAY, "employee_id")


@register("is_on_leave_range", f"""
select r.request_id, r.replacement_emp,
       exists(select 1 from {LEDGER} lg where lg.emp_id = r.replacement_emp
              and {ci('lg.final_approval_status')} in ('approved', 'pending')
              and {overlap('r.start_date', 'r.end_date', 'lg.start_date', 'lg.end_date')}) as is_on_leave
from (select a.request_id, a.replacement_emp, l.start_date, l.end_date
      from annual_leave a join leave l on l.request_id = a.request_id) r
""")
def _q(t):
    probes = t.annual_leave.join(t.leave, "request_id").select(
        "request_id", "replacement_emp", "start_date", "end_date")
    return flags.flag_on_leave_range(probes, L.ledger_from(t),
                                     "replacement_emp", "start_date", "end_date").select(
        "request_id", "replacement_emp", "is_on_leave")


@register("is_dean_or_vice", f"""
select e.employee_id,
       exists(select 1 from employee_role r where r.emp_id = e.employee_id
              and {ci('r.role_name')} in ('dean', 'vice dean')) as is_dean_or_vice
from employee e
""")
def _q(t):
    return flags.flag_dean_or_vice(t.employee.select("employee_id"), t.employee_role,
                                   "employee_id")


PT = f"coalesce({ci('type_of_contract')} = 'part_time', false)"


@register("is_part_time", f"select employee_id, {PT} as is_part_time from employee")
def _q(t):
    return flags.employee_flags(t.employee).select("employee_id", "is_part_time")


@register("is_not_part_time", f"select employee_id, not {PT} as is_not_part_time from employee")
def _q(t):
    return flags.employee_flags(t.employee).select("employee_id", "is_not_part_time")


@register("is_male", f"select employee_id, coalesce({ci('gender')} = 'm', false) as is_male from employee")
def _q(t):
    return flags.employee_flags(t.employee).select("employee_id", "is_male")


@register("request_year", """
select request_id, cast(year(date_of_request) as integer) as request_year from leave
""")
def _q(t):
    return flags.request_year(t.leave)


@register("unpaid_requester", """
select l.request_id, u.emp_id as requester_id
from leave l left join unpaid_leave u on u.request_id = l.request_id
""")
def _q(t):
    return flags.unpaid_requester(t.leave, L.ledger_from(t))


@register("compensation_requester", """
select l.request_id, c.emp_id as requester_id
from leave l left join compensation_leave c on c.request_id = l.request_id
""")
def _q(t):
    return flags.compensation_requester(t.leave, L.ledger_from(t))


REPL_PROBES = """(select a.request_id, a.replacement_emp, l.start_date, l.end_date
   from annual_leave a join leave l on l.request_id = a.request_id
   union all
   select c.request_id, c.replacement_emp, l.start_date, l.end_date
   from compensation_leave c join leave l on l.request_id = c.request_id)"""


def _repl_probes(t):
    a = t.annual_leave.join(t.leave, "request_id").select(
        "request_id", "replacement_emp", "start_date", "end_date")
    c = t.compensation_leave.join(t.leave, "request_id").select(
        "request_id", "replacement_emp", "start_date", "end_date")
    return a.unionByName(c)


def _free_sql(lo: str, hi: str) -> str:
    return f"""
select p.request_id, p.replacement_emp,
       p.replacement_emp is not null and not exists(
         select 1 from employee_replace_employee r where r.emp2_id = p.replacement_emp
         and (r.from_date between {lo} and {hi} or r.to_date between {lo} and {hi}
              or {lo} between r.from_date and r.to_date or {hi} between r.from_date and r.to_date)) as is_free
from {REPL_PROBES} p
"""


@register("replacement_is_free", _free_sql("p.end_date", "p.start_date"))
def _q(t):
    return flags.replacement_is_free(_repl_probes(t), t.employee_replace_employee, "replacement_emp", "start_date",
                                     "end_date").select("request_id", "replacement_emp",
                                                        "is_free")


@register("replacement_is_free_corrected", _free_sql("p.start_date", "p.end_date"))
def _q(t):
    return flags.replacement_is_free(_repl_probes(t), t.employee_replace_employee, "replacement_emp", "start_date",
                                     "end_date", mode="corrected").select(
        "request_id", "replacement_emp", "is_free")


@register("later_date", f"""
select request_id, case when end_date >= {d(M1)} then end_date else {d(M1)} end as later_date from leave
""")
def _q(t):
    return flags.date_choice(t.leave, M0, M1).select("request_id", "later_date")


@register("earlier_date", f"""
select request_id, case when start_date <= {d(M0)} then start_date else {d(M0)} end as earlier_date from leave
""")
def _q(t):
    return flags.date_choice(t.leave, M0, M1).select("request_id", "earlier_date")


@register("highest_ranked_available", f"""
select department_name, employee_id from (
  select e.dept_name as department_name, e.employee_id,
         row_number() over (partition by e.dept_name order by r.rank, e.employee_id) as rn
  from employee e join employee_role er on e.employee_id = er.emp_id
  join role r on {ci('er.role_name')} = {ci('r.role_name')}
  where e.employee_id not in {on_leave_ids(LEAVE_DAY)}) x
where rn = 1
""")
def _q(t):
    blocked = L.on_leave_ids(L.ledger_from(t), LEAVE_DAY, LEAVE_DAY)
    return flags.highest_ranked_available(t.employee, t.employee_role, t.role, blocked)


@register("highest_ranked_available_role", f"""
select department_name, employee_id from (
  select e.dept_name as department_name, e.employee_id,
         row_number() over (partition by e.dept_name order by r.rank, e.employee_id) as rn
  from employee e join employee_role er on e.employee_id = er.emp_id
  join role r on {ci('er.role_name')} = {ci('r.role_name')}
  where {ci('er.role_name')} = 'researcher' and e.employee_id not in {on_leave_ids(LEAVE_DAY)}) x
where rn = 1
""")
def _q(t):
    blocked = L.on_leave_ids(L.ledger_from(t), LEAVE_DAY, LEAVE_DAY)
    return flags.highest_ranked_available(t.employee, t.employee_role, t.role, blocked,
                                          role_name="Researcher")


# ---------------------------------------------------------------- bonus & payroll


def bonus_sql(hours: bool = False, first=M0) -> str:
    denom = 22 * 8 * 100 * 100 * (60 if hours else 1)
    num = f"{cents('e.salary')} * {cents('f.percentage_overtime')} * m.extra"
    return f"""(select e.employee_id,
       coalesce({from_cents(rq(num, denom))}, cast(0 as decimal(10,2))) as bonus_amount
from employee e
left join {top_role('r.percentage_overtime')} f on f.emp_id = e.employee_id
left join (select emp_id, sum(case when total_duration > 480 then total_duration - 480 else 0 end) as extra
           from attendance where {in_month('date', first)} group by emp_id) m on m.emp_id = e.employee_id)"""


@register("bonus_amount", f"select * from {bonus_sql()} b")
def _q(t):
    return payroll.bonus_amount(t.employee, t.employee_role, t.role, t.attendance, as_of=AS_OF)


@register("bonus_amount_corrected", f"select * from {bonus_sql(hours=True)} b")
def _q(t):
    return payroll.bonus_amount(t.employee, t.employee_role, t.role, t.attendance, as_of=AS_OF,
                                mode="corrected")


def payroll_todo() -> str:
    return (f"(select employee_id, salary from employee e where not exists (select 1 from payroll p "
            f"where p.emp_id = e.employee_id and {in_month('p.from_date', M0)}))")


def payroll_sql(hours: bool) -> str:
    return f"""
select {next_ids('payroll', 'id', 'e.employee_id')} as id, {d(AS_OF)} as payment_date,
       cast(e.salary + b.bonus_amount - coalesce(dd.ded, 0) as decimal(10,1)) as final_salary_amount,
       {d(M0)} as from_date, {d(M1)} as to_date, cast(null as varchar) as comments,
       b.bonus_amount, cast(coalesce(dd.ded, 0) as decimal(10,2)) as deductions_amount,
       e.employee_id as emp_id
from {payroll_todo()} e
join {bonus_sql(hours)} b on b.employee_id = e.employee_id
left join (select emp_id, sum(amount) as ded from deduction
           where date between {d(M0)} and {d(M1)} and {ci('status')} = 'pending'
           group by emp_id) dd on dd.emp_id = e.employee_id
"""


@register("run_payroll", payroll_sql(False))
def _q(t):
    return payroll.run_payroll(t.employee, t.employee_role, t.role, t.attendance, t.deduction,
                               t.payroll, M0, M1, AS_OF)["payroll"]


@register("run_payroll_corrected", payroll_sql(True))
def _q(t):
    return payroll.run_payroll(t.employee, t.employee_role, t.role, t.attendance, t.deduction,
                               t.payroll, M0, M1, AS_OF, mode="corrected")["payroll"]


@register("run_payroll_deductions", f"""
select d.* replace (
  case when d.date between {d(M0)} and {d(M1)} and {ci('d.status')} = 'pending'
        and d.emp_id in (select employee_id from {payroll_todo()} x)
       then 'finalized' else d.status end as status)
from deduction d
""")
def _q(t):
    return payroll.run_payroll(t.employee, t.employee_role, t.role, t.attendance, t.deduction,
                               t.payroll, M0, M1, AS_OF)["deductions"]


# ---------------------------------------------------------------- deductions


def _hours_sql(skip_part_time: bool) -> str:
    pt = f"and not coalesce({ci('e.type_of_contract')} = 'part_time', false)" if skip_part_time else ""
    return f"""
select {next_ids('deduction', 'deduction_id', 'x.emp_id, x.attendance_id')} as deduction_id,
       x.emp_id, {d(AS_OF)} as date,
       {from_cents(rq(cents('e.salary') + ' * (480 - x.total_duration)', 10560))} as amount,
       'missing_hours' as type, 'pending' as status, cast(null as bigint) as unpaid_id, x.attendance_id
from (select emp_id, attendance_id, total_duration,
             row_number() over (partition by emp_id order by date, attendance_id) as rn
      from attendance a
      where {in_month('a.date', M0)} and a.total_duration < 480
        and not exists (select 1 from deduction dd where dd.attendance_id = a.attendance_id)) x
join employee e on e.employee_id = x.emp_id
where x.rn = 1 {pt}
"""


@register("missing_hour_deductions", _hours_sql(False))
def _q(t):
    return payroll.missing_hour_deductions(t.attendance, t.employee, t.deduction, AS_OF)


@register("missing_hour_deductions_corrected", _hours_sql(True))
def _q(t):
    return payroll.missing_hour_deductions(t.attendance, t.employee, t.deduction, AS_OF,
                                           mode="corrected")


def _days_sql(corrected: bool) -> str:
    appr = f"and {ci('l.final_approval_status')} = 'approved'" if corrected else ""
    again = ("and not exists (select 1 from deduction dd where dd.attendance_id = a.attendance_id)"
             if corrected else "")
    return f"""
select {next_ids('deduction', 'deduction_id', 'a.emp_id, a.attendance_id')} as deduction_id,
       a.emp_id, {d(AS_OF)} as date, {from_cents(rq(cents('e.salary'), 22))} as amount,
       'missing_days' as type, 'pending' as status, cast(null as bigint) as unpaid_id, a.attendance_id
from attendance a join employee e on e.employee_id = a.emp_id
where {in_month('a.date', M0)} and {ci('a.status')} = 'absent' {again}
  and not exists (select 1 from unpaid_leave u join leave l on u.request_id = l.request_id
                  where u.emp_id = a.emp_id and a.date between l.start_date and l.end_date {appr})
"""


@register("missing_day_deductions", _days_sql(False))
def _q(t):
    return payroll.missing_day_deductions(t.attendance, t.employee, L.ledger_from(t),
                                          t.deduction, AS_OF)


@register("missing_day_deductions_corrected", _days_sql(True))
def _q(t):
    return payroll.missing_day_deductions(t.attendance, t.employee, L.ledger_from(t),
                                          t.deduction, AS_OF, mode="corrected")


def _unpaid_sql(corrected: bool) -> str:
    if corrected:
        guard = (f"not exists (select 1 from deduction dd where {ci('dd.type')} = 'unpaid' "
                 f"and {in_month('dd.date', M0)} and dd.unpaid_id = l.request_id) "
                 f"and l.start_date <= {d(M1)} and l.end_date >= {d(M0)}")
        rs = f"case when p.start_date >= {d(M0)} then p.start_date else {d(M0)} end"
        re_ = f"case when p.end_date <= {d(M1)} then p.end_date else {d(M1)} end"
        dated = rs
    else:
        guard = f"not exists (select 1 from deduction dd where month(dd.date) = {M0.month})"
        rs = f"case when p.start_date <= {d(M0)} then p.start_date else {d(M0)} end"
        re_ = f"case when p.end_date >= {d(M1)} then p.end_date else {d(M1)} end"
        dated = "p.start_date"
    days = f"(datediff('day', {rs}, {re_}) + 1)"
    daily = rq(cents('coalesce(e.salary, 0)'), 22)
    return f"""
select {next_ids('deduction', 'deduction_id', 'p.emp_id, p.request_id')} as deduction_id,
       p.emp_id, {dated} as date, {from_cents(f'{daily} * {days}')} as amount,
       'unpaid' as type, 'pending' as status, p.request_id as unpaid_id,
       cast(null as bigint) as attendance_id
from (select u.emp_id, l.request_id, l.start_date, l.end_date,
             row_number() over (partition by u.emp_id order by l.request_id desc) as rn
      from unpaid_leave u join leave l on l.request_id = u.request_id
      where {ci('l.final_approval_status')} = 'approved' and {guard}) p
join employee e on e.employee_id = p.emp_id
where p.rn = 1
"""


@register("unpaid_leave_deductions", _unpaid_sql(False))
def _q(t):
    return payroll.unpaid_leave_deductions(t.employee, L.ledger_from(t), t.deduction, AS_OF)


@register("unpaid_leave_deductions_corrected", _unpaid_sql(True))
def _q(t):
    return payroll.unpaid_leave_deductions(t.employee, L.ledger_from(t), t.deduction, AS_OF,
                                           mode="corrected")


# ---------------------------------------------------------------- quality


def _tables(t, names):
    return {n: getattr(t, n) for n in names}


def _render_sql(cols, text=frozenset()):
    parts = []
    for c in cols:
        v = ci(c) if c in text else c
        parts.append(f"coalesce(cast({v} as varchar), 'NULL')")
    return f"concat_ws('|', {', '.join(parts)})"


def _text(name):
    return {f.name for f in SCHEMAS[name].fields if f.dataType.typeName() == "string"}


def _pk_sql(prefix: str = "") -> str:
    parts = []
    for name, pk in PRIMARY_KEYS.items():
        table = prefix + name
        nul = " or ".join(f"{c} is null" for c in pk)
        parts.append(f"select '{name}' as table_name, {_render_sql(pk)} as key_value, "
                     f"'null_key' as violation, count(*) as n_rows from {table} where {nul} "
                     f"group by {_render_sql(pk)}")
        txt = _text(name)
        keys = ", ".join(ci(c) if c in txt else c for c in pk)
        parts.append(f"select '{name}', {_render_sql(pk, txt)}, 'duplicate', count(*) "
                     f"from {table} where not ({nul}) group by {keys} having count(*) > 1")
    return "\nunion all\n".join(parts)


@register("pk_violations", _pk_sql())
def _q(t):
    return quality.pk_violations(_tables(t, list(PRIMARY_KEYS)))


def _fk_sql() -> str:
    parts = []
    for child, col, parent, pcol in FOREIGN_KEYS:
        txt = col in _text(child)
        ck = ci(f"c.{col}") if txt else f"c.{col}"
        pk = ci(f"p.{pcol}") if txt else f"p.{pcol}"
        parts.append(
            f"select '{child}.{col}->{parent}.{pcol}' as fk_name, cast(c.{col} as varchar) as child_value, "
            f"count(*) as n_rows from {child} c where c.{col} is not null and not exists "
            f"(select 1 from {parent} p where {pk} = {ck}) group by cast(c.{col} as varchar)")
    return "\nunion all\n".join(parts)


FK_TABLES = sorted({c for c, _, _, _ in FOREIGN_KEYS} | {p for _, _, p, _ in FOREIGN_KEYS})


@register("fk_violations", _fk_sql())
def _q(t):
    return quality.fk_violations(_tables(t, FK_TABLES))


CHECKS_SQL = [
    ("employee_contract", "employee", f"{ci('type_of_contract')} in ('full_time', 'part_time')",
     "type_of_contract"),
    ("employee_status", "employee",
     f"{ci('employment_status')} in ('active', 'onleave', 'notice_period', 'resigned')",
     "employment_status"),
    ("hr_department_roles", "role_existsin_department",
     f"{ci('department_name')} <> 'hr' or role_name ilike 'HR_Representative_%' "
     f"or {ci('role_name')} = 'hr manager'", "role_name"),
    ("medical_type", "medical_leave", f"{ci('type')} in ('sick', 'maternity')", "type"),
    ("document_status", "document", f"{ci('status')} in ('valid', 'expired')", "status"),
    ("attendance_status", "attendance", f"{ci('status')} in ('absent', 'attended')", "status"),
    ("deduction_type", "deduction", f"{ci('type')} in ('unpaid', 'missing_hours', 'missing_days')",
     "type"),
    ("deduction_status", "deduction", f"{ci('status')} in ('pending', 'finalized')", "status"),
    ("performance_rating", "performance", "rating between 1 and 5", "rating"),
    ("approval_status", "employee_approve_leave",
     f"{ci('status')} in ('approved', 'rejected', 'pending')", "status"),
]


def _check_sql() -> str:
    return "\nunion all\n".join(
        f"select '{n}' as check_name, '{tb}' as table_name, {_render_sql(PRIMARY_KEYS[tb])} as row_key, "
        f"cast({col} as varchar) as bad_value from {tb} where not ({pred})"
        for n, tb, pred, col in CHECKS_SQL)


@register("check_violations", _check_sql())
def _q(t):
    return quality.check_violations(_tables(t, sorted({tb for _, tb, _, _ in CHECKS_SQL})))


def role_batch(t):
    """Stand-in batch of new roles: the role record of every employee-role row."""
    er = t.employee_role.select(F.col("role_name").alias("_rn"))
    role = t.role
    return er.join(role, er._rn == role.role_name, "inner").drop("_rn")


ROLE_BATCH = "(select r.* from employee_role er join role r on er.role_name = r.role_name)"
GUARD_BAD = (f"select * from {ROLE_BATCH} b where role_name ilike 'HR_Representative_%' and "
             f"{ci('substring(role_name, 19, length(rtrim(role_name)) - 18)')} not in "
             f"(select {ci('name')} from department)")


@register("hr_role_set_guard", f"select * from {ROLE_BATCH} b where not exists ({GUARD_BAD})")
def _q(t):
    return quality.hr_role_set_guard(role_batch(t), t.department)[0]


@register("hr_role_set_guard_rejects", GUARD_BAD)
def _q(t):
    return quality.hr_role_set_guard(role_batch(t), t.department)[1]


# ---------------------------------------------------------------- admin


@register("expire_documents", f"""
select * replace (case when expiry_date <= {d(AS_OF)} then 'expired' else status end as status)
from document
""")
def _q(t):
    return admin.expire_documents(t.document, AS_OF)


@register("drop_resigned_deductions", f"""
select * from deduction dd where not exists (
  select 1 from employee e where e.employee_id = dd.emp_id and {ci('e.employment_status')} = 'resigned')
""")
def _q(t):
    return admin.drop_resigned_deductions(t.deduction, t.employee)


@register("refresh_employment_status", f"""
select * replace (case when employee_id in {on_leave_ids(LEAVE_DAY)} then 'onleave' else 'active' end
                  as employment_status)
from employee
""")
def _q(t):
    return admin.refresh_employment_status(t.employee, L.ledger_from(t), LEAVE_DAY)


@register("refresh_employment_status_corrected", f"""
select * replace (case when {ci('employment_status')} in ('resigned', 'notice_period') then employment_status
                       when employee_id in {on_leave_ids(LEAVE_DAY, ('approved',))} then 'onleave'
                       else 'active' end as employment_status)
from employee
""")
def _q(t):
    return admin.refresh_employment_status(t.employee, L.ledger_from(t), LEAVE_DAY,
                                           mode="corrected")


@register("initiate_attendance", f"""
select {next_ids('attendance', 'attendance_id', 'employee_id')} as attendance_id, {d(AS_OF)} as date,
       cast(null as timestamp) as check_in_time, cast(null as timestamp) as check_out_time,
       cast(null as integer) as total_duration, 'absent' as status, employee_id as emp_id
from employee
where employee_id not in (select emp_id from attendance where date = {d(AS_OF)})
""")
def _q(t):
    return admin.initiate_attendance(t.attendance, t.employee, AS_OF)


def checkin_batch(t):
    """Stand-in check-in batch: each event on AS_OF is one check-in record; half of
    them are mapped to employees without an attendance row (to exercise inserts)."""
    ev = t.base("events").filter(F.to_date("ts") == F.lit(AS_OF))
    users = t.base("events").agg(F.max("user_id") + 1).scalar()
    return ev.select(
        (F.col("user_id") + 1 + users * (F.col("event_id") % 2)).cast("bigint").alias("emp_id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("check_in_time"),
        F.col("ts").alias("check_out_time"), F.col("event_id").alias("seq"))


CHECKIN_SQL = f"""(select emp_id, arg_max(check_in_time, seq) as cin, arg_max(check_out_time, seq) as cout
 from (select cast(user_id + 1 + (select max(user_id) + 1 from events) * (event_id % 2)
                   as bigint) as emp_id,
              date_trunc('hour', ts) as check_in_time, ts as check_out_time, event_id as seq
       from events where cast(ts as date) = {d(AS_OF)}) b group by emp_id)"""

def holiday_batch(t):
    """Stand-in batch: each month with orders is one holiday from its first to its last order."""
    day = F.to_date("o_orderdate")
    month = (F.year(day) * 12 + F.month(day)).alias("seq")
    return t.base("orders").groupBy(month).agg(
        F.min(day).alias("from_date"), F.max(day).alias("to_date")).select(
        "seq", F.concat(F.lit("Month "), F.col("seq")).alias("holiday_name"),
        "from_date", "to_date")


@register("append_holidays", f"""
select holiday_id, holiday_name, from_date, to_date from holiday
union all
select {next_ids('holiday', 'holiday_id', 'seq')}, concat('Month ', seq), from_date, to_date
from (select year(o_orderdate) * 12 + month(o_orderdate) as seq,
             min(cast(o_orderdate as date)) as from_date, max(cast(o_orderdate as date)) as to_date
      from orders group by 1) b
""")
def _q(t):
    return admin.append_holidays(t.holiday, holiday_batch(t))


DUR = "cast(hour({o})*60 + minute({o}) - hour({i})*60 - minute({i}) as integer)"


@register("upsert_attendance", f"""
select attendance_id, date, check_in_time, check_out_time, total_duration, status, emp_id
from attendance where not (date = {d(AS_OF)}) or date is null
union all
select a.attendance_id, a.date,
       case when b.emp_id is not null then b.cin else a.check_in_time end,
       case when b.emp_id is not null then b.cout else a.check_out_time end,
       {DUR.format(o="case when b.emp_id is not null then b.cout else a.check_out_time end",
                   i="case when b.emp_id is not null then b.cin else a.check_in_time end")},
       case when b.emp_id is not null then 'attended' else a.status end, a.emp_id
from attendance a left join {CHECKIN_SQL} b on b.emp_id = a.emp_id
where a.date = {d(AS_OF)}
union all
select {next_ids('attendance', 'attendance_id', 'b.emp_id')}, {d(AS_OF)}, b.cin, b.cout,
       {DUR.format(o="b.cout", i="b.cin")}, 'attended', b.emp_id
from {CHECKIN_SQL} b
where not exists (select 1 from attendance a where a.date = {d(AS_OF)} and a.emp_id = b.emp_id)
""")
def _q(t):
    return admin.upsert_attendance(t.attendance, checkin_batch(t), AS_OF)


@register("drop_holiday_attendance", """
select * from attendance a
where not exists (select 1 from holiday h where a.date between h.from_date and h.to_date)
""")
def _q(t):
    return admin.drop_holiday_attendance(t.attendance, t.holiday)


@register("drop_day_off_absences", f"""
select * from attendance a
where not coalesce({in_month('a.date', M0)} and {ci('a.status')} = 'absent'
  and exists (select 1 from employee e where e.employee_id = a.emp_id
              and lower(dayname(a.date)) = {ci('e.official_day_off')}), false)
""")
def _q(t):
    return admin.drop_day_off_absences(t.attendance, t.employee, AS_OF)


@register("drop_leave_attendance", f"""
select * from attendance a
where not exists (select 1 from {LEDGER} lg where lg.emp_id = a.emp_id
                  and {ci('lg.final_approval_status')} = 'approved'
                  and a.date between lg.start_date and lg.end_date)
""")
def _q(t):
    return admin.drop_leave_attendance(t.attendance, L.ledger_from(t))


def replacement_batch(t):
    """Stand-in batch: approved compensation leaves that name a replacement."""
    c = t.compensation_leave.join(t.leave, "request_id").filter(
        (F.col("final_approval_status") == "approved") & F.col("replacement_emp").isNotNull())
    return c.select(F.col("emp_id").alias("emp1_id"), F.col("replacement_emp").alias("emp2_id"),
                    F.col("start_date").alias("from_date"), F.col("end_date").alias("to_date"),
                    F.col("request_id").alias("seq"))


@register("append_replacements", f"""
select table_id, emp1_id, emp2_id, from_date, to_date from employee_replace_employee
union all
select {next_ids('employee_replace_employee', 'table_id', 'c.request_id')}, c.emp_id, c.replacement_emp,
       l.start_date, l.end_date
from compensation_leave c join leave l on l.request_id = c.request_id
where l.final_approval_status = 'approved' and c.replacement_emp is not null
""")
def _q(t):
    return admin.append_replacements(t.employee_replace_employee, replacement_batch(t))


@register("recompute_salaries", f"""
select e.* replace (
  case when tr.emp_id is not null then
       {from_cents(rq(cents('tr.base_salary') + ' * (10000 + ' + cents('tr.percentage_yoe') + ' * e.years_of_experience)', 10000))}
       else e.salary end as salary)
from employee e left join {top_role('r.base_salary, r.percentage_yoe')} tr on tr.emp_id = e.employee_id
""")
def _q(t):
    return admin.recompute_salaries(t.employee, t.employee_role, t.role)
