"""Catalog: leave decisions and evaluations.

Stand-in decision batches come from the approval table: each approval row whose
approver holds the deciding role is one decision call (``seq`` orders them).
The unpaid upperboard decision runs on the approvals produced by the unpaid
submission of the same data, as in the reference's submit -> decide flow.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hrforge.catalog import LEAVE_DAY, register
from hrforge.catalog_flow import (APPROVALS_SQL, _docs_sql, _flow_ctes, _frames)
from hrforge.functions.text import ci_eq, ci_in
from hrforge.oracle_sql import LEDGER, ci, d, next_ids, overlap
from hrforge.operators import decide as D
from hrforge.operators import ledger as L

DAY = LEAVE_DAY
SEQ = "cast({l} as bigint) * 2147483648 + {e}"


def _seq(leave_col, emp_col):
    return (F.col(leave_col).cast("bigint") * F.lit(2147483648) + F.col(emp_col)).alias("seq")


def _holders(t, cond):
    return t.employee_role.filter(cond).select(F.col("emp_id").alias("_h")).distinct()


def _approval_batch(approvals, holders, subtype, who):
    ap = approvals.join(holders, approvals.emp1_id == holders._h, "left_semi")
    ap = ap.join(subtype.select(F.col("request_id").alias("_r")), ap.leave_id == F.col("_r"),
                 "left_semi")
    return ap.select(_seq("leave_id", "emp1_id"), F.col("leave_id").alias("request_id"),
                     F.col("emp1_id").alias(who))


UPPER_SQL = f"{ci('role_name')} in ('dean', 'vice dean', 'president')"
HR_SQL = f"(role_name ilike 'HR_Representative%' or {ci('role_name')} = 'hr manager')"


def _batch_sql(subtype: str, role_pred: str, who: str, approvals: str = "employee_approve_leave",
               extra: str = "") -> str:
    return (f"select {SEQ.format(l='ap.leave_id', e='ap.emp1_id')} as seq, ap.leave_id as request_id, "
            f"ap.emp1_id as {who}{extra} from {approvals} ap "
            f"where ap.emp1_id in (select emp_id from employee_role where {role_pred}) "
            f"and ap.leave_id in (select request_id from {subtype})")


# ---------------------------------------------------------------- upperboard annual


def _ub_annual_frames(t, mode="as_written", of=lambda batch: batch):
    batch = _approval_batch(t.employee_approve_leave,
                            _holders(t, ci_in("role_name", D.UPPERBOARD_ROLES)),
                            t.annual_leave, "upperboard_id")
    batch = batch.join(t.annual_leave.select(F.col("request_id").alias("_r"),
                                             F.col("replacement_emp").alias("replacement_id")),
                       F.col("request_id") == F.col("_r"), "left").drop("_r")
    return D.upperboard_decide_annual(of(batch), t.employee_approve_leave, t.annual_leave,
                                      t.employee_role, t.role_existsin_department, t.leave,
                                      L.ledger_from(t), mode)


def _ub_annual_ctes(mode):
    auth = ("b.upperboard_id in (select emp1_id from employee_approve_leave)" if mode == "as_written"
            else "exists (select 1 from employee_approve_leave p where p.emp1_id = b.upperboard_id "
                 "and p.leave_id = b.request_id)")
    return [
        ("b0", _batch_sql("annual_leave", UPPER_SQL, "upperboard_id")),
        ("b", "select b0.*, a.replacement_emp as replacement_id from b0 left join annual_leave a "
              "on a.request_id = b0.request_id"),
        ("auth", f"select * from b where {auth}"),
        ("role_of", "select emp_id, max(role_name) as role from employee_role group by emp_id"),
        ("dept_of", f"select {ci('role_name')} as rk, max(department_name) as dept "
                    f"from role_existsin_department group by 1"),
        ("dec", f"""select x.seq, x.upperboard_id as emp1_id, x.request_id as leave_id,
   case when coalesce(not exists (select 1 from {LEDGER} lg where lg.emp_id = x.replacement_id
                 and {ci('lg.final_approval_status')} in ('approved', 'pending')
                 and {overlap('l.start_date', 'l.end_date', 'lg.start_date', 'lg.end_date')})
               and {ci('d1.dept')} = {ci('d2.dept')}, false)
        then 'approved' else 'rejected' end as new_status
 from auth x left join annual_leave a on a.request_id = x.request_id
 left join leave l on l.request_id = x.request_id
 left join role_of r1 on r1.emp_id = a.emp_id left join dept_of d1 on d1.rk = {ci('r1.role')}
 left join role_of r2 on r2.emp_id = x.replacement_id left join dept_of d2 on d2.rk = {ci('r2.role')}"""),
        ("upd", "select emp1_id, leave_id, arg_max(new_status, seq) as new_status from dec group by 1, 2"),
    ]


UB_SNAPSHOT = ("select ap.emp1_id, ap.leave_id, coalesce(u.new_status, ap.status) as status "
               "from employee_approve_leave ap left join upd u on u.emp1_id = ap.emp1_id "
               "and u.leave_id = ap.leave_id")
UB_REJECTS = (f"select seq, request_id, upperboard_id, '{D.MSG_NOT_AUTHORISED}' as reason from b "
              f"where seq not in (select seq from auth)")

register("upperboard_decide_annual", UB_SNAPSHOT, _ub_annual_ctes("as_written"))(
    lambda t: _ub_annual_frames(t)[0])
register("upperboard_decide_annual_rejections", UB_REJECTS, _ub_annual_ctes("as_written"))(
    lambda t: _ub_annual_frames(t)[1])
register("upperboard_decide_annual_corrected", UB_SNAPSHOT, _ub_annual_ctes("corrected"))(
    lambda t: _ub_annual_frames(t, "corrected")[0])


# ---------------------------------------------------------------- upperboard unpaid


def _ub_unpaid(t):
    sub = _frames("unpaid", t)
    new_ap = sub["approvals"]
    approvals = t.employee_approve_leave.unionByName(new_ap)
    unpaid = t.unpaid_leave.unionByName(sub["leaves"].select("request_id", "emp_id"))
    batch = new_ap.select(_seq("leave_id", "emp1_id"), F.col("leave_id").alias("request_id"),
                          F.col("emp1_id").alias("upperboard_id"))
    return D.upperboard_decide_unpaid(batch, approvals, unpaid, t.employee_role, sub["documents"])


_UNPAID_CTES = _flow_ctes("unpaid", dec_name="sdec") + [
    ("newap", APPROVALS_SQL),
    ("docs", _docs_sql("unpaid_id", [("description", "document_description"),
                                     ("file_name", "file_name"), ("emp_id", "employee_id")], False)),
    ("allap", "select emp1_id, leave_id, status from employee_approve_leave "
              "union all select emp1_id, leave_id, status from newap"),
    ("unp", "select request_id from unpaid_leave union all select request_id from acc"),
    ("ub", f"select {SEQ.format(l='leave_id', e='emp1_id')} as seq, leave_id as request_id, "
           f"emp1_id as upperboard_id from newap"),
    ("dec", f"""select x.seq, x.upperboard_id as emp1_id, x.request_id as leave_id,
   case when exists (select 1 from docs dc where dc.unpaid_id = x.request_id
                     and {ci('dc.type')} = 'memo' and {ci('dc.status')} = 'valid'
                     and rtrim(coalesce(dc.description, '')) <> '')
        then 'approved' else 'rejected' end as new_status
 from ub x where x.request_id in (select request_id from unp)
   and x.upperboard_id in (select emp_id from employee_role where {UPPER_SQL})"""),
    ("upd", "select emp1_id, leave_id, arg_max(new_status, seq) as new_status from dec group by 1, 2"),
]

register("upperboard_decide_unpaid", f"""
select ap.emp1_id, ap.leave_id,
       case when u.new_status is not null and {ci('ap.status')} = 'pending' then u.new_status
            else ap.status end as status
from allap ap left join upd u on u.emp1_id = ap.emp1_id and u.leave_id = ap.leave_id
""", _UNPAID_CTES)(_ub_unpaid)


# ---------------------------------------------------------------- HR decisions


def _hr_batch(t, subtype):
    holders = _holders(t, F.col("role_name").ilike("HR_Representative%")
                       | ci_eq("role_name", "HR Manager"))
    return _approval_batch(t.employee_approve_leave, holders, subtype, "hr_id")


def _guard_cte(subtype: str, mode: str) -> list[tuple[str, str]]:
    own = "and p.emp1_id <> b.hr_id" if mode != "as_written" else ""
    status = f"and {ci('l.final_approval_status')} = 'pending'" if mode != "as_written" else ""
    first = ("" if mode == "as_written" else
             "qualify row_number() over (partition by b.request_id order by b.seq) = 1")
    return [
        ("b", _batch_sql(subtype, HR_SQL, "hr_id")),
        ("g", f"""select b.*, l.date_of_request, l.start_date, l.end_date, l.num_days
 from b join leave l on l.request_id = b.request_id
 where not exists (select 1 from employee_approve_leave p where p.leave_id = b.request_id
                   and {ci('p.status')} = 'pending' {own})
   and l.start_date is not null and l.start_date > {d(DAY)} {status} {first}"""),
    ]


def _repl_flags(lo_hi: tuple[str, str]) -> str:
    lo, hi = lo_hi
    return f"""exists (select 1 from {LEDGER} lg where lg.emp_id = a.replacement_emp
              and {ci('lg.final_approval_status')} in ('approved', 'pending')
              and {overlap('g.start_date', 'g.end_date', 'lg.start_date', 'lg.end_date')}) as repl_on_leave,
       a.replacement_emp is not null and not exists (
              select 1 from employee_replace_employee r where r.emp2_id = a.replacement_emp
              and (r.from_date between {lo} and {hi} or r.to_date between {lo} and {hi}
                   or {lo} between r.from_date and r.to_date or {hi} between r.from_date and r.to_date)) as repl_free"""


NO_REJECTION = ("not exists (select 1 from employee_approve_leave p where p.leave_id = g.request_id "
                "and lower(rtrim(p.status)) = 'rejected') as approval_ok")


def _sequential_ctes(ok: str, days: str, bal: str, mode: str) -> list[tuple[str, str]]:
    """One call after the other: each step holds the list of all earlier approvals."""
    lo, hi = ("c.end_date", "c.start_date") if mode == "as_written" else ("c.start_date", "c.end_date")
    mine = "list_filter(f.booked, lambda x: x.emp = c.myid)"
    left = (f"(case when len(list_filter({mine}, lambda x: x.days is null)) > 0 then null else {bal} - "
            f"coalesce(list_sum(list_transform({mine}, lambda x: x.days)), 0) end)")
    clash = (f"len(list_filter(f.booked, lambda x: x.repl = c.replacement_emp and "
             f"coalesce({overlap(lo, hi, 'x.s', 'x.e')}, false))) > 0")
    fits = f"(not coalesce({days} > {left}, false) and not {clash})"
    entry = (f"[{{'emp': c.myid, 'days': {days}, 'repl': c.replacement_emp, "
             "'s': c.start_date, 'e': c.end_date}]")
    return [
        ("c", f"select *, row_number() over (order by request_id, seq) as rn from a where {ok}"),
        ("f", f"""select c.rn, c.seq, not coalesce({days} > {bal}, false) as approved,
        cast({bal} - {days} as bigint) as remaining,
        case when not coalesce({days} > {bal}, false) then {entry} else list_filter({entry}, lambda x: false) end as booked
 from c where c.rn = 1
 union all
 select c.rn, c.seq, {fits}, cast({left} - {days} as bigint),
        case when {fits} then list_concat(f.booked, {entry}) else f.booked end
 from f join c on c.rn = f.rn + 1"""),
    ]


def _accidental_fold_ctes(ok: str) -> list[tuple[str, str]]:
    first, nxt = "coalesce(c.bal > c.num_days, false)", "coalesce(f.remaining > c.num_days, false)"
    return [
        ("c", f"select *, coalesce(myid, -2147483648) as k, row_number() over "
              f"(partition by coalesce(myid, -2147483648) order by request_id, seq) as rn from a where {ok}"),
        ("f", f"""select c.k, c.rn, c.seq, {first} as approved,
        case when {first} then c.bal - c.num_days else c.bal end as remaining
 from c where c.rn = 1
 union all
 select c.k, c.rn, c.seq, {nxt},
        case when {nxt} then f.remaining - c.num_days else f.remaining end
 from f join c on c.k = f.k and c.rn = f.rn + 1"""),
    ]


DECISIONS_BAL = """select a.seq, a.request_id, a.myid as emp_id, a.hr_id,
       case when coalesce(f.approved, false) then 'approved' else 'rejected' end as final_approval_status,
       case when coalesce(f.approved, false) then cast(f.remaining as integer) end as balance_after
from a left join f on f.seq = a.seq"""


def _annual_ctes(mode: str) -> list[tuple[str, str]]:
    lohi = ("g.end_date", "g.start_date") if mode == "as_written" else ("g.start_date", "g.end_date")
    avail = "repl_on_leave" if mode == "as_written" else "not repl_on_leave"
    return _guard_cte("annual_leave", mode) + [
        ("a", f"""select g.*, x.replacement_emp, e.employee_id as myid, e.annual_balance as bal,
       coalesce({ci('e.type_of_contract')} = 'part_time', false) as pt,
       {_repl_flags(lohi)}, {NO_REJECTION}
 from g join annual_leave x on x.request_id = g.request_id
 left join employee e on e.employee_id = x.emp_id""".replace("a.replacement_emp", "x.replacement_emp")),
    ] + _sequential_ctes(
        f"not pt and replacement_emp is not null and {avail} and repl_free and approval_ok",
        "c.num_days", "c.bal", mode)


def _annual_frames(t, mode="as_written"):
    return D.hr_decide_annual(_hr_batch(t, t.annual_leave), t.leave, t.annual_leave,
                              t.employee_approve_leave, t.employee, L.ledger_from(t),
                              t.employee_replace_employee, DAY, mode)


register("hr_decide_annual", DECISIONS_BAL, _annual_ctes("as_written"), recursive=True)(
    lambda t: _annual_frames(t)["decisions"])
register("hr_decide_annual_corrected", DECISIONS_BAL, _annual_ctes("corrected"), recursive=True)(
    lambda t: _annual_frames(t, "corrected")["decisions"])
REPLACEMENTS = f"""
select table_id, emp1_id, emp2_id, from_date, to_date from employee_replace_employee
union all
select {next_ids('employee_replace_employee', 'table_id', 'a.seq')}, a.myid, a.replacement_emp,
       a.start_date, a.end_date
from a join f on f.seq = a.seq where f.approved
"""

register("hr_decide_annual_replacements", REPLACEMENTS, _annual_ctes("as_written"),
         recursive=True)(lambda t: _annual_frames(t)["replacements"])
register("hr_decide_annual_corrected_replacements", REPLACEMENTS, _annual_ctes("corrected"),
         recursive=True)(lambda t: _annual_frames(t, "corrected")["replacements"])


def _accidental_ctes(mode: str) -> list[tuple[str, str]]:
    return _guard_cte("accidental_leave", mode) + [
        ("a", """select g.*, e.employee_id as myid, e.accidental_balance as bal,
       not coalesce(g.num_days <> 1, false) as one_day,
       coalesce(datediff('day', g.date_of_request, g.start_date) * 24 between 0 and 48, false) as within
 from g join accidental_leave x on x.request_id = g.request_id
 left join employee e on e.employee_id = x.emp_id"""),
    ] + _accidental_fold_ctes("one_day and within")


def _accidental_frames(t, mode="as_written"):
    return D.hr_decide_accidental(_hr_batch(t, t.accidental_leave), t.leave,
                                  t.accidental_leave, t.employee_approve_leave, t.employee,
                                  DAY, mode)["decisions"]


register("hr_decide_accidental", DECISIONS_BAL, _accidental_ctes("as_written"),
         recursive=True)(_accidental_frames)
register("hr_decide_accidental_corrected", DECISIONS_BAL, _accidental_ctes("corrected"),
         recursive=True)(lambda t: _accidental_frames(t, "corrected"))


def _unpaid_ctes(mode: str) -> list[tuple[str, str]]:
    base = _guard_cte("unpaid_leave", mode) + [
        ("a", f"""select g.*, x.emp_id as myid,
       coalesce({ci('e.type_of_contract')} = 'part_time', false) as pt,
       coalesce(g.num_days <= 30, false) as short, {NO_REJECTION},
       year(g.date_of_request) as ry, year(g.start_date) as sy
 from g join unpaid_leave x on x.request_id = g.request_id
 left join employee e on e.employee_id = x.emp_id"""),
        ("appr", f"select emp_id, year(start_date) as y from {LEDGER} lg where kind = 3 "
                 f"and {ci('lg.final_approval_status')} = 'approved'"),
    ]
    ok = "not pt and short and approval_ok"
    if mode == "as_written":
        base += [
            ("c", f"select a.*, row_number() over (order by request_id, seq) as rn, "
                  f"(select coalesce(max(y), -1) from appr) as m0 from a where {ok}"),
        ]
        key_join = "c.rn = f.rn + 1"
        part = ""
    else:
        base += [
            ("c", f"select a.*, coalesce(myid, -2147483648) as k, row_number() over "
                  f"(partition by coalesce(myid, -2147483648) order by request_id, seq) as rn, "
                  f"coalesce((select max(y) from appr p where p.emp_id = a.myid), -1) as m0 "
                  f"from a where {ok}"),
        ]
        key_join = "c.k = f.k and c.rn = f.rn + 1"
        part = "c.k, "
    base.append(("f", f"""select {part}c.rn, c.seq, coalesce(c.ry > c.m0, false) as approved,
        case when coalesce(c.ry > c.m0, false) and c.sy is not null then greatest(c.m0, c.sy) else c.m0 end as m
 from c where c.rn = 1
 union all
 select {part}c.rn, c.seq, coalesce(c.ry > f.m, false),
        case when coalesce(c.ry > f.m, false) and c.sy is not null then greatest(f.m, c.sy) else f.m end
 from f join c on {key_join}"""))
    return base


DECISIONS_PLAIN = """select a.seq, a.request_id, a.myid as emp_id, a.hr_id,
       case when coalesce(f.approved, false) then 'approved' else 'rejected' end as final_approval_status
from a left join f on f.seq = a.seq"""


def _unpaid_frames(t, mode="as_written"):
    return D.hr_decide_unpaid(_hr_batch(t, t.unpaid_leave), t.leave, t.unpaid_leave,
                              t.employee_approve_leave, t.employee, L.ledger_from(t), DAY,
                              mode)["decisions"]


register("hr_decide_unpaid", DECISIONS_PLAIN, _unpaid_ctes("as_written"), recursive=True)(
    _unpaid_frames)
register("hr_decide_unpaid_corrected", DECISIONS_PLAIN, _unpaid_ctes("corrected"),
         recursive=True)(lambda t: _unpaid_frames(t, "corrected"))


def _comp_ctes(mode: str) -> list[tuple[str, str]]:
    lohi = ("g.end_date", "g.start_date") if mode == "as_written" else ("g.start_date", "g.end_date")
    avail = "repl_on_leave" if mode == "as_written" else "not repl_on_leave"
    return _guard_cte("compensation_leave", mode) + [
        ("a", f"""select g.*, x.emp_id as myid, x.reason as creason, x.replacement_emp,
       exists (select 1 from attendance att join employee e on e.employee_id = x.emp_id
               where att.date = x.date_of_original_workday and att.emp_id = x.emp_id
                 and att.total_duration >= 480
                 and lower(dayname(x.date_of_original_workday)) = {ci('e.official_day_off')}
                 and year(x.date_of_original_workday) = year(g.date_of_request)
                 and month(x.date_of_original_workday) = month(g.date_of_request)) as spent,
       {_repl_flags(lohi).replace('a.replacement_emp', 'x.replacement_emp')}
 from g join compensation_leave x on x.request_id = g.request_id"""),
    ] + _sequential_ctes(
        f"replacement_emp is not null and {avail} and repl_free and spent "
        "and coalesce(rtrim(creason) <> '', false)",
        "cast(null as integer)", "cast(null as integer)", mode)


def _comp_frames(t, mode="as_written"):
    return D.hr_decide_compensation(_hr_batch(t, t.compensation_leave), t.leave,
                                    t.compensation_leave, t.employee_approve_leave,
                                    t.employee, t.attendance, L.ledger_from(t),
                                    t.employee_replace_employee, DAY, mode)


register("hr_decide_compensation", DECISIONS_PLAIN, _comp_ctes("as_written"), recursive=True)(
    lambda t: _comp_frames(t)["decisions"])
register("hr_decide_compensation_corrected", DECISIONS_PLAIN, _comp_ctes("corrected"),
         recursive=True)(lambda t: _comp_frames(t, "corrected")["decisions"])
register("hr_decide_compensation_corrected_replacements", REPLACEMENTS,
         _comp_ctes("corrected"), recursive=True)(
    lambda t: _comp_frames(t, "corrected")["replacements"])


# ---------------------------------------------------------------- evaluations


def evaluation_batch(t):
    """Stand-in batch: one evaluation per part row (ratings 0..6, so some fail)."""
    p = t.base("part")
    employees = t.base("customer").agg(F.count(F.lit(1))).scalar()
    return p.select(F.col("p_partkey").alias("seq"),
                    (F.col("p_partkey") % employees + 1).cast("bigint").alias("employee_id"),
                    (F.col("p_size") % 7).cast("int").alias("rating"),
                    F.col("p_type").alias("comment"), F.lit("W24").alias("semester"))


EVAL_BATCH = ("(select p_partkey as seq, cast(p_partkey % (select count(*) from "
              "customer) + 1 as bigint) as employee_id, "
              "cast(p_size % 7 as integer) as rating, p_type as comment, 'W24' as semester from part)")

register("append_evaluations", f"""
select {next_ids('performance', 'performance_id', 'seq')} as performance_id, rating,
       comment as comments, semester, employee_id as emp_id
from {EVAL_BATCH} x where rating between 1 and 5 or rating is null
""")(lambda t: D.append_evaluations(t.performance, evaluation_batch(t))[0])

register("append_evaluations_rejects", f"""
select seq, employee_id, rating, comment, semester from {EVAL_BATCH} x where not (rating between 1 and 5)
""")(lambda t: D.append_evaluations(t.performance, evaluation_batch(t))[1])


# ---------------------------------------------------------------- decision snapshots


# Outputs of a decision batch as SQL over its decisions ``dd``.
_LEAVE_SNAPSHOT = """
select l.request_id, l.date_of_request, l.start_date, l.end_date, l.num_days,
       coalesce(u.st, l.final_approval_status) as final_approval_status
from leave l left join (select request_id, arg_max(final_approval_status, seq) as st
                        from dd group by 1) u on u.request_id = l.request_id
"""
_APPROVAL_SNAPSHOT = """
select ap.emp1_id, ap.leave_id, coalesce(u.st, ap.status) as status
from employee_approve_leave ap
left join (select hr_id, request_id, arg_max(final_approval_status, seq) as st
           from dd group by 1, 2) u on u.hr_id = ap.emp1_id and u.request_id = ap.leave_id
"""


def _balance_snapshot(column: str) -> str:
    return f"""
select e.* replace (case when u.emp_id is not null then u.bal else e.{column} end as {column})
from employee e
left join (select emp_id, arg_max(balance_after, (request_id, seq)) as bal from dd
           where final_approval_status = 'approved' group by 1) u on u.emp_id = e.employee_id
"""


def _register_snapshots(key: str, decide, ctes: list[tuple[str, str]], decisions_sql: str,
                        balance: str | None = None) -> None:
    """Leave, approval and (with a balance column) Employee snapshots after a batch."""
    ctes = ctes + [("dd", decisions_sql)]
    register(f"{key}_leave", _LEAVE_SNAPSHOT, ctes, recursive=True)(
        lambda t: D.apply_leave_status(t.leave, decide(t)))
    register(f"{key}_approvals", _APPROVAL_SNAPSHOT, ctes, recursive=True)(
        lambda t: D.apply_approval_updates(t.employee_approve_leave,
                                           D.approval_updates_from(decide(t))))
    if balance:
        register(f"{key}_balances", _balance_snapshot(balance), ctes, recursive=True)(
            lambda t: D.apply_balances(t.employee, decide(t), balance))


_register_snapshots("hr_decide_annual_corrected",
                    lambda t: _annual_frames(t, "corrected")["decisions"],
                    _annual_ctes("corrected"), DECISIONS_BAL, "annual_balance")
_register_snapshots("hr_decide_accidental_corrected",
                    lambda t: _accidental_frames(t, "corrected"),
                    _accidental_ctes("corrected"), DECISIONS_BAL, "accidental_balance")
_register_snapshots("hr_decide_unpaid_corrected", lambda t: _unpaid_frames(t, "corrected"),
                    _unpaid_ctes("corrected"), DECISIONS_PLAIN)
_register_snapshots("hr_decide_compensation_corrected",
                    lambda t: _comp_frames(t, "corrected")["decisions"],
                    _comp_ctes("corrected"), DECISIONS_PLAIN)
