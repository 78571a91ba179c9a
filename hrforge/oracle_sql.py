"""Small SQL text builders shared by the DuckDB oracles."""

from __future__ import annotations

import datetime as dt


def d(x: dt.date) -> str:
    return f"date '{x.isoformat()}'"


def ci(x: str) -> str:
    return f"lower(rtrim({x}))"


def rq(n: str, den: int) -> str:
    """Integer n / den rounded half away from zero."""
    return (f"(case when ({n}) < 0 then -((2*(-({n})) + {den}) // {2 * den}) "
            f"else (2*({n}) + {den}) // {2 * den} end)")


def from_cents(c: str, p: int = 10) -> str:
    return f"cast(cast({c} as decimal(18,0)) * 0.01 as decimal({p},2))"


def cents(x: str) -> str:
    return f"cast(({x}) * 100 as bigint)"


def in_month(col: str, first: dt.date) -> str:
    nxt = (first.replace(year=first.year + 1, month=1) if first.month == 12
           else first.replace(month=first.month + 1))
    return f"({col} >= {d(first)} and {col} < {d(nxt)})"


def overlap(fa: str, ta: str, fb: str, tb: str) -> str:
    return (f"({fa} between {fb} and {tb} or {ta} between {fb} and {tb} "
            f"or {fb} between {fa} and {ta} or {tb} between {fa} and {ta})")


LEDGER = """(select s.request_id, s.kind, s.emp_id, s.replacement_emp, l.date_of_request,
        l.start_date, l.end_date, l.num_days, l.final_approval_status
 from (select request_id, emp_id, 0 as kind, replacement_emp from annual_leave
       union select request_id, emp_id, 1, cast(null as bigint) from accidental_leave
       union select request_id, emp_id, 2, cast(null as bigint) from medical_leave
       union select request_id, emp_id, 3, cast(null as bigint) from unpaid_leave
       union select request_id, emp_id, 4, replacement_emp from compensation_leave) s
 join leave l on l.request_id = s.request_id)"""


def on_leave_ids(day: dt.date, statuses=("approved", "pending")) -> str:
    st = ", ".join(f"'{s}'" for s in statuses)
    return (f"(select distinct emp_id from {LEDGER} lg where emp_id is not null "
            f"and {ci('lg.final_approval_status')} in ({st}) "
            f"and {overlap(d(day), d(day), 'lg.start_date', 'lg.end_date')})")


def top_role(cols: str) -> str:
    """Per employee, the lowest-rank role (ties by role name) with ``cols``."""
    return (f"(select * from (select er.emp_id, {cols}, row_number() over "
            f"(partition by er.emp_id order by r.rank, er.role_name) as rn "
            f"from employee_role er join role r on {ci('er.role_name')} = {ci('r.role_name')}) "
            f"where rn = 1)")


def next_ids(table: str, col: str, order: str) -> str:
    return (f"cast((select coalesce(max({col}), 0) from {table}) + row_number() over "
            f"(order by {order}) as bigint)")
