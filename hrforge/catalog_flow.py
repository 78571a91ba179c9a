"""Catalog: leave submission routing and decisions.

Stand-in request batches are built from the existing leave tables (each existing
request is submitted again, in request-id order), so the batch grows with the data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hrforge.catalog import LEAVE_DAY, register
from hrforge.oracle_sql import ci, d, next_ids, on_leave_ids
from hrforge.operators import submit as S
from hrforge.operators import ledger as L

DAY = LEAVE_DAY

# ---------------------------------------------------------------- stand-in batches


def annual_requests(t):
    return t.annual_leave.join(t.leave, "request_id").select(
        F.col("request_id").alias("seq"), F.col("emp_id").alias("employee_id"),
        "replacement_emp", "start_date", "end_date")


def accidental_requests(t):
    return t.accidental_leave.join(t.leave, "request_id").select(
        F.col("request_id").alias("seq"), F.col("emp_id").alias("employee_id"),
        "start_date", "end_date")


def medical_requests(t):
    docs = t.document.select(F.col("medical_id").alias("request_id"), "file_name",
                             F.col("description").alias("document_description"))
    docs = docs.groupBy("request_id").agg(F.max(F.struct("file_name", "document_description"))
                                          .alias("_d"))
    return (t.medical_leave.join(t.leave, "request_id")
            .join(docs, "request_id", "left")
            .select(F.col("request_id").alias("seq"), F.col("emp_id").alias("employee_id"),
                    "start_date", "end_date", "type", "insurance_status", "disability_details",
                    F.col("_d.document_description").alias("document_description"),
                    F.col("_d.file_name").alias("file_name")))


def unpaid_requests(t):
    docs = t.document.select(F.col("unpaid_id").alias("request_id"), "file_name",
                             F.col("description").alias("document_description"))
    docs = docs.groupBy("request_id").agg(F.max(F.struct("file_name", "document_description"))
                                          .alias("_d"))
    return (t.unpaid_leave.join(t.leave, "request_id")
            .join(docs, "request_id", "left")
            .select(F.col("request_id").alias("seq"), F.col("emp_id").alias("employee_id"),
                    "start_date", "end_date",
                    F.col("_d.document_description").alias("document_description"),
                    F.col("_d.file_name").alias("file_name")))


def compensation_requests(t):
    return t.compensation_leave.join(t.leave, "request_id").select(
        F.col("request_id").alias("seq"), "reason",
        F.col("start_date").alias("compensation_date"), "date_of_original_workday", "emp_id",
        "replacement_emp")


REQ_SQL = {
    "annual": """select a.request_id as seq, a.emp_id as employee_id, a.replacement_emp,
                 l.start_date, l.end_date from annual_leave a join leave l on l.request_id = a.request_id""",
    "accidental": """select a.request_id as seq, a.emp_id as employee_id, l.start_date, l.end_date
                 from accidental_leave a join leave l on l.request_id = a.request_id""",
    "medical": """select m.request_id as seq, m.emp_id as employee_id, l.start_date, l.end_date,
                 m.type, m.insurance_status, m.disability_details,
                 dd.document_description, dd.file_name
                 from medical_leave m join leave l on l.request_id = m.request_id
                 left join (select medical_id, arg_max(file_name, struct_pack(f := file_name, s := description)) as file_name,
                                   arg_max(description, struct_pack(f := file_name, s := description)) as document_description
                            from document where medical_id is not null group by medical_id) dd
                   on dd.medical_id = m.request_id""",
    "unpaid": """select u.request_id as seq, u.emp_id as employee_id, l.start_date, l.end_date,
                 dd.document_description, dd.file_name
                 from unpaid_leave u join leave l on l.request_id = u.request_id
                 left join (select unpaid_id, arg_max(file_name, struct_pack(f := file_name, s := description)) as file_name,
                                   arg_max(description, struct_pack(f := file_name, s := description)) as document_description
                            from document where unpaid_id is not null group by unpaid_id) dd
                   on dd.unpaid_id = u.request_id""",
    "compensation": """select c.request_id as seq, c.reason as comp_reason, l.start_date as compensation_date,
                 c.date_of_original_workday, c.emp_id, c.replacement_emp
                 from compensation_leave c join leave l on l.request_id = c.request_id""",
}


def _hrrep(x: str) -> str:
    """Text after the second underscore (whole text when there is none)."""
    p1 = f"strpos({x}, '_')"
    p2 = (f"(case when {p1} = 0 then 0 when strpos(substr({x}, {p1} + 1), '_') = 0 then 0 "
          f"else {p1} + strpos(substr({x}, {p1} + 1), '_') end)")
    return f"substring({x}, {p2} + 1, length({x}))"


ONL = on_leave_ids(DAY)
NOT_OFF = f"emp_id not in (select emp_id from onl)"
RED_ER = f"(select * from employee_role where {ci('role_name')} in (select {ci('role_name')} from role_existsin_department))"


def dir_ctes(mode: str = "as_written") -> list[tuple[str, str]]:
    ctes = [
        ("onl", f"select * from {ONL} o"),
        ("hr_mgr_red_avail", f"select max(emp_id) as id from {RED_ER} x where {ci('role_name')} = 'hr manager' and {NOT_OFF}"),
        ("hr_mgr_red_any", f"select max(emp_id) as id from {RED_ER} x where {ci('role_name')} = 'hr manager'"),
        ("hr_mgr_plain_avail", f"select max(emp_id) as id from employee_role where {ci('role_name')} = 'hr manager' and {NOT_OFF}"),
        ("president", f"select max(emp_id) as id from employee_role where {ci('role_name')} = 'president' and {NOT_OFF}"),
        ("vice_president", f"select max(emp_id) as id from employee_role where {ci('role_name')} = 'vice president' and {NOT_OFF}"),
        ("hrrep_avail", f"select {ci(_hrrep('role_name'))} as dkey, max(emp_id) as hr_rep from {RED_ER} x where role_name ilike 'HR_Representative%' and {NOT_OFF} group by 1"),
        ("hrrep_avail_u", f"select {ci(_hrrep('role_name'))} as dkey, max(emp_id) as hr_rep from {RED_ER} x where role_name ilike 'HR_Representative_%' and {NOT_OFF} group by 1"),
        ("hrrep_any", f"select {ci(_hrrep('role_name'))} as dkey, max(emp_id) as hr_rep from {RED_ER} x where role_name ilike 'HR_Representative%' group by 1"),
        ("medic", f"select min(emp_id) as id from employee_role where {ci('role_name')} in (select {ci('role_name')} from role_existsin_department where {ci('department_name')} = 'medical') and {NOT_OFF}"),
        ("dov", f"select distinct emp_id from employee_role where {ci('role_name')} in ('dean', 'vice dean')"),
    ]
    for role, name in (("dean", "dean_d"), ("vice dean", "vdean_d")):
        col = "dean" if role == "dean" else "vice_dean"
        if mode == "as_written":
            ctes.append((name, f"select distinct {ci('department_name')} as dkey, "
                               f"(select max(emp_id) from employee_role where {ci('role_name')} = '{role}' and {NOT_OFF}) as {col} "
                               f"from role_existsin_department where {ci('role_name')} = '{role}'"))
        else:
            ctes.append((name, f"select r.dkey, h.{col} from (select distinct {ci('department_name')} as dkey from role_existsin_department where {ci('role_name')} = '{role}') r "
                               f"join (select {ci('e.dept_name')} as dkey, max(er.emp_id) as {col} from employee_role er join employee e on e.employee_id = er.emp_id "
                               f"where {ci('er.role_name')} = '{role}' and er.{NOT_OFF} group by 1) h on h.dkey = r.dkey"))
    return ctes


def _base(req: str, emp_col: str = "employee_id") -> str:
    return (f"select r.*, e.dept_name as _dept, {ci('e.dept_name')} as _dkey, "
            f"coalesce({ci('e.type_of_contract')} = 'part_time', false) as _pt, "
            f"coalesce({ci('e.gender')} = 'm', false) as _male, "
            f"coalesce(r.{emp_col} in (select emp_id from dov), false) as _dov "
            f"from ({req}) r left join employee e on e.employee_id = r.{emp_col}")


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def dec_annual() -> str:
    return f"""select b.*, h.hr_rep, dn.dean, vd.vice_dean,
  case when _pt then {_q(S.MSG_ANNUAL_PART_TIME)}
       when _dept is null then {_q(S.MSG_ANNUAL_NO_DEPT)}
       when _dkey = 'hr' and (select id from hr_mgr_red_avail) is null then {_q(S.MSG_ANNUAL_NO_HR_MANAGER)}
       when _dkey = 'hr' then null
       when h.hr_rep is null then {_q(S.MSG_ANNUAL_NO_HR_REP)}
       when _dov and (select id from president) is null then {_q(S.MSG_ANNUAL_NO_PRESIDENT)}
       when _dov then null
       when coalesce(dn.dean, vd.vice_dean) is null then {_q(S.MSG_ANNUAL_NO_DEAN)} end as reason,
  case when _dkey = 'hr' then [(select id from hr_mgr_red_avail)]
       when _dov then [(select id from president), h.hr_rep]
       else [coalesce(dn.dean, vd.vice_dean), h.hr_rep] end as approvers
from ({_base(REQ_SQL['annual'])}) b
left join hrrep_avail h on h.dkey = b._dkey
left join dean_d dn on dn.dkey = b._dkey
left join vdean_d vd on vd.dkey = b._dkey"""


def dec_accidental() -> str:
    return f"""select b.*, h.hr_rep,
  case when start_date <> end_date then {_q(S.MSG_ACC_ONE_DAY)}
       when _dept is null then {_q(S.MSG_ACC_NOT_FOUND)}
       when _dkey = 'hr' and (select id from hr_mgr_red_avail) is null then {_q(S.MSG_ACC_NO_HR_MANAGER)}
       when _dkey = 'hr' then null
       when h.hr_rep is null or h.hr_rep in (select emp_id from onl) then {_q(S.MSG_ACC_NO_HR_REP)} end as reason,
  case when _dkey = 'hr' then [(select id from hr_mgr_red_avail)] else [h.hr_rep] end as approvers
from ({_base(REQ_SQL['accidental'])}) b
left join hrrep_any h on h.dkey = b._dkey"""


def dec_medical() -> str:
    return f"""select b.*, h.hr_rep,
  case when {ci('type')} = 'maternity' and (_male or _pt) then {_q(S.MSG_MED_MATERNITY)}
       when _dkey = 'hr' and ((select id from medic) is null or (select id from hr_mgr_red_avail) is null) then {_q(S.MSG_MED_NO_HR_MANAGER)}
       when _dkey = 'hr' then null
       when (select id from medic) is null or h.hr_rep is null or h.hr_rep in (select emp_id from onl) then {_q(S.MSG_MED_NO_HR_REP)} end as reason,
  case when _dkey = 'hr' then [(select id from medic), (select id from hr_mgr_red_avail)]
       else [(select id from medic), h.hr_rep] end as approvers
from ({_base(REQ_SQL['medical'])}) b
left join hrrep_any h on h.dkey = b._dkey"""


def dec_unpaid(mode: str) -> str:
    upper = "coalesce((select id from president), (select id from vice_president))"
    head = "coalesce(dn.dean, vd.vice_dean)"
    noapp = (f"(case when _dkey = 'hr' then (select id from hr_mgr_plain_avail) is null or {upper} is null "
             f"when _dov then h.hr_rep is null or {upper} is null "
             f"else {head} is null or h.hr_rep is null or {upper} is null end)")
    if mode == "as_written":
        reason = "cast(null as varchar)"
        creates = "not _pt"
    else:
        reason = f"case when _pt then null when {noapp} then {_q(S.MSG_UNPAID_NO_APPROVERS)} end"
        creates = f"not _pt and not {noapp}"
    return f"""select b.*, h.hr_rep, {reason} as reason, {creates} as creates_leave,
  case when {noapp} then cast([] as bigint[])
       when _dkey = 'hr' then [{upper}, (select id from hr_mgr_plain_avail)]
       when _dov then [{upper}, h.hr_rep]
       else [{head}, {upper}, h.hr_rep] end as approvers
from ({_base(REQ_SQL['unpaid'])}) b
left join hrrep_avail_u h on h.dkey = b._dkey
left join dean_d dn on dn.dkey = b._dkey
left join vdean_d vd on vd.dkey = b._dkey"""


def dec_compensation() -> str:
    return f"""select b.*, b.emp_id as employee_id, h.hr_rep,
  case when _dkey = 'hr' and ((select id from hr_mgr_red_any) is null or (select id from hr_mgr_red_any) in (select emp_id from onl)) then {_q(S.MSG_COMP_NO_HR_MANAGER)}
       when _dkey = 'hr' then null
       when h.hr_rep is null or h.hr_rep in (select emp_id from onl) then {_q(S.MSG_COMP_NO_HR_REP)} end as reason,
  case when _dkey = 'hr' then [(select id from hr_mgr_red_any)] else [h.hr_rep] end as approvers,
  compensation_date as start_date, compensation_date as end_date
from ({_base(REQ_SQL['compensation'], 'emp_id')}) b
left join hrrep_any h on h.dkey = b._dkey"""


SUBTYPE_SQL = {
    "annual": "employee_id as emp_id, replacement_emp",
    "accidental": "employee_id as emp_id",
    "medical": "employee_id as emp_id, insurance_status, disability_details, type",
    "unpaid": "employee_id as emp_id",
    "compensation": "comp_reason as reason, date_of_original_workday, emp_id, replacement_emp",
}


def _flow_ctes(kind: str, mode: str = "as_written", dec_name: str = "dec") -> list[tuple[str, str]]:
    dec = {"annual": dec_annual, "accidental": dec_accidental, "medical": dec_medical,
           "compensation": dec_compensation}
    dsql = dec_unpaid(mode) if kind == "unpaid" else dec[kind]()
    creates = "creates_leave" if kind == "unpaid" else "reason is null"
    return dir_ctes(mode) + [
        (dec_name, dsql),
        ("acc", f"select *, {next_ids('leave', 'request_id', 'seq')} as request_id from {dec_name} where {creates}"),
    ]


def _leaves_sql(kind: str) -> str:
    return (f"select request_id, {d(DAY)} as date_of_request, start_date, end_date, "
            f"cast(datediff('day', start_date, end_date) + 1 as integer) as num_days, "
            f"'pending' as final_approval_status, {SUBTYPE_SQL[kind]} from acc")


APPROVALS_SQL = ("select distinct emp1_id, leave_id, 'pending' as status from "
                 "(select unnest(approvers) as emp1_id, request_id as leave_id from acc) x "
                 "where emp1_id is not null")


def _rejections_sql(kind: str) -> str:
    creates = "creates_leave" if kind == "unpaid" else "reason is null"
    return f"select seq, employee_id, reason from dec where not ({creates})"


def _frames(kind, t, mode="as_written"):
    args = (t.employee, t.employee_role, t.role_existsin_department, L.ledger_from(t), t.leave)
    if kind == "annual":
        return S.submit_annual(annual_requests(t), *args, DAY, mode)
    if kind == "accidental":
        return S.submit_accidental(accidental_requests(t), *args, DAY, mode)
    if kind == "medical":
        return S.submit_medical(medical_requests(t), *args, t.document, DAY, mode)
    if kind == "unpaid":
        return S.submit_unpaid(unpaid_requests(t), *args, t.document, DAY, mode)
    return S.submit_compensation(compensation_requests(t), *args, DAY, mode)


def _register_submit(kind: str, mode: str = "as_written", suffix: str = ""):
    ctes = _flow_ctes(kind, mode)
    base = f"submit_{kind}{suffix}"
    register(f"{base}_leaves", _leaves_sql(kind), ctes)(
        lambda t: _frames(kind, t, mode)["leaves"])
    register(f"{base}_approvals", APPROVALS_SQL, ctes)(
        lambda t: _frames(kind, t, mode)["approvals"])
    register(f"{base}_rejections", _rejections_sql(kind), ctes)(
        lambda t: _frames(kind, t, mode)["rejections"])


for _k in ("annual", "accidental", "medical", "unpaid", "compensation"):
    _register_submit(_k)
_register_submit("unpaid", "corrected", "_corrected")
_register_submit("annual", "corrected", "_corrected")


def _docs_sql(id_col: str, match: list[tuple[str, str]], set_desc: bool) -> str:
    cond = " and ".join(f"dc.{a} = b.{b}" for a, b in match)
    keys = ", ".join(b for _, b in match)
    best = (f"(select {keys}, max(request_id) as request_id, "
            f"arg_max(document_description, request_id) as document_description from acc group by {keys})")
    set_d = ("case when b.request_id is not null then b.document_description else dc.description end"
             if set_desc else "dc.description")
    return (f"select dc.* replace (case when b.request_id is not null then b.request_id else dc.{id_col} end as {id_col}, "
            f"{set_d} as description) from document dc left join {best} b on {cond}")


register("submit_medical_documents",
         _docs_sql("medical_id", [("file_name", "file_name")], True),
         _flow_ctes("medical"))(lambda t: _frames("medical", t)["documents"])

register("submit_unpaid_documents",
         _docs_sql("unpaid_id", [("description", "document_description"),
                                 ("file_name", "file_name"), ("emp_id", "employee_id")], False),
         _flow_ctes("unpaid"))(lambda t: _frames("unpaid", t)["documents"])
