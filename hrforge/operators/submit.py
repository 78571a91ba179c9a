"""Leave submission as batch routing.

Each reference procedure takes one request and either PRINTs an error and
returns, or inserts a Leave row, its subtype row and one approval row per
approver. Here a whole DataFrame of requests (column ``seq`` gives the call
order) is routed at once:

* approver lookups are computed once per run as small frames keyed by
  department (one row per department) or as single-row scalars;
* each request gets a decision: ``reason`` (the PRINT text) or an ``approvers``
  array;
* accepted requests get request ids continuing from max(request_id) in ``seq``
  order and are exploded into approval rows.

All requests read the same snapshot: a request submitted earlier in the batch
does not make its submitter "on leave" for later requests of the same batch.
When several employees qualify for one approver slot, the reference keeps an
arbitrary one; here the highest employee id wins (for its ``TOP 1`` without
ORDER BY, the lowest).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hrforge.functions.dates import as_date
from hrforge.functions.text import ci, ci_eq, hr_representative_of
from hrforge.operators.flags import flag_dean_or_vice, is_male, part_time
from hrforge.operators.ledger import on_leave_ids
from hrforge.plans.ids import assign_ids, max_id
from hrforge.plans.outputs import Outputs
from hrforge.session import checkpoint_dir

# PRINT texts of the reference (fixed values).
MSG_ANNUAL_PART_TIME = "Error! Part-time employees cannot apply for annual leave"
MSG_ANNUAL_NO_DEPT = "Error! Employee department not found."
MSG_ANNUAL_NO_HR_MANAGER = "Error! No HR manager available to approve you!"
MSG_ANNUAL_NO_HR_REP = "Error! HR representative for your department is on leave or not found"
MSG_ANNUAL_NO_PRESIDENT = "Error! President is on leave or not found"
MSG_ANNUAL_NO_DEAN = "Error! No Dean or Vice Dean available to approve your leave."
MSG_ACC_ONE_DAY = "Error! Accidental leave must be for 1 day only"
MSG_ACC_NOT_FOUND = "Error! Employee not found."
MSG_ACC_NO_HR_MANAGER = "Error! No HR manager is available to approve you!"
MSG_ACC_NO_HR_REP = "Error! HR representative for your department is on leave or not found."
MSG_MED_MATERNITY = ("Error! Male and part-time employees are not authorised to apply for "
                     "maternity leaves")
MSG_MED_NO_HR_MANAGER = "Error! No approvers available (Medical staff or HR Manager)."
MSG_MED_NO_HR_REP = "Error! No approvers available (Medical staff or HR representative)."
MSG_COMP_NO_HR_MANAGER = "Error! HR Manager is unavailable."
MSG_COMP_NO_HR_REP = "Error! Your HR representative is unavailable."
# Not in the reference (it returns silently); used by the corrected unpaid routing.
MSG_UNPAID_NO_APPROVERS = "No approvers available"


@dataclass
class Directory:
    """Approver lookups for one run (one snapshot, one as_of day)."""

    employee: DataFrame
    employee_role: DataFrame
    red: DataFrame          # role_existsin_department
    on_leave: DataFrame     # emp_id on leave on as_of
    mode: str = "as_written"

    def roles_in_some_department(self) -> DataFrame:
        r = self.red.select(ci("role_name").alias("_rk")).distinct()
        return self.employee_role.join(r, ci(self.employee_role.role_name) == r._rk,
                                       "left_semi")

    def available(self, er: DataFrame) -> DataFrame:
        off = self.on_leave.select(F.col("emp_id").alias("_off"))
        return er.join(off, er.emp_id == off._off, "left_anti")

    @staticmethod
    def pick(er: DataFrame, lowest: bool = False) -> Column:
        """Scalar subquery: one employee id (highest, or lowest) or null."""
        agg = F.min("emp_id") if lowest else F.max("emp_id")
        return er.select(agg).scalar()

    def is_on_leave(self, emp: Column) -> Column:
        """Per-row test (``emp`` is a column of the probe rows): an existence
        join keyed on the employee id."""
        return emp.isin(self.on_leave.select("emp_id"))

    def scalar_on_leave(self, emp: Column) -> Column:
        """The same test for one scalar employee id: a scalar subquery filtered by
        that id, so the on-leave set is never broadcast as a whole."""
        return self.on_leave.filter(F.col("emp_id") == emp).select(
            F.count(F.lit(1)) > 0).scalar()

    def hr_manager(self, via_department: bool = True, available: bool = True) -> Column:
        er = self.roles_in_some_department() if via_department else self.employee_role
        er = er.filter(ci_eq("role_name", "HR Manager"))
        return self.pick(self.available(er) if available else er)

    def by_role(self, role_name: str) -> Column:
        er = self.employee_role.filter(ci_eq("role_name", role_name))
        return self.pick(self.available(er))

    def hr_reps(self, available: bool, pattern: str = "HR_Representative%") -> DataFrame:
        """Per department key: the HR representative (dkey, hr_rep)."""
        er = self.roles_in_some_department().filter(F.col("role_name").ilike(pattern))
        if available:
            er = self.available(er)
        return (er.groupBy(ci(hr_representative_of(F.col("role_name"))).alias("dkey"))
                .agg(F.max("emp_id").alias("hr_rep")))

    def dept_heads(self, role_name: str, out: str) -> DataFrame:
        """Per department key: an available employee holding ``role_name``.

        As written the lookup only checks that the *role* exists in the department
        (any dean of any department qualifies); ``corrected`` also requires the
        employee to work in that department.
        """
        er = self.available(self.employee_role.filter(ci_eq("role_name", role_name)))
        depts = (self.red.filter(ci_eq("role_name", role_name))
                 .select(ci("department_name").alias("dkey")).distinct())
        if self.mode == "as_written":
            return depts.withColumn(out, self.pick(er))
        e = self.employee.select(F.col("employee_id").alias("_e"), ci("dept_name").alias("dkey"))
        per = (er.join(e, er.emp_id == e._e, "inner").groupBy("dkey")
               .agg(F.max("emp_id").alias(out)))
        return depts.join(per, "dkey", "inner")

    def medical_staff(self) -> Column:
        """Any available employee whose role exists in the Medical department
        (``TOP 1`` without ORDER BY: lowest id)."""
        med = (self.red.filter(ci_eq("department_name", "Medical"))
               .select(ci("role_name").alias("_rk")).distinct())
        er = self.employee_role.join(med, ci(self.employee_role.role_name) == med._rk,
                                     "left_semi")
        return self.pick(self.available(er), lowest=True)


def directory(employee: DataFrame, employee_role: DataFrame, red: DataFrame,
              ledger: DataFrame, as_of, mode: str = "as_written") -> Directory:
    """Approver lookups for one run. The ids on leave on as_of feed every lookup,
    so they are computed once and frozen with a reliable checkpoint (one row per
    employee on leave that day) instead of re-deriving the ledger per lookup."""
    checkpoint_dir(employee.sparkSession)
    off = on_leave_ids(ledger, as_of, as_of).checkpoint(eager=True)
    return Directory(employee, employee_role, red, off, mode)


def _with_employee(requests: DataFrame, employee: DataFrame, emp_col: str) -> DataFrame:
    e = employee.select(F.col("employee_id").alias("_eid"), F.col("dept_name").alias("_dept"),
                        F.col("type_of_contract").alias("_contract"),
                        F.col("gender").alias("_gender"))
    r = requests.join(e, requests[emp_col] == e._eid, "left").drop("_eid")
    return r.withColumn("_dkey", ci("_dept"))


def _join_dept(r: DataFrame, lookup: DataFrame) -> DataFrame:
    return r.join(lookup, r._dkey == lookup.dkey, "left").drop("dkey")


def _arr(*cols: Column) -> Column:
    return F.array(*cols)


# ---------------------------------------------------------------- routing rules


def route_annual(requests: DataFrame, d: Directory) -> DataFrame:
    """requests: seq, employee_id, replacement_emp, start_date, end_date."""
    r = _with_employee(requests, d.employee, "employee_id")
    r = _join_dept(r, d.hr_reps(available=True))
    r = _join_dept(r, d.dept_heads("Dean", "dean"))
    r = _join_dept(r, d.dept_heads("Vice Dean", "vice_dean"))
    r = flag_dean_or_vice(r, d.employee_role, "employee_id", "_dov")
    hr_mgr = d.hr_manager()
    president = d.by_role("President")
    head = F.coalesce(F.col("dean"), F.col("vice_dean"))
    is_hr = F.col("_dkey") == F.lit("hr")
    reason = (F.when(part_time(F.col("_contract")), F.lit(MSG_ANNUAL_PART_TIME))
              .when(F.col("_dept").isNull(), F.lit(MSG_ANNUAL_NO_DEPT))
              .when(is_hr & hr_mgr.isNull(), F.lit(MSG_ANNUAL_NO_HR_MANAGER))
              .when(is_hr, F.lit(None))
              .when(F.col("hr_rep").isNull(), F.lit(MSG_ANNUAL_NO_HR_REP))
              .when(F.col("_dov") & president.isNull(), F.lit(MSG_ANNUAL_NO_PRESIDENT))
              .when(F.col("_dov"), F.lit(None))
              .when(head.isNull(), F.lit(MSG_ANNUAL_NO_DEAN)))
    approvers = (F.when(is_hr, _arr(hr_mgr))
                 .when(F.col("_dov"), _arr(president, F.col("hr_rep")))
                 .otherwise(_arr(head, F.col("hr_rep"))))
    return r.withColumn("reason", reason).withColumn("approvers", approvers) \
        .withColumn("creates_leave", F.col("reason").isNull())


def route_accidental(requests: DataFrame, d: Directory) -> DataFrame:
    """requests: seq, employee_id, start_date, end_date."""
    r = _with_employee(requests, d.employee, "employee_id")
    r = _join_dept(r, d.hr_reps(available=False))
    hr_mgr = d.hr_manager()
    is_hr = F.col("_dkey") == F.lit("hr")
    reason = (F.when(F.col("start_date") != F.col("end_date"), F.lit(MSG_ACC_ONE_DAY))
              .when(F.col("_dept").isNull(), F.lit(MSG_ACC_NOT_FOUND))
              .when(is_hr & hr_mgr.isNull(), F.lit(MSG_ACC_NO_HR_MANAGER))
              .when(is_hr, F.lit(None))
              .when(F.col("hr_rep").isNull() | d.is_on_leave(F.col("hr_rep")),
                    F.lit(MSG_ACC_NO_HR_REP)))
    approvers = F.when(is_hr, _arr(hr_mgr)).otherwise(_arr(F.col("hr_rep")))
    return r.withColumn("reason", reason).withColumn("approvers", approvers) \
        .withColumn("creates_leave", F.col("reason").isNull())


def route_medical(requests: DataFrame, d: Directory) -> DataFrame:
    """requests: seq, employee_id, start_date, end_date, type, insurance_status,
    disability_details, document_description, file_name."""
    r = _with_employee(requests, d.employee, "employee_id")
    r = _join_dept(r, d.hr_reps(available=False))
    hr_mgr = d.hr_manager()
    medic = d.medical_staff()
    is_hr = F.col("_dkey") == F.lit("hr")
    maternity = ci_eq("type", "maternity")
    reason = (F.when(maternity & (is_male(F.col("_gender")) | part_time(F.col("_contract"))),
                     F.lit(MSG_MED_MATERNITY))
              .when(is_hr & (medic.isNull() | hr_mgr.isNull()), F.lit(MSG_MED_NO_HR_MANAGER))
              .when(is_hr, F.lit(None))
              .when(medic.isNull() | F.col("hr_rep").isNull() | d.is_on_leave(F.col("hr_rep")),
                    F.lit(MSG_MED_NO_HR_REP)))
    approvers = F.when(is_hr, _arr(medic, hr_mgr)).otherwise(_arr(medic, F.col("hr_rep")))
    return r.withColumn("reason", reason).withColumn("approvers", approvers) \
        .withColumn("creates_leave", F.col("reason").isNull())


def route_unpaid(requests: DataFrame, d: Directory) -> DataFrame:
    """requests: seq, employee_id, start_date, end_date, document_description,
    file_name.

    Part-timers are turned away silently. As written the Leave and Unpaid_Leave
    rows are written *before* the approvers are looked up, so a request with no
    approvers still creates its (pending) leave, with no approval rows;
    ``corrected`` sends such requests to the rejections instead.
    """
    r = _with_employee(requests, d.employee, "employee_id")
    r = _join_dept(r, d.hr_reps(available=True, pattern="HR_Representative_%"))
    r = _join_dept(r, d.dept_heads("Dean", "dean"))
    r = _join_dept(r, d.dept_heads("Vice Dean", "vice_dean"))
    r = flag_dean_or_vice(r, d.employee_role, "employee_id", "_dov")
    hr_mgr = d.hr_manager(via_department=False)
    upper = F.coalesce(d.by_role("President"), d.by_role("Vice President"))
    head = F.coalesce(F.col("dean"), F.col("vice_dean"))
    is_hr = F.col("_dkey") == F.lit("hr")
    pt = part_time(F.col("_contract"))
    no_approvers = (F.when(is_hr, hr_mgr.isNull() | upper.isNull())
                    .when(F.col("_dov"), F.col("hr_rep").isNull() | upper.isNull())
                    .otherwise(head.isNull() | F.col("hr_rep").isNull() | upper.isNull()))
    approvers = (F.when(is_hr, _arr(upper, hr_mgr))
                 .when(F.col("_dov"), _arr(upper, F.col("hr_rep")))
                 .otherwise(_arr(head, upper, F.col("hr_rep"))))
    approvers = F.when(no_approvers, F.array().cast("array<int>")).otherwise(approvers)
    if d.mode == "as_written":
        reason = F.lit(None).cast("string")
        creates = ~pt
    else:
        reason = F.when(pt, F.lit(None)).when(no_approvers, F.lit(MSG_UNPAID_NO_APPROVERS))
        creates = ~pt & ~no_approvers
    return (r.withColumn("reason", reason).withColumn("approvers", approvers)
            .withColumn("creates_leave", creates))


def route_compensation(requests: DataFrame, d: Directory) -> DataFrame:
    """requests: seq, reason, compensation_date, date_of_original_workday, emp_id,
    replacement_emp. The leave is for the compensation day only."""
    r = _with_employee(requests.withColumnRenamed("reason", "comp_reason"),
                       d.employee, "emp_id")
    r = _join_dept(r, d.hr_reps(available=False))
    hr_mgr = d.hr_manager(available=False)
    is_hr = F.col("_dkey") == F.lit("hr")
    reason = (F.when(is_hr & (hr_mgr.isNull() | d.scalar_on_leave(hr_mgr)),
                     F.lit(MSG_COMP_NO_HR_MANAGER))
              .when(is_hr, F.lit(None))
              .when(F.col("hr_rep").isNull() | d.is_on_leave(F.col("hr_rep")),
                    F.lit(MSG_COMP_NO_HR_REP)))
    approvers = F.when(is_hr, _arr(hr_mgr)).otherwise(_arr(F.col("hr_rep")))
    return (r.withColumn("reason", reason).withColumn("approvers", approvers)
            .withColumn("creates_leave", F.col("reason").isNull())
            .withColumn("start_date", F.col("compensation_date"))
            .withColumn("end_date", F.col("compensation_date"))
            .withColumn("employee_id", F.col("emp_id")))


# ---------------------------------------------------------------- materialise


def materialize(decisions: DataFrame, leave: DataFrame, as_of,
                subtype_cols: list[Column]) -> Outputs:
    """Turn routed requests into new rows.

    Returns ``leaves`` (new Leave rows with the subtype columns), ``approvals``
    (emp1_id, leave_id, status) and ``rejections`` (seq, employee_id, reason),
    each built on first access.
    """
    def accepted() -> DataFrame:
        acc = decisions.filter(F.col("creates_leave"))
        return assign_ids(acc, ["seq"], "request_id", max_id(leave, "request_id"))

    def leaves() -> DataFrame:
        return out["accepted"].select(
            "request_id", as_date(as_of).alias("date_of_request"), "start_date", "end_date",
            (F.datediff("end_date", "start_date") + 1).cast("int").alias("num_days"),
            F.lit("pending").alias("final_approval_status"), *subtype_cols)

    def approvals() -> DataFrame:
        return (out["accepted"].select(F.explode(F.array_distinct("approvers")).alias("emp1_id"),
                                       F.col("request_id").alias("leave_id"))
                .filter(F.col("emp1_id").isNotNull())
                .withColumn("status", F.lit("pending")))

    def rejections() -> DataFrame:
        return decisions.filter(~F.col("creates_leave")).select("seq", "employee_id", "reason")

    out = Outputs(accepted=accepted, leaves=leaves, approvals=approvals, rejections=rejections)
    return out


def link_documents(document: DataFrame, accepted: DataFrame, id_col: str,
                   match: list[tuple[str, str]], set_description: bool) -> DataFrame:
    """UPDATE Document SET <id_col> = request_id [, description] WHERE <match>.

    ``match`` pairs (document column, request column). When several new requests
    match one document, the highest request id wins (the last UPDATE).
    """
    req_cols = [rc for _, rc in match]
    cand = accepted.select("request_id", "document_description",
                           *[F.col(rc).alias(f"_m_{rc}") for rc in req_cols])
    best = (cand.groupBy(*[f"_m_{rc}" for rc in req_cols])
            .agg(F.max(F.struct("request_id", "document_description")).alias("_b")))
    cond = None
    for dc, rc in match:
        c = document[dc] == best[f"_m_{rc}"]
        cond = c if cond is None else cond & c
    j = document.join(best, cond, "left")
    hit = F.col("_b").isNotNull()
    out = j.withColumn(id_col, F.when(hit, F.col("_b.request_id")).otherwise(F.col(id_col)))
    if set_description:
        out = out.withColumn("description", F.when(hit, F.col("_b.document_description"))
                             .otherwise(F.col("description")))
    return out.select(*document.columns)


# ---------------------------------------------------------------- entry points


def submit_annual(requests, employee, employee_role, red, ledger, leave, as_of,
                  mode: str = "as_written") -> Outputs:
    d = directory(employee, employee_role, red, ledger, as_of, mode)
    dec = route_annual(requests, d)
    return materialize(dec, leave, as_of,
                       [F.col("employee_id").alias("emp_id"), "replacement_emp"])


def submit_accidental(requests, employee, employee_role, red, ledger, leave, as_of,
                      mode: str = "as_written") -> Outputs:
    d = directory(employee, employee_role, red, ledger, as_of, mode)
    dec = route_accidental(requests, d)
    return materialize(dec, leave, as_of, [F.col("employee_id").alias("emp_id")])


def submit_medical(requests, employee, employee_role, red, ledger, leave, document, as_of,
                   mode: str = "as_written") -> Outputs:
    """Also relinks documents: as written every document with the request's file
    name (any owner) gets the new medical_id and description; ``corrected`` only
    the requester's own."""
    d = directory(employee, employee_role, red, ledger, as_of, mode)
    dec = route_medical(requests, d)
    out = materialize(dec, leave, as_of, [
        F.col("employee_id").alias("emp_id"), "insurance_status", "disability_details", "type"])
    match = [("file_name", "file_name")]
    if mode != "as_written":
        match.append(("emp_id", "employee_id"))
    out._makers["documents"] = lambda: link_documents(document, out["accepted"], "medical_id",
                                                      match, True)
    return out


def submit_unpaid(requests, employee, employee_role, red, ledger, leave, document, as_of,
                  mode: str = "as_written") -> Outputs:
    """Also links the memo document (same description, file name and owner)."""
    d = directory(employee, employee_role, red, ledger, as_of, mode)
    dec = route_unpaid(requests, d)
    out = materialize(dec, leave, as_of, [F.col("employee_id").alias("emp_id")])
    match = [("description", "document_description"), ("file_name", "file_name"),
             ("emp_id", "employee_id")]
    out._makers["documents"] = lambda: link_documents(document, out["accepted"], "unpaid_id",
                                                      match, False)
    return out


def submit_compensation(requests, employee, employee_role, red, ledger, leave, as_of,
                        mode: str = "as_written") -> Outputs:
    d = directory(employee, employee_role, red, ledger, as_of, mode)
    dec = route_compensation(requests, d)
    return materialize(dec, leave, as_of, [
        F.col("comp_reason").alias("reason"), "date_of_original_workday", "emp_id",
        "replacement_emp"])
