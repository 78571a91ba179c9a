"""Leave decisions, evaluated for a batch of (request, decider) rows at once.

Every decision procedure of the reference handles one request. Here ``batch``
holds many (``seq`` = call order). Checks that only read the snapshot become
flags computed by joins. Rules whose outcome depends on earlier decisions of the
same batch apply to the requests that pass every other check, in (request_id, seq)
order: the annual balance and the booked replacements by components of requests that can
touch each other (``hrforge.plans.settle``), the accidental balance as a row number, and
the one unpaid leave a year by the rows that change the year (``hrforge.plans.fold``).

Outputs are decision frames plus helpers that apply them to the Leave,
Employee, approval and replacement tables as new snapshots.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hrforge.functions.dates import as_date, weekday_name
from hrforge.functions.text import ci, ci_eq, ci_in
from hrforge.operators.admin import append_rows
from hrforge.operators.flags import flag_on_leave_range, flag_replacement, part_time
from hrforge.operators.ledger import UNPAID
from hrforge.operators.quality import check_predicate
from hrforge.plans.fold import year_sequence_fold
from hrforge.plans.ids import assign_ids, max_id
from hrforge.plans.outputs import Outputs
from hrforge.plans.settle import settle_in_order
from hrforge.session import checkpoint_dir

MSG_NOT_AUTHORISED = "Error! You are not authorised to approve/reject this leave"
UPPERBOARD_ROLES = ["Dean", "Vice Dean", "President"]
_NULL_KEY = -2147483648  # fold key for requests whose employee is unknown


# ---------------------------------------------------------------- snapshot helpers


def apply_approval_updates(approvals: DataFrame, updates: DataFrame,
                           only_pending: bool = False) -> DataFrame:
    """Set approvals.status for (emp1_id, leave_id) pairs in ``updates``
    (columns emp1_id, leave_id, new_status, seq; the latest seq wins)."""
    u = (updates.groupBy(F.col("emp1_id").alias("_u1"), F.col("leave_id").alias("_ul"))
         .agg(F.max(F.struct("seq", "new_status")).alias("_n")))
    j = approvals.join(u, (approvals.emp1_id == u._u1) & (approvals.leave_id == u._ul), "left")
    hit = F.col("_n").isNotNull()
    if only_pending:
        hit = hit & ci_eq("status", "pending")
    return j.withColumn("status", F.when(hit, F.col("_n.new_status"))
                        .otherwise(F.col("status"))).select(*approvals.columns)


def apply_leave_status(leave: DataFrame, decisions: DataFrame) -> DataFrame:
    """Leave snapshot with final_approval_status from the decisions frame."""
    dd = (decisions.groupBy(F.col("request_id").alias("_r"))
          .agg(F.max(F.struct("seq", "final_approval_status")).alias("_n")))
    j = leave.join(dd, leave.request_id == dd._r, "left")
    return j.withColumn("final_approval_status",
                        F.coalesce(F.col("_n.final_approval_status"),
                                   F.col("final_approval_status"))).select(*leave.columns)


def apply_balances(employee: DataFrame, decisions: DataFrame, column: str) -> DataFrame:
    """Employee snapshot with ``column`` set to the last approved balance_after."""
    ok = decisions.filter(F.col("final_approval_status") == "approved")
    dd = (ok.groupBy(F.col("emp_id").alias("_e"))
          .agg(F.max(F.struct("request_id", "seq", "balance_after")).alias("_n")))
    j = employee.join(dd, employee.employee_id == dd._e, "left")
    return j.withColumn(column, F.when(F.col("_n").isNotNull(),
                                       F.col("_n.balance_after").cast("int"))
                        .otherwise(F.col(column))).select(*employee.columns)


def approval_updates_from(decisions: DataFrame) -> DataFrame:
    """HR decisions -> updates of the deciding HR's own approval row."""
    return decisions.select(F.col("hr_id").alias("emp1_id"),
                            F.col("request_id").alias("leave_id"),
                            F.col("final_approval_status").alias("new_status"), "seq")


# ---------------------------------------------------------------- upperboard


def _same_department(rows: DataFrame, one: str, other: str, employee_role: DataFrame, red: DataFrame) -> DataFrame:
    """seq and ``_same``: do the roles of both employees of a row sit in one department
    (highest role name, then highest department name)? Both sides of a row are asked in one
    join and meet in one aggregate; a side without a department makes the row false."""
    role_of = employee_role.groupBy("emp_id").agg(ci(F.max("role_name")).alias("_rk"))
    dept_of = red.groupBy(ci("role_name").alias("_rk")).agg(ci(F.max("department_name")).alias("_dept"))
    home = role_of.join(dept_of, "_rk").select(F.col("emp_id").alias("_who"), "_dept")
    sides = rows.select("seq", F.explode(F.array(one, other)).alias("_who")).join(home, "_who")
    return sides.groupBy("seq").agg(
        ((F.count("_dept") == 2) & (F.min("_dept") == F.max("_dept"))).alias("_same"))


def upperboard_decide_annual(batch: DataFrame, approvals: DataFrame, annual_leave: DataFrame,
                             employee_role: DataFrame, red: DataFrame, leave: DataFrame,
                             ledger: DataFrame, mode: str = "as_written"
                             ) -> tuple[DataFrame, DataFrame]:
    """``Upperboard_approve_annual`` for a batch (seq, request_id, upperboard_id,
    replacement_id). Returns (approvals snapshot, rejections).

    Authorised when the upperboard member has *any* approval row (as written) or
    a row for this request (``corrected``). Approved when the replacement is not
    on leave during the request and both employees' roles sit in the same
    department (employee with several roles: highest role name; role in several
    departments: highest department name); a null department rejects.
    """
    if mode == "as_written":
        approvers = approvals.select(F.col("emp1_id").alias("_a")).distinct()
        auth, denied = [batch.join(approvers, batch.upperboard_id == approvers._a, how)
                        for how in ("left_semi", "left_anti")]
    else:
        pairs = approvals.select(F.col("emp1_id").alias("_a"), F.col("leave_id").alias("_l"))
        auth, denied = [batch.join(pairs, (batch.upperboard_id == pairs._a)
                                   & (batch.request_id == pairs._l), how)
                        for how in ("left_semi", "left_anti")]
    rejections = denied.select("seq", "request_id", "upperboard_id",
                               F.lit(MSG_NOT_AUTHORISED).alias("reason"))

    a = annual_leave.select("request_id", F.col("emp_id").alias("_emp"))
    lv = leave.select("request_id", "start_date", "end_date")
    # frozen: the flags below and the updates read it
    checkpoint_dir(batch.sparkSession)
    b = auth.join(a, "request_id", "left").join(lv, "request_id", "left").checkpoint()
    same = _same_department(b, "_emp", "replacement_id", employee_role, red).withColumnRenamed("seq", "_s")
    b = flag_on_leave_range(b, ledger, "replacement_id", "start_date", "end_date", "_repl_off")
    b = b.join(same, b["seq"] == same["_s"], "left")
    ok = F.coalesce(~F.col("_repl_off") & F.col("_same"), F.lit(False))
    updates = b.select(F.col("upperboard_id").alias("emp1_id"),
                       F.col("request_id").alias("leave_id"),
                       F.when(ok, F.lit("approved")).otherwise(F.lit("rejected")).alias("new_status"),
                       "seq")
    return apply_approval_updates(approvals, updates), rejections


def upperboard_decide_unpaid(batch: DataFrame, approvals: DataFrame, unpaid_leave: DataFrame,
                             employee_role: DataFrame, document: DataFrame) -> DataFrame:
    """``Upperboard_approve_unpaids`` for a batch (seq, request_id, upperboard_id);
    returns the approvals snapshot. Only unpaid requests and deciders holding an
    upperboard role are handled; approved when a valid, non-empty memo document
    is linked to the request; only pending approval rows change."""
    b = batch.join(unpaid_leave.select("request_id"), "request_id", "left_semi")
    ub = employee_role.filter(ci_in("role_name", UPPERBOARD_ROLES)).select(
        F.col("emp_id").alias("_ub")).distinct()
    b = b.join(ub, b.upperboard_id == ub._ub, "left_semi")
    memo = (document.filter(ci_eq("type", "memo") & ci_eq("status", "valid")
                            & (F.rtrim(F.coalesce(F.col("description"), F.lit(""))) != ""))
            .select(F.col("unpaid_id").alias("_m")).distinct())
    b = b.join(memo.withColumn("_has", F.lit(True)), b.request_id == memo._m, "left")
    updates = b.select(F.col("upperboard_id").alias("emp1_id"),
                       F.col("request_id").alias("leave_id"),
                       F.when(F.col("_has").isNotNull(), F.lit("approved"))
                       .otherwise(F.lit("rejected")).alias("new_status"), "seq")
    return apply_approval_updates(approvals, updates, only_pending=True)


# ---------------------------------------------------------------- HR decisions


def _guarded(batch: DataFrame, approvals: DataFrame, leave: DataFrame, as_of,
             mode: str) -> DataFrame:
    """Drop batch rows the procedure returns early for, and attach the Leave row.

    As written: any pending approval row of the request (including the deciding
    HR's own) stops it; ``corrected`` ignores the decider's own row and only
    decides requests whose status is still pending: its first decider by ``seq``
    decides it, for the later ones it is no longer pending. A request that is not in
    the future (start on or before as_of) is never decided.
    """
    pend = approvals.filter(ci_eq("status", "pending")).select(
        F.col("emp1_id").alias("_p1"), F.col("leave_id").alias("_pl"))
    cond = batch.request_id == pend._pl
    if mode != "as_written":
        cond = cond & (pend._p1 != batch.hr_id)
    b = batch.join(pend, cond, "left_anti")
    if mode != "as_written":
        b = (b.groupBy("request_id").agg(F.min(F.struct("seq", "hr_id")).alias("_first"))
             .select("_first.seq", "request_id", "_first.hr_id"))
    lv = leave.select("request_id", "date_of_request", "start_date", "end_date", "num_days",
                      F.col("final_approval_status").alias("_status"))
    b = b.join(lv, "request_id", "inner").filter(
        F.col("start_date").isNotNull() & (F.col("start_date") > as_date(as_of)))
    if mode != "as_written":
        b = b.filter(ci_eq("_status", "pending"))
    return b


def _no_rejection(b: DataFrame, approvals: DataFrame) -> DataFrame:
    rej = approvals.filter(ci_eq("status", "rejected")).select(
        F.col("leave_id").alias("_rj")).distinct().withColumn("_rejected", F.lit(True))
    return b.join(rej, b.request_id == rej._rj, "left").withColumn(
        "_approval_ok", F.col("_rejected").isNull()).drop("_rj", "_rejected")


def _settle(b: DataFrame, ok: Column, days: Column, balance: Column, mode: str) -> DataFrame:
    """``b`` with ``approved`` and ``balance_after``: the rows that pass ``ok``, decided in
    order against the balance and the replacements that the batch itself books. The flags
    are computed once: ``b`` is frozen."""
    checkpoint_dir(b.sparkSession)
    b = b.checkpoint()
    requests = b.filter(ok).select(
        "seq", "request_id", F.col("_myid").alias("emp_id"), days.alias("days"),
        balance.alias("balance"), F.col("replacement_emp").alias("replacement"),
        "start_date", "end_date")
    return _approve(b, settle_in_order(requests, reversed_range=mode == "as_written"))


def _approve(b: DataFrame, approved: DataFrame) -> DataFrame:
    """Attach the approved rows (seq, balance_after) to the batch."""
    return b.join(approved.withColumn("approved", F.lit(True)), "seq", "left").withColumn(
        "approved", F.coalesce(F.col("approved"), F.lit(False)))


def _replacement_outputs(settled, decisions, replacements: DataFrame) -> Outputs:
    """Decisions, the replacement rows that approvals add, and the new snapshot."""
    def added() -> DataFrame:
        return settled().filter(F.col("approved")).select(
            F.col("_myid").alias("emp1_id"), F.col("replacement_emp").alias("emp2_id"),
            F.col("start_date").alias("from_date"), F.col("end_date").alias("to_date"), "seq")

    return Outputs(decisions=lambda: decisions(settled()), new_replacements=added,
                   replacements=lambda: append_rows(replacements, added(),
                                                    "employee_replace_employee", "table_id",
                                                    ["seq"]))


def _decisions(b: DataFrame, with_balance: bool) -> DataFrame:
    cols = ["seq", "request_id", F.col("_myid").alias("emp_id"), "hr_id",
            F.when(F.col("approved"), F.lit("approved")).otherwise(F.lit("rejected"))
            .alias("final_approval_status")]
    if with_balance:
        cols.append(F.when(F.col("approved"), F.col("balance_after").cast("int"))
                    .alias("balance_after"))
    return b.select(*cols)


def hr_decide_annual(batch: DataFrame, leave: DataFrame, annual_leave: DataFrame,
                     approvals: DataFrame, employee: DataFrame, ledger: DataFrame,
                     replacements: DataFrame, as_of, mode: str = "as_written"
                     ) -> Outputs:
    """``HR_approval_an_acc`` for annual requests: batch (seq, request_id, hr_id).

    Five checks: requester not part-time; replacement given and (as written) *on
    leave* during the request -- ``corrected``: not on leave; replacement not
    already replacing someone in that range; no rejected approval; days <= the
    remaining annual balance (a null balance passes). Approval subtracts the days
    and books the replacement, for the later requests of the batch too.
    """
    b = _guarded(batch, approvals, leave, as_of, mode)
    a = annual_leave.select("request_id", F.col("emp_id").alias("_aemp"), "replacement_emp")
    b = b.join(a, "request_id", "inner")
    e = employee.select(F.col("employee_id").alias("_myid"), F.col("annual_balance").alias("_bal"),
                        F.col("type_of_contract").alias("_contract"))
    b = b.join(e, b._aemp == e._myid, "left")
    b = flag_replacement(b, ledger, replacements, "replacement_emp", "start_date", "end_date",
                         mode, "_repl_on_leave", "_repl_free")
    b = _no_rejection(b, approvals)
    avail = F.col("_repl_on_leave") if mode == "as_written" else ~F.col("_repl_on_leave")
    avail = F.col("replacement_emp").isNotNull() & avail
    b = b.withColumn("_ok", ~part_time(F.col("_contract")) & avail & F.col("_repl_free")
                     & F.col("_approval_ok"))
    settled = cache(lambda: _settle(b, F.col("_ok"), F.col("num_days"), F.col("_bal"), mode))
    return _replacement_outputs(settled, lambda x: _decisions(x, with_balance=True),
                                replacements)


def hr_decide_accidental(batch: DataFrame, leave: DataFrame, accidental_leave: DataFrame,
                         approvals: DataFrame, employee: DataFrame, as_of,
                         mode: str = "as_written") -> dict[str, DataFrame]:
    """``HR_approval_an_acc`` for accidental requests: exactly one day (a null day
    count passes), submitted 0..48 hours before the start, and an accidental
    balance strictly greater than the days, so a null day count is refused here.
    Every approval costs one day: the n-th candidate of an employee, in (request_id,
    seq) order, is approved when n is below the balance."""
    b = _guarded(batch, approvals, leave, as_of, mode)
    a = accidental_leave.select("request_id", F.col("emp_id").alias("_aemp"))
    b = b.join(a, "request_id", "inner")
    e = employee.select(F.col("employee_id").alias("_myid"),
                        F.col("accidental_balance").alias("_bal"))
    b = b.join(e, b._aemp == e._myid, "left")
    one_day = ~F.coalesce(F.col("num_days") != 1, F.lit(False))
    hours = F.datediff("start_date", "date_of_request") * 24
    within = F.coalesce(hours.between(0, 48), F.lit(False))
    nth = F.row_number().over(Window.partitionBy("_myid").orderBy("request_id", "seq"))
    approved = (b.filter(one_day & within & F.col("num_days").isNotNull() & (F.col("_bal") > 1))
                .select("seq", "_bal", nth.alias("_n")).filter(F.col("_n") < F.col("_bal"))
                .select("seq", (F.col("_bal") - F.col("_n")).alias("balance_after")))
    return {"decisions": _decisions(_approve(b, approved), with_balance=True)}


def hr_decide_unpaid(batch: DataFrame, leave: DataFrame, unpaid_leave: DataFrame,
                     approvals: DataFrame, employee: DataFrame, ledger: DataFrame, as_of,
                     mode: str = "as_written") -> dict[str, DataFrame]:
    """``HR_approval_unpaid``: requester not part-time, at most 30 days, no rejected
    approval, and the request year later than the latest start year of any
    approved unpaid leave. As written that latest year is over *all* employees
    (one global sequence); ``corrected`` keeps it per employee."""
    b = _guarded(batch, approvals, leave, as_of, mode)
    u = unpaid_leave.select("request_id", F.col("emp_id").alias("_myid"))
    b = b.join(u, "request_id", "inner")
    e = employee.select(F.col("employee_id").alias("_e"), F.col("type_of_contract").alias("_contract"))
    b = b.join(e, b._myid == e._e, "left").drop("_e")
    b = _no_rejection(b, approvals)
    b = b.withColumn("_ok", ~part_time(F.col("_contract"))
                     & F.coalesce(F.col("num_days") <= 30, F.lit(False)) & F.col("_approval_ok"))
    b = (b.withColumn("_ry", F.year("date_of_request")).withColumn("_sy", F.year("start_date")))
    approved_unpaid = ledger.filter((F.col("kind") == F.lit(UNPAID))
                                    & ci_eq("final_approval_status", "approved"))
    cand = b.filter(F.col("_ok"))
    if mode == "as_written":
        m0 = approved_unpaid.select(F.coalesce(F.max(F.year("start_date")), F.lit(-1))).scalar()
        cand = cand.select("seq", "request_id", "_ry", "_sy", m0.alias("_m0"))
        folded = year_sequence_fold(cand, ["request_id", "seq"], "_ry", "_sy")
    else:
        per = approved_unpaid.groupBy(F.col("emp_id").alias("_pe")).agg(
            F.max(F.year("start_date")).alias("_pm"))
        cand = cand.withColumn("_key", F.coalesce(F.col("_myid"), F.lit(_NULL_KEY)))
        cand = cand.join(per, cand._myid == per._pe, "left").select(
            "seq", "request_id", "_key", "_ry", "_sy",
            F.coalesce(F.col("_pm"), F.lit(-1)).alias("_m0"))
        folded = year_sequence_fold(cand, ["request_id", "seq"], "_ry", "_sy", key="_key")
    b = b.join(folded.select("seq", "approved"), "seq", "left").withColumn(
        "approved", F.coalesce(F.col("approved"), F.lit(False)))
    return {"decisions": _decisions(b, with_balance=False)}


def hr_decide_compensation(batch: DataFrame, leave: DataFrame, compensation_leave: DataFrame,
                           approvals: DataFrame, employee: DataFrame, attendance: DataFrame,
                           ledger: DataFrame, replacements: DataFrame, as_of,
                           mode: str = "as_written") -> Outputs:
    """``HR_approval_comp``: worked >= 480 minutes on the original workday, which
    is the requester's day off and in the month and year of the request; a
    non-empty reason; a replacement that (as written) is on leave -- ``corrected``:
    is not -- and is not already replacing someone then, by the table or by an
    earlier approval of the batch."""
    b = _guarded(batch, approvals, leave, as_of, mode)
    c = compensation_leave.select("request_id", F.col("emp_id").alias("_myid"),
                                  F.col("reason").alias("_reason"), "date_of_original_workday",
                                  "replacement_emp")
    b = b.join(c, "request_id", "inner")
    e = employee.select(F.col("employee_id").alias("_e"), "official_day_off")
    att = attendance.filter(F.col("total_duration") >= 480).select(
        F.col("emp_id").alias("_ae"), F.col("date").alias("_ad"))
    worked = (b.join(e, b._myid == e._e, "inner")
              .filter((F.lower(weekday_name(F.col("date_of_original_workday")))
                       == ci("official_day_off"))
                      & (F.year("date_of_original_workday") == F.year("date_of_request"))
                      & (F.month("date_of_original_workday") == F.month("date_of_request")))
              .join(att, (F.col("_myid") == att._ae)
                    & (F.col("date_of_original_workday") == att._ad), "left_semi")
              .select("seq").withColumn("_spent", F.lit(True)))
    b = b.join(worked, "seq", "left")
    b = flag_replacement(b, ledger, replacements, "replacement_emp", "start_date", "end_date",
                         mode, "_repl_on_leave", "_repl_free")
    avail = F.col("_repl_on_leave") if mode == "as_written" else ~F.col("_repl_on_leave")
    avail = F.col("replacement_emp").isNotNull() & avail
    reason_ok = F.coalesce(F.rtrim(F.col("_reason")) != "", F.lit(False))
    ok = avail & F.col("_repl_free") & F.col("_spent").isNotNull() & reason_ok
    none = F.lit(None).cast("int")
    settled = cache(lambda: _settle(b, ok, none, none, mode))
    return _replacement_outputs(settled, lambda x: _decisions(x, with_balance=False),
                                replacements)


# ---------------------------------------------------------------- evaluations


def append_evaluations(performance: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``Dean_andHR_Evaluation`` for a batch (seq, employee_id, rating, comment,
    semester). Rows failing the rating CHECK (1..5; null passes) are returned
    separately; the others get performance ids in seq order.
    Returns (appended rows, rejected rows)."""
    ok = check_predicate("performance_rating")
    good = batch.filter(ok | ok.isNull())
    bad = batch.filter(~ok)
    new = good.select("seq", F.col("employee_id").alias("emp_id"), "rating",
                      F.col("comment").alias("comments"), "semester")
    new = assign_ids(new, ["seq"], "performance_id", max_id(performance, "performance_id"))
    return (new.select("performance_id", "rating", "comments", "semester", "emp_id"),
            bad.select("seq", "employee_id", "rating", "comment", "semester"))
