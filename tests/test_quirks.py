
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from hrforge.functions.dates import duration_minutes, earlier_date, later_date, prev_month_start
from hrforge.functions.text import hr_representative_of
from hrforge.operators import admin, decide, flags, payroll, quality, submit, tvf
from hrforge.operators import ledger as L
from hrforge.sources.schemas import SCHEMAS

D = dt.date


def mk(spark, table, rows):
    schema = SCHEMAS[table]
    full = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(full, schema)


def empty(spark, table):
    return spark.createDataFrame([], SCHEMAS[table])


def ledger_of(spark, leaves, annual=(), accidental=(), medical=(), unpaid=(), comp=()):
    return L.leave_ledger(
        mk(spark, "leave", leaves), mk(spark, "annual_leave", list(annual)),
        mk(spark, "accidental_leave", list(accidental)), mk(spark, "medical_leave", list(medical)),
        mk(spark, "unpaid_leave", list(unpaid)), mk(spark, "compensation_leave", list(comp)))


# ---------------------------------------------------------------- dates and text


def test_minute_boundary(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 0, 59), dt.datetime(2024, 1, 1, 10, 1, 0))],
                               "a timestamp_ntz, b timestamp_ntz")
    assert df.select(duration_minutes(F.col("a"), F.col("b"))).first()[0] == 1


def test_month_end_previous_month():
    assert prev_month_start(D(2024, 3, 31)) == D(2024, 2, 1)
    assert prev_month_start(D(2024, 1, 15)) == D(2023, 12, 1)


def test_later_earlier_date_nulls(spark):
    df = spark.createDataFrame([(None, D(2024, 1, 2)), (D(2024, 1, 3), None)], "a date, b date")
    got = df.select(later_date(F.col("a"), F.col("b")).alias("l"),
                    earlier_date(F.col("a"), F.col("b")).alias("e")).collect()
    # null first -> second; null second -> null (greatest/least would skip nulls)
    assert got[0]["l"] == D(2024, 1, 2) and got[0]["e"] == D(2024, 1, 2)
    assert got[1]["l"] is None and got[1]["e"] is None


def test_hr_rep_without_second_underscore(spark):
    df = spark.createDataFrame([("HR_Representative_CS",), ("HRRepresentative",), ("A_B",)], "r string")
    got = [r[0] for r in df.select(hr_representative_of(F.col("r"))).collect()]
    assert got == ["CS", "HRRepresentative", "A_B"]


# ---------------------------------------------------------------- three-valued logic


def test_null_day_off_drops_absent_rows(spark):
    emp = mk(spark, "employee", [{"employee_id": 1, "official_day_off": None},
                                 {"employee_id": 2, "official_day_off": "friday"}])
    att = mk(spark, "attendance", [
        {"attendance_id": 1, "date": D(2024, 1, 5), "status": "absent", "emp_id": 1},
        {"attendance_id": 2, "date": D(2024, 1, 5), "status": "attended", "emp_id": 1},
        {"attendance_id": 3, "date": D(2024, 1, 5), "status": "absent", "emp_id": 2},  # Friday
        {"attendance_id": 4, "date": D(2024, 1, 4), "status": "absent", "emp_id": 2}])
    got = sorted(r.attendance_id for r in tvf.attendance_this_month(att, emp, D(2024, 1, 30)).collect())
    assert got == [2, 4]


def test_not_in_with_null_gives_no_rows(spark):
    emp = mk(spark, "employee", [{"employee_id": 1}, {"employee_id": 2}])
    att = mk(spark, "attendance", [{"attendance_id": 9, "date": D(2024, 1, 30), "emp_id": None}])
    assert admin.initiate_attendance(att, emp, D(2024, 1, 30)).count() == 0
    att2 = mk(spark, "attendance", [{"attendance_id": 9, "date": D(2024, 1, 30), "emp_id": 1}])
    rows = admin.initiate_attendance(att2, emp, D(2024, 1, 30)).collect()
    assert [(r.attendance_id, r.emp_id, r.status) for r in rows] == [(10, 2, "absent")]


def test_overlap_with_null_end_date_matches_on_start(spark):
    lg = ledger_of(spark, [{"request_id": 1, "start_date": D(2024, 1, 10), "end_date": None,
                            "final_approval_status": "pending"}],
                   accidental=[{"request_id": 1, "emp_id": 7}])
    probes = spark.createDataFrame([(7,), (8,)], "employee_id int")
    got = {r.employee_id: r.is_on_leave for r in
           flags.flag_on_leave_today(probes, lg, D(2024, 1, 10), "employee_id").collect()}
    assert got == {7: True, 8: False}


def test_check_unknown_passes(spark):
    perf = mk(spark, "performance", [{"performance_id": 1, "rating": None},
                                     {"performance_id": 2, "rating": 9}])
    bad = quality.check_violations({"performance": perf}).collect()
    assert [(r.check_name, r.row_key) for r in bad] == [("performance_rating", "2")]


# ---------------------------------------------------------------- ranks and money


def test_rank_tie_goes_to_lowest_id(spark):
    emp = mk(spark, "employee", [{"employee_id": 5, "dept_name": "CS"},
                                 {"employee_id": 3, "dept_name": "CS"}])
    er = mk(spark, "employee_role", [{"emp_id": 5, "role_name": "Dean"},
                                     {"emp_id": 3, "role_name": "dean"}])
    role = mk(spark, "role", [{"role_name": "Dean", "rank": 3}])
    blocked = spark.createDataFrame([], "emp_id int")
    got = flags.highest_ranked_available(emp, er, role, blocked).collect()
    assert [(r.department_name, r.employee_id) for r in got] == [("CS", 3)]


def test_salary_zero_and_null_in_day_deductions(spark):
    emp = mk(spark, "employee", [{"employee_id": 1, "salary": Decimal("0.00")},
                                 {"employee_id": 2, "salary": None},
                                 {"employee_id": 3, "salary": Decimal("1000.01")}])
    att = mk(spark, "attendance", [
        {"attendance_id": i, "date": D(2024, 1, 3), "status": "absent", "emp_id": i} for i in (1, 2, 3)])
    lg = ledger_of(spark, [])
    out = payroll.missing_day_deductions(att, emp, lg, empty(spark, "deduction"), D(2024, 1, 30))
    got = {r.emp_id: r.amount for r in out.collect()}
    assert got == {1: Decimal("0.00"), 2: None, 3: Decimal("45.46")}  # 1000.01/22 = 45.4550 -> 45.46


def test_missing_hours_amount_rounding(spark):
    emp = mk(spark, "employee", [{"employee_id": 1, "salary": Decimal("5280.00")}])
    att = mk(spark, "attendance", [
        {"attendance_id": 1, "date": D(2024, 1, 3), "total_duration": 450, "emp_id": 1},
        {"attendance_id": 2, "date": D(2024, 1, 2), "total_duration": 470, "emp_id": 1}])
    out = payroll.missing_hour_deductions(att, emp, empty(spark, "deduction"), D(2024, 1, 30)).collect()
    # earliest row only: 5280/22/8 = 30 per hour; 10 minutes -> 5.00
    assert [(r.attendance_id, r.amount, r.type) for r in out] == [(2, Decimal("5.00"), "missing_hours")]


def test_unpaid_range_widened_as_written_clipped_corrected(spark):
    emp = mk(spark, "employee", [{"employee_id": 1, "salary": Decimal("2200.00")}])
    lg = ledger_of(spark, [{"request_id": 4, "start_date": D(2024, 1, 10), "end_date": D(2024, 1, 12),
                            "final_approval_status": "approved"}], unpaid=[{"request_id": 4, "emp_id": 1}])
    ded = empty(spark, "deduction")
    w = payroll.unpaid_leave_deductions(emp, lg, ded, D(2024, 1, 20)).first()
    c = payroll.unpaid_leave_deductions(emp, lg, ded, D(2024, 1, 20), mode="corrected").first()
    assert w.amount == Decimal("3100.00") and w.date == D(2024, 1, 10)  # 31 days x 100
    assert c.amount == Decimal("300.00")  # 3 days x 100


# ---------------------------------------------------------------- decisions


def _hr_tables(spark, balance):
    emp = mk(spark, "employee", [{"employee_id": 1, "annual_balance": balance,
                                  "accidental_balance": balance, "type_of_contract": "full_time"},
                                 {"employee_id": 2, "type_of_contract": "full_time"}])
    leaves = [{"request_id": r, "date_of_request": D(2024, 1, 14), "start_date": s, "end_date": e,
               "num_days": (e - s).days + 1, "final_approval_status": "pending"}
              for r, s, e in ((1, D(2024, 2, 1), D(2024, 2, 3)), (2, D(2024, 2, 10), D(2024, 2, 13)),
                              (3, D(2024, 2, 20), D(2024, 2, 21)))]
    return emp, leaves


def test_two_requests_against_one_balance(spark):
    emp, leaves = _hr_tables(spark, 5)
    annual = [{"request_id": r, "emp_id": 1, "replacement_emp": 2} for r in (1, 2, 3)]
    lg = ledger_of(spark, leaves + [{"request_id": 9, "start_date": D(2024, 1, 1),
                                     "end_date": D(2024, 3, 1), "final_approval_status": "approved"}],
                   annual=annual, accidental=[{"request_id": 9, "emp_id": 2}])
    batch = spark.createDataFrame([(r, r, 50) for r in (1, 2, 3)], "seq long, request_id int, hr_id int")
    out = decide.hr_decide_annual(batch, mk(spark, "leave", leaves), mk(spark, "annual_leave", annual),
                                  empty(spark, "employee_approve_leave"), emp, lg,
                                  empty(spark, "employee_replace_employee"), D(2024, 1, 15))
    got = {r.request_id: (r.final_approval_status, r.balance_after)
           for r in out["decisions"].collect()}
    # 3 days fit (5 -> 2); 4 days do not; the refused request consumes nothing, 2 days fit (2 -> 0)
    assert got == {1: ("approved", 2), 2: ("rejected", None), 3: ("approved", 0)}
    assert out["new_replacements"].count() == 2


def test_accidental_needs_balance_strictly_greater(spark):
    emp, _ = _hr_tables(spark, 1)
    leaves = [{"request_id": 1, "date_of_request": D(2024, 1, 20), "start_date": D(2024, 1, 21),
               "end_date": D(2024, 1, 21), "num_days": 1, "final_approval_status": "pending"}]
    acc = mk(spark, "accidental_leave", [{"request_id": 1, "emp_id": 1}])
    batch = spark.createDataFrame([(1, 1, 50)], "seq long, request_id int, hr_id int")
    out = decide.hr_decide_accidental(batch, mk(spark, "leave", leaves), acc,
                                      empty(spark, "employee_approve_leave"), emp, D(2024, 1, 15))
    assert out["decisions"].first().final_approval_status == "rejected"  # balance 1 is not > 1


def test_empty_reason_rejects_compensation(spark):
    emp = mk(spark, "employee", [{"employee_id": 1, "official_day_off": "Sunday"}])
    leaves = [{"request_id": r, "date_of_request": D(2024, 1, 10), "start_date": D(2024, 1, 20),
               "end_date": D(2024, 1, 20), "num_days": 1, "final_approval_status": "pending"} for r in (1, 2)]
    comp = mk(spark, "compensation_leave", [
        {"request_id": 1, "reason": "  ", "date_of_original_workday": D(2024, 1, 7), "emp_id": 1,
         "replacement_emp": 2},
        {"request_id": 2, "reason": "extra day", "date_of_original_workday": D(2024, 1, 7), "emp_id": 1,
         "replacement_emp": 2}])
    att = mk(spark, "attendance", [{"attendance_id": 1, "date": D(2024, 1, 7), "total_duration": 500,
                                    "emp_id": 1}])
    lg = ledger_of(spark, leaves + [{"request_id": 9, "start_date": D(2024, 1, 19), "end_date": D(2024, 1, 21),
                                     "final_approval_status": "approved"}],
                   comp=[{"request_id": 1, "emp_id": 1}, {"request_id": 2, "emp_id": 1}],
                   accidental=[{"request_id": 9, "emp_id": 2}])
    batch = spark.createDataFrame([(r, r, 50) for r in (1, 2)], "seq long, request_id int, hr_id int")
    out = decide.hr_decide_compensation(batch, mk(spark, "leave", leaves), comp,
                                        empty(spark, "employee_approve_leave"), emp, att, lg,
                                        empty(spark, "employee_replace_employee"), D(2024, 1, 15))
    got = {r.request_id: r.final_approval_status for r in out["decisions"].collect()}
    assert got == {1: "rejected", 2: "approved"}


def test_payroll_twice_adds_nothing_and_finalizes(spark):
    emp = mk(spark, "employee", [{"employee_id": 1, "salary": Decimal("3000.00")}])
    ded = mk(spark, "deduction", [{"deduction_id": 1, "emp_id": 1, "date": D(2024, 1, 5),
                                   "amount": Decimal("10.05"), "status": "pending"}])
    args = (emp, empty(spark, "employee_role"), empty(spark, "role"), empty(spark, "attendance"))
    out = payroll.run_payroll(*args, ded, empty(spark, "payroll"), D(2024, 1, 1), D(2024, 1, 31),
                              D(2024, 1, 30))
    rows, ded2 = out["payroll"], out["deductions"]
    r = rows.first()
    assert (r.id, r.final_salary_amount, r.deductions_amount) == (1, Decimal("2990.0"), Decimal("10.05"))
    assert ded2.first().status == "finalized"
    rows2 = payroll.run_payroll(*args, ded2, rows, D(2024, 1, 1), D(2024, 1, 31),
                                D(2024, 1, 30))["payroll"]
    assert rows2.count() == 0


def test_unpaid_submission_without_approvers(spark):
    emp = mk(spark, "employee", [{"employee_id": 1, "dept_name": "CS", "type_of_contract": "full_time"},
                                 {"employee_id": 2, "dept_name": "CS", "type_of_contract": "part_time"}])
    req = spark.createDataFrame([(1, 1, D(2024, 2, 1), D(2024, 2, 2), "memo", "f.pdf"),
                                 (2, 2, D(2024, 2, 1), D(2024, 2, 2), "memo", "f.pdf")],
                                "seq long, employee_id int, start_date date, end_date date, "
                                "document_description string, file_name string")
    args = (emp, empty(spark, "employee_role"), empty(spark, "role_existsin_department"),
            ledger_of(spark, []), empty(spark, "leave"), empty(spark, "document"), D(2024, 1, 15))
    w = submit.submit_unpaid(req, *args)
    assert [r.request_id for r in w["leaves"].collect()] == [1]   # leave row stays (as written)
    assert w["approvals"].count() == 0
    c = submit.submit_unpaid(req, *args, mode="corrected")
    assert c["leaves"].count() == 0
    assert {r.seq: r.reason for r in c["rejections"].collect()} == {1: submit.MSG_UNPAID_NO_APPROVERS, 2: None}


def test_append_holidays_continues_ids_in_batch_order(spark):
    hol = mk(spark, "holiday", [{"holiday_id": 5, "holiday_name": "Winter break",
                                 "from_date": D(2024, 1, 1), "to_date": D(2024, 1, 2)}])
    batch = spark.createDataFrame([("Spring day", D(2024, 3, 21), D(2024, 3, 21), 2),
                                   ("Founders day", D(2024, 1, 25), D(2024, 1, 25), 1)],
                                  "holiday_name string, from_date date, to_date date, seq long")
    got = sorted((r.holiday_id, r.holiday_name) for r in admin.append_holidays(hol, batch).collect())
    assert got == [(5, "Winter break"), (6, "Founders day"), (7, "Spring day")]
