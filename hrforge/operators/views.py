"""The five stored views, as functions of their input tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrforge.functions.dates import to_date_value
from hrforge.functions.text import ci_eq


def all_employee_profiles(employee: DataFrame) -> DataFrame:
    """Employee projection without password, salary, national id and contacts."""
    return employee.select(
        "employee_id", "first_name", "last_name", "gender", "email", "address",
        "years_of_experience", "official_day_off", "type_of_contract",
        "employment_status", "annual_balance", "accidental_balance")


def employees_per_department(employee: DataFrame) -> DataFrame:
    """COUNT(employee_id) per dept_name; a null department is its own group."""
    return employee.groupBy(F.col("dept_name").alias("department_name")).agg(
        F.count("employee_id").alias("num_employees"))


def winter_performance(performance: DataFrame, employee: DataFrame) -> DataFrame:
    """Evaluations in a semester starting with W (case-blind LIKE 'W%')."""
    p = performance.filter(F.lower(F.col("semester")).startswith("w"))
    e = employee.select("employee_id", "first_name", "last_name")
    return p.join(e, p.emp_id == e.employee_id, "inner").select(
        "performance_id", "emp_id", "first_name", "last_name", "rating", "comments",
        "semester")


def rejected_medical_leaves(medical_leave: DataFrame, leave: DataFrame) -> DataFrame:
    """Medical requests whose final status is rejected."""
    lv = leave.filter(ci_eq("final_approval_status", "rejected"))
    return medical_leave.join(lv, "request_id", "inner").select(
        "request_id", "date_of_request", "start_date", "end_date", "num_days",
        "final_approval_status", "emp_id", "insurance_status", "disability_details",
        "type")


def attendance_yesterday(attendance: DataFrame, employee: DataFrame, as_of) -> DataFrame:
    """Attendance rows dated the day before ``as_of``, with the employee's name."""
    day = to_date_value(as_of) - dt.timedelta(days=1)
    a = attendance.filter(F.col("date") == F.lit(day))
    e = employee.select("employee_id", "first_name", "last_name")
    return a.join(e, a.emp_id == e.employee_id, "inner").select(
        "attendance_id", "emp_id", "first_name", "last_name", "date", "check_in_time",
        "check_out_time", "total_duration", "status")
