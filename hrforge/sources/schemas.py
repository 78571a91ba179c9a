"""Typed schemas of the twenty HR tables (plus the login-attempt input).

Reference types map as: INT -> int (ids -> bigint, so that a table can have more than 2**31
rows), VARCHAR/CHAR -> string, DECIMAL(p,s) ->
decimal(p,s), DATE -> date, BIT -> boolean. TIME becomes ``timestamp_ntz``
(date plus time of day, no zone): Spark 4.1 has no usable TIME type in queries
or parquet, and a zone-free timestamp keeps the wall-clock meaning.
"""

from __future__ import annotations

from pyspark.sql import types as T

INT = T.IntegerType()
STR = T.StringType()
DATE = T.DateType()
TS = T.TimestampNTZType()
BOOL = T.BooleanType()
LONG = T.LongType()
#: Identity columns and the columns that refer to them.
ID = LONG


def DEC(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


SCHEMAS: dict[str, T.StructType] = {
    "department": _schema(("name", STR), ("building_location", STR)),
    "employee": _schema(
        ("employee_id", ID), ("first_name", STR), ("last_name", STR), ("email", STR),
        ("password", STR), ("address", STR), ("gender", STR), ("official_day_off", STR),
        ("years_of_experience", INT), ("national_id", STR), ("employment_status", STR),
        ("type_of_contract", STR), ("emergency_contact_name", STR),
        ("emergency_contact_phone", STR), ("annual_balance", INT),
        ("accidental_balance", INT), ("salary", DEC(10, 2)), ("hire_date", DATE),
        ("last_working_date", DATE), ("dept_name", STR)),
    "employee_phone": _schema(("emp_id", ID), ("phone_num", STR)),
    "role": _schema(
        ("role_name", STR), ("title", STR), ("description", STR), ("rank", INT),
        ("base_salary", DEC(10, 2)), ("percentage_yoe", DEC(4, 2)),
        ("percentage_overtime", DEC(4, 2)), ("annual_balance", INT),
        ("accidental_balance", INT)),
    "employee_role": _schema(("emp_id", ID), ("role_name", STR)),
    "role_existsin_department": _schema(("department_name", STR), ("role_name", STR)),
    "leave": _schema(
        ("request_id", ID), ("date_of_request", DATE), ("start_date", DATE),
        ("end_date", DATE), ("num_days", INT), ("final_approval_status", STR)),
    "annual_leave": _schema(("request_id", ID), ("emp_id", ID), ("replacement_emp", ID)),
    "accidental_leave": _schema(("request_id", ID), ("emp_id", ID)),
    "medical_leave": _schema(
        ("request_id", ID), ("insurance_status", BOOL), ("disability_details", STR),
        ("type", STR), ("emp_id", ID)),
    "unpaid_leave": _schema(("request_id", ID), ("emp_id", ID)),
    "compensation_leave": _schema(
        ("request_id", ID), ("reason", STR), ("date_of_original_workday", DATE),
        ("emp_id", ID), ("replacement_emp", ID)),
    "document": _schema(
        ("document_id", ID), ("type", STR), ("description", STR), ("file_name", STR),
        ("creation_date", DATE), ("expiry_date", DATE), ("status", STR), ("emp_id", ID),
        ("medical_id", ID), ("unpaid_id", ID)),
    "payroll": _schema(
        ("id", ID), ("payment_date", DATE), ("final_salary_amount", DEC(10, 1)),
        ("from_date", DATE), ("to_date", DATE), ("comments", STR),
        ("bonus_amount", DEC(10, 2)), ("deductions_amount", DEC(10, 2)), ("emp_id", ID)),
    "attendance": _schema(
        ("attendance_id", ID), ("date", DATE), ("check_in_time", TS),
        ("check_out_time", TS), ("total_duration", INT), ("status", STR), ("emp_id", ID)),
    "deduction": _schema(
        ("deduction_id", ID), ("emp_id", ID), ("date", DATE), ("amount", DEC(10, 2)),
        ("type", STR), ("status", STR), ("unpaid_id", ID), ("attendance_id", ID)),
    "performance": _schema(
        ("performance_id", ID), ("rating", INT), ("comments", STR), ("semester", STR),
        ("emp_id", ID)),
    "employee_replace_employee": _schema(
        ("table_id", ID), ("emp1_id", ID), ("emp2_id", ID), ("from_date", DATE),
        ("to_date", DATE)),
    "employee_approve_leave": _schema(("emp1_id", ID), ("leave_id", ID), ("status", STR)),
    "holiday": _schema(
        ("holiday_id", ID), ("holiday_name", STR), ("from_date", DATE), ("to_date", DATE)),
    # Batch input for the login flags (one row per attempt).
    "login_attempts": _schema(("attempt_id", LONG), ("employee_id", ID), ("password", STR)),
}

# Primary keys (reference DDL, fixed values).
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "department": ("name",),
    "employee": ("employee_id",),
    "employee_phone": ("emp_id", "phone_num"),
    "role": ("role_name",),
    "employee_role": ("emp_id", "role_name"),
    "role_existsin_department": ("department_name", "role_name"),
    "leave": ("request_id",),
    "annual_leave": ("request_id",),
    "accidental_leave": ("request_id",),
    "medical_leave": ("request_id",),
    "unpaid_leave": ("request_id",),
    "compensation_leave": ("request_id",),
    "document": ("document_id",),
    "payroll": ("id",),
    "attendance": ("attendance_id",),
    "deduction": ("deduction_id",),
    "performance": ("performance_id",),
    "employee_replace_employee": ("table_id", "emp1_id", "emp2_id"),
    "employee_approve_leave": ("emp1_id", "leave_id"),
    "holiday": ("holiday_id",),
}

# Foreign keys (reference DDL, fixed values): (child table, child column,
# parent table, parent column). 31 in total.
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("employee", "dept_name", "department", "name"),
    ("employee_phone", "emp_id", "employee", "employee_id"),
    ("employee_role", "emp_id", "employee", "employee_id"),
    ("employee_role", "role_name", "role", "role_name"),
    ("role_existsin_department", "department_name", "department", "name"),
    ("role_existsin_department", "role_name", "role", "role_name"),
    ("annual_leave", "request_id", "leave", "request_id"),
    ("annual_leave", "emp_id", "employee", "employee_id"),
    ("annual_leave", "replacement_emp", "employee", "employee_id"),
    ("accidental_leave", "request_id", "leave", "request_id"),
    ("accidental_leave", "emp_id", "employee", "employee_id"),
    ("medical_leave", "request_id", "leave", "request_id"),
    ("medical_leave", "emp_id", "employee", "employee_id"),
    ("unpaid_leave", "request_id", "leave", "request_id"),
    ("unpaid_leave", "emp_id", "employee", "employee_id"),
    ("compensation_leave", "request_id", "leave", "request_id"),
    ("compensation_leave", "emp_id", "employee", "employee_id"),
    ("compensation_leave", "replacement_emp", "employee", "employee_id"),
    ("document", "emp_id", "employee", "employee_id"),
    ("document", "medical_id", "medical_leave", "request_id"),
    ("document", "unpaid_id", "unpaid_leave", "request_id"),
    ("payroll", "emp_id", "employee", "employee_id"),
    ("attendance", "emp_id", "employee", "employee_id"),
    ("deduction", "emp_id", "employee", "employee_id"),
    ("deduction", "unpaid_id", "unpaid_leave", "request_id"),
    ("deduction", "attendance_id", "attendance", "attendance_id"),
    ("performance", "emp_id", "employee", "employee_id"),
    ("employee_replace_employee", "emp1_id", "employee", "employee_id"),
    ("employee_replace_employee", "emp2_id", "employee", "employee_id"),
    ("employee_approve_leave", "emp1_id", "employee", "employee_id"),
    ("employee_approve_leave", "leave_id", "leave", "request_id"),
]

HR_TABLES = [n for n in SCHEMAS if n != "login_attempts"]


def duck_type(dt: T.DataType) -> str:
    """DuckDB spelling of a Spark type (used by the oracle SQL)."""
    if isinstance(dt, T.IntegerType):
        return "INTEGER"
    if isinstance(dt, T.LongType):
        return "BIGINT"
    if isinstance(dt, T.StringType):
        return "VARCHAR"
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    if isinstance(dt, T.DateType):
        return "DATE"
    if isinstance(dt, T.TimestampNTZType):
        return "TIMESTAMP"
    if isinstance(dt, T.BooleanType):
        return "BOOLEAN"
    raise TypeError(dt)
