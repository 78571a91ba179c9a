"""Schema rules as data-quality operators.

Parquet tables enforce no keys or CHECKs, so each rule becomes a query that
returns the violating rows: duplicate or null primary keys, orphan foreign keys,
rows whose CHECK predicate is FALSE (UNKNOWN passes, as in SQL), and the
all-or-nothing guard on new HR representative roles. Computed columns and
DEFAULTs become column expressions applied by the append operators.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hrforge.functions.dates import duration_minutes
from hrforge.functions.text import ci, ci_in, role_suffix_fixed
from hrforge.operators.setops import not_in
from hrforge.sources.schemas import FOREIGN_KEYS, PRIMARY_KEYS, SCHEMAS

# ---------------------------------------------------------------- computed columns


def leave_with_num_days(leave: DataFrame) -> DataFrame:
    """``num_days = DATEDIFF(day, start_date, end_date) + 1``."""
    return leave.withColumn("num_days",
                            (F.datediff("end_date", "start_date") + 1).cast("int"))


def attendance_with_duration(attendance: DataFrame) -> DataFrame:
    """``total_duration = DATEDIFF(minute, check_in_time, check_out_time)``."""
    return attendance.withColumn(
        "total_duration", duration_minutes(F.col("check_in_time"), F.col("check_out_time")))


# Column DEFAULTs (reference DDL, fixed values).
DEFAULTS = {
    "attendance": {"status": "absent"},
    "deduction": {"status": "pending"},
    "employee_approve_leave": {"status": "pending"},
}


def fill_defaults(df: DataFrame, table: str) -> DataFrame:
    """Apply the table's column DEFAULTs to null values of a batch being inserted."""
    for col, value in DEFAULTS.get(table, {}).items():
        df = df.withColumn(col, F.coalesce(F.col(col), F.lit(value)))
    return df


# ---------------------------------------------------------------- key rules


def _render(cols: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL"))
                              for c in cols])


def pk_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Duplicate or null primary keys: table_name, key_value, violation, n_rows.

    One pass and one grouping per table: null keys are groups like any other.
    Texts compare case-blind in whole keys and as they are in keys with a null.
    """
    parts = []
    for name, df in tables.items():
        pk = list(PRIMARY_KEYS[name])
        any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in pk])
        text = _text_cols(name)
        keys = [(F.when(any_null, F.col(c)).otherwise(ci(c)) if c in text else F.col(c)).alias(c)
                for c in pk]
        parts.append(df.select(*keys).groupBy(*pk).agg(F.count(F.lit(1)).alias("n_rows"))
                     .filter(any_null | (F.col("n_rows") > 1))
                     .select(F.lit(name).alias("table_name"), _render(pk).alias("key_value"),
                             F.when(any_null, F.lit("null_key")).otherwise(F.lit("duplicate"))
                             .alias("violation"), "n_rows"))
    return reduce(DataFrame.unionByName, parts)


def _text_cols(name: str) -> set[str]:
    return {f.name for f in SCHEMAS[name].fields if f.dataType.typeName() == "string"}


def fk_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Orphan non-null references: fk_name, child_value, n_rows.

    Each child is read once: all its references become one exploded array, counted
    per value on the map side. The values of all children meet the distinct keys of
    all parents in one join on (parent key, value). It is an outer join with a
    marker, because Catalyst pushes an anti join below the union, once per child.
    """
    refs: dict[str, list[tuple[str, str, str]]] = {}
    parent_keys: dict[str, tuple[str, str]] = {}
    for child, col, parent, pcol in FOREIGN_KEYS:
        if child in tables and parent in tables:
            refs.setdefault(child, []).append((col, parent, pcol))
            parent_keys[f"{parent}.{pcol}"] = (parent, pcol)

    def key(col: str, parent: str, pcol: str) -> Column:
        return ci(col) if pcol in _text_cols(parent) else F.col(col).cast("string")

    kids = []
    for child, cols in refs.items():
        values = F.array(*[
            F.struct(F.lit(f"{child}.{col}->{parent}.{pcol}").alias("fk_name"),
                     F.lit(f"{parent}.{pcol}").alias("_parent"),
                     key(col, parent, pcol).alias("_k"),
                     F.col(col).cast("string").alias("child_value"))
            for col, parent, pcol in cols])
        kids.append(tables[child].select(F.inline(values)).filter(F.col("_k").isNotNull())
                    .groupBy("fk_name", "_parent", "_k", "child_value")
                    .agg(F.count(F.lit(1)).alias("n_rows")))
    known = [tables[parent].select(F.lit(tag).alias("_parent"),
                                   key(pcol, parent, pcol).alias("_k"))
             .filter(F.col("_k").isNotNull()).distinct().withColumn("_known", F.lit(True))
             for tag, (parent, pcol) in parent_keys.items()]
    c = reduce(DataFrame.unionByName, kids)
    p = reduce(DataFrame.unionByName, known)
    return (c.join(p, ["_parent", "_k"], "left").filter(F.col("_known").isNull())
            .select("fk_name", "child_value", F.col("n_rows").cast("bigint").alias("n_rows")))


# CHECK constraints (reference DDL, fixed values): name -> (table, predicate).
def _checks() -> dict[str, tuple[str, Column, str]]:
    return {
        "employee_contract": ("employee", ci_in("type_of_contract", ["full_time", "part_time"]),
                              "type_of_contract"),
        "employee_status": ("employee", ci_in("employment_status",
                                              ["active", "onleave", "notice_period", "resigned"]),
                            "employment_status"),
        "hr_department_roles": ("role_existsin_department",
                                (ci("department_name") != F.lit("hr"))
                                | F.col("role_name").ilike("HR_Representative_%")
                                | (ci("role_name") == F.lit("hr manager")),
                                "role_name"),
        "medical_type": ("medical_leave", ci_in("type", ["sick", "maternity"]), "type"),
        "document_status": ("document", ci_in("status", ["valid", "expired"]), "status"),
        "attendance_status": ("attendance", ci_in("status", ["absent", "attended"]), "status"),
        "deduction_type": ("deduction", ci_in("type", ["unpaid", "missing_hours", "missing_days"]),
                           "type"),
        "deduction_status": ("deduction", ci_in("status", ["pending", "finalized"]), "status"),
        "performance_rating": ("performance", F.col("rating").between(1, 5), "rating"),
        "approval_status": ("employee_approve_leave",
                            ci_in("status", ["approved", "rejected", "pending"]), "status"),
    }


def check_predicate(name: str) -> Column:
    return _checks()[name][1]


def check_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows whose CHECK predicate is FALSE: check_name, table_name, row_key, bad_value."""
    parts = []
    for name, (table, pred, col) in _checks().items():
        if table not in tables:
            continue
        pk = list(PRIMARY_KEYS[table])
        parts.append(tables[table].filter(~pred).select(
            F.lit(name).alias("check_name"), F.lit(table).alias("table_name"),
            _render(pk).alias("row_key"), F.col(col).cast("string").alias("bad_value")))
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- role batch guard


def hr_role_set_guard(new_roles: DataFrame, department: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All-or-nothing insert of a batch of roles.

    A row is bad when its name is LIKE ``HR_Representative_%`` and the fixed-offset
    suffix is NOT IN the department names (null-aware: a null department name makes
    NOT IN unknown, so nothing is bad). Returns (accepted, bad): accepted is the
    whole batch when no row is bad, otherwise empty.
    """
    suffix = role_suffix_fixed(F.col("role_name"))
    names = department.select(ci("name").alias("name"))
    reps = new_roles.filter(F.col("role_name").ilike("HR_Representative_%"))
    bad = not_in(reps, ci(suffix), names, "name")
    any_bad = bad.select(F.lit(1)).limit(1).exists()
    accepted = new_roles.filter(~any_bad)
    return accepted, bad
