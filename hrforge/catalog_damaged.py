"""Queries over damaged inputs: what the rules refuse on tables that break them.

The stand-in tables keep most rules, so on them these refusals would not be seen at work.
Each input here is derived from the whole stored table: keys repeated or lost, departments
missing, a month without deductions, deciders that have no approval row.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrforge.catalog import AS_OF, register
from hrforge.catalog_decide import UB_REJECTS, _ub_annual_ctes, _ub_annual_frames
from hrforge.catalog_ops import GUARD_BAD, _pk_sql, _unpaid_sql, role_batch
from hrforge.operators import ledger as L
from hrforge.operators import payroll, quality
from hrforge.sources.schemas import PRIMARY_KEYS, SCHEMAS


def _every(table: str, n: int, rest: int) -> str:
    """A condition that holds for about each ``n``-th row, by the first key column."""
    key = PRIMARY_KEYS[table][0]
    number = f"length({key})" if SCHEMAS[table][key].dataType.typeName() == "string" else key
    return f"{number} % {n} = {rest}"


def damaged_keys(df: DataFrame, table: str) -> DataFrame:
    """The table with some rows twice and some copies without the first key column."""
    key = PRIMARY_KEYS[table][0]
    lost = df.filter(_every(table, 7, 4)).withColumn(key, F.lit(None).cast(SCHEMAS[table][key].dataType))
    return df.unionByName(df.filter(_every(table, 5, 2))).unionByName(lost)


def _damaged_ctes() -> list[tuple[str, str]]:
    out = []
    for table, pk in PRIMARY_KEYS.items():
        cols = SCHEMAS[table].fieldNames()
        lost = ", ".join(f"nullif({c}, {c}) as {c}" if c == pk[0] else c for c in cols)
        every = ", ".join(cols)
        out.append((f"damaged_{table}", f"select {every} from {table} union all select {every} from {table} where {_every(table, 5, 2)} "
                                        f"union all select {lost} from {table} where {_every(table, 7, 4)}"))
    return out


@register("pk_violations_damaged", _pk_sql("damaged_"), _damaged_ctes())
def _q(t):
    return quality.pk_violations({n: damaged_keys(getattr(t, n), n) for n in PRIMARY_KEYS})


FEW_DEPARTMENTS = "length(name) % 2 = 0"
_FEW = [("few_department", f"select * from department where {FEW_DEPARTMENTS}")]


@register("hr_role_set_guard_damaged_rejects", re.sub(r"\bdepartment\b", "few_department", GUARD_BAD), _FEW)
def _q(t):
    return quality.hr_role_set_guard(role_batch(t), t.department.filter(FEW_DEPARTMENTS))[1]


@register("unpaid_leave_deductions_damaged", re.sub(r"\bdeduction\b", "kept_deduction", _unpaid_sql(False)),
          [("kept_deduction", f"select * from deduction where month(date) <> {AS_OF.month}")])
def _q(t):
    kept = t.deduction.filter(F.month("date") != AS_OF.month)
    return payroll.unpaid_leave_deductions(t.employee, L.ledger_from(t), kept, AS_OF)


def _unknown_deciders(batch: DataFrame) -> DataFrame:
    return batch.withColumn("upperboard_id", F.when(F.col("request_id") % 3 == 0, -F.col("upperboard_id"))
                            .when(F.col("request_id") % 3 == 1, F.col("upperboard_id")))


def _unknown_ctes(mode: str) -> list[tuple[str, str]]:
    name, text = _ub_annual_ctes(mode)[0]
    unknown = f"""select seq, request_id, case request_id % 3 when 0 then -upperboard_id when 1 then upperboard_id end as upperboard_id
 from ({text}) known"""
    return [(name, unknown), *_ub_annual_ctes(mode)[1:]]


for _mode, _key in (("as_written", ""), ("corrected", "_corrected")):
    # a null decider is unknown too: not in the list, whatever the list holds
    register(f"upperboard_decide_annual_damaged{_key}_rejections", UB_REJECTS, _unknown_ctes(_mode))(
        lambda t, mode=_mode: _ub_annual_frames(t, mode, _unknown_deciders)[1])
