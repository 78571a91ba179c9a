"""Every registered query equals its DuckDB oracle (sf0.001; the driver uses sf0.01)."""

import pytest

from tests.oracle_compare import compare, duck_connect
from __spark_entry__ import oracle_sql
from hrforge.catalog import QUERIES

SF = "/root/testdata/sf0.001"
KEYS = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


def test_every_hr_query_has_an_oracle():
    # training-data operators that SQL cannot express are tested in tests/llm
    assert sorted(set(QUERIES) - set(KEYS)) == []


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    r = compare(spark, key, SF, con)
    assert r["status"] == "ok", r


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert "final_salary_amount" in df.columns


@pytest.mark.parametrize("key", [k for k in KEYS if "_damaged" in k])
def test_damaged_inputs_are_refused(spark, con, key):
    assert compare(spark, key, SF, con)["spark_rows"] > 0


def test_one_bad_role_refuses_the_batch(spark):
    from hrforge.catalog_damaged import FEW_DEPARTMENTS
    from hrforge.catalog_ops import role_batch
    from hrforge.operators.quality import hr_role_set_guard
    from hrforge.sources.fixtures import Tables
    t = Tables(spark, SF)
    accepted, bad = hr_role_set_guard(role_batch(t), t.department.filter(FEW_DEPARTMENTS))
    assert accepted.count() == 0 < bad.count() < role_batch(t).count()
