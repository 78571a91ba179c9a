"""Registered queries: one Spark builder and one DuckDB oracle per key.

Each builder takes (spark, sf_dir), derives the HR tables from the driver's
parquet files (``Tables``) and runs one library operator over the whole tables.
Each oracle is independent ANSI SQL over the same derivations (inlined as CTEs).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hrforge.sources.fixtures import Tables, oracle

# Reference dates used by the registered queries (FIXTURES.md §2).
AS_OF = dt.date(2024, 1, 30)        # month-based operators
LEAVE_DAY = dt.date(2024, 1, 15)    # on-leave checks, submissions and decisions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# key -> builder over a table accessor (``Tables`` or ``StoredTables``)
BUILDERS: dict[str, Callable] = {}


def register(key: str, sql: str | None, ctes: list[tuple[str, str]] | None = None,
             recursive: bool = False):
    def deco(fn: Callable[[Tables], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        BUILDERS[key] = fn
        if sql is not None:
            ORACLES[key] = oracle(sql.strip(), ctes, recursive)
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules fills QUERIES / ORACLES.
    from hrforge import catalog_basic  # noqa: F401
    from hrforge import catalog_ops  # noqa: F401
    from hrforge import catalog_flow  # noqa: F401
    from hrforge import catalog_decide  # noqa: F401
    from hrforge import catalog_damaged  # noqa: F401


_load_all()
