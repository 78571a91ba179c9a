"""Typed table storage: parquet folders that versions refer to by manifest.

Parquet refuses UPDATE / DELETE / MERGE, and a job must never overwrite a path it
is reading, so a state change writes new folders and publishes a new version:

``<root>/<table>/data/write_id=<id>/[month_key=<month>/]``  rows of one write
``<root>/<table>/versions/v=<version>.json``                 manifest: the folders of a version

The tables that grow with time are partitioned by the month of one date column
(``MONTH_OF``). ``write_snapshot`` writes a whole table; ``write_months`` writes the rows of
some months and refers to the folders of an earlier version for all others, so a daily
change costs the months it touches. A manifest has a line per month, so the calendar
bounds it, and it is what makes a version exist: it is written under another name and
renamed, so a writer that dies before that leaves folders that no reader looks at, and a
second attempt writes folders of its own. Folders are never changed; readers of older
versions go on as before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hrforge.functions.dates import as_date
from hrforge.sources.fixtures import conform
from hrforge.sources.schemas import HR_TABLES, PRIMARY_KEYS, SCHEMAS

#: Date column by whose month a table's snapshots are partitioned.
MONTH_OF = {"attendance": "date", "deduction": "date", "payroll": "payment_date", "leave": "start_date"}
_MONTH, _WRITE = "month_key", "write_id"
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def month_key(date: Column) -> Column:
    """Year and month as one number (202401); null for a null date."""
    return F.year(date) * 100 + F.month(date)


# ---------------------------------------------------------------- manifests


class Folder(NamedTuple):
    """A folder that a version refers to: its month (None: no date, or a table without
    months), path below ``data``, rows and largest id (None where not known)."""

    month: int | None
    path: str
    rows: int | None = None
    max_id: int | None = None


def _data(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}/data"


def manifest_path(root: str, table: str, version: int | str) -> str:
    return f"{root.rstrip('/')}/{table}/versions/v={version}.json"


def _file(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def published(spark: SparkSession, root: str, table: str, version: int | str) -> bool:
    path, fs = _file(spark, manifest_path(root, table, version))
    return fs.exists(path)


def read_manifest(spark: SparkSession, root: str, table: str, version: int | str) -> list[Folder]:
    path, fs = _file(spark, manifest_path(root, table, version))
    if not fs.exists(path):
        raise FileNotFoundError(f"{table} has no version {version} under {root}")
    stream = fs.open(path)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return [Folder(**json.loads(line)) for line in text.splitlines()]


def publish(spark: SparkSession, root: str, table: str, version: int | str, folders: list[Folder]) -> str:
    """Make ``folders`` the version ``version``; refuses a version that exists."""
    name = manifest_path(root, table, version)
    if published(spark, root, table, version):
        raise FileExistsError(name)
    draft, fs = _file(spark, f"{name}.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write("".join(json.dumps(f._asdict()) + "\n" for f in folders).encode())
    out.close()
    target, _ = _file(spark, name)
    if published(spark, root, table, version) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise FileExistsError(name)
    return name


# ---------------------------------------------------------------- reading


def load_table(spark: SparkSession, root: str, table: str, version: int | str,
               first=None, last=None, months: Iterable[int | None] | None = None) -> DataFrame:
    """Read one table with its declared schema (no inference). ``first`` and ``last``
    (dates, inclusive) keep the rows of that range of the table's ``MONTH_OF`` column, and
    ``months`` those of some month keys; only the folders of these months are read."""
    if table not in MONTH_OF and not (first is None and last is None and months is None):
        raise ValueError(f"{table} has no month partitions")
    folders = read_manifest(spark, root, table, version)
    low, high = [None if d is None else d.year * 100 + d.month for d in map(_day, (first, last))]
    if months is not None:
        wanted = set(months)
        folders = [f for f in folders if f.month in wanted]
    if low is not None or high is not None:
        folders = [f for f in folders if f.month is not None and (low or 0) <= f.month <= (high or f.month)]
    if not folders:
        return spark.createDataFrame([], SCHEMAS[table])
    parts = [T.StructField(_WRITE, T.StringType())] + [T.StructField(_MONTH, T.IntegerType())] * (table in MONTH_OF)
    data = _data(root, table)
    df = (spark.read.schema(T.StructType([*SCHEMAS[table].fields, *parts])).option("basePath", data)
          .parquet(*[f"{data}/{f.path}" for f in folders]))
    if first is not None:
        df = df.filter((F.col(_MONTH) >= low) & (F.col(MONTH_OF[table]) >= as_date(first)))
    if last is not None:
        df = df.filter((F.col(_MONTH) <= high) & (F.col(MONTH_OF[table]) <= as_date(last)))
    return df.select(*SCHEMAS[table].fieldNames())


def _day(value):
    import datetime as dt
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def load_tables(spark: SparkSession, root: str, version: int | str,
                tables: list[str] | None = None) -> dict[str, DataFrame]:
    return {t: load_table(spark, root, t, version) for t in (tables or HR_TABLES)}


def load_holidays(spark: SparkSession, root: str | None = None,
                  version: int | str = 0) -> DataFrame:
    """The Holiday table; an empty typed frame when it has not been created yet."""
    if root is None:
        return spark.createDataFrame([], SCHEMAS["holiday"])
    return load_table(spark, root, "holiday", version)


def stored_max_id(spark: SparkSession, root: str, table: str, version: int | str) -> int:
    """Largest id of a month-partitioned table, 0 without rows: read from the manifest."""
    return max((f.max_id or 0 for f in read_manifest(spark, root, table, version)), default=0)


# ---------------------------------------------------------------- writing


def _write(df: DataFrame, root: str, table: str) -> list[Folder]:
    """Write the rows into folders of their own; the folders.

    The rows of a month are brought together before they are written, so that it has
    few files; AQE splits a month that is too large for one task.
    """
    spark = df.sparkSession
    name = f"{_WRITE}={uuid.uuid4().hex}"
    path = f"{_data(root, table)}/{name}"
    rows = conform(df, table)
    if table not in MONTH_OF:
        rows.write.mode("errorifexists").parquet(path)
        return [Folder(None, name)]
    rows = rows.withColumn(_MONTH, month_key(F.col(MONTH_OF[table]))).hint("rebalance", F.col(_MONTH))
    rows.write.mode("errorifexists").partitionBy(_MONTH).parquet(path)
    p, fs = _file(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    if not names:
        return []
    key = PRIMARY_KEYS[table][0]
    schema = T.StructType([SCHEMAS[table][key], T.StructField(_MONTH, T.IntegerType())])
    counts = (spark.read.schema(schema).parquet(path).groupBy(_MONTH)
              .agg(F.count(F.lit(1)).alias("rows"), F.max(key).alias("id")).collect())  # a row per month
    found = {r[_MONTH]: (r["rows"], r["id"]) for r in counts}
    out = []
    for folder in sorted(names):
        value = folder.partition("=")[2]
        month = None if value == _NO_MONTH else int(value)
        out.append(Folder(month, f"{name}/{folder}", *found[month]))
    return out


def write_snapshot(df: DataFrame, root: str, table: str, version: int | str) -> str:
    """Write a table's new state as a version of its own and return its manifest.

    Refuses to replace a version: it is immutable once published, so a retried job
    cannot clobber what readers use.
    """
    if published(df.sparkSession, root, table, version):
        raise FileExistsError(manifest_path(root, table, version))
    return publish(df.sparkSession, root, table, version, _write(df, root, table))


def write_months(df: DataFrame, root: str, table: str, base: int | str, version: int | str,
                 months: Iterable[int | None]) -> str:
    """Publish ``version``: ``df`` holds all rows of ``months`` (None: rows without a date), and
    the other months are those of version ``base``, whose folders are referred to, not copied.
    A row of another month is an error, and nothing is published."""
    spark, touched = df.sparkSession, set(months)
    kept = [f for f in read_manifest(spark, root, table, base) if f.month not in touched]
    if published(spark, root, table, version):
        raise FileExistsError(manifest_path(root, table, version))
    written = _write(df, root, table)
    stray = {f.month for f in written} - touched
    if stray:
        raise ValueError(f"rows of months that are not replaced: {sorted(map(str, stray))}")
    return publish(spark, root, table, version, kept + written)
