"""Check-ins as a stream: each micro-batch runs the attendance upsert.

Check-in records (emp_id, date, check_in_time, check_out_time, seq) arrive as
files. ``foreachBatch`` applies ``upsert_attendance_days`` to the months that the
batch touches and publishes a version in which only these months have new folders
(``sources/io.py``); the next id comes from the manifest, so no other month is read or
written. Versions follow the stream's batch ids, which Structured Streaming records in
the query checkpoint, so a restarted query resumes where it stopped: a batch whose version
was published before a crash is not written again, and folders of a batch that was killed
before its version was published belong to no version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hrforge.operators.admin import upsert_attendance_days
from hrforge.sources.io import load_table, month_key, published, stored_max_id, write_months

CHECKIN_SCHEMA = T.StructType([
    T.StructField("emp_id", T.IntegerType()),
    T.StructField("date", T.DateType()),
    T.StructField("check_in_time", T.TimestampNTZType()),
    T.StructField("check_out_time", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])


def upsert_version(checkins: DataFrame, root: str, base: int | str, version: int | str) -> None:
    """Publish attendance ``version``: version ``base`` with the check-ins (of any days)."""
    spark = checkins.sparkSession
    # at most one row per month of the calendar
    months = [r[0] for r in checkins.select(month_key(F.col("date"))).distinct().collect()]
    current = load_table(spark, root, "attendance", base, months=months)
    new = upsert_attendance_days(current, checkins, stored_max_id(spark, root, "attendance", base))
    write_months(new, root, "attendance", base, version, months)


def start_checkin_stream(spark: SparkSession, source_dir: str, tables_root: str,
                         base_version: int, query_checkpoint: str,
                         trigger: dict | None = None) -> StreamingQuery:
    """Start the stream. Batch ``b`` reads attendance version ``base_version + b``
    and publishes version ``base_version + b + 1``."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        target = base_version + batch_id + 1
        if not published(spark, tables_root, "attendance", target):
            upsert_version(batch, tables_root, base_version + batch_id, target)

    stream = spark.readStream.schema(CHECKIN_SCHEMA).parquet(source_dir)
    writer = (stream.writeStream.foreachBatch(apply)
              .option("checkpointLocation", query_checkpoint))
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()
