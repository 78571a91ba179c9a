import datetime as dt
import os
import tempfile

import pytest

from hrforge.operators.admin import upsert_attendance_days
from hrforge.sources import io
from hrforge.sources.io import load_table, read_manifest, stored_max_id, write_months, write_snapshot
from hrforge.sources.schemas import SCHEMAS
from hrforge.streaming.checkins import CHECKIN_SCHEMA, start_checkin_stream, upsert_version


def test_checkin_stream_publishes_versions(spark):
    base = tempfile.mkdtemp(prefix="hrforge-stream-", dir="/tmp")
    root, src, ckpt = f"{base}/tables", f"{base}/src", f"{base}/ckpt"
    d = dt.date(2024, 1, 30)
    att = spark.createDataFrame(
        [(7, d, None, None, None, "absent", 1)], SCHEMAS["attendance"])
    write_snapshot(att, root, "attendance", 0)
    rows = [(1, d, dt.datetime(2024, 1, 30, 9, 0), dt.datetime(2024, 1, 30, 17, 30), 1),
            (2, d, dt.datetime(2024, 1, 30, 8, 0), dt.datetime(2024, 1, 30, 12, 0), 2),
            (2, d, dt.datetime(2024, 1, 30, 8, 5), dt.datetime(2024, 1, 30, 16, 5), 3)]
    spark.createDataFrame(rows, CHECKIN_SCHEMA).write.parquet(f"{src}/part1")
    q = start_checkin_stream(spark, f"{src}/*", root, 0, ckpt)
    q.awaitTermination(120)
    out = {r.emp_id: r for r in load_table(spark, root, "attendance", 1).collect()}
    assert out[1].attendance_id == 7 and out[1].status == "attended"
    assert out[1].total_duration == 510
    assert out[2].attendance_id == 8 and out[2].total_duration == 480   # latest seq wins


def test_checkin_stream_resumes_after_restart(spark):
    base = tempfile.mkdtemp(prefix="hrforge-stream-", dir="/tmp")
    root, src, ckpt = f"{base}/tables", f"{base}/src", f"{base}/ckpt"
    d = dt.date(2024, 1, 30)
    write_snapshot(spark.createDataFrame([], SCHEMAS["attendance"]), root, "attendance", 0)
    first = [(1, d, dt.datetime(2024, 1, 30, 9, 0), dt.datetime(2024, 1, 30, 17, 0), 1)]
    spark.createDataFrame(first, CHECKIN_SCHEMA).write.parquet(f"{src}/part1")
    start_checkin_stream(spark, f"{src}/*", root, 0, ckpt).awaitTermination(120)
    # restart on the same query checkpoint with one more file: only it is processed
    second = [(2, d, dt.datetime(2024, 1, 30, 10, 0), dt.datetime(2024, 1, 30, 11, 0), 2)]
    spark.createDataFrame(second, CHECKIN_SCHEMA).write.parquet(f"{src}/part2")
    start_checkin_stream(spark, f"{src}/*", root, 0, ckpt).awaitTermination(120)
    v1 = {r.emp_id: r.attendance_id for r in load_table(spark, root, "attendance", 1).collect()}
    v2 = {r.emp_id: (r.attendance_id, r.total_duration)
          for r in load_table(spark, root, "attendance", 2).collect()}
    assert v1 == {1: 1}
    assert v2 == {1: (1, 480), 2: (2, 60)}


def _files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def _months(spark, days):
    return spark.createDataFrame([(i + 1, d, None, None, None, "absent", i) for i, d in enumerate(days)], SCHEMAS["attendance"])


def test_a_batch_writes_the_months_it_touches(spark):
    root = tempfile.mkdtemp(prefix="hrforge-months-", dir="/tmp")
    days = [None] + [dt.date(2022, 1, 15) + dt.timedelta(days=k) for k in range(0, 730, 3)]
    write_snapshot(_months(spark, days), root, "attendance", 0)
    before, old = _files(root), load_table(spark, root, "attendance", 0).collect()
    new_day = dt.date(2023, 5, 9)
    rows = [(i, new_day, dt.datetime(2023, 5, 9, 9), dt.datetime(2023, 5, 9, 17), i) for i in range(1000, 1003)]
    checkins = spark.createDataFrame(rows, CHECKIN_SCHEMA)
    upsert_version(checkins, root, 0, 1)
    added = _files(root) - before
    assert added and all("month_key=202305" in f for f in added)  # old folders stay, one month is new
    a, b = (read_manifest(spark, root, "attendance", v) for v in (0, 1))
    assert {f for f in a if f.month != 202305} == {f for f in b if f.month != 202305}
    assert sorted(map(str, load_table(spark, root, "attendance", 0).collect())) == sorted(map(str, old))
    whole = upsert_attendance_days(load_table(spark, root, "attendance", 0), checkins).collect()
    assert sorted(map(str, load_table(spark, root, "attendance", 1).collect())) == sorted(map(str, whole))
    assert stored_max_id(spark, root, "attendance", 1) == len(days) + 3
    # a check-in without a date goes to the folder of rows without one
    upsert_version(spark.createDataFrame([(7, None, None, None, 1)], CHECKIN_SCHEMA), root, 1, 2)
    assert load_table(spark, root, "attendance", 2).filter("date IS NULL").count() == 2


def test_months_can_empty_and_strays_are_refused(spark):
    root = tempfile.mkdtemp(prefix="hrforge-months-", dir="/tmp")
    write_snapshot(_months(spark, [dt.date(2024, 1, 5), dt.date(2024, 2, 5)]), root, "attendance", 0)
    write_months(_months(spark, []), root, "attendance", 0, 1, [202401])
    assert [r.date for r in load_table(spark, root, "attendance", 1).collect()] == [dt.date(2024, 2, 5)]
    with pytest.raises(ValueError):
        write_months(_months(spark, [dt.date(2024, 3, 1)]), root, "attendance", 1, 2, [202402])
    with pytest.raises(FileNotFoundError):
        load_table(spark, root, "attendance", 2)
    with pytest.raises(FileExistsError):
        write_months(_months(spark, []), root, "attendance", 0, 1, [202402])


@pytest.mark.parametrize("after_publishing", [False, True])
def test_crash_between_data_and_manifest(spark, monkeypatch, after_publishing):
    base = tempfile.mkdtemp(prefix="hrforge-stream-", dir="/tmp")
    root, src, ckpt = f"{base}/tables", f"{base}/src", f"{base}/ckpt"
    d = dt.date(2024, 1, 30)
    write_snapshot(spark.createDataFrame([(7, d, None, None, None, "absent", 1)], SCHEMAS["attendance"]), root, "attendance", 0)
    rows = [(2, d, dt.datetime(2024, 1, 30, 9, 0), dt.datetime(2024, 1, 30, 17, 0), 1)]
    spark.createDataFrame(rows, CHECKIN_SCHEMA).write.parquet(f"{src}/part1")
    real = io.publish

    def killed(*args):
        if after_publishing:
            real(*args)
        raise RuntimeError("killed")

    monkeypatch.setattr(io, "publish", killed)
    with pytest.raises(Exception, match="killed"):
        start_checkin_stream(spark, f"{src}/*", root, 0, ckpt).awaitTermination(120)
    monkeypatch.setattr(io, "publish", real)
    left = _files(root)
    assert io.published(spark, root, "attendance", 1) == after_publishing
    start_checkin_stream(spark, f"{src}/*", root, 0, ckpt).awaitTermination(120)
    got = load_table(spark, root, "attendance", 1)
    assert sorted((r.emp_id, r.attendance_id) for r in got.collect()) == [(1, 7), (2, 8)]
    assert (_files(root) == left) == after_publishing  # written again only if no version had been published
    assert load_table(spark, root, "attendance", 0).count() == 1
