"""The steps of the year rule equal a plain sequential fold (global and per key)."""

import random

from hrforge.plans.fold import year_sequence_fold


def _seq(rows, m0):
    m, out = m0, {}
    for rid, ry, sy in rows:
        ok = ry is not None and ry > m
        if ok and sy is not None:
            m = max(m, sy)
        out[rid] = ok
    return out


def test_year_fold_matches_sequential(spark):
    rng = random.Random(3)
    rows = []
    for rid in range(1, 801):
        emp = 1 if rng.random() < 0.4 else rng.randint(2, 40)   # one hot employee
        ry = None if rng.random() < 0.05 else rng.randint(2019, 2026)
        sy = None if rng.random() < 0.05 else rng.randint(2019, 2026)
        rows.append((rid, emp, ry, sy))
    df = spark.createDataFrame([(r, e, ry, sy, 2020) for r, e, ry, sy in rows],
                               "request_id int, emp int, ry int, sy int, _m0 long")
    got = {r.request_id: r.approved for r in year_sequence_fold(df, ["request_id"], "ry", "sy")
           .collect()}
    assert got == _seq([(r, ry, sy) for r, _, ry, sy in rows], 2020)
    got_k = {r.request_id: r.approved
             for r in year_sequence_fold(df, ["request_id"], "ry", "sy", key="emp").collect()}
    want_k = {}
    for e in {e for _, e, _, _ in rows}:
        want_k.update(_seq([(r, ry, sy) for r, ee, ry, sy in rows if ee == e], 2020))
    assert got_k == want_k
    assert 0 < sum(got.values()) < len(got)


def test_many_years_one_row_and_none(spark):
    up = [(i, 1, 2000 + i, 2000 + i) for i in range(40)]  # every row changes the year
    schema = "request_id int, emp int, ry int, sy int, _m0 long"
    for rows in (up, up[:1], []):
        df = spark.createDataFrame([(*r, 1990) for r in rows], schema)
        for key in (None, "emp"):
            got = {r.request_id: r.approved for r in year_sequence_fold(df, ["request_id"], "ry", "sy", key=key).collect()}
            assert got == _seq([(r, ry, sy) for r, _, ry, sy in rows], 1990)
