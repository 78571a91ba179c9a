"""Day-keyed range joins equal brute force (nulls, reversed and long ranges)."""

import datetime as dt
import random

from hrforge.operators.ranges import drop_points_in_ranges, overlapping_keys

BASE = dt.date(2023, 11, 20)


def _d(rng):
    if rng.random() < 0.1:
        return None
    return BASE + dt.timedelta(days=rng.randint(0, 150))


def _between(x, a, b):
    if x is None or a is None or b is None:
        return None
    return a <= x <= b


def _or(*vals):
    if any(v is True for v in vals):
        return True
    if any(v is None for v in vals):
        return None
    return False


def test_overlap_keys_match_brute_force(spark):
    rng = random.Random(7)
    probes = [(i, rng.randint(1, 4), _d(rng), _d(rng)) for i in range(300)]
    ivs = [(rng.randint(1, 4), _d(rng), _d(rng)) for _ in range(200)]
    pdf = spark.createDataFrame(probes, "k int, e int, f date, t date")
    idf = spark.createDataFrame(ivs, "e int, s date, n date")
    got = {r.k for r in overlapping_keys(pdf, ["k"], "e", "f", "t", idf, "e", "s", "n").collect()}
    want = set()
    for k, e, f, t in probes:
        for ie, s, n in ivs:
            if ie == e and _or(_between(f, s, n), _between(t, s, n),
                               _between(s, f, t), _between(n, f, t)) is True:
                want.add(k)
    assert got == want and len(want) > 20


def test_points_in_ranges_match_brute_force(spark):
    rng = random.Random(11)
    pts = [(i, rng.randint(1, 4), _d(rng)) for i in range(300)]
    ivs = [(rng.randint(1, 4), _d(rng), _d(rng)) for _ in range(120)]
    pdf = spark.createDataFrame(pts, "k int, emp_id int, date date")
    idf = spark.createDataFrame(ivs, "emp_id int, s date, n date")
    got = {r.k for r in drop_points_in_ranges(pdf, "emp_id", "date", idf, "emp_id", "s", "n")
           .collect()}
    want = {k for k, e, d in pts
            if not any(ie == e and _between(d, s, n) is True for ie, s, n in ivs)}
    assert got == want and 0 < len(want) < len(pts)


def test_tables_tested_together_match_one_by_one(spark):
    from hrforge.operators.ranges import Intervals, overlap_flags
    rng = random.Random(13)
    probes = [(i, rng.choice([None, 1, 2, 3]), _d(rng), _d(rng)) for i in range(200)] + [(900, 1, None, None)]
    a = [(rng.choice([None, 1, 2, 3]), _d(rng), _d(rng)) for _ in range(40)]
    b = [(rng.randint(1, 3), _d(rng), _d(rng)) for _ in range(15)] + [(2, BASE, dt.date(9999, 12, 31))]
    pdf = spark.createDataFrame(probes, "k int, e int, f date, t date")
    adf, bdf = (spark.createDataFrame(x, "e int, s date, n date") for x in (a, b))
    got = {r.k: (r.x, r.y) for r in overlap_flags(pdf, "e", "f", "t", {
        "x": Intervals(adf, "e", "s", "n"), "y": Intervals(bdf, "e", "s", "n", swapped=True)}).collect()}

    def hit(e, f, t, rows):
        return any(e is not None and ie == e and _or(_between(f, s, n), _between(t, s, n), _between(s, f, t), _between(n, f, t)) is True
                   for ie, s, n in rows)

    assert got == {k: (hit(e, f, t, a), hit(e, t, f, b)) for k, e, f, t in probes}
    assert 20 < sum(x for x, _ in got.values()) < 180


def test_a_far_end_makes_no_more_rows(spark):
    from hrforge.operators.ranges import Intervals, overlap_hits
    pdf = spark.createDataFrame([(1, BASE, dt.date(9999, 12, 31))], "e int, f date, t date")
    idf = spark.createDataFrame([(1, BASE, dt.date(9999, 12, 31))], "e int, s date, n date")
    hits = overlap_hits(pdf, "e", "f", "t", [Intervals(idf, "e", "s", "n")])
    assert hits.count() == 1
    assert "sequence(" not in hits._jdf.queryExecution().toString()
