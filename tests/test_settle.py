"""Decisions in rounds equal decisions made one after another."""

import datetime as dt
import random

from test_quirks import empty, ledger_of, mk

from hrforge.operators import decide
from hrforge.plans.settle import settle_in_order

D = dt.date
BASE = D(2024, 2, 1)
COLUMNS = ("seq long, request_id int, emp_id int, days int, balance int, replacement int, "
           "start_date date, end_date date")


def _covers(a, b, x):
    return None not in (a, b, x) and a <= x <= b


def _one_by_one(rows, reversed_range):
    booked, used, out = [], {}, {}
    for seq, _, emp, days, bal, repl, s, e in sorted(rows, key=lambda r: (r[1], r[0])):
        left = bal if emp not in used else used[emp]
        if left is not None and days is not None and days > left:
            continue
        f, t = (e, s) if reversed_range else (s, e)
        if any(r == repl and (_covers(x, y, f) or _covers(x, y, t) or _covers(f, t, x)
                              or _covers(f, t, y)) for r, x, y in booked):
            continue
        used[emp] = None if left is None or days is None else left - days
        booked.append((repl, s, e))
        out[seq] = used[emp]
    return out


def test_rounds_match_one_by_one(spark):
    rng = random.Random(5)
    balances = {e: rng.choice([None, 0, 4, 9, 15]) for e in range(1, 9)}
    rows = []
    for i in range(260):
        emp = rng.randint(1, 8)
        start = BASE + dt.timedelta(days=rng.randint(0, 60))
        length = rng.choice([0, 1, 2, 5, -2])
        days = None if rng.random() < 0.02 else length + 1
        end = None if rng.random() < 0.03 else start + dt.timedelta(days=length)
        rows.append((i, rng.randint(1, 120), emp, days, balances[emp], rng.randint(20, 24),
                     start, end))
    df = spark.createDataFrame(rows, COLUMNS)
    for reversed_range in (False, True):
        got = {r.seq: r.balance_after for r in settle_in_order(df, reversed_range).collect()}
        want = _one_by_one(rows, reversed_range)
        assert got == want and 10 < len(want) < len(rows)


def test_no_requests(spark):
    assert settle_in_order(spark.createDataFrame([], COLUMNS), False).collect() == []


def test_two_deciders_and_a_shared_replacement(spark):
    emp = mk(spark, "employee", [
        {"employee_id": i, "annual_balance": 10, "type_of_contract": "full_time"}
        for i in (1, 2, 9)])
    leaves = [{"request_id": r, "date_of_request": D(2024, 1, 10), "start_date": D(2024, 2, 5),
               "end_date": D(2024, 2, 6), "num_days": 2, "final_approval_status": "pending"}
              for r in (1, 2)]
    annual = [{"request_id": r, "emp_id": r, "replacement_emp": 9} for r in (1, 2)]
    batch = spark.createDataFrame([(1, 1, 50), (2, 1, 51), (3, 2, 50)],
                                  "seq long, request_id int, hr_id int")
    lg = ledger_of(spark, leaves, annual=annual)
    out = decide.hr_decide_annual(batch, mk(spark, "leave", leaves),
                                  mk(spark, "annual_leave", annual),
                                  empty(spark, "employee_approve_leave"), emp, lg,
                                  empty(spark, "employee_replace_employee"), D(2024, 1, 15),
                                  mode="corrected")
    got = [(r.request_id, r.final_approval_status, r.balance_after)
           for r in out["decisions"].orderBy("seq").collect()]
    assert got == [(1, "approved", 8), (2, "rejected", None)]
    snap = decide.apply_balances(emp, out["decisions"], "annual_balance")
    assert {r.employee_id: r.annual_balance for r in snap.collect()} == {1: 8, 2: 10, 9: 10}
    assert out["new_replacements"].count() == 1


def chain(n):
    """Request i shares its employee with one neighbour and its replacement with the other."""
    return [(i, i, i // 2, 5, 7, 100 + (i + 1) // 2, BASE, BASE + dt.timedelta(days=4)) for i in range(n)]


def test_chains_take_few_jobs(spark, monkeypatch):
    frame = type(spark.range(0))
    count, real = [], frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda self, *a, **k: (count.append(1), real(self, *a, **k))[1])
    jobs = {}
    for n in (24, 400):
        count.clear()
        rows = chain(n)
        got = {r.seq: r.balance_after for r in settle_in_order(spark.createDataFrame(rows, COLUMNS), False).collect()}
        assert got == _one_by_one(rows, False) and len(got) == n // 2
        jobs[n] = len(count)
    assert jobs[24] <= 6 and jobs[400] <= 8, jobs


def test_far_ends_cost_no_more(spark):
    rows = [(i, i, i % 5, 1, 3, 50 + i % 3, BASE + dt.timedelta(days=i), D(9999, 12, 31) if i % 4 == 0 else BASE + dt.timedelta(days=i + 2))
            for i in range(60)]
    for reversed_range in (False, True):
        got = {r.seq: r.balance_after for r in settle_in_order(spark.createDataFrame(rows, COLUMNS), reversed_range).collect()}
        assert got == _one_by_one(rows, reversed_range)


def test_components_of_random_links(spark):
    from hrforge.plans.components import component_roots
    rng = random.Random(3)
    links = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(1300)] + [(i, i + 1) for i in range(5000, 5200)]
    root = {x: x for e in links for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    got = {r.node: r.root for r in component_roots(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: r for n, r in root.items() if n != r}
