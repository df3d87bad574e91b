import datetime as dt
import random

from conftest import transfer, ts
from pyspark.sql import functions as F

from ringwatch.operators.summary import accounts_by_period, daily_account_sketches


def _rows(n, accounts, days=6, seed=5):
    rng = random.Random(seed)
    return [transfer(i, ts(rng.randrange(24 * days)), f"A{rng.randrange(accounts)}", f"A{rng.randrange(accounts)}")
            for i in range(n)]


def test_periods_unite_daily_sketches(make_transfers):
    """Few accounts: sketches are exact, so any union of days must equal the set of accounts."""
    rows = _rows(400, 60)
    t = make_transfers(rows)
    broken = make_transfers([transfer(900, ts(1), "gone", "A1"), transfer(901, ts(1), "late", "late")])
    t = t.unionByName(broken.withColumns({"from_account": F.when(F.col("txn_id") != 900, F.col("from_account")),
                                          "timestamp": F.when(F.col("txn_id") != 901, F.col("timestamp"))}))
    rows.append(transfer(900, ts(1), None, "A1"))
    s = daily_account_sketches(t).cache()
    assert s.count() == 6
    halves = F.when(F.dayofmonth("day") <= 3, "first").when(F.dayofmonth("day") <= 5, "second")
    got = {r.period: (r.transfers, r.accounts) for r in accounts_by_period(s, halves).collect()}
    want = {}
    for r in rows:
        if r[1] >= dt.datetime(2022, 9, 6):
            continue
        n, seen = want.setdefault("first" if r[1] < dt.datetime(2022, 9, 4) else "second", [0, set()])
        want["first" if r[1] < dt.datetime(2022, 9, 4) else "second"][0] += 1
        seen.update(a for a in (r[3], r[5]) if a is not None)
    assert got == {p: (n, len(seen)) for p, (n, seen) in want.items()}


def test_error_bound_on_many_accounts(make_transfers):
    rows = _rows(30_000, 40_000)
    exact = len({a for r in rows for a in (r[3], r[5])})
    got = accounts_by_period(daily_account_sketches(make_transfers(rows)), F.lit("all")).first()
    assert got.transfers == 30_000 and abs(got.accounts - exact) <= 3 * 1.04 / 64 * exact


def test_no_rows(make_transfers):
    assert accounts_by_period(daily_account_sketches(make_transfers([])), F.lit("all")).count() == 0
