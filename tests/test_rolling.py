import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from visitledger.operators.rolling import rolling_active_users, rolling_active_users_sketch, rolling_sums

DAY0 = dt.date(2024, 1, 1)


def brute(rows, windows, until):
    """Every day, every window, by definition."""
    out = {}
    keys = {r[0] for r in rows}
    day = min(r[2] for r in rows)
    while day <= until:
        for k in keys:
            counts = tuple(
                len({u for kk, u, d, _ in rows if kk == k and day - dt.timedelta(days=n) < d <= day}) for n in windows
            )
            if any(counts):
                out[(k, day)] = counts
        day += dt.timedelta(days=1)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = [
        (rnd.choice("ab"), rnd.randrange(6), DAY0 + dt.timedelta(days=rnd.randrange(50)), 1)
        for _ in range(rnd.randrange(1, 60))
    ]
    # one user that visits every day, many times
    rows += [("a", 99, DAY0 + dt.timedelta(days=i), 1) for i in range(20) for _ in range(30)]
    until = max(r[2] for r in rows) + dt.timedelta(days=3)
    df = spark.createDataFrame(rows, "k string, user_id int, event_date date, n bigint")
    windows = (1, 7, 28)
    got = rolling_active_users(df, ["k"], windows=windows, sums=("n",), until=until).collect()
    assert {(r["k"], r["event_date"]): tuple(r[f"users_{n}d"] for n in windows) for r in got} == brute(rows, windows, until)
    per_day = defaultdict(int)
    for k, _, d, n in rows:
        per_day[(k, d)] += n
    assert {(r["k"], r["event_date"]): r["n"] for r in got if r["n"] is not None} == dict(per_day)


def test_unknown_users_add_to_sums_only(spark):
    rows = [("a", None, DAY0, 5), ("a", 1, DAY0 + dt.timedelta(days=1), 2), ("a", None, DAY0 + dt.timedelta(days=1), 3)]
    df = spark.createDataFrame(rows, "k string, user_id int, event_date date, n bigint")
    got = rolling_active_users(df, ["k"], windows=(1, 7), sums=("n",)).orderBy("event_date").collect()
    assert [(r["event_date"], r["users_1d"], r["users_7d"], r["n"]) for r in got] == [(DAY0, 0, 0, 5), (DAY0 + dt.timedelta(days=1), 1, 1, 5)]


def test_exact_gap_boundaries(spark):
    """A visit exactly N days after the last one starts a new run the day the old one ends."""
    rows = [("a", 1, DAY0, 1), ("a", 1, DAY0 + dt.timedelta(days=7), 1), ("a", 1, DAY0 + dt.timedelta(days=15), 1)]
    df = spark.createDataFrame(rows, "k string, user_id int, event_date date, n bigint")
    until = DAY0 + dt.timedelta(days=30)
    got = rolling_active_users(df, ["k"], windows=(7,), until=until).collect()
    assert {(r["k"], r["event_date"]): (r["users_7d"],) for r in got} == brute(rows, (7,), until)


def test_no_keys_and_default_end(spark):
    rows = [("a", u, DAY0 + dt.timedelta(days=d), 1) for u in range(3) for d in (0, 2 + u)]
    df = spark.createDataFrame(rows, "k string, user_id int, event_date date, n bigint").drop("k")
    got = rolling_active_users(df, []).orderBy("event_date").collect()
    assert [r["event_date"] for r in got][-1] == DAY0 + dt.timedelta(days=4)
    assert [(r["users_1d"], r["users_7d"]) for r in got] == [(3, 3), (0, 3), (1, 3), (1, 3), (1, 3)]


def test_sketch_is_close(spark):
    df = spark.range(40000).select(
        (F.col("id") % 7 < 3).cast("string").alias("k"), (F.col("id") % 5003).alias("user_id"),
        F.date_add(F.lit(DAY0), (F.hash("id") % 20 + 20).cast("int")).alias("event_date"),
    )
    exact = {(r["k"], r["event_date"]): r for r in rolling_active_users(df, ["k"]).collect()}
    near = {(r["k"], r["event_date"]): r for r in rolling_active_users_sketch(df, ["k"]).collect()}
    assert exact.keys() == near.keys()
    for key, row in exact.items():
        for name in ("users_1d", "users_7d", "users_28d"):
            assert abs(near[key][name] - row[name]) <= max(3, 0.06 * row[name])


def test_sums_use_calendar_days(spark):
    """Days missing from the data do not stretch the window."""
    days = [0, 3, 6, 7, 40]
    df = spark.createDataFrame([("a", DAY0 + dt.timedelta(days=i), 10 ** p) for p, i in enumerate(days)], "k string, event_date date, n bigint")
    got = rolling_sums(df, ["k"], {7: {"n7": "n"}, 28: {"n28": "n"}}).orderBy("event_date").collect()
    assert [r["n7"] for r in got] == [1, 11, 111, 1110, 10000]
    assert [r["n28"] for r in got] == [1, 11, 111, 1111, 10000]


def test_one_window_for_both_frames(spark):
    df = spark.createDataFrame([("a", DAY0, 1)], "k string, event_date date, n bigint")
    plan = rolling_sums(df, ["k"], {7: {"n7": "n"}, 28: {"n28": "n"}})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1
