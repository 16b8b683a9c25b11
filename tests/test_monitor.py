"""Dead-letter retention and backlog alarm against brute force."""

import datetime as dt

from orderlake.operators import monitor


def _events(spark):
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    offsets_min = [0, 1, 4, 5, 11, 60 * 24 * 3, 60 * 24 * 15, 60 * 24 * 15 + 2, 60 * 24 * 30]
    rows = [(i, base + dt.timedelta(minutes=m, seconds=7)) for i, m in enumerate(offsets_min)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz"), rows


def test_retention(spark):
    df, rows = _events(spark)
    latest = max(r[1] for r in rows)
    exp = sorted(i for i, ts in rows if latest - dt.timedelta(days=14) < ts <= latest)
    assert sorted(r[0] for r in monitor.retained(df).collect()) == exp


def test_backlog_alarm_brute_force(spark):
    df, rows = _events(spark)
    got = monitor.backlog_alarm(df).orderBy("window_start").collect()

    def bucket(ts):
        return ts.replace(second=0, microsecond=0) - dt.timedelta(minutes=ts.minute % 5)
    starts = [bucket(ts) for _, ts in rows]
    lo, hi = min(starts), max(starts)
    n = int((hi - lo).total_seconds() // 300) + 1
    assert len(got) == n
    span = dt.timedelta(days=14)
    for r in got[:: max(1, n // 500)] + got[-3:]:
        w = r["window_start"]
        arrivals = sum(1 for s in starts if s == w)
        backlog = sum(1 for s in starts if w - span < s <= w)
        assert r["arrivals"] == arrivals
        assert r["backlog"] == backlog
        assert r["state"] == ("ALARM" if backlog >= 1 else "OK")
    assert any(r["state"] == "OK" for r in got)  # the queue drains after 14 quiet days


def test_alarm_has_no_single_task_window(spark):
    df, _ = _events(spark)
    plan = monitor.backlog_alarm(df)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("[day" in line for line in windows)
    assert "SinglePartition" not in "".join(line for line in plan.splitlines() if "Window" in line)


def test_alarm_returns_to_ok_by_as_of_and_stands_outliers(spark):
    from pyspark.sql import functions as F
    rows = [(dt.datetime(1990, 1, 1),), (dt.datetime(2024, 1, 1, 0, 2),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = monitor.backlog_alarm(df, as_of=F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"))
    last = got.orderBy(F.desc("window_start")).limit(300).collect()
    assert last[0]["window_start"] == dt.datetime(2024, 1, 16) and last[0]["state"] == "OK"
    states = {r["window_start"]: r["state"] for r in last}
    assert states[dt.datetime(2024, 1, 15)] == "OK"
    assert got.where("state = 'ALARM'").count() == 2 * 4032
    assert got.where((F.col("window_start") == dt.datetime(2024, 1, 14, 23, 55)) & (F.col("state") == "ALARM")).count() == 1
