"""The live alarm against the batch alarm over the same messages."""

import datetime as dt
import random

from pyspark.sql import functions as F

from orderlake.operators.monitor import backlog_alarm
from orderlake.streaming.alarm import live_alarm

T0 = dt.datetime(2024, 1, 1, 10, 2)


def run(spark, folder, out, **kw):
    stream = spark.readStream.schema("event_id long, ts timestamp, q string").option("maxFilesPerTrigger", "1").parquet(folder)
    query = (live_alarm(stream, **kw).writeStream.format("parquet").outputMode("append").option("path", out)
             .option("checkpointLocation", out + "-ckpt").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(out)


def test_same_rows_as_the_batch_alarm(spark, tmp_path):
    r = random.Random(2)
    minutes = sorted([r.randint(0, 3 * 1440) for _ in range(60)] + [0, 19 * 1440, 19 * 1440 + 1, 40 * 1440])
    rows = [(i, T0 + dt.timedelta(minutes=m)) for i, m in enumerate(minutes)]
    end = rows[-1][1] + dt.timedelta(days=14, minutes=30)
    folder = str(tmp_path / "in")
    # Two batches, then a tick that lets the last message expire.
    for part in (rows[:30], rows[30:], [(None, end)]):
        spark.createDataFrame([(*x, "a") for x in part], "event_id long, ts timestamp, q string") \
            .coalesce(1).write.mode("append").parquet(folder)
        live = run(spark, folder, str(tmp_path / "out"))
    # The last row emitted is that of the bucket in which the last message expires.
    last = rows[-1][1] + dt.timedelta(days=14)
    want = backlog_alarm(spark.createDataFrame(rows, "event_id long, ts timestamp"), as_of=F.lit(last))
    bag = lambda df: sorted(tuple(x) for x in df.select("window_start", "arrivals", "backlog", "state").collect())
    got, want = bag(live), bag(want)
    assert got == want[:len(got)] and len(want) - len(got) in (0, 1)
    assert got[-1][3] == "OK" and {s for *_, s in got} == {"OK", "ALARM"}
    assert len({w for w, *_ in got}) == len(got)


def test_queues_are_apart(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    at = lambda m: T0 + dt.timedelta(minutes=m)
    for part in ([(1, at(0), "a"), (2, at(60), "b")], [(3, at(55), "a"), (None, at(120), "b")], [(None, at(200), "b")]):
        spark.createDataFrame(part, "event_id long, ts timestamp, q string").coalesce(1).write.mode("append").parquet(folder)
        rows = run(spark, folder, out, queue=F.col("q"))
    last = {r["queue"]: r for r in rows.orderBy("window_start").collect()}
    assert last["a"]["backlog"] == 2 and last["b"]["backlog"] == 1
    assert rows.groupBy("queue", "window_start").count().where("count > 1").count() == 0
