"""Dead-letter monitoring: retention (REJ-5), backlog alarm (REJ-6) and
failure alert payloads (REJ-8).

Messages are rows with a timestamp ``ts``. The alarm counts messages per
5-minute bucket (partial aggregation, so the row volume never reaches one
task). The backlog of a bucket is the messages of the 14 days before its day,
plus what arrived in the day up to it, less what expired in the day up to it.
The first term is an aggregation by day, the others are a running sum inside
the day: no task ever sees more than one day of buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import json_record

# Fixed values of the reference's queue and alarm configuration.
RETENTION_DAYS = 14
ALARM_PERIOD_MINUTES = 5
ALARM_THRESHOLD = 1
ALARM, OK = "ALARM", "OK"


def retained(messages: DataFrame, as_of: Column | None = None,
             days: int = RETENTION_DAYS, ts: str = "ts") -> DataFrame:
    """Messages still in the queue at ``as_of`` (default: the latest message)."""
    if as_of is None:
        as_of = messages.select(F.max(ts)).scalar()  # scalar subquery, one value
    lo = as_of - F.expr(f"INTERVAL {days} DAYS")
    return messages.where((F.col(ts) > lo) & (F.col(ts) <= as_of))


def backlog_alarm(messages: DataFrame, ts: str = "ts", period_minutes: int = ALARM_PERIOD_MINUTES,
                  retention_days: int = RETENTION_DAYS, threshold: int = ALARM_THRESHOLD,
                  as_of: Column | None = None) -> DataFrame:
    """Per bucket: window_start, arrivals, backlog, state (missing data = OK).

    Buckets run from the first message to the last one, or to ``as_of`` if
    that is later (the alarm's return to OK shows only then).
    """
    if (24 * 60) % period_minutes:
        raise ValueError("period_minutes must divide a day")
    step, day_step = F.expr(f"INTERVAL {period_minutes} MINUTES"), F.expr("INTERVAL 1 DAY")
    keep = F.expr(f"INTERVAL {retention_days} DAYS")
    start = F.col("window_start")
    per_bucket = (messages.groupBy(F.window(ts, f"{period_minutes} minutes").start.alias("window_start"))
                  .agg(F.count(F.lit(1)).alias("arrivals")))
    changes = (per_bucket.select(start, "arrivals", F.lit(0).cast("long").alias("expired"))
               .unionByName(per_bucket.select((start + keep).alias("window_start"),
                                              F.lit(0).cast("long").alias("arrivals"),
                                              F.col("arrivals").alias("expired")))
               .groupBy("window_start").agg(F.sum("arrivals").alias("arrivals"),
                                            F.sum("expired").alias("expired")))
    # Messages of the retention_days days before each day.
    per_day = (per_bucket.groupBy(F.window("window_start", "1 day").start.alias("day"))
               .agg(F.sum("arrivals").alias("n")))
    before = (per_day.select(
        F.explode(F.sequence(F.col("day") + day_step, F.col("day") + keep, day_step)).alias("day"), "n")
        .groupBy("day").agg(F.sum("n").alias("before")))

    last = F.max("window_start")
    if as_of is not None:
        last = F.greatest(last, as_of)
    bounds = per_bucket.agg(F.min("window_start").alias("lo"), last.alias("hi"))
    days = bounds.select("lo", "hi", F.explode(F.sequence(
        F.date_trunc("day", "lo").cast(messages.schema[ts].dataType),
        F.date_trunc("day", "hi").cast(messages.schema[ts].dataType), day_step)).alias("day"))
    grid = (days.join(before, "day", "left").repartition("day")
            .select("day", "lo", "hi", F.coalesce("before", F.lit(0)).alias("before"),
                    F.explode(F.sequence(F.col("day"), F.col("day") + day_step - step, step))
                    .alias("window_start"))
            .where((start >= F.col("lo")) & (start <= F.col("hi"))))
    # Days cut at the first bucket lose nothing: nothing arrived before it.
    dense = grid.join(changes, "window_start", "left").fillna(0, ["arrivals", "expired"])
    w = Window.partitionBy("day").orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
    backlog = F.col("before") + F.sum(F.col("arrivals") - F.col("expired")).over(w)
    return dense.select("window_start", "arrivals", backlog.alias("backlog")).select(
        "window_start", "arrivals", "backlog",
        F.when(F.col("backlog") >= threshold, F.lit(ALARM)).otherwise(F.lit(OK)).alias("state"))


def failure_alerts(dead_letters: DataFrame) -> DataFrame:
    """Alert payload per dead letter: JSON with error (the exception's type),
    cause (its text), bucket, key."""
    return dead_letters.select(
        "source_file",
        json_record(error="error_type", cause="error",
                    bucket="bucket", key="key").alias("payload"))


def dead_letter_json(dead_letters: DataFrame) -> DataFrame:
    """The queue message body of each dead letter."""
    return dead_letters.select(
        "source_file",
        json_record("bucket", "key", "error",
                    timestamp=F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"),
                    request_id="request_id").alias("body"))
