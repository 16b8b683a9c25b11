"""The backlog alarm over a live queue (REJ-6): ``monitor.backlog_alarm`` as a
stream, with event time, a watermark and a timer.

Messages are counted into 5-minute buckets per queue, as state: the buckets of
the last 14 days and those that are not closed yet, so at most some 4,000
numbers a queue. A bucket is closed when the watermark passes its end; then
its row (arrivals, backlog, state) is emitted, once. The timer of a queue is
the end of its next bucket, so the alarm returns to OK by itself when the last
message has expired; after that the queue has no timer until a message comes,
and the buckets in between are emitted then, as in the batch form.

A message that comes later than ``delay`` behind the newest one is dropped by
Spark before it gets here; choose the delay by the queue's. A message without
an id is a tick: it moves time on and counts for nothing (a source without
traffic moves no watermark).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.monitor import ALARM, ALARM_PERIOD_MINUTES, ALARM_THRESHOLD, OK, RETENTION_DAYS

OUTPUT = "queue string, window_start timestamp, arrivals long, backlog long, state string"
STATE = "next_bucket long, buckets binary, counts binary"
_MINUTE = 60_000  # milliseconds


def _alarm(period: int, retention: int, threshold: int):
    """The stateful function; times in milliseconds."""
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            next_bucket, buckets, counts = state.get
            buckets, counts = np.frombuffer(buckets, np.int64), np.frombuffer(counts, np.int64)
        else:
            next_bucket, buckets, counts = None, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for frame in frames:
            at = frame["at"][frame["message"].notna()].to_numpy(np.int64)
            new, n = np.unique(at - at % period, return_counts=True)
            if len(new) and next_bucket is None:
                next_bucket = int(new[0])
            every, where = np.unique(np.r_[buckets, new], return_inverse=True)
            total = np.zeros(len(every), np.int64)
            np.add.at(total, where, np.r_[counts, n])
            buckets, counts = every, total
        watermark = state.getCurrentWatermarkMs()
        if next_bucket is None:  # ticks only
            return
        # A first batch has no watermark yet, so it may bring earlier buckets.
        if watermark <= 0 and len(buckets):
            next_bucket = min(next_bucket, int(buckets[0]))
        closed = max((watermark - next_bucket) // period, 0) if watermark > 0 else 0
        if closed:
            start = next_bucket + np.arange(closed) * period
            running = np.r_[0, np.cumsum(counts)]
            upto = running[np.searchsorted(buckets, start, "right")]
            expired = running[np.searchsorted(buckets, start - retention, "right")]
            here = np.searchsorted(buckets, start)
            here_n = np.where((here < len(buckets)) & (buckets[np.minimum(here, len(buckets) - 1)] == start),
                              counts[np.minimum(here, len(buckets) - 1)], 0)
            backlog = upto - expired
            # With an empty queue the rows wait for the next message.
            quiet = len(buckets) == 0 or start[-1] >= buckets[-1] + retention
            last = int(np.searchsorted(start, buckets[-1] + retention, "right")) if quiet else len(start)
            yield pd.DataFrame({
                "queue": key[0], "window_start": pd.to_datetime(start[:last], unit="ms"), "arrivals": here_n[:last],
                "backlog": backlog[:last], "state": np.where(backlog[:last] >= threshold, ALARM, OK)})
            next_bucket = int(next_bucket + last * period)
            kept = buckets > next_bucket - period - retention
            buckets, counts = buckets[kept], counts[kept]
        state.update((next_bucket, buckets.tobytes(), counts.tobytes()))
        if len(buckets):
            state.setTimeoutTimestamp(max(next_bucket + period, watermark + 1))
    return run


def live_alarm(messages: DataFrame, ts: str = "ts", message_id: str = "event_id", queue: Column | None = None,
               delay: str = "10 minutes", period_minutes: int = ALARM_PERIOD_MINUTES,
               retention_days: int = RETENTION_DAYS, threshold: int = ALARM_THRESHOLD) -> DataFrame:
    """Streaming rows (queue, window_start, arrivals, backlog, state), to be
    written in append mode. Time zone of ``ts``: that of the session."""
    rows = messages.select(
        (F.lit("dead-letters") if queue is None else queue).cast("string").alias("queue"),
        F.col(message_id).cast("string").alias("message"), F.col(ts).cast("timestamp").alias("ts"))
    rows = rows.withWatermark("ts", delay).withColumn("at", F.unix_millis("ts"))
    return rows.groupBy("queue").applyInPandasWithState(
        _alarm(period_minutes * _MINUTE, retention_days * 24 * 60 * _MINUTE, threshold),
        OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
