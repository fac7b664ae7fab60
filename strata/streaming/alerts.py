"""Live alerts on volume, with state per source.

Records are counted per source and time window first, so that a hot source reaches its state
as one row per closed window. The state of a source is four numbers and a timer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from strata.operators.projection import quoted

ALERT = (
    T.StructType().add("source", "string").add("window_start", "timestamp").add("records", "long").add("previous", "long")
    .add("mean", "double").add("deviation", "double").add("anomaly", "boolean")
)
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Volume(StatefulProcessor):
    """Closed windows of a source against the mean and deviation of all before them.

    ``silence_ms``: a source that closes no window for so long is told once, as a window
    of 0 records at that time, which counts neither as a window nor for the mean.
    """

    def __init__(self, k: float, silence_ms: int | None):
        self.k, self.silence_ms = k, silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "n long, mean double, squares double, previous long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        n, mean, squares, previous = self.seen.get() if self.seen.exists() else (0, 0.0, 0.0, None)
        # One row per window that closed since the last trigger.
        closed = sorted((r.window_start, r.window_end, r.records) for r in rows)
        for start, _, records in closed:
            deviation = math.sqrt(squares / (n - 1)) if n > 1 else None
            yield Row(
                source=key[0], window_start=start, records=records, previous=previous, mean=mean if n else None, deviation=deviation,
                anomaly=deviation is not None and abs(records - mean) > self.k * deviation)
            n += 1
            gap = records - mean
            mean += gap / n
            squares += gap * (records - mean)
            previous = records
        self.seen.update((n, mean, squares, previous))
        if self.silence_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
            self.handle.registerTimer(int(closed[-1][1].timestamp() * 1000) + self.silence_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        n, mean, squares, previous = self.seen.get()
        at = expiredTimerInfo.getExpiryTimeInMs()
        yield Row(
            source=key[0], window_start=datetime.fromtimestamp(at / 1000), records=0, previous=previous, mean=mean,
            deviation=math.sqrt(squares / (n - 1)) if n > 1 else None, anomaly=True)

    def close(self) -> None:
        pass


def live_volume(
    stream: DataFrame, ts: str, source: str, width: str = "1 hour", delay: str = "1 hour", k: float = 3.0,
    silence_ms: int | None = None,
) -> DataFrame:
    """``ALERT`` rows for every closed window of every source; late rows count until the
    delay has passed. Sources that are null are one. Needs the state store of ``keep_state``."""
    counted = (
        stream.withWatermark(ts, delay).groupBy(F.window(quoted(ts), width).alias("w"), quoted(source).cast("string").alias("source"))
        .agg(F.count(F.lit(1)).alias("records"))
        .select("source", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), F.window_time("w").alias("at"), "records")
    )
    return counted.groupBy("source").transformWithState(
        statefulProcessor=Volume(k, silence_ms), outputStructType=ALERT, outputMode="Append", timeMode="EventTime")


def volume_by_source(df: DataFrame, ts: str, source: str, width: str = "1 hour", k: float = 3.0) -> DataFrame:
    """The same figures of a table that holds all its rows: every window counts."""
    counts = df.groupBy(F.window(quoted(ts), width).alias("w"), quoted(source).cast("string").alias("source")).agg(
        F.count(F.lit(1)).alias("records")).select("source", F.col("w.start").alias("window_start"), "records")
    # One row per source and window, not per record.
    by = "over (partition by source order by window_start rows between unbounded preceding and 1 preceding)"
    return counts.selectExpr(
        "source", "window_start", "records", "lag(records) over (partition by source order by window_start) as previous",
        f"avg(records) {by} as mean", f"stddev_samp(records) {by} as deviation",
    ).withColumn("anomaly", F.coalesce(F.abs(F.col("records") - F.col("mean")) > F.lit(float(k)) * F.col("deviation"), F.lit(False)))


def keep_state(spark: SparkSession) -> None:
    """State of several kinds per key, and timers, need this store. Queries that run keep
    theirs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
