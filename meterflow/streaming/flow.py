"""Measured flow on a stream of counter readings.

Per series the last reading is kept as state. Readings are put in time order within a trigger and
within what the watermark still allows: a reading waits until the watermark passes its time, so a
late one, or a correction of one that still waits, takes its place before differences are made.
Of several values for one time the one that was recorded last counts. Readings older than the
watermark are dropped by Spark.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from meterflow.plans.stage import new_path

OUTPUT = "timeseries_id string, timestamp timestamp, delta double"


class DeltaProcessor(StatefulProcessor):
    """State per series: the last emitted (time, value), readings that still wait, as they came, and the
    smallest time of these, for which the timer is set. What waits is read and written as a list, so a
    trigger makes a few calls per series, not per reading."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at timestamp, value double")
        self.waiting = handle.getListState("waiting", "at timestamp, value double, recorded timestamp")
        self.first = handle.getValueState("first", "at timestamp")

    def _wait_for(self, at: pd.Timestamp | None) -> None:
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        if at is None:
            self.first.clear()
            return
        self.first.update((at.to_pydatetime(),))
        # pandas timestamps are in UTC; timers are in milliseconds
        self.handle.registerTimer(int(at.timestamp() * 1000) + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = pd.Timestamp(self.first.get()[0]) if self.first.exists() else None
        for part in rows:
            new = [(at.to_pydatetime(), float(value), None if pd.isna(recorded) else recorded.to_pydatetime()) for at, value, recorded in zip(part["timestamp"], part["value"], part["recorded_at"])]
            if new:
                self.waiting.appendList(new)
                least = part["timestamp"].min()
                first = least if first is None else min(first, least)
        self._wait_for(first)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        kept: dict[pd.Timestamp, tuple] = {}
        for at, value, recorded in self.waiting.get():
            at, old = pd.Timestamp(at), kept.get(pd.Timestamp(at))
            if old is None or old[1] is None or (recorded is not None and recorded >= old[1]):
                kept[at] = (value, recorded)
        due = sorted(at for at in kept if at.timestamp() * 1000 < now)
        out, before = [], self.last.get() if self.last.exists() else None
        for at in due:
            value = kept.pop(at)[0]
            if before is not None:
                out.append((key[0], at, value - before[1]))
            before = (at, value)
        if due:
            self.last.update((before[0].to_pydatetime(), before[1]))
            if kept:
                self.waiting.put([(at.to_pydatetime(), *row) for at, row in kept.items()])
            else:
                self.waiting.clear()
        self._wait_for(min(kept, default=None))
        if out:
            yield pd.DataFrame(out, columns=["timeseries_id", "timestamp", "delta"])

    def close(self) -> None:
        pass


def measured_flow_stream(readings: DataFrame, lateness: str = "2 days") -> DataFrame:
    """(timeseries_id, timestamp, delta) of a stream (timeseries_id, timestamp, value, recorded_at)
    of preferred counters, in append mode. The state store must be RocksDB, as for all such
    processors; a reading is emitted once the watermark has passed it."""
    rows = readings.select("timeseries_id", F.col("timestamp"), F.col("value").cast("double").alias("value"), "recorded_at")
    return rows.withWatermark("timestamp", lateness).groupBy("timeseries_id").transformWithStateInPandas(
        statefulProcessor=DeltaProcessor(), outputStructType=StructType.fromDDL(OUTPUT), outputMode="Append", timeMode="EventTime"
    )


def run_once(spark: SparkSession, arrivals: Iterable[DataFrame], lateness: str = "2 days") -> DataFrame:
    """`measured_flow_stream` over tables of readings that arrive one after the other; the rows that came
    out by then. All files of an arrival are one trigger, so however many tasks write it, the watermark
    moves only between arrivals."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        inbox, out, log = new_path(spark, "inbox"), new_path(spark, "stream"), new_path(spark, "stream-checkpoint")
        for readings in arrivals:
            readings.write.mode("append").parquet(inbox)
            stream = measured_flow_stream(spark.readStream.schema(readings.schema).parquet(inbox), lateness)
            query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", log).trigger(availableNow=True).start()
            query.awaitTermination()
        return spark.read.schema(OUTPUT).parquet(out)
    finally:
        spark.conf.set(provider, before)
