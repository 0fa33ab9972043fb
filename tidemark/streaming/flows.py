"""Structured Streaming flows: duplicates, windows, sessions, running bursts and batch sinks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.storage import exists

KEYS = ["subject_uri", "event_type", "actor_did"]
WATERMARK = "10 minutes"


def replay(spark: SparkSession, path: str, schema, files: int = 1, kind: str = "json") -> DataFrame:
    """A stream over the files of a folder, some per trigger."""
    return spark.readStream.schema(schema).format(kind).option("maxFilesPerTrigger", files).load(path)


def deduplicate(events: DataFrame, time: str, keys: list[str] = KEYS, watermark: str | None = WATERMARK) -> DataFrame:
    """The first event of each key. With a watermark, a key's state goes when that has passed; without, it is kept for good."""
    return events.withWatermark(time, watermark).dropDuplicatesWithinWatermark(keys) if watermark else events.dropDuplicates(keys)


def tumbling(events: DataFrame, time: str, by: list[str], size: str = "1 hour", watermark: str = WATERMARK) -> DataFrame:
    """Counts per window of event time."""
    return events.withWatermark(time, watermark).groupBy(F.window(time, size), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *by, "n")


def sessions(events: DataFrame, time: str, by: str, gap: str = "30 minutes", watermark: str = WATERMARK) -> DataFrame:
    """Sessions of a key: events with less than `gap` between them."""
    return events.withWatermark(time, watermark).groupBy(F.session_window(time, gap), by).agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), by, "n")


class BurstStates(StatefulProcessor):
    """Per key the number of events, the last time and the cost of each state, as one value; a timer ends what was idle too long."""

    def __init__(self, key: str, time_us: str, rate: np.ndarray, gamma: float, idle_ms: int | None) -> None:
        self.key, self.time_us, self.rate, self.idle_ms = key, time_us, rate, idle_ms
        self.rise = gamma * np.maximum(np.arange(len(rate))[:, None] - np.arange(len(rate))[None], 0)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.held = handle, handle.getValueState("costs", "n long, last long, cost array<double>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, last, cost = self.held.get() if self.held.exists() else (0, None, None)
        if self.idle_ms is not None and last is not None:
            self.handle.deleteTimer(last // 1000 + self.idle_ms)
        cost = np.array(cost) if cost is not None else None
        for t in sorted(x for p in rows for x in p[self.time_us].tolist()):
            if last is not None:
                gap = max(0.0, (t - last) / 1e6)
                cost = ((cost[None] + self.rise).min(axis=1) if cost is not None else 0.0) - np.log(self.rate) + self.rate * gap
            last, n = t if last is None else max(last, t), n + 1
        self.held.update((n, last, None if cost is None else cost.tolist()))
        if self.idle_ms is not None:
            self.handle.registerTimer(last // 1000 + self.idle_ms)
        yield pd.DataFrame({self.key: [key[0]], "n": [n], "state": [int(np.argmin(cost)) if cost is not None else 0]})

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def running_bursts(events: DataFrame, key: str, time_us: str, base_rate: float, s: float = 2.0, gamma: float = 1.0, states: int = 10, time: str | None = None, idle: str | None = None, watermark: str = WATERMARK) -> DataFrame:
    """(key, n, state): the automaton's cheapest state given the events so far, after each batch.

    Later events can't change what was emitted, so this is the forward pass alone; an event older than the last one counts as a gap of 0.
    With `idle` (an interval such as '1 hour') and `time`, a timestamp, a key's state goes when the watermark has passed its last event by so much, and the
    key begins anew if it comes again; without, state is kept for good. Run it within `keyed_state`.
    """
    rate = base_rate * s ** np.arange(states)
    held = events.withWatermark(time, watermark) if idle else events
    kind = events.schema[key].dataType.simpleString()
    worker = BurstStates(key, time_us, rate, gamma, int(pd.Timedelta(idle).total_seconds() * 1000) if idle else None)
    return held.groupBy(key).transformWithStateInPandas(worker, f"{key} {kind}, n long, state int", "update", "eventTime" if idle else "none")


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams that are started within keep their state in RocksDB, which state with timers needs; the session's setting comes back."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def sliding(events: DataFrame, time: str, by: list[str], size: str = "1 hour", step: str = "15 minutes", watermark: str = WATERMARK) -> DataFrame:
    """Counts per window of event time, a new one every step."""
    return events.withWatermark(time, watermark).groupBy(F.window(time, size, step), *by).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), *by, "n")


def split_late(stream: DataFrame, time: str, lateness: str, path: str, checkpoint: str) -> StreamingQuery:
    """Rows older than the newest of the batches before by more than `lateness` go to path/late, all others to path/rows, all that is there now.

    A batch's bound comes from the batches before it, and its files have its number, so one that runs again writes the same again.
    """
    spark, late_by = stream.sparkSession, F.expr(f"INTERVAL {lateness}")

    def write(df: DataFrame, n: int) -> None:
        bounds = f"{path}/bounds"
        held = spark.read.schema("newest timestamp, _n long").parquet(bounds).where(F.col("_n") < n).agg(F.max("newest")).first()[0] if exists(spark, bounds) else None
        late = F.coalesce(F.col(time) < F.lit(held) - late_by, F.lit(False)) if held is not None else F.lit(False)
        df.where(late).write.mode("overwrite").parquet(f"{path}/late/_n={n}")
        df.where(~late).write.mode("overwrite").parquet(f"{path}/rows/_n={n}")
        df.agg(F.max(time).alias("newest")).write.mode("overwrite").parquet(f"{bounds}/_n={n}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def to_batches(stream: DataFrame, path: str, checkpoint: str, prefix: str, time: str, keys: list[str] | None = None) -> StreamingQuery:
    """Append to Parquet by hourly batch name, all that is there now; repeats within a trigger go."""

    def write(df: DataFrame, _: int) -> None:
        df = df.dropDuplicates(keys) if keys else df
        df.withColumn("_batch", F.concat(F.lit(prefix), F.date_format(time, "yyyyMMdd-HH"))).repartition("_batch").write.mode("append").partitionBy("_batch").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def collect_stream(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there now and return its rows from a Parquet table; for update or complete mode the last ones written."""
    spark = stream.sparkSession
    if mode == "append":
        stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start(path).awaitTermination()
        return spark.read.schema(stream.schema).parquet(path)

    def write(df: DataFrame, n: int) -> None:
        df.withColumn("_n", F.lit(n)).write.mode("append").parquet(path)

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path)
