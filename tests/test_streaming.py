"""Keyed state with expiry, and late rows in a table of their own."""

import time

import numpy as np
from pyspark.sql import functions as F

from tidemark.streaming import flows

HOUR = 3600 * 1_000_000


def feed(spark, path, batches):
    """A stream of one file a trigger, in order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "k string, t long").coalesce(1).write.json(f"{path}/{i}")
        time.sleep(1.1)  # files are taken by age
    stream = spark.readStream.schema("k string, t long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").json(path)
    return stream.withColumn("ts", F.timestamp_micros("t"))


def test_idle_keys_lose_their_state(spark, tmp_path):
    batches = [[("a", 1 * HOUR), ("a", 1 * HOUR + 1_000_000), ("b", 1 * HOUR), ("c", 1 * HOUR)], [("c", 3 * HOUR)], [("c", 6 * HOUR)], [("a", 6 * HOUR), ("c", 6 * HOUR + 1_000_000)]]
    rows = flows.running_bursts(feed(spark, f"{tmp_path}/in", batches), "k", "t", 1.0, time="ts", idle="1 hour", watermark="1 minute")
    with flows.keyed_state(spark):
        query = rows.writeStream.foreachBatch(lambda df, n: df.withColumn("_n", F.lit(n)).write.mode("append").parquet(f"{tmp_path}/out")).option("checkpointLocation", f"{tmp_path}/state").outputMode("update").trigger(availableNow=True).start()
        query.awaitTermination()
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    held = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert held[0] == 3 and min(held) == 1
    got = sorted((r._n, r.k, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert [(k, n) for _, k, n in got if k == "a"] == [("a", 2), ("a", 1)]  # it began anew


def test_running_states_equal_the_forward_pass(spark, tmp_path):
    rng = np.random.default_rng(0)
    t = np.cumsum(rng.exponential(1e6, 60) * np.where(np.arange(60) % 20 < 6, 0.05, 1)).astype(int).tolist()
    stream = feed(spark, f"{tmp_path}/in", [[("a", x) for x in t[i : i + 20]] for i in (0, 20, 40)])
    with flows.keyed_state(spark):
        got = flows.collect_stream(flows.running_bursts(stream, "k", "t", 1.0), f"{tmp_path}/out", f"{tmp_path}/state", "update").orderBy("n").collect()
    rate, rise, cost, want = 2.0 ** np.arange(10), np.maximum(np.arange(10)[:, None] - np.arange(10)[None], 0), None, []
    for i in range(1, 60):
        gap = (t[i] - t[i - 1]) / 1e6
        cost = (0 if cost is None else (cost[None] + rise).min(axis=1)) - np.log(rate) + rate * gap
        if i % 20 == 19:
            want.append((i + 1, int(cost.argmin())))
    assert [(r.n, r.state) for r in got] == want


def test_late_rows_have_a_table_of_their_own(spark, tmp_path):
    batches = [[("a", 10 * HOUR), ("b", 1 * HOUR)], [("c", 9 * HOUR), ("d", 7 * HOUR), ("e", 12 * HOUR), (None, None)], [("f", 9 * HOUR), ("g", 11 * HOUR)]]
    flows.split_late(feed(spark, f"{tmp_path}/in", batches), "ts", "2 hours", f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    names = lambda kind: sorted(str(r.k) for r in spark.read.parquet(f"{tmp_path}/out/{kind}").collect())
    assert names("late") == ["d", "f"] and names("rows") == ["None", "a", "b", "c", "e", "g"]
