"""The partitioned reader of live events: pages, equal times, rewinds, rotation and restarts."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import live


class Server:
    """Events in time order, at most `most` of them a page; endpoints that are down raise."""

    def __init__(self, events, down=()):
        self.events, self.down, self.asked = events, down, []

    def __call__(self, endpoint, collection, since, until, most):
        self.asked.append((endpoint, collection, since, most))
        if endpoint in self.down:
            raise OSError(endpoint)
        return [e for e in self.events if e["kind"] == collection and (e["time_us"] is None or e["time_us"] >= since)][:most]


def read_all(reader, start, end):
    spans = reader.partitions({"time_us": start}, {"time_us": end})
    return [json.loads(v) for s in spans for (v,) in reader.read(s)]


def reader_of(server, head, **more):
    return live.EventReader(server, lambda: head, ("a", "b"), ("x", "y"), 0, **more)


@pytest.mark.parametrize("most", [1, 3, 10, 1000])
@pytest.mark.parametrize("parts", [1, 4])
def test_more_equal_times_than_a_page_has_room(most, parts):
    rng = random.Random(most)
    events = sorted(({"time_us": rng.choice([5, 5, 5, 7, 9, 20, 21]), "kind": rng.choice("xy"), "n": i} for i in range(200)), key=lambda e: e["time_us"])
    reader = reader_of(Server(events), 22, most=most, seconds=1e-6, parts=parts)
    got = read_all(reader, 0, 10) + read_all(reader, 10, 21) + read_all(reader, 21, 22)
    assert sorted(e["n"] for e in got) == list(range(200))
    assert read_all(reader, 22, 22) == [] and reader.latestOffset() == {"time_us": 22}


def test_a_rewind_brings_events_again_and_loses_none():
    events = [{"time_us": 1000 * i, "kind": "x", "n": i} for i in range(50)]
    reader = reader_of(Server(events), 50_000, rewind=0.003, most=4)
    first, second = read_all(reader, 0, 25_000), read_all(reader, 25_000, 50_000)
    assert [e["n"] for e in first] == list(range(25)) and [e["n"] for e in second] == list(range(22, 50))


def test_endpoints_rotate_and_events_without_time_keep_their_place(monkeypatch):
    slept = []
    monkeypatch.setattr(live.time, "sleep", slept.append)
    events = [{"time_us": 1, "kind": "x"}, {"time_us": None, "kind": "x"}, {"time_us": 4, "kind": "x"}, {"time_us": 9, "kind": "x"}]
    server = Server(events, down=("a",))
    assert read_all(reader_of(server, 9, most=2), 0, 9) == events[:3]
    assert {e for e, *_ in server.asked} == {"a", "b"} and slept
    with pytest.raises(OSError):
        read_all(reader_of(Server(events, down=("a", "b")), 9, tries=2), 0, 9)
    assert live.waits(10, draw=lambda: 0) == 30 and live.waits(0, draw=lambda: 1) == pytest.approx(1.2)


def test_a_batch_is_read_again_as_it_was(spark, tmp_path):
    """A run that stopped before its batch was committed reads the same spans again; every event is in the table once."""
    rows = spark.range(900).select(F.col("id").alias("n"), F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("kind"), (F.col("id") % 7 + F.floor(F.col("id") / 100) * 100).alias("t"))
    log, out, state = f"file://{tmp_path}/log", f"{tmp_path}/out", f"{tmp_path}/state"
    live.write_log(rows, log, "kind", "t")

    def run(name, head):
        spark.dataSource.register(live.event_source(name, live.log_fetch, lambda: head, (log,), ("x", "y", "none")))
        stream = spark.readStream.format(name).option("max", 10).option("seconds", 0.0001).option("parts", 5).load()
        stream.select(F.get_json_object("value", "$.n").cast("long").alias("n")).writeStream.format("parquet").option("checkpointLocation", state).trigger(once=True).start(out).awaitTermination()

    run("again_0", 403)
    os.remove(f"{state}/commits/0")
    os.remove(f"{state}/commits/.0.crc")
    run("again_1", 700)
    run("again_2", 10_000)
    assert sorted(r.n for r in spark.read.schema("n long").parquet(out).collect()) == list(range(900))
