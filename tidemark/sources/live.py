"""Live sources as Python data sources: a replayable event stream and a paged feed.

`fetch` makes both testable without a network: it is any picklable callable that returns events, or a page and the next cursor.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

ENDPOINTS = tuple(f"wss://jetstream{i}.{r}.bsky.network/subscribe" for r in ("us-east", "us-west") for i in (1, 2))


def waits(attempt: int, least: float = 1.0, most: float = 30.0, jitter: float = 0.2, draw: Callable[[], float] = random.random) -> float:
    """Seconds before a try: doubling, bounded, with a random part of up to `jitter` of it."""
    return min(most, least * 2**attempt) * (1 + jitter * draw())


@dataclass
class Span(InputPartition):
    """Events of one collection from `since` up to, but not at, `until`; asked of the endpoint `first` before others."""

    collection: str
    since: int
    until: int
    first: int


#: fetch(endpoint, collection, since, until, most): up to about `most` events from `since` on in the server's order; those at or after `until` may be left out.
Fetch = Callable[[str, str, int, int, int], list[dict]]


class EventReader(DataSourceStreamReader):
    """Offsets are times before which all has been read, so equal times are never parted and a batch can be read again as it was.

    A batch's range is cut into spans by collection and time, each read by a task of its own; the driver sees times alone. `head` gives the time
    before which the server's events are complete. With a rewind every batch begins that many seconds before the last one's end, for
    servers that may still add to the past: then events come at least once.
    """

    def __init__(self, fetch: Fetch, head: Callable[[], int], endpoints: tuple[str, ...], collections: tuple[str, ...], start: int, rewind: float = 0.0, most: int = 10_000, seconds: float = 60.0, parts: int = 64, tries: int = 8) -> None:
        self.fetch, self.head, self.endpoints, self.collections, self.start, self.rewind, self.most, self.seconds, self.parts, self.tries = fetch, head, endpoints, collections, start, rewind, most, seconds, parts, tries

    def initialOffset(self) -> dict:
        return {"time_us": self.start}

    def latestOffset(self) -> dict:
        return {"time_us": max(self.start, int(self.head()))}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        if end["time_us"] <= start["time_us"]:
            return []
        since, until = max(0, int(start["time_us"] - self.rewind * 1e6)), end["time_us"]
        n = max(1, min(self.parts, -(-(until - since) // int(self.seconds * 1e6))))
        edges = [since + (until - since) * i // n for i in range(n + 1)]
        return [Span(c, a, b, i + j) for i, c in enumerate(self.collections) for j, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]

    def _page(self, span: Span, since: int, most: int) -> list[dict]:
        for attempt in range(self.tries):
            try:
                return self.fetch(self.endpoints[(span.first + attempt) % len(self.endpoints)], span.collection, since, span.until, most)
            except OSError:
                if attempt + 1 == self.tries:
                    raise
                time.sleep(waits(attempt))
        return []

    def read(self, partition: Span) -> Iterator[tuple]:
        """Pages from the last time seen, without the events of that time that came before; a page that is full of them alone is asked
        again with twice the room. The span ends with an event at its end or after it, or with a page that has room and nothing new."""
        at, seen, most = partition.since, 0, self.most
        while True:
            events, now, skip, new = self._page(partition, at, most), at, seen, 0
            for e in events:
                t = e.get("time_us")
                now = max(now, now if t is None else t)  # an event without a time stands at that of the one before
                if now >= partition.until:
                    return
                if now == at and skip:
                    skip -= 1
                    continue
                if t is not None and t < partition.since:
                    continue
                seen = seen + 1 if now == at else 1
                at, new = now, new + 1
                yield (json.dumps(e),)
            if not new:
                if len(events) < most:
                    return
                most *= 2


def clock(lag: float = 5.0) -> Callable[[], int]:
    """A head for servers that keep time: what is older than `lag` seconds is complete."""
    return lambda: int((time.time() - lag) * 1e6)


def event_source(name: str, fetch: Fetch, head: Callable[[], int], endpoints: tuple[str, ...] = ENDPOINTS, collections: tuple[str, ...] = ("",)) -> type[DataSource]:
    """A data source class for spark.dataSource.register: rows of one column `value` with an event as JSON.

    Options: `cursor` is the first time (microseconds), `rewind` seconds that batches overlap, `max` events of a page, `seconds` of a span and
    `parts`, the most spans of a collection in a batch.
    """

    class Events(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "value string"

        def streamReader(self, schema) -> EventReader:
            get = self.options.get
            return EventReader(fetch, head, endpoints, collections, int(get("cursor", 0)), float(get("rewind", 0)), int(get("max", 10_000)), float(get("seconds", 60)), int(get("parts", 64)))

    return Events


def log_fetch(endpoint: str, collection: str, since: int, until: int, most: int) -> list[dict]:
    """A Fetch over an event log in files, as write_log leaves it, at any file system that Arrow knows by its URI."""
    filesystem, path = fs.FileSystem.from_uri(endpoint)
    folder = f"{path}/collection={collection}"
    if filesystem.get_file_info(folder).type == fs.FileType.NotFound:
        return []
    wanted = (ds.field("time_us") >= since) & (ds.field("time_us") < until)
    found = ds.dataset(folder, filesystem=filesystem, format="parquet").to_table(columns=["time_us", "value"], filter=wanted)
    return [json.loads(v) for v in found.sort_by([("time_us", "ascending"), ("value", "ascending")]).column("value")[:most].to_pylist()]


def write_log(events: DataFrame, path: str, collection: str, time_us: str) -> None:
    """Events as an archive to be replayed: a folder for each collection, files sorted by time whose statistics let a span's reader skip others."""
    body = F.to_json(F.struct(*[F.col(c) for c in events.columns if c not in (collection, time_us)], F.col(time_us).alias("time_us")))
    rows = events.select(F.col(collection).alias("collection"), F.col(time_us).alias("time_us"), body.alias("value"))
    rows.repartitionByRange("collection", "time_us").sortWithinPartitions("collection", "time_us", "value").write.partitionBy("collection").parquet(path)


def feed_source(name: str, fetch: Callable[[str | None, int], tuple[list[dict], str | None]]) -> type[DataSource]:
    """A paged feed: pages are read until the limit is reached, counted by page, or no cursor follows."""

    class Feed(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "value string"

        def reader(self, schema) -> DataSourceReader:
            limit, page = int(self.options.get("limit", 100)), int(self.options.get("page", 50))

            class Reader(DataSourceReader):
                def read(self, partition) -> Iterator[tuple]:
                    cursor, count = None, 0
                    while True:
                        items, cursor = fetch(cursor, page)
                        for item in items:
                            yield (json.dumps(item),)
                        count += len(items)
                        if count >= limit or not cursor or not items:
                            return

            return Reader()

    return Feed
