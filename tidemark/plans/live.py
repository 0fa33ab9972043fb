"""Live sources with their transport replaced by rows of a table, bounded collection, and small readers."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidemark.functions.vectors import auto_clusters, auto_k, decode_vector, encode_vector, search_width
from tidemark.plans.tables import read
from tidemark.sources import files, live
from tidemark.storage import copy_missing, files_below, new_path
from tidemark.streaming import flows

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("SELECT event_id AS key, event_type AS kind, epoch_us(ts) AS time_us FROM events WHERE event_type IN ('click', 'view')")
def live_events(spark, d):
    """SRC-01/02, STM-01: an archive of the events is replayed by tasks for each collection and span of time, first its older half, then,
    after a stop, the rest; every event comes once, and the driver sees times alone."""
    at = new_path(spark, "live")
    events = read(spark, d, "events").select("event_id", F.col("event_type").alias("kind"), "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("time_us"))
    live.write_log(events, f"{at}/log", "event_type", "time_us")
    first, middle, last = events.agg(F.min("time_us"), F.percentile_approx("time_us", 0.5), F.max("time_us")).first()
    for turn, until in enumerate((middle, last + 1) if last else ()):
        name = f"tidemark_events_{turn}"
        spark.dataSource.register(live.event_source(name, live.log_fetch, lambda until=until: until, (f"{at}/log",), ("click", "view")))
        stream = spark.readStream.format(name).option("cursor", first).option("max", 5000).option("seconds", 86400).load()
        rows = stream.select(F.from_json("value", "event_id long, kind string, time_us long").alias("e")).select(F.col("e.event_id").alias("key"), "e.kind", "e.time_us")
        rows.writeStream.format("parquet").option("checkpointLocation", f"{at}/state").trigger(once=True).start(f"{at}/rows").awaitTermination()
    return spark.read.schema("key long, kind string, time_us long").parquet(f"{at}/rows") if last else spark.createDataFrame([], "key long, kind string, time_us long")


@query("SELECT CAST(n_nationkey AS BIGINT) AS key FROM nation ORDER BY 1 LIMIT 12")
def paged_feed(spark, d):
    """SRC-03: pages of four until ten items came, counted by page."""
    rows = sorted(r[0] for r in read(spark, d, "nation").select("n_nationkey").collect())

    def fetch(cursor: str | None, page: int) -> tuple[list[dict], str | None]:
        at = int(cursor or 0)
        return [{"key": k} for k in rows[at : at + page]], str(at + page) if at + page < len(rows) else None

    spark.dataSource.register(live.feed_source("tidemark_feed", fetch))
    found = spark.read.format("tidemark_feed").option("limit", 10).option("page", 4).load()
    return found.select(F.get_json_object("value", "$.key").cast("long").alias("key"))


@query("SELECT least(count(*), 500) AS n FROM events WHERE event_type IN ('click', 'view')")
def bounded_collection(spark, d):
    """SRC-06, STM-05: a stream is collected to JSON until 500 events came or what was there is read."""
    at = new_path(spark, "bounded")
    schema = read(spark, d, "events").schema
    rows = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*").where(F.col("event_type").isin("click", "view")).select("event_id", "event_type").limit(500)
    flows.collect_stream(rows, f"{at}/rows", f"{at}/state")
    files.write_json(spark.read.parquet(f"{at}/rows"), f"{at}/json", 100_000)
    return spark.read.text(f"{at}/json").agg(F.count("*").alias("n"))


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, substr(text, 1, 120) AS text, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents ORDER BY documents.doc_id LIMIT 5")
def described(spark, d):
    """SRC-12: first rows as text, cut to 120 characters; a look at a table."""
    return files.describe(read(spark, d, "documents").select("doc_id", "text", "source", "n_chars").orderBy("doc_id"))


@query("SELECT CAST(ceil(log2(count(*))) AS INT) AS k, CAST(least(count(*), greatest(2, floor(sqrt(count(*) / 2.0)))) AS INT) AS clusters, CAST(least(500, greatest(200, count(*) // 1000)) AS INT) AS width FROM embeddings")
def auto_parameters(spark, d):
    """MTH-03: k, number of clusters and search width by the number of rows."""
    n = read(spark, d, "embeddings").count()
    return spark.createDataFrame([(auto_k(n), auto_clusters(n), search_width(n))], "k int, clusters int, width int")


@query("SELECT vec_id, len(embedding) AS n, round(list_sum(list_transform(embedding, lambda x: x::FLOAT::DOUBLE)), 5) AS total FROM embeddings")
def stored_vectors(spark, d):
    """STR-13, FLT-08: vectors to base64 and back; rows without one are left out."""
    rows = read(spark, d, "embeddings").where("embedding is not null and size(embedding) > 0")
    back = rows.select("vec_id", encode_vector("embedding").alias("code")).select("vec_id", decode_vector("code").alias("v"))
    return back.select("vec_id", F.size("v").cast("long").alias("n"), F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x), 5).alias("total"))


@query("SELECT 'b' || k AS file FROM generate_series(0, 2) t(k)")
def copied_batches(spark, d):
    """SRC-19: batches are copied once; a second run finds them there."""
    root, target = new_path(spark, "datasets"), new_path(spark, "copy")
    files.write_batches(read(spark, d, "nation").select("n_nationkey", F.concat(F.lit("b"), (F.col("n_nationkey") % 3).cast("string")).alias("_batch")), root, "nations")
    first, second = copy_missing(spark, root, target), copy_missing(spark, root, target)
    if second or len(first) != 3:
        raise AssertionError(f"{first}, then {second}")
    return spark.createDataFrame([(f.split("/")[1],) for f in files_below(spark, target) if f.endswith("merged.parquet")], "file string")
