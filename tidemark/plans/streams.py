"""Streams over the given tables, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.tables import REACTIONS, read
from tidemark.storage import shared_dir
from tidemark.streaming import flows

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _folder(spark) -> str:
    import uuid

    return f"{shared_dir(spark)}/tidemark/stream-{uuid.uuid4().hex}"


def _stream(spark, d):
    schema = read(spark, d, "events").schema
    rows = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*")
    kind = F.when(F.col("event_type") == "click", "like").when(F.col("event_type") == "view", "repost")
    return rows.where(F.col("event_type").isin("click", "view")).select(F.get_json_object("props", "$.k").cast("long").alias("subject"), kind.alias("kind"), F.col("user_id").alias("actor"), F.col("ts").cast("timestamp").alias("ts"))


@query(f"WITH {REACTIONS} SELECT DISTINCT subject, kind, actor FROM reactions")
def stream_dedup(spark, d):
    """STM-02, AGG-11, SNK-01."""
    at = _folder(spark)
    rows = flows.deduplicate(_stream(spark, d), "ts", ["subject", "kind", "actor"], watermark=None)
    return flows.collect_stream(rows, f"{at}/rows", f"{at}/state").select("subject", "kind", "actor")


@query("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, CASE event_type WHEN 'click' THEN 'like' ELSE 'repost' END AS kind, count(*) AS n FROM events WHERE event_type IN ('click', 'view') GROUP BY 1, 2")
def stream_tumbling(spark, d):
    """STM-03/05: windows of an hour of event time."""
    at = _folder(spark)
    rows = flows.collect_stream(flows.tumbling(_stream(spark, d), "ts", ["kind"]), f"{at}/rows", f"{at}/state", "complete")
    last = rows.where(F.col("_n") == rows.agg(F.max("_n")).first()[0])
    return last.select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "kind", "n")


@query("""WITH r AS (SELECT user_id AS actor, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WHERE event_type IN ('click', 'view') WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT actor, ts, sum(new) OVER (PARTITION BY actor ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM r), g AS (SELECT actor, k, min(ts) AS t, count(*) AS n FROM s GROUP BY 1, 2) SELECT actor, strftime(t, '%Y-%m-%d %H:%M:%S') AS start, n FROM g""")
def stream_session(spark, d):
    """STM-08: sessions with a gap of 30 minutes."""
    at = _folder(spark)
    rows = flows.collect_stream(flows.sessions(_stream(spark, d), "ts", "actor"), f"{at}/rows", f"{at}/state", "complete")
    last = rows.where(F.col("_n") == rows.agg(F.max("_n")).first()[0])
    return last.select("actor", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("SELECT 'stream-' || strftime(ts, '%Y%m%d-%H') AS batch, count(*) AS n FROM events WHERE event_type IN ('click', 'view') GROUP BY 1")
def stream_batches(spark, d):
    """SNK-01/02, STM-07, DAT-01: hourly batches by foreachBatch."""
    at = _folder(spark)
    flows.to_batches(_stream(spark, d), f"{at}/rows", f"{at}/state", "stream-", "ts").awaitTermination()
    return spark.read.parquet(f"{at}/rows").groupBy(F.col("_batch").alias("batch")).agg(F.count("*").alias("n"))


@query(f"""WITH RECURSIVE {REACTIONS}, g AS (SELECT subject, time_us, row_number() OVER w AS pos, greatest((time_us - lag(time_us) OVER w) / 1e6, 0.0) AS gap FROM reactions WINDOW w AS (PARTITION BY subject ORDER BY time_us)),
s AS (SELECT subject, count(*) AS n, coalesce(list(gap ORDER BY pos) FILTER (pos > 1), []) AS gaps FROM g GROUP BY 1),
v AS (SELECT subject, gaps, 1 AS i, list_transform(range(0, 10), lambda q: -ln(pow(2, q) / 60000) + pow(2, q) / 60000 * gaps[1]) AS cost FROM s WHERE len(gaps) > 0
  UNION ALL SELECT subject, gaps, i + 1, list_transform(range(0, 10), lambda q: list_min(list_transform(range(0, 10), lambda p: cost[p + 1] + greatest(q - p, 0))) - ln(pow(2, q) / 60000) + pow(2, q) / 60000 * gaps[i + 1]) FROM v WHERE i < len(gaps))
SELECT s.subject, s.n, CAST(coalesce(list_position(cost, list_min(cost)) - 1, 0) AS INT) AS state FROM s LEFT JOIN v ON v.subject IS NOT DISTINCT FROM s.subject AND i = len(s.gaps)""")
def stream_bursts(spark, d):
    """STM-08, WIN-02: running burst states, one row per subject and batch."""
    at = _folder(spark)
    events = _stream(spark, d).select("subject", F.unix_micros("ts").alias("time_us"))
    with flows.keyed_state(spark):
        return flows.collect_stream(flows.running_bursts(events, "subject", "time_us", 1 / 60000), f"{at}/rows", f"{at}/state", "update").select("subject", "n", "state")


@query("""SELECT strftime(w, '%Y-%m-%d %H:%M') AS start, CASE event_type WHEN 'click' THEN 'like' ELSE 'repost' END AS kind, count(*) AS n
FROM (SELECT event_type, unnest([time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR * k FOR k IN range(0, 4)]) AS w FROM events WHERE event_type IN ('click', 'view')) GROUP BY 1, 2""")
def stream_sliding(spark, d):
    """STM-08: windows of a day, a new one every six hours."""
    at = _folder(spark)
    rows = flows.collect_stream(flows.sliding(_stream(spark, d), "ts", ["kind"], "24 hours", "6 hours"), f"{at}/rows", f"{at}/state", "complete")
    last = rows.where(F.col("_n") == rows.agg(F.max("_n")).first()[0])
    return last.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "kind", "n")
