"""Reactions and bursts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.stats import upper_median
from tidemark.operators import bursts
from tidemark.plans.tables import REACTIONS, reactions

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


#: The automaton in SQL: costs of all states as a list, back-pointers as a list of lists.
VITERBI = f"""{REACTIONS}, g AS (SELECT subject, time_us, row_number() OVER w AS pos, CASE WHEN lag(time_us) OVER w IS NOT NULL THEN greatest((time_us - lag(time_us) OVER w) / 1e6, 0.0) END AS gap FROM reactions WINDOW w AS (PARTITION BY subject ORDER BY time_us)),
s AS (SELECT subject, count(*) AS n, list(gap ORDER BY pos) FILTER (gap IS NOT NULL) AS gaps FROM g GROUP BY 1 HAVING count(*) >= 3),
r AS (SELECT subject, n, gaps, CASE WHEN list_sum(gaps) > 0 THEN len(gaps) / list_sum(gaps) ELSE 1.0 END AS rate FROM s),
v AS (
  SELECT subject, n, gaps, rate, 1 AS i, list_transform(range(0, 10), lambda q: -ln(rate * pow(2, q)) + rate * pow(2, q) * gaps[1]) AS cost, [] :: BIGINT[][] AS back FROM r
  UNION ALL
  SELECT subject, n, gaps, rate, i + 1, list_transform(range(0, 10), lambda q: list_min(list_transform(range(0, 10), lambda p: cost[p + 1] + greatest(q - p, 0))) - ln(rate * pow(2, q)) + rate * pow(2, q) * gaps[i + 1]),
    list_append(back, list_transform(range(0, 10), lambda q: list_position(list_transform(range(0, 10), lambda p: cost[p + 1] + greatest(q - p, 0)), list_min(list_transform(range(0, 10), lambda p: cost[p + 1] + greatest(q - p, 0)))) - 1))
  FROM v WHERE i < len(gaps)),
e AS (SELECT subject, n, gaps, back, len(gaps) AS i, list_position(cost, list_min(cost)) - 1 AS state FROM v WHERE i = len(gaps)),
p AS (SELECT * FROM e UNION ALL SELECT subject, n, gaps, back, i - 1, back[i - 1][state + 1] FROM p WHERE i > 1),
states AS (SELECT subject, n, i - 1 AS pos, gaps[i] AS gap, state FROM p)"""
SEGMENTS = f"""{VITERBI}, isl AS (SELECT *, count(*) FILTER (state = 0) OVER (PARTITION BY subject ORDER BY pos) AS island FROM states),
seg AS (SELECT subject, min(pos) AS "start", max(pos) AS "end", max(state) AS max_state, sum(gap) AS duration FROM isl WHERE state >= 1 GROUP BY subject, island)"""


@query(f"WITH {REACTIONS} SELECT DISTINCT subject, kind, actor FROM reactions")
def reaction_dedup(spark, d):
    """AGG-11."""
    return reactions(spark, d).select("subject", "kind", "actor").dropDuplicates()


@query(f"WITH {REACTIONS} SELECT subject, count(*) AS num_reactions, count(*) FILTER (kind = 'like') AS num_likes, count(*) FILTER (kind = 'repost') AS num_reposts FROM reactions GROUP BY 1 HAVING count(*) >= 3")
def reaction_counts(spark, d):
    """AGG-28, FLT-09."""
    g = reactions(spark, d).groupBy("subject").agg(F.count("*").alias("num_reactions"), F.count_if(F.col("kind") == "like").alias("num_likes"), F.count_if(F.col("kind") == "repost").alias("num_reposts"))
    return g.where("num_reactions >= 3")


@query(f"WITH {REACTIONS} SELECT subject, time_us, row_number() OVER w AS pos, round(CASE WHEN lag(time_us) OVER w IS NOT NULL THEN greatest((time_us - lag(time_us) OVER w) / 1e6, 0.0) END, 6) AS gap FROM reactions WINDOW w AS (PARTITION BY subject ORDER BY time_us)")
def interarrival_gaps(spark, d):
    """WIN-01, DAT-04."""
    g = bursts.interarrival(reactions(spark, d), "subject", "time_us")
    return g.select("subject", "time_us", F.col("pos").cast("long"), F.round("gap", 6).alias("gap"))


def _states(spark, d):
    return bursts.burst_states(reactions(spark, d), "subject", "time_us")


@query(f"WITH RECURSIVE {VITERBI} SELECT subject, pos, CAST(state AS INT) AS state FROM states")
def burst_states(spark, d):
    """WIN-02."""
    return _states(spark, d).select("subject", "at", F.posexplode("states").alias("pos", "state")).select("subject", (F.col("at") + F.col("pos")).alias("pos"), "state")


@query(f'WITH RECURSIVE {SEGMENTS} SELECT subject, "start", "end", CAST(max_state AS INT) AS max_state, round(duration, 3) AS duration, round(max_state * duration, 3) AS energy FROM seg')
def burst_segments(spark, d):
    """WIN-03."""
    s = bursts.burst_segments(_states(spark, d), "subject")
    return s.select("subject", F.col("start").cast("long"), F.col("end").cast("long"), "max_state", F.round("duration", 3).alias("duration"), F.round("energy", 3).alias("energy"))


METRICS = f"""{SEGMENTS}, m AS (SELECT subject, max(max_state) AS m, sum(max_state * duration) AS e, sum(max_state) AS w, count(*) AS c FROM seg GROUP BY 1),
metrics AS (SELECT r.subject, n AS num_reactions, round(coalesce(m, 0)) :: BIGINT AS max_burst_weight, round(coalesce(e, 0.0), 3) AS total_burst_energy, coalesce(w, 0) :: BIGINT AS weighted_burst_count, coalesce(c, 0) AS num_bursts, round(list_sum(gaps), 3) AS time_span_s, round(rate, 9) AS base_rate FROM r LEFT JOIN m ON m.subject = r.subject)"""


def _metrics(spark, d):
    m = bursts.burst_metrics(_states(spark, d), "subject")
    return m.select("subject", "num_reactions", "max_burst_weight", F.round("total_burst_energy", 3).alias("total_burst_energy"), "weighted_burst_count", "num_bursts", F.round("time_span_s", 3).alias("time_span_s"), F.round("base_rate", 9).alias("base_rate"))


@query(f"WITH RECURSIVE {METRICS} SELECT * FROM metrics")
def burst_metrics(spark, d):
    """WIN-04."""
    return _metrics(spark, d)


@query(f"WITH RECURSIVE {METRICS} SELECT subject, total_burst_energy, row_number() OVER (ORDER BY total_burst_energy DESC, subject) AS place FROM metrics ORDER BY place LIMIT 10")
def burst_topn(spark, d):
    """WIN-05: a report of the ten strongest."""
    top = _metrics(spark, d).select("subject", "total_burst_energy").orderBy(F.desc("total_burst_energy"), "subject").limit(10)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("total_burst_energy"), "subject")).cast("long"))


@query(f"WITH RECURSIVE {METRICS} SELECT max_burst_weight, count(*) AS n, count(*) FILTER (num_bursts > 0) AS bursty FROM metrics GROUP BY 1")
def burst_level_hist(spark, d):
    """AGG-30."""
    return _metrics(spark, d).groupBy("max_burst_weight").agg(F.count("*").alias("n"), F.count_if(F.col("num_bursts") > 0).alias("bursty"))


@query(f"WITH {REACTIONS}, c AS (SELECT kind, subject, count(*) AS n FROM reactions GROUP BY 1, 2) SELECT kind, min(n) AS least, (list(n ORDER BY n))[count(*) // 2 + 1] AS mid, max(n) AS most, round(avg(n), 6) AS mean FROM c GROUP BY 1")
def stat_row_upper_median(spark, d):
    """AGG-29."""
    c = reactions(spark, d).groupBy("kind", "subject").agg(F.count("*").alias("n"))
    return c.groupBy("kind").agg(F.min("n").alias("least"), upper_median("n").alias("mid"), F.max("n").alias("most"), F.round(F.avg("n"), 6).alias("mean"))
