"""URL filters against dated lists: a temporal as-of join.

A list is a table of dated events, each adding a domain to it or taking it off. The events of an entry become validity intervals, from
an addition to the next event; a capture is blocked if an entry for its host, or for a domain above it, was active when it was fetched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def host_of(url: Column) -> Column:
    """The lower-case host of an absolute URL, without a last dot; null if there is none."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.$", "")
    return F.when(host != "", host)


def validity(events: DataFrame) -> DataFrame:
    """(list, domain, valid_from, valid_to) from (list, domain, day, action): an entry holds from an `add` up to the next event.

    valid_to is null while nothing ends it. Of events of one entry and day the last by action name (`remove` after `add`) counts;
    an addition of an active entry starts a new interval at once, so nothing changes. Events with a null field count for nothing.
    """
    sound = events.where("list is not null and domain is not null and day is not null and action is not null")
    daily = sound.groupBy("list", F.lower("domain").alias("domain"), "day").agg(F.max("action").alias("action"))
    ends = F.lead("day").over(Window.partitionBy("list", "domain").orderBy("day"))
    return daily.withColumn("valid_to", ends).where("action = 'add'").select("list", "domain", F.col("day").alias("valid_from"), "valid_to")


def filter_urls(captures: DataFrame, events: DataFrame, id_col: str = "page_id", url_col: str = "url", day_col: str = "fetched") -> DataFrame:
    """(page_id, host, fetched, blocked, entry, n_lists) of every capture: the longest active entry and how many lists have one.

    Captures without a host or a fetch day are never blocked; repeated captures stay; empty lists block nothing. Verdicts are made
    once for each host and day, so a host with a large part of all captures is joined once; other columns are not read.
    """
    rows = captures.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), F.col(day_col).alias("fetched"))
    asked = rows.where("host is not null and fetched is not null").select("host", "fetched").distinct()
    parts = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    asked = asked.select("host", "fetched", F.explode(above).alias("domain"))
    active = asked.join(validity(events), "domain").where("valid_from <= fetched and (valid_to is null or fetched < valid_to)")
    longest = F.max(F.struct(F.length("domain").alias("n"), "domain"))["domain"]
    verdicts, _ = materialize(active.groupBy("host", "fetched").agg(longest.alias("entry"), F.countDistinct("list").alias("n_lists")), "verdicts")
    out = rows.join(verdicts, ["host", "fetched"], "left")
    return out.select("page_id", "host", "fetched", F.col("entry").isNotNull().alias("blocked"), "entry", F.coalesce("n_lists", F.lit(0)).cast("long").alias("n_lists"))
