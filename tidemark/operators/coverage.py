"""How far annotation has come: labels, coverage and shares per batch and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def label_shares(df: DataFrame, by: str, label: str, wanted: str) -> DataFrame:
    """(by, total, hits, pct) with a TOTAL row for everything."""
    out = df.where(F.col(by).isNotNull()).rollup(by).agg(F.count("*").alias("total"), F.count_if(F.col(label) == wanted).alias("hits"))
    pct = F.when(F.col("total") > 0, 100.0 * F.col("hits") / F.col("total")).otherwise(0.0)
    return out.select(F.coalesce(by, F.lit("TOTAL")).alias(by), "total", "hits", F.round(pct, 4).alias("pct"))


def distribution(df: DataFrame, by: str, label: str) -> DataFrame:
    """(by, label, n, pct): each label's share of its group."""
    n = df.groupBy(by, label).agg(F.count("*").alias("n"))
    return n.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy(by)), 4))


def coverage_status(base: DataFrame, done: DataFrame, group: str, batch: str) -> DataFrame:
    """Per group: batches, annotated batches, rows, annotated rows, percentage and status."""
    b = base.groupBy(group).agg(F.countDistinct(batch).alias("batches"), F.count("*").alias("total"))
    d = done.groupBy(group).agg(F.countDistinct(batch).alias("done_batches"), F.count("*").alias("annotated"))
    out = b.join(d, group, "full_outer").fillna(0, ["batches", "total", "done_batches", "annotated"])
    pct = F.when(F.col("total") > 0, 100.0 * F.col("annotated") / F.col("total")).otherwise(0.0)
    part = F.concat(F.lit(" ("), F.col("done_batches").cast("string"), F.lit("/"), F.col("batches").cast("string"), F.lit(" batches)"))
    status = F.when(F.col("annotated") == 0, "not annotated").when(pct >= 99.9, "complete").when(pct > 50, F.concat(F.lit("partial"), part)).otherwise(F.concat(F.lit("sparse"), part))
    return out.select(group, "batches", "total", "annotated", F.round(pct, 4).alias("pct"), status.alias("status"))


def column_stats(df: DataFrame, day: str, columns: list[str], label: str) -> DataFrame:
    """Per day and column: non-null values, those equal to label, and their percentage."""
    long = df.where(F.col(day).isNotNull()).select(day, *columns).unpivot(day, columns, "column", "v")
    out = long.groupBy(day, "column").agg(F.count("v").alias("total_non_null"), F.count_if(F.col("v") == label).alias("label_count"))
    return out.withColumn("label_pct", F.round(F.when(F.col("total_non_null") > 0, 100.0 * F.col("label_count") / F.col("total_non_null")).otherwise(0.0), 4))


def merge_days(series: dict[str, DataFrame], day: str = "day", first: str | None = None, last: str | None = None) -> DataFrame:
    """Counts of several (day, n) series side by side over all days, 0 where one lacks a day; days may be limited, ends included."""
    out = None
    for name, df in series.items():
        df = df.select(day, F.col("n").alias(name))
        out = df if out is None else out.join(df, day, "full_outer")
    out = out.fillna(0, list(series))
    if first:
        out = out.where(F.col(day) >= first.replace("-", ""))
    return out.where(F.col(day) <= last.replace("-", "")) if last else out


def bracketed_sum(df: DataFrame, day: str, size: str) -> DataFrame:
    """(day, n): sums of sizes that are written as `[n]`."""
    return df.groupBy(day).agg(F.coalesce(F.sum(F.regexp_replace(size, r"^\[+|\]+$", "").cast("long")), F.lit(0)).alias("n"))
