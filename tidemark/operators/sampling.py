"""Deterministic samples, balancing and splits by digest order."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def digest(c: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), c.cast("string")).cast("binary"))


def sample_n(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows without replacement, in digest order: a top-n, so no more than n rows of each partition move."""
    return df.withColumn("_d", digest(F.col(key), seed)).orderBy("_d", key).limit(n).drop("_d")


def ranked(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    """df with `_r`, each row's place from 0 among its label's rows in digest order, and `_n`, how many those are.

    Places are counted within slices of the digests' range and moved on by the sizes of the slices before, so that no task holds a label.
    """
    d = digest(F.col(key), seed)
    rows = df.withColumns({"_d": d, "_s": F.substring(d, 1, 3)})
    sizes = rows.groupBy(F.col(label).alias("_l"), F.col("_s").alias("_t")).agg(F.count("*").alias("_c"))
    w = Window.partitionBy("_l")
    sizes = sizes.select("_l", "_t", F.coalesce(F.sum("_c").over(w.orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"), F.sum("_c").over(w).alias("_n"))
    found = rows.join(sizes, rows[label].eqNullSafe(sizes["_l"]) & (rows["_s"] == sizes["_t"]))
    place = F.row_number().over(Window.partitionBy(label, "_s").orderBy("_d", key)) - 1
    return found.withColumn("_r", F.col("_b") + place).drop("_d", "_s", "_t", "_l", "_b")


def balance(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    """As many rows of each label as the rarest has."""
    least = df.groupBy(label).agg(F.count("*").alias("n")).agg(F.min("n").alias("_least"))
    return ranked(df, key, label, seed).crossJoin(F.broadcast(least)).where("_r < _least").drop("_r", "_n", "_least")  # one row


def split(df: DataFrame, key: str, label: str, seed: int, train: float = 0.8, val: float = 0.1) -> DataFrame:
    """df with a `split` column, the same shares of every label."""
    place = F.col("_r") / F.col("_n")
    return ranked(df, key, label, seed).withColumn("split", F.when(place < train, "train").when(place < train + val, "val").otherwise("test")).drop("_r", "_n")


def allocate(sizes: list[int], n: int) -> list[int]:
    """How many of n each bin gives: what its share of n rounds to, one at least, as far as n goes in the order of bins; what is left
    comes from the fullest bins. All if there are no more than n."""
    size = np.asarray(sizes, np.int64)
    if size.sum() <= n:
        return size.tolist()
    wished = np.where(size > 0, np.clip(np.rint(n * size / size.sum()), 1, size), 0).astype(np.int64)
    given = np.diff(np.minimum(np.cumsum(wished), n), prepend=0)
    fullest = np.argsort(-size, kind="stable")
    given[fullest] += np.diff(np.minimum(np.cumsum((size - given)[fullest]), n - given.sum()), prepend=0)
    return given.tolist()


def sample_clusters(clusters: DataFrame, key: str, texts: str, n: int, least: int, seed: int = 42, most_texts: int = 32) -> DataFrame:
    """n clusters over three bins of size (up to least + 2, below 10, the rest), texts cut to most_texts; all if there are no more."""
    full = clusters.withColumn(texts, F.filter(texts, lambda t: F.length(F.trim(t)) > 0)).where(F.size(texts) > 0)
    bin_ = F.when(F.size(texts) <= least + 2, 0).when(F.size(texts) < 10, 1).otherwise(2)
    found = {r[0]: r[1] for r in full.groupBy(bin_.alias("bin")).count().collect()}
    sizes = [found.get(i, 0) for i in range(3)]
    take = allocate(sizes, n)
    rank = F.row_number().over(Window.partitionBy("bin").orderBy(digest(F.col(key), seed), key))
    wanted = F.element_at(F.array(*[F.lit(x) for x in take]), F.col("bin") + 1)
    return full.withColumn("bin", bin_).withColumn("_r", rank).where(F.col("_r") <= wanted).withColumn(texts, F.slice(texts, 1, most_texts)).drop("bin", "_r")


def boundary(df: DataFrame, key: str, value: str, threshold: float, n: int, margin: float = 0.05, seed: int = 18) -> DataFrame:
    """n rows near a threshold, half below and half from it up; a side with too few is filled from the other."""
    near = df.where(F.abs(F.col(value) - threshold) <= margin).withColumn("_below", F.col(value) < threshold)
    rank = F.row_number().over(Window.partitionBy("_below").orderBy(digest(F.col(key), seed), key))
    below = near.where("_below").count()
    above = near.where("not _below").count()
    low = min(below, n - min(above, n - n // 2))
    high = min(above, n - low)
    return near.withColumn("_r", rank).where(F.col("_r") <= F.when(F.col("_below"), low).otherwise(high)).drop("_r", "_below")


def first_days(df: DataFrame, day: str, n: int) -> DataFrame:
    """Rows of the first n days that have any: the days are a top-n of the distinct ones."""
    return df.join(df.select(day).distinct().orderBy(day).limit(n), day, "left_semi")


def union_days(days: dict[str, DataFrame]) -> DataFrame:
    """The rows of several days under one another, with their `day`."""
    out = None
    for name, rows in days.items():
        rows = rows.withColumn("day", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
