"""Grids of clustering parameters over one neighbour table, with judged samples, and the clusters of each day."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.vectors import auto_k, centroids, kept_neighbours, summed_centroids
from tidemark.operators import clustering, models, neighbours
from tidemark.operators.components import connected_components
from tidemark.operators.sampling import allocate
from tidemark.storage import cut, shared_dir

MOST_TEXTS, MOST_JOBS = 32, 8
COMBO = ("drop_frac", "min_size", "threshold")


def cluster_counts(vectors: DataFrame, ks: tuple[int, ...], drops: tuple[float, ...]) -> DataFrame:
    """(k, drop_frac, n): clusters of every combination; those that keep as many neighbours share one graph."""
    kept = {(k, f): kept_neighbours(k, f) for k, f in itertools.product(ks, drops)}
    near, _ = cut(neighbours.nearest(vectors, max(kept.values())), "near")
    rows, joined = vectors.agg(F.count_distinct("id")).first()[0], {}
    for m in set(kept.values()):  # a component has one node that is not joined to a smaller one
        found = connected_components(neighbours.symmetric(near.where(F.col("rank") <= m)), one_task=neighbours.ONE_TASK_EDGES)
        joined[m] = found.where("node <> component").count()
    return vectors.sparkSession.createDataFrame([(k, f, rows - joined[m]) for (k, f), m in kept.items()], "k int, drop_frac double, n long")


def relabels(parts: DataFrame, sizes: tuple[int, ...], thresholds: tuple[float, ...]) -> DataFrame:
    """What merge_small makes of the clusters of (drop_frac, id, cluster, v) for every size and threshold: (*COMBO, cluster, new), without those
    that go. Rows and their vectors are read once, for the centroids, which meet in blocks."""
    c, _ = cut(summed_centroids(parts, ["drop_frac", "cluster"], "v").withColumnRenamed("centroid", "v"), "means")
    c = c.withColumn("min_size", F.explode(F.array(*map(F.lit, sizes)))).withColumn("grp", F.concat_ws("|", "drop_frac", "min_size"))
    c = c.join(c.groupBy("grp").agg(F.max(F.col("size") >= F.col("min_size")).alias("any_large")), "grp").withColumn("small", F.col("size") < F.col("min_size"))
    c, _ = cut(c.orderBy("grp", "cluster").withColumn("id", F.monotonically_increasing_id()), "centroids")  # ids in the order of clusters, for ties
    alone, merging = c.where("not any_large"), c.where("any_large")
    best = neighbours.meet(merging.where("small"), merging.where("not small"), 1, by="grp").unionByName(neighbours.meet(alone, alone, 1, by="grp"))
    best = best.select(F.col("src").alias("id"), F.round("sim", 9).alias("max_sim"), F.col("dst"))
    target = c.select(F.col("id").alias("dst"), F.col("cluster").alias("nearest"))
    found = c.select("drop_frac", "min_size", "cluster", "id", "small", "any_large").join(best, "id", "left").join(target, "dst", "left")
    every = found.withColumn("threshold", F.explode(F.array(*map(F.lit, thresholds))))
    stays = ~F.col("small") | (F.col("threshold") <= 0) | F.coalesce(F.col("max_sim") >= F.col("threshold"), F.lit(False))
    new = F.when(F.col("small") & F.col("any_large"), F.col("nearest")).otherwise(F.col("cluster"))
    return every.where(stays).select(*COMBO, "cluster", new.alias("new"))


def merged_grid(parts: DataFrame, sizes: tuple[int, ...], thresholds: tuple[float, ...]) -> DataFrame:
    """(*COMBO, id, cluster): the rows of parts as merge_small names them for every size and threshold."""
    return parts.select("drop_frac", "id", "cluster").join(relabels(parts, sizes, thresholds), ["drop_frac", "cluster"]).select(*COMBO, "id", F.col("new").alias("cluster"))


def judged_sweep(rows: DataFrame, drops: tuple[float, ...], sizes: tuple[int, ...], thresholds: tuple[float, ...], max_size: int = 50, scale: float = 0.5, sample: int = 20, judge: Callable[[list], list] = models.coherent, seed: int = 42) -> DataFrame:
    """One row for each drop_frac, min_size and threshold over the (id, text, v) of a day, with the verdicts on a sample of its clusters.

    Clusters without text aren't judged. The sample is dealt to three bins of size in proportion, and a verdict sees 32 rows. near_10
    is the place, up to 5, among combinations of 5 to 20 clusters by coherence_rate.
    """
    spark = rows.sparkSession
    rows, _ = cut(rows.select("id", "v", F.coalesce(F.trim("text") != "", F.lit(False)).alias("says")), "rows")  # texts are read once
    n = rows.count()
    k = auto_k(n)
    near, _ = cut(neighbours.nearest(rows, max(1, *(kept_neighbours(k, f) for f in drops))), "near")

    def graph(m: int) -> DataFrame:
        return cut(rows.select("id", "v").join(neighbours.with_components(rows, neighbours.symmetric(near.where(F.col("rank") <= m))), "id"), "graph")[0]

    def split(f: float) -> DataFrame:
        return clustering.split_large(graphs[kept_neighbours(k, f)], max_size, k, f, scale, near).select(F.lit(f).alias("drop_frac"), "id", "cluster", "v")

    with ThreadPoolExecutor(MOST_JOBS) as pool:  # jobs of one share leave most tasks' places free; shares that keep as many neighbours have one graph
        kept = sorted({kept_neighbours(k, f) for f in drops})
        graphs = dict(zip(kept, pool.map(graph, kept), strict=True))
        parts, _ = cut(reduce(DataFrame.unionByName, pool.map(split, drops)), "parts")
    grid = spark.createDataFrame(list(itertools.product(drops, sizes, thresholds)), "drop_frac double, min_size int, threshold double")
    moved, _ = cut(relabels(parts, sizes, thresholds), "relabels")
    said, _ = cut(parts.join(rows.select("id", "says"), "id"), "said")
    counts = said.groupBy("drop_frac", "cluster").agg(F.count("*").alias("size"), F.count_if("says").alias("texts"))
    clusters, _ = cut(counts.join(moved, ["drop_frac", "cluster"]).groupBy(*COMBO, F.col("new").alias("cluster")).agg(F.sum("size").alias("size"), F.sum("texts").alias("texts")), "sizes")
    before = parts.groupBy("drop_frac", "cluster").agg(F.count("*").alias("size"))
    small = before.withColumn("min_size", F.explode(F.array(*map(F.lit, sizes)))).groupBy("drop_frac", "min_size").agg(F.count_if(F.col("size") < F.col("min_size")).alias("n_small"))
    size_bin = F.when(F.col("texts") <= F.col("min_size") + 2, 0).when(F.col("texts") < 10, 1).otherwise(2)
    binned = clusters.where("texts > 0").withColumn("bin", size_bin)
    # One row for each bin of a combination, whatever the size of the data.
    count: dict[tuple, list[int]] = {}
    for r in binned.groupBy(*COMBO, "bin").count().collect():
        count.setdefault((r.drop_frac, r.min_size, r.threshold), [0, 0, 0])[r.bin] = r["count"]
    give = [(*c, b, m) for c, bins in count.items() for b, m in enumerate(allocate(bins, sample))]
    give = spark.createDataFrame(give, "drop_frac double, min_size int, threshold double, bin int, give int")
    drawn = F.row_number().over(Window.partitionBy(*COMBO, "bin").orderBy(F.xxhash64("cluster", *COMBO, F.lit(seed)), "cluster"))
    chosen = binned.withColumn("r", drawn).join(give, [*COMBO, "bin"]).where("r <= give").select(*COMBO, "cluster")
    place = F.row_number().over(Window.partitionBy(*COMBO, "cluster").orderBy("id"))
    wanted = moved.join(chosen.withColumnRenamed("cluster", "new"), [*COMBO, "new"], "left_semi")  # rows are copied for sampled clusters alone
    shown = said.where("says").join(wanted, ["drop_frac", "cluster"]).select(*COMBO, F.col("new").alias("cluster"), "id", "v").withColumn("place", place).where(F.col("place") <= MOST_TEXTS)
    asked = shown.groupBy(*COMBO, "cluster").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "v"))), lambda s: s["v"]).alias("vectors"))
    verdicts = models.annotate(asked, "vectors", judge, "verdict", T.IntegerType()).groupBy(*COMBO).agg(F.count("*").alias("n_sampled"), F.count("verdict").alias("n_judged"), F.count_if(F.col("verdict") == 1).alias("n_coherent"))
    sums = clusters.groupBy(*COMBO).agg(F.count("*").alias("n_clusters"), F.round(F.avg("size"), 1).alias("avg_size"), F.round(F.stddev_pop("size"), 1).alias("std_size"))
    out = grid.join(sums, [*COMBO], "left").join(small, ["drop_frac", "min_size"], "left").join(verdicts, [*COMBO], "left")
    out = out.na.fill(0, ["n_clusters", "avg_size", "std_size", "n_small", "n_sampled", "n_judged", "n_coherent"]).withColumn("n_items", F.when(F.col("n_clusters") > 0, F.lit(n)).otherwise(0))
    out = out.withColumn("coherence_rate", F.when(F.col("n_judged") > 0, F.round(100 * F.col("n_coherent") / F.col("n_judged"), 2)))
    close = F.col("n_clusters").between(5, 20) & F.col("coherence_rate").isNotNull()
    rank = F.row_number().over(Window.partitionBy(close).orderBy(F.desc("coherence_rate"), *COMBO))
    return out.withColumn("near_10", F.when(close & (rank <= 5), rank))


def day_clusters(rows: DataFrame, eps: float = 0.75, min_samples: int = 5, min_cluster_size: int = 50, width: int = 300, sample: int = 30) -> DataFrame:
    """From (id, day, text, v): the clusters of each day, written by day and read again, with their central and diverse samples.

    Rows meet only rows of their day, so all days are one job. Near copies go before the samples are drawn, and clusters that then are
    too small go with them; centroids are means of the rows that stay.
    """
    named = neighbours.dbscan(rows, eps, min_samples, min_cluster_size, width, by="day").select("id", "cluster")
    kept, _ = cut(clustering.drop_near_copies(rows.join(named, "id").select("id", "cluster", "v", "text", "day"), min_cluster_size), "kept")
    texts = kept.select("id", "text")
    central, diverse = clustering.central(kept, sample).join(texts, "id"), clustering.diverse(kept, sample).join(texts, "id")

    def drawn(found: DataFrame, name: str) -> DataFrame:
        g = found.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "text"))).alias("s"))
        return g.select("cluster", F.col("s.id").alias(f"{name}_ids"), F.col("s.text").alias(f"{name}_texts"))

    sizes = centroids(kept, "cluster", "v").join(kept.groupBy("cluster").agg(F.min("day").alias("day")), "cluster")
    out = sizes.select("day", "cluster", F.col("size").alias("cluster_size"), "centroid").join(drawn(central, "central"), "cluster").join(drawn(diverse, "diverse"), "cluster")
    path = f"{shared_dir(rows.sparkSession)}/tidemark/day-clusters-{uuid.uuid4().hex}"
    out.write.partitionBy("day").parquet(path)
    return rows.sparkSession.read.schema(out.schema).parquet(path).select(*out.columns)
