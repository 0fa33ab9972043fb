"""Judges, raters and repeated runs: flips, transitions, accuracies and agreement over long (dataset, example, run) tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.stats import majority, mean_ci


def rated_by_all(ratings: DataFrame, subject: str, rater: str, value: str, raters: list[str]) -> DataFrame:
    """One row per subject with a column for each rater, of subjects that all of them have rated."""
    return ratings.groupBy(subject).pivot(rater, raters).agg(F.first(value, ignorenulls=True)).dropna(subset=raters)


def predict_unique(rows: DataFrame, text: str, predict) -> DataFrame:
    """rows with predict(distinct texts)' columns: each text is predicted once, however often it occurs."""
    return rows.join(predict(rows.select(text).distinct()), text, "left")


def paired(search: DataFrame, plain: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of both kinds side by side, where neither failed."""
    return search.where("validity is not null").select(*keys, F.col("validity").alias("s")).join(plain.where("validity is not null").select(*keys, F.col("validity").alias("p")), keys)


def flip_rates(pairs: DataFrame, example: str) -> DataFrame:
    """Per example: pairs, flips, and the share of pairs that disagree in percent."""
    return pairs.groupBy(example).agg(F.count("*").alias("n_pairs"), F.count_if(F.col("s") != F.col("p")).alias("n_flips")).withColumn("flip_rate", 100.0 * F.col("n_flips") / F.col("n_pairs"))


def transitions(pairs: DataFrame, example: str) -> DataFrame:
    """Per example: the percentage of each of the four ways from plain to search."""
    n = F.count("*")
    way = lambda a, b: (100.0 * F.count_if((F.col("p") == a) & (F.col("s") == b)) / n)
    return pairs.groupBy(example).agg(way(0, 0).alias("ff"), way(0, 1).alias("ft"), way(1, 0).alias("tf"), way(1, 1).alias("tt"))


def votes(runs: DataFrame, example: str) -> DataFrame:
    return runs.groupBy(example).agg(majority(F.col("validity")).alias("vote"), F.count("validity").alias("n_valid"))


def run_accuracy(runs: DataFrame, truth: DataFrame, example: str) -> DataFrame:
    """Per run: valid verdicts with a known truth and the percentage that are right."""
    both = runs.where("validity is not null").join(truth.where("truth is not null"), example)
    return both.groupBy("run").agg(F.count("*").alias("n"), (100.0 * F.avg((F.col("validity") == F.col("truth")).cast("int"))).alias("accuracy"))


def agreement(a: Column, b: Column, mask: Column) -> Column:
    """Aggregate: percentage of equal labels under a mask, null if it is empty."""
    return 100.0 * F.avg(F.when(mask & a.isNotNull() & b.isNotNull(), (a == b).cast("int")))


def class_shares(runs: DataFrame, by: list[str], value: str, classes: tuple[int, ...] = (0, 1, 2)) -> DataFrame:
    """Per group and class: percentage among verdicts that did not fail, and with failures counted as class 0."""
    ok = F.count(value)
    cols = []
    for k in classes:
        hit = F.count_if(F.col(value) == k)
        cols.append(F.when(ok > 0, 100.0 * hit / ok).alias(f"pct_{k}"))
        cols.append((100.0 * F.count_if(F.coalesce(value, F.lit(0)) == k) / F.count("*")).alias(f"pct_{k}_failed_as_0"))
    return runs.groupBy(*by).agg(F.count("*").alias("n"), (F.count("*") - ok).alias("n_failed"), *cols)


def over_runs(values: DataFrame, keys: list[str], value: str) -> DataFrame:
    return mean_ci(values, keys, value)


def thresholds(sims: DataFrame, size: str, sim: str, levels: list[float]) -> DataFrame:
    """Per threshold: clusters and items below it, and their percentage of all items."""
    t = F.explode(F.array(*[F.lit(x) for x in levels])).alias("threshold")
    below = F.col(sim) < F.col("threshold")
    g = sims.select(size, sim, t).groupBy("threshold").agg(F.count_if(below).alias("clusters"), F.coalesce(F.sum(F.when(below, F.col(size))), F.lit(0)).alias("items"), F.sum(size).alias("all"))
    return g.select("threshold", "clusters", "items", F.round(100.0 * F.col("items") / F.col("all"), 4).alias("pct_items"))


def first_examples(rows: DataFrame, by: list[str], example: str, run: str, n: int = 5) -> DataFrame:
    """At most n distinct examples per group, each with its earliest run."""
    once = rows.withColumn("_a", F.row_number().over(Window.partitionBy(*by, example).orderBy(run))).where("_a = 1")
    return once.withColumn("pos", F.row_number().over(Window.partitionBy(*by).orderBy(run, example))).where(F.col("pos") <= n).drop("_a")


def best_epoch(epochs: DataFrame, task: str) -> DataFrame:
    """Per task the epoch of least validation loss, the first of equals."""
    return epochs.groupBy(task).agg(F.min_by(F.struct("epoch", "train_loss", "val_loss", "val_acc"), F.struct("val_loss", "epoch")).alias("e")).select(task, "e.*")


def grid(spark, **axes) -> DataFrame:
    """All combinations of parameter values, in a `combo` order."""
    return grid_over(spark.range(1).select(F.lit(0).alias("_")), **axes).drop("_")


def grid_over(rows: DataFrame, **axes) -> DataFrame:
    """Rows of parameters, one for each setting and not each row of data, with all combinations of other values, in a `combo` order."""
    for name, values in axes.items():
        rows = rows.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    return rows.withColumn("combo", F.row_number().over(Window.orderBy(*rows.columns)) - 1)


def check_sweep(drop_frac: list[float], min_size: list[int], threshold: list[float]) -> None:
    """Raise ValueError unless 0 <= drop_frac < 1, min_size >= 2 and 0 <= threshold < 1 for all values of a sweep."""
    for name, values, ok in (("drop_frac", drop_frac, lambda x: 0 <= x < 1), ("min_size", min_size, lambda x: x >= 2), ("threshold", threshold, lambda x: 0 <= x < 1)):
        if wrong := [x for x in values if not ok(x)]:
            raise ValueError(f"{name} out of range: {wrong}")


def comparison_row(judges: DataFrame, labels: DataFrame, example: str) -> DataFrame:
    """One row: mean accuracy over runs of each judge against each label kind, and agreement of every two kinds.

    judges has (judge, example, run, validity), labels (example, one column of 0, 1 or null for each kind). Failed verdicts and unknown
    labels count for nothing.
    """
    kinds = [c for c in labels.columns if c != example]
    both = judges.where("validity is not null").join(labels, example)
    right = [F.avg(F.when(F.col(k).isNotNull(), (F.col("validity") == F.col(k)).cast("int"))).alias(k) for k in kinds]
    runs = both.groupBy("judge", "run").agg(*right)
    means = runs.groupBy().pivot("judge", sorted(r[0] for r in judges.select("judge").distinct().collect())).agg(*[(100.0 * F.avg(k)).alias(f"vs_{k}") for k in kinds])
    pairs = [(a, b) for i, a in enumerate(kinds) for b in kinds[i + 1 :]]
    shares = labels.agg(*[agreement(F.col(a), F.col(b), F.lit(True)).alias(f"{a}_{b}") for a, b in pairs])
    return means.crossJoin(shares)  # one row each


def noise_rates(candidates: DataFrame, judged: DataFrame, levels: list[float]) -> DataFrame:
    """Per threshold: judged clusters, those that are noise, the noise rate in percent, items below the threshold and, of these, how many
    are dropped wrongly if the rate holds: none where no noise was found.

    candidates has (cluster, size, max_sim), judged (cluster, threshold, verdict), verdict 0 for noise, 1 for coherent, null if failed.
    """
    t = F.explode(F.array(*[F.lit(x) for x in levels])).alias("threshold")
    below = candidates.select("size", "max_sim", t).groupBy("threshold").agg(F.coalesce(F.sum(F.when(F.col("max_sim") < F.col("threshold"), F.col("size"))), F.lit(0)).alias("dropped"))
    seen = judged.groupBy("threshold").agg(F.count("verdict").alias("sampled"), F.count_if(F.col("verdict") == 0).alias("n_noise"))
    rows = below.join(seen, "threshold", "left").fillna(0, ["sampled", "n_noise"])
    rows = rows.withColumn("noise_pct", F.when(F.col("sampled") > 0, 100.0 * F.col("n_noise") / F.col("sampled")).otherwise(0.0))
    wrong = F.when(F.col("noise_pct") > 0, F.floor((1 - F.col("noise_pct") / 100) * F.col("dropped"))).otherwise(0)
    return rows.select("threshold", "sampled", "n_noise", "noise_pct", "dropped", wrong.cast("long").alias("est_fp"))


def outlier_candidates(sims: DataFrame, texts: DataFrame, cluster: str, n_texts: int = 32) -> DataFrame:
    """sims (cluster, size, max_sim) of small clusters with the first n_texts of their texts (cluster, id, text), worst first from rank 0."""
    place = F.row_number().over(Window.partitionBy(cluster).orderBy("id"))
    few = texts.join(sims.select(cluster), cluster, "left_semi").withColumn("_p", place).where(F.col("_p") <= n_texts)
    listed = few.groupBy(cluster).agg(F.transform(F.array_sort(F.collect_list(F.struct("_p", "text"))), lambda s: s["text"]).alias("texts"))
    return sims.join(listed, cluster, "left").withColumn("rank", F.row_number().over(Window.orderBy("max_sim", cluster)) - 1)
