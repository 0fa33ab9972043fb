"""Statistics over runs, raters and days."""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@lru_cache(maxsize=1024)
def t_quantile(df: int, p: float = 0.975) -> float:
    """Student's t quantile: bisection over Simpson's integral of the density."""
    c = math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)

    def mass(t: float) -> float:  # from 0 to t, in u = atan(t / sqrt(df)), where the density is a power of the cosine
        top, n = math.atan(t / math.sqrt(df)), 400
        f = lambda u: math.cos(u) ** (df - 1)
        s = f(0) + f(top) + sum((4 if i % 2 else 2) * f(top * i / n) for i in range(1, n))
        return c * math.sqrt(df) * s * top / n / 3

    low, high = 0.0, 1e3
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if mass(mid) < p - 0.5 else (low, mid)
    return (low + high) / 2


def t_column(n: Column, most: int = 100) -> Column:
    """The 97.5 % quantile for n - 1 degrees of freedom; the normal one beyond the table."""
    table = F.array(*[F.lit(t_quantile(k)) for k in range(1, most)])
    return F.when(n < 2, None).when(n > most, 1.959964).otherwise(F.try_element_at(table, (n - 1).cast("int")))


def mean_ci(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, n, mean, std, sem, ci_low, ci_high): sample deviation, bounds kept within 0 and 100; one value has a mean alone."""
    g = df.groupBy(*keys).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
    g = g.withColumn("std", F.when(F.col("n") > 1, F.col("std"))).withColumn("sem", F.col("std") / F.sqrt("n"))
    half = t_column(F.col("n")) * F.col("sem")
    return g.withColumn("ci_low", F.greatest(F.lit(0.0), F.col("mean") - half)).withColumn("ci_high", F.least(F.lit(100.0), F.col("mean") + half)).withColumns({c: F.when(F.col("std").isNotNull(), F.col(c)) for c in ("ci_low", "ci_high")})


def fleiss_kappa(ratings: DataFrame, subject: str, category: str) -> DataFrame:
    """One row (n_subjects, kappa). Missing ratings may be null; subjects with one rating don't count; nan below two subjects."""
    cell = ratings.where(F.col(category).isNotNull()).groupBy(subject, category).agg(F.count("*").alias("n"))
    per = cell.groupBy(subject).agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.col("n")).alias("sq")).where("m >= 2")
    agree = per.agg(F.count("*").alias("n_subjects"), F.avg((F.col("sq") - F.col("m")) / (F.col("m") * (F.col("m") - 1))).alias("p"), F.sum("m").alias("all"))
    shares = cell.join(per.select(subject), subject, "left_semi").groupBy(category).agg(F.sum("n").alias("n"))
    chance = shares.agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("sq"))
    both = agree.crossJoin(chance).withColumn("e", F.col("sq") / (F.col("all").cast("double") * F.col("all")))  # one row each
    kappa = F.when(F.col("n_subjects") < 2, F.lit(float("nan"))).when(F.col("e") >= 1, 1.0).otherwise((F.col("p") - F.col("e")) / (1 - F.col("e")))
    return both.select("n_subjects", kappa.alias("kappa"))


def majority(v: Column) -> Column:
    """Aggregate: true if at least as many 1 as 0; false without votes."""
    ones, zeros = F.count_if(v == 1), F.count_if(v == 0)
    return (ones + zeros > 0) & (ones >= zeros)


def share(condition: Column, among: Column | None = None) -> Column:
    """Aggregate: percentage of rows where a condition holds, null among none."""
    total = F.count("*") if among is None else F.count_if(among)
    hit = F.count_if(condition if among is None else condition & among)
    return F.when(total > 0, 100.0 * hit / total)


def upper_median(column: str) -> Column:
    """Aggregate: the element at place n div 2 of a column's sorted whole numbers, which is the lower median from above. Equal values are
    counted before they move, so a group costs no more than its distinct ones."""
    return F.expr(f"percentile_disc(0.5) within group (order by `{column}` desc)").cast("long")


def clean(c: Column, digits: int = 2) -> Column:
    """Rounded; nan is null."""
    return F.round(F.when(~F.isnan(c), c), digits)
