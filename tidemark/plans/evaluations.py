"""Raters, judges and repeated runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.stats import clean, fleiss_kappa, mean_ci, t_quantile, upper_median
from tidemark.operators import evaluation as ev
from tidemark.plans.tables import embedded, read, runs, runs_sql

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


RATINGS = "ratings AS (SELECT doc_id, 'a' AS rater, quality AS v FROM labels UNION ALL SELECT doc_id, 'b', 1 - toxic FROM labels UNION ALL SELECT doc_id, 'c', quality * (1 - toxic) FROM labels)"
T_CASE = "CASE n " + " ".join(f"WHEN {n} THEN {t_quantile(n - 1)!r}" for n in range(2, 101)) + " ELSE 1.959964 END"


def _ratings(spark, d):
    t = read(spark, d, "labels")
    r = lambda name, v: t.select("doc_id", F.lit(name).alias("rater"), v.alias("v"))
    return r("a", F.col("quality")).unionByName(r("b", 1 - F.col("toxic"))).unionByName(r("c", F.col("quality") * (1 - F.col("toxic"))))


def ci_sql(rows: str, keys: str, value: str) -> str:
    """The mean, deviation and interval of `value` in `rows` by `keys`."""
    return f"""g AS (SELECT {keys}, count({value}) AS n, avg({value}) AS mean, CASE WHEN count({value}) > 1 THEN stddev_samp({value}) END AS std FROM {rows} GROUP BY {keys})
SELECT {keys}, n, round(mean, 4) AS mean, round(std, 4) AS std, round(CASE WHEN std IS NOT NULL THEN greatest(0.0, mean - {T_CASE} * std / sqrt(n)) END, 4) AS ci_low, round(CASE WHEN std IS NOT NULL THEN least(100.0, mean + {T_CASE} * std / sqrt(n)) END, 4) AS ci_high FROM g"""


def _ci(df, keys, value):
    m = mean_ci(df, keys, value)
    return m.select(*keys, "n", *[F.round(c, 4).alias(c) for c in ("mean", "std", "ci_low", "ci_high")])


@query(f"WITH {RATINGS} SELECT doc_id, max(v) FILTER (rater = 'a') AS a, max(v) FILTER (rater = 'b') AS b, max(v) FILTER (rater = 'c') AS c FROM ratings GROUP BY 1 HAVING count(DISTINCT rater) = 3")
def rater_intersection(spark, d):
    """JOIN-09, SET-02."""
    return ev.rated_by_all(_ratings(spark, d), "doc_id", "rater", "v", ["a", "b", "c"])


@query(f"""WITH {RATINGS}, cell AS (SELECT doc_id, v, count(*) AS n FROM ratings GROUP BY 1, 2), per AS (SELECT doc_id, sum(n) AS m, sum(n * n) AS sq FROM cell GROUP BY 1 HAVING sum(n) >= 2),
a AS (SELECT count(*) AS n_subjects, avg((sq - m) / (m * (m - 1))::DOUBLE) AS p, sum(m) AS al FROM per), e AS (SELECT sum(n * n) AS sq FROM (SELECT v, sum(n)::DOUBLE AS n FROM cell GROUP BY 1))
SELECT n_subjects, round((p - sq / (al::DOUBLE * al)) / (1 - sq / (al::DOUBLE * al)), 9) AS kappa FROM a, e""")
def fleiss(spark, d):
    """AGG-16."""
    return fleiss_kappa(_ratings(spark, d), "doc_id", "v").select("n_subjects", F.round("kappa", 9).alias("kappa"))


@query(f"WITH {RATINGS} SELECT rater, round(100.0 * avg(CASE WHEN v = quality THEN 1 ELSE 0 END), 6) AS accuracy FROM ratings JOIN labels USING (doc_id) GROUP BY 1")
def accuracy(spark, d):
    """AGG-17."""
    both = _ratings(spark, d).join(read(spark, d, "labels").select("doc_id", "quality"), "doc_id")
    return both.groupBy("rater").agg(F.round(100.0 * F.avg((F.col("v") == F.col("quality")).cast("int")), 6).alias("accuracy"))


@query(f"WITH x AS (SELECT source, least(n_chars / 100.0, 100.0) AS v FROM documents), {ci_sql('x', 'source', 'v')}")
def mean_ci_by_group(spark, d):
    """AGG-15, MTH-04."""
    return _ci(read(spark, d, "documents").select("source", F.least(F.col("n_chars") / 100.0, F.lit(100.0)).alias("v")), ["source"], "v")


@query(f"WITH {runs_sql('s')} SELECT ex_idx, count(*) FILTER (validity = 1) + count(*) FILTER (validity = 0) > 0 AND count(*) FILTER (validity = 1) >= count(*) FILTER (validity = 0) AS vote, count(validity) AS n_valid FROM s GROUP BY 1")
def majority_vote(spark, d):
    """AGG-18, UDF-08."""
    return ev.votes(runs(spark, d, "s"), "ex_idx")


PAIRS = f"{runs_sql('s')}, {runs_sql('p')}, pairs AS (SELECT ex_idx, run, s.validity AS s, p.validity AS p FROM s JOIN p USING (ex_idx, run) WHERE s.validity IS NOT NULL AND p.validity IS NOT NULL)"


def _pairs(spark, d):
    return ev.paired(runs(spark, d, "s"), runs(spark, d, "p"), ["ex_idx", "run"])


@query(f"WITH {PAIRS}, f AS (SELECT 'all' AS dataset, ex_idx, 100.0 * count(*) FILTER (s <> p) / count(*) AS v FROM pairs GROUP BY ex_idx), {ci_sql('f', 'dataset', 'v')}")
def paired_flips(spark, d):
    """AGG-19, JOIN-11."""
    rates = ev.flip_rates(_pairs(spark, d), "ex_idx").select(F.lit("all").alias("dataset"), F.col("flip_rate").alias("v"))
    return _ci(rates, ["dataset"], "v")


@query(f"""WITH {PAIRS}, t AS (SELECT ex_idx, 100.0 * count(*) FILTER (p = 0 AND s = 0) / count(*) AS ff, 100.0 * count(*) FILTER (p = 0 AND s = 1) / count(*) AS ft, 100.0 * count(*) FILTER (p = 1 AND s = 0) / count(*) AS tf, 100.0 * count(*) FILTER (p = 1 AND s = 1) / count(*) AS tt FROM pairs GROUP BY 1),
u AS (SELECT 'ff' AS way, ff AS v FROM t UNION ALL SELECT 'ft', ft FROM t UNION ALL SELECT 'tf', tf FROM t UNION ALL SELECT 'tt', tt FROM t), {ci_sql('u', 'way', 'v')}""")
def flip_categories(spark, d):
    """AGG-20."""
    t = ev.transitions(_pairs(spark, d), "ex_idx")
    return _ci(t.unpivot("ex_idx", ["ff", "ft", "tf", "tt"], "way", "v"), ["way"], "v")


@query(f"WITH {runs_sql('s')}, e AS (SELECT 'search' AS agent, ex_idx, 100.0 * avg(validity) AS v FROM s GROUP BY 2), {ci_sql('e', 'agent', 'v')}")
def true_rates(spark, d):
    """AGG-21."""
    e = runs(spark, d, "s").groupBy("ex_idx").agg((100.0 * F.avg("validity")).alias("v")).withColumn("agent", F.lit("search"))
    return _ci(e, ["agent"], "v")


@query(f"WITH {runs_sql('s')} SELECT CAST(run AS INT) AS run, count(*) AS n, round(100.0 * avg(CASE WHEN validity = quality THEN 1 ELSE 0 END), 6) AS accuracy FROM s JOIN labels ON doc_id = ex_idx WHERE validity IS NOT NULL GROUP BY 1")
def per_run_accuracy(spark, d):
    """AGG-24."""
    truth = read(spark, d, "labels").select(F.col("doc_id").alias("ex_idx"), F.col("quality").alias("truth"))
    return ev.run_accuracy(runs(spark, d, "s"), truth, "ex_idx").select("run", "n", F.round("accuracy", 6).alias("accuracy"))


@query(f"WITH {runs_sql('s')}, {runs_sql('p')} SELECT round(100.0 * avg(CASE WHEN s.validity = p.validity THEN 1 ELSE 0 END) FILTER (toxic = 0 AND s.validity IS NOT NULL AND p.validity IS NOT NULL), 6) AS clean, round(100.0 * avg(CASE WHEN s.validity = p.validity THEN 1 ELSE 0 END) FILTER (toxic = 7 AND s.validity IS NOT NULL), 6) AS none FROM s JOIN p USING (ex_idx, run) JOIN labels ON doc_id = ex_idx")
def agreement(spark, d):
    """AGG-25."""
    both = runs(spark, d, "s").select("ex_idx", "run", F.col("validity").alias("s")).join(runs(spark, d, "p").select("ex_idx", "run", F.col("validity").alias("p")), ["ex_idx", "run"])
    both = both.join(read(spark, d, "labels").withColumnRenamed("doc_id", "ex_idx"), "ex_idx")
    pct = lambda t: F.round(ev.agreement(F.col("s"), F.col("p"), F.col("toxic") == t), 6)
    return both.agg(pct(0).alias("clean"), pct(7).alias("none"))


@query(f"""WITH {runs_sql('s')} SELECT CAST(run AS INT) AS run, count(*) AS n, count(*) - count(validity) AS n_failed, round(100.0 * count(*) FILTER (validity = 0) / count(validity), 6)::DOUBLE AS pct_0, round(100.0 * count(*) FILTER (validity = 0 OR validity IS NULL) / count(*), 6)::DOUBLE AS pct_0_failed_as_0,
round(100.0 * count(*) FILTER (validity = 1) / count(validity), 6)::DOUBLE AS pct_1, round(100.0 * count(*) FILTER (validity = 1) / count(*), 6)::DOUBLE AS pct_1_failed_as_0 FROM s GROUP BY 1""")
def class_pct_two_denominators(spark, d):
    """AGG-22/23."""
    c = ev.class_shares(runs(spark, d, "s"), ["run"], "validity", (0, 1))
    return c.select("run", "n", "n_failed", *[F.round(x, 6).alias(x) for x in c.columns[3:]])


@query(f"WITH {runs_sql('s')} SELECT round(avg(calls), 6) AS over_runs, round((SELECT avg(m) FROM (SELECT avg(calls) AS m FROM s GROUP BY ex_idx)), 6) AS over_examples FROM s")
def mean_tool_calls(spark, d):
    """AGG-27: over runs, and over examples' means."""
    r = runs(spark, d, "s")
    per = r.groupBy("ex_idx").agg(F.avg("calls").alias("m"), F.sum("calls").alias("s"), F.count("*").alias("n"))
    return per.agg(F.round(F.sum("s") / F.sum("n"), 6).alias("over_runs"), F.round(F.avg("m"), 6).alias("over_examples"))


@query("""WITH s AS (SELECT source, count(*) AS size, round((CAST(('0x' || substr(md5(source), 1, 2)) AS INT)) / 255.0, 6) AS sim FROM documents GROUP BY 1), t AS (SELECT unnest([0.2, 0.5, 0.8])::DOUBLE AS threshold)
SELECT threshold, count(*) FILTER (sim < threshold) AS clusters, CAST(coalesce(sum(size) FILTER (sim < threshold), 0) AS BIGINT) AS items, round(100.0 * coalesce(sum(size) FILTER (sim < threshold), 0) / sum(size), 4)::DOUBLE AS pct_items FROM s, t GROUP BY 1""")
def threshold_simulation(spark, d):
    """AGG-35, JOIN-17."""
    sim = F.round(F.conv(F.substring(F.md5(F.col("source").cast("binary")), 1, 2), 16, 10).cast("int") / 255.0, 6)
    s = read(spark, d, "documents").groupBy("source").agg(F.count("*").alias("size")).withColumn("sim", sim)
    return ev.thresholds(s, "size", "sim", [0.2, 0.5, 0.8])


@query("SELECT label, count(*) FILTER (vec_id % 3 = 0) AS m0, count(*) FILTER (vec_id % 3 = 1) AS m1, count(*) FILTER (vec_id % 3 = 2) AS m2 FROM embeddings GROUP BY 1")
def pivot_grid(spark, d):
    """AGG-33."""
    p = embedded(spark, d).withColumn("m", F.concat(F.lit("m"), (F.col("id") % 3).cast("string"))).groupBy("label").pivot("m", ["m0", "m1", "m2"]).agg(F.count("label"))
    return p.fillna(0)


@query("WITH a AS (SELECT DISTINCT CAST(count(*) AS INT) AS k FROM embeddings GROUP BY label), b AS (SELECT unnest([0.8, 0.9])::DOUBLE AS drop_frac) SELECT k, drop_frac, CAST(row_number() OVER (ORDER BY k, drop_frac) - 1 AS INT) AS combo FROM a, b")
def parameter_grid(spark, d):
    """JOIN-17, ML-20: the sizes of the labels as numbers of neighbours, with two shares to drop."""
    sizes = embedded(spark, d).groupBy("label").agg(F.count("*").cast("int").alias("k")).select("k").distinct()
    return ev.grid_over(sizes, drop_frac=[0.8, 0.9])


@query("""WITH s AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1) SELECT round(avg(n), 6) AS mean, round(stddev_pop(n), 6) AS std, min(n) AS least, max(n) AS most, round(median(n), 6) AS mid, (list(n ORDER BY n))[count(*) // 2 + 1] AS upper FROM s""")
def cluster_size_summary(spark, d):
    """AGG-31/29."""
    s = embedded(spark, d).groupBy("label").agg(F.count("*").alias("n"))
    return s.agg(F.round(F.avg("n"), 6).alias("mean"), F.round(F.stddev_pop("n"), 6).alias("std"), F.min("n").alias("least"), F.max("n").alias("most"), F.round(F.median("n"), 6).alias("mid"), upper_median("n").alias("upper"))


@query(f"""WITH {PAIRS}, c AS (SELECT ex_idx, run, CAST(p AS VARCHAR) || CAST(s AS VARCHAR) AS way FROM pairs), o AS (SELECT *, row_number() OVER (PARTITION BY way, ex_idx ORDER BY run) AS a FROM c),
q AS (SELECT way, ex_idx, run, row_number() OVER (PARTITION BY way ORDER BY run, ex_idx) AS pos FROM o WHERE a = 1) SELECT way, ex_idx, CAST(run AS INT) AS run, pos FROM q WHERE pos <= 5""")
def examples_per_category(spark, d):
    """WIN-12/13."""
    rows = _pairs(spark, d).select("ex_idx", "run", F.concat(F.col("p").cast("string"), F.col("s").cast("string")).alias("way"))
    return ev.first_examples(rows, ["way"], "ex_idx", "run").select("way", "ex_idx", "run", F.col("pos").cast("long"))


@query(f"WITH {runs_sql('s')}, r AS (SELECT CAST(run AS INT) AS run, 100.0 * avg(validity) AS v FROM s GROUP BY 1), z AS (SELECT 'all' AS kind, v FROM r), {ci_sql('z', 'kind', 'v')}")
def coherence_over_runs(spark, d):
    """AGG-32: rates per run, then over runs."""
    r = runs(spark, d, "s").where("validity is not null").groupBy("run").agg((100.0 * F.avg("validity")).alias("v")).withColumn("kind", F.lit("all"))
    return _ci(r, ["kind"], "v")


@query("SELECT source, CASE WHEN count(*) > 1 THEN round(stddev_samp(n_chars), 2) END AS std FROM documents GROUP BY 1")
def cleaned_stats(spark, d):
    """MTH-04."""
    g = read(spark, d, "documents").groupBy("source").agg(F.stddev_samp("n_chars").alias("std"))
    return g.select("source", clean(F.col("std")).alias("std"))
