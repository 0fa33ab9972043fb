"""Views, coverage, samples and exports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.parse import day_of_batch, json_scalar, sunday_label
from tidemark.operators import coverage, sampling, sketches
from tidemark.operators.views import Layer, annotation_view, export_rows, export_view, first_text, hash_share, merge_rows
from tidemark.plans.tables import ANN, POSTS, REACTIONS, annotations, embedded, posts, reactions, read
from tidemark.storage import new_path

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"""WITH {POSTS}, {ANN}, done AS (SELECT DISTINCT vec_id AS id FROM embeddings WHERE label < 3)
SELECT _batch, count(*) AS cnt FROM posts JOIN ann USING (id) WHERE json_extract_string(classifier_label, '$') = 'LABEL_2' AND id NOT IN (SELECT id FROM done) GROUP BY 1""")
def pending_by_batch(spark, d):
    """AGG-01/05, JOIN-01/02, FLT-01, SRC-07/08: posts of the wanted label without an embedding, per batch. A third of the labels counts as embedded."""
    layer = Layer(annotations(spark, d), ["classifier_label"], json_scalar(F.col("classifier_label")) == "LABEL_2")
    done = embedded(spark, d).where("label < 3")
    return annotation_view(posts(spark, d), [layer], ["_batch"], done).groupBy("_batch").agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), "_batch")


@query("""WITH p AS (SELECT doc_id AS id, text, source AS _batch FROM documents UNION ALL SELECT doc_id, NULL, source || 'x' FROM documents)
SELECT id, min(text) AS text, min(_batch) AS _batch FROM p GROUP BY id""")
def merged_posts(spark, d):
    """AGG-01: one row per id where every id comes twice, once without text."""
    p = posts(spark, d)
    again = p.select("id", F.lit(None).cast("string").alias("text"), F.concat("_batch", F.lit("x")).alias("_batch"))
    return merge_rows(p.unionByName(again))


@query(f"WITH {ANN} SELECT json_extract_string(classifier_label, '$') AS label, count(*) AS cnt FROM ann GROUP BY 1")
def label_histogram_json(spark, d):
    """AGG-03, JSN-01, SRT-01."""
    return annotations(spark, d).groupBy(json_scalar(F.col("classifier_label")).alias("label")).agg(F.count("*").alias("cnt")).orderBy("label")


@query(f"""WITH {POSTS}, {ANN} SELECT coalesce(_batch, 'TOTAL') AS _batch, count(*) AS total, count(*) FILTER (classifier_label = '"LABEL_2"') AS hits,
round(100.0 * count(*) FILTER (classifier_label = '"LABEL_2"') / count(*), 4)::DOUBLE AS pct FROM posts JOIN ann USING (id) GROUP BY ROLLUP (posts._batch)""")
def label_share_by_batch_rollup(spark, d):
    """AGG-04."""
    view = export_view(posts(spark, d), [Layer(annotations(spark, d), ["classifier_label"])], ["_batch"])
    return coverage.label_shares(view, "_batch", "classifier_label", '"LABEL_2"')


@query(f"""WITH {POSTS}, {ANN} SELECT _batch, classifier_label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY _batch), 4)::DOUBLE AS pct
FROM posts JOIN ann USING (id) GROUP BY 1, 2""")
def label_distribution(spark, d):
    """AGG-08."""
    view = export_view(posts(spark, d), [Layer(annotations(spark, d), ["classifier_label"])], ["_batch"])
    return coverage.distribution(view, "_batch", "classifier_label")


DAYS = "day AS (SELECT doc_id AS id, source AS _batch, '202401' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') AS day FROM documents)"


def _days(spark, d):
    return posts(spark, d).select("id", "_batch", F.concat(F.lit("202401"), F.lpad((1 + F.col("id") % 28).cast("string"), 2, "0")).alias("day"))


@query(f"""WITH {DAYS}, b AS (SELECT day, count(DISTINCT _batch) AS batches, count(*) AS total FROM day GROUP BY 1),
a AS (SELECT day, count(DISTINCT _batch) AS done, count(*) AS annotated FROM day JOIN labels ON doc_id = id GROUP BY 1),
m AS (SELECT coalesce(b.day, a.day) AS day, coalesce(batches, 0) AS batches, coalesce(total, 0) AS total, coalesce(annotated, 0) AS annotated, coalesce(done, 0) AS done FROM b FULL JOIN a ON a.day = b.day),
q AS (SELECT *, CASE WHEN total > 0 THEN 100.0 * annotated / total ELSE 0 END AS p FROM m)
SELECT day, batches, total, annotated, round(p, 4)::DOUBLE AS pct, CASE WHEN annotated = 0 THEN 'not annotated' WHEN p >= 99.9 THEN 'complete' WHEN p > 50 THEN 'partial (' || done || '/' || batches || ' batches)' ELSE 'sparse (' || done || '/' || batches || ' batches)' END AS status FROM q""")
def annotation_coverage_status(spark, d):
    """AGG-02/06, JOIN-06, SET-01."""
    rows = _days(spark, d)
    return coverage.coverage_status(rows, rows.join(annotations(spark, d), "id"), "day", "_batch")


@query("""WITH u AS (SELECT strftime(ts, '%Y-%m-%d') AS date, 'event_type' AS "column", event_type AS v FROM events UNION ALL SELECT strftime(ts, '%Y-%m-%d'), 'kind', CASE WHEN event_type IN ('click', 'view') THEN event_type END FROM events)
SELECT date, "column", count(v) AS total_non_null, count(*) FILTER (v = 'click') AS label_count, round(CASE WHEN count(v) > 0 THEN 100.0 * count(*) FILTER (v = 'click') / count(v) ELSE 0 END, 4)::DOUBLE AS label_pct FROM u GROUP BY 1, 2""")
def daily_label_stats(spark, d):
    """AGG-07, PRJ-07."""
    rows = read(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("date"), "event_type", F.when(F.col("event_type").isin("click", "view"), F.col("event_type")).alias("kind"))
    return coverage.column_stats(rows, "date", ["event_type", "kind"], "click")


@query(f"""WITH {DAYS}, {ANN}, r AS (SELECT day, count(*) AS n FROM day GROUP BY 1), a AS (SELECT day, count(*) AS n FROM day JOIN ann USING (id) GROUP BY 1),
c AS (SELECT day, count(*) AS n FROM day JOIN ann USING (id) WHERE classifier_label = '"LABEL_1"' GROUP BY 1)
SELECT coalesce(r.day, a.day, c.day) AS day, coalesce(r.n, 0) AS raw, coalesce(a.n, 0) AS annotated, coalesce(c.n, 0) AS toxic FROM r FULL JOIN a ON a.day = r.day FULL JOIN c ON c.day = coalesce(r.day, a.day)
WHERE coalesce(r.day, a.day, c.day) BETWEEN '20240105' AND '20240120'""")
def coverage_full_outer(spark, d):
    """JOIN-05, SET-01, FLT-05."""
    rows = _days(spark, d)
    done = rows.join(annotations(spark, d), "id")
    n = lambda x: x.groupBy("day").agg(F.count("*").alias("n"))
    return coverage.merge_days({"raw": n(rows), "annotated": n(done), "toxic": n(done.where(F.col("classifier_label") == '"LABEL_1"'))}, first="2024-01-05", last="2024-01-20")


@query(f"""WITH {DAYS}, {ANN}, l AS (SELECT day, count(*) AS n FROM day JOIN ann USING (id) WHERE classifier_label = '"LABEL_2"' GROUP BY 1),
s AS (SELECT day, count(*) AS n FROM day JOIN embeddings ON vec_id = id GROUP BY 1)
SELECT coalesce(l.day, s.day) AS day, coalesce(l.n, 0) - coalesce(s.n, 0) AS dropped FROM l FULL JOIN s ON l.day = s.day""")
def outliers_dropped(spark, d):
    """JOIN-07, AGG-09/10: rows of the label less rows in clusters, whose sizes are written as `[n]`; may be negative."""
    rows = _days(spark, d)
    labelled = rows.join(annotations(spark, d).where(F.col("classifier_label") == '"LABEL_2"'), "id").groupBy("day").agg(F.count("*").alias("n"))
    sizes = rows.join(embedded(spark, d), "id").groupBy("day", "label").agg(F.concat(F.lit("["), F.count("*").cast("string"), F.lit("]")).alias("cluster_size"))
    both = coverage.merge_days({"labelled": labelled, "clustered": coverage.bracketed_sum(sizes, "day", "cluster_size")})
    return both.select("day", (F.col("labelled") - F.col("clustered")).alias("dropped"))


@query("""WITH b AS (SELECT DISTINCT 'stream-' || strftime(ts, '%Y%m%d-%H') AS batch FROM events UNION SELECT DISTINCT source FROM documents)
SELECT batch, coalesce(nullif(regexp_extract(batch, '([0-9]{8})', 1), ''), 'unknown') AS day, CASE WHEN batch LIKE 'stream-%' AND dayofweek(strptime(substr(batch, 8, 8), '%Y%m%d')) = 0 THEN substr(batch, 8, 8) ELSE '' END AS sunday FROM b""")
def batch_name_day(spark, d):
    """DAT-01/02, PRJ-05/06, SRC-11."""
    live = read(spark, d, "events").select(F.concat(F.lit("stream-"), F.date_format("ts", "yyyyMMdd-HH")).alias("batch")).distinct()
    every = live.unionByName(posts(spark, d).select(F.col("_batch").alias("batch"))).distinct()
    day = day_of_batch(F.col("batch"))
    return every.select("batch", day.alias("day"), F.coalesce(sunday_label(day), F.lit("")).alias("sunday"))


@query(f"WITH {POSTS}, x AS (SELECT DISTINCT id FROM posts WHERE _batch LIKE 'src1_') SELECT count(*) AS n, min(id) AS first, max(id) AS last FROM x")
def glob_batches(spark, d):
    """FLT-04/10: batches by a shell pattern."""
    from tidemark.functions.parse import glob_match

    return posts(spark, d).where(glob_match(F.col("_batch"), "src1?")).agg(F.countDistinct("id").alias("n"), F.min("id").alias("first"), F.max("id").alias("last"))


@query(f"WITH {REACTIONS}, w AS (SELECT DISTINCT subject FROM reactions) SELECT item_id AS subject, text FROM benchmark WHERE item_id IN (SELECT subject FROM w) AND length(trim(text)) > 0")
def text_lookup_semi(spark, d):
    """JOIN-03, FLT-06."""
    texts = read(spark, d, "benchmark").select(F.col("item_id").alias("subject"), "text", F.col("item_id").alias("at"))
    return first_text(texts, reactions(spark, d), "subject", "text", "at")


@query(f"WITH {REACTIONS}, m AS (SELECT subject, count(*) AS n FROM reactions GROUP BY 1) SELECT subject, n, text FROM m LEFT JOIN benchmark ON item_id = subject")
def text_lookup_left(spark, d):
    """JOIN-04."""
    m = reactions(spark, d).groupBy("subject").agg(F.count("*").alias("n"))
    return m.join(read(spark, d, "benchmark").select(F.col("item_id").alias("subject"), "text"), "subject", "left")


@query(f"WITH {POSTS} SELECT id FROM posts WHERE ('0x' || substr(md5('0|' || id), 1, 8))::BIGINT < 214748364")
def hash_sample(spark, d):
    """SMP-01."""
    return posts(spark, d).where(hash_share(F.col("id"), 0.05)).select("id")


@query("SELECT doc_id FROM labels ORDER BY md5('7|' || doc_id), doc_id LIMIT 50")
def seeded_sample(spark, d):
    """SMP-02/03, SRT-03/07."""
    return sampling.sample_n(read(spark, d, "labels"), "doc_id", 50, 7).select("doc_id")


@query("""WITH c AS (SELECT min(n) AS least FROM (SELECT count(*) AS n FROM labels GROUP BY quality)),
r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('3|' || doc_id), doc_id) AS r FROM labels) SELECT doc_id, quality FROM r, c WHERE r <= least""")
def class_balance(spark, d):
    """SMP-04, SRT-05, WIN-15."""
    return sampling.balance(read(spark, d, "labels"), "doc_id", "quality", 3).select("doc_id", "quality")


@query("""WITH r AS (SELECT doc_id, quality, (row_number() OVER (PARTITION BY quality ORDER BY md5('5|' || doc_id), doc_id) - 1) / (count(*) OVER (PARTITION BY quality))::DOUBLE AS p FROM labels)
SELECT doc_id, quality, CASE WHEN p < 0.8 THEN 'train' WHEN p < 0.9 THEN 'val' ELSE 'test' END AS split FROM r""")
def stratified_split(spark, d):
    """SMP-05."""
    return sampling.split(read(spark, d, "labels"), "doc_id", "quality", 5).select("doc_id", "quality", "split")


@query(f"""WITH {POSTS}, {ANN}, v AS (SELECT id, _batch, classifier_label FROM posts JOIN ann USING (id) WHERE classifier_label <> '"LABEL_0"')
SELECT subset, count(*) AS n, min(id) AS first FROM (SELECT 'default' AS subset, id FROM v UNION ALL SELECT _batch, id FROM v) GROUP BY 1""")
def export_by_batch(spark, d):
    """SNK-06, SET-06, FLT-02, PRJ-01."""
    layer = Layer(annotations(spark, d), ["classifier_label"], F.col("classifier_label") != '"LABEL_0"')
    return export_rows(posts(spark, d), ["_batch"], by="_batch", layers=[layer]).groupBy("subset").agg(F.count("*").alias("n"), F.min("id").alias("first"))


@query("SELECT 'documents' AS kind, doc_id AS id, source, CAST(NULL AS VARCHAR) AS url FROM documents UNION ALL SELECT 'pages', page_id, NULL, url FROM pages")
def union_results(spark, d):
    """SET-04."""
    a = read(spark, d, "documents").select(F.lit("documents").alias("kind"), F.col("doc_id").alias("id"), "source")
    return a.unionByName(read(spark, d, "pages").select(F.lit("pages").alias("kind"), F.col("page_id").alias("id"), "url"), allowMissingColumns=True)


@query("""WITH r AS (SELECT source, doc_id, substr(text, 1, 60) AS text, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS pos FROM documents) SELECT source, doc_id, text, pos FROM r WHERE pos <= 3""")
def first_n_per_batch(spark, d):
    """WIN-10."""
    w = Window.partitionBy("source").orderBy("doc_id")
    rows = read(spark, d, "documents").withColumn("pos", F.row_number().over(w)).where("pos <= 3")
    return rows.select("source", "doc_id", F.substring("text", 1, 60).alias("text"), F.col("pos").cast("long"))


@query("""WITH s AS (SELECT label, count(*) AS size FROM embeddings GROUP BY 1) SELECT label, size, row_number() OVER (ORDER BY size DESC, label) AS place, CAST(sum(size) OVER (ORDER BY size DESC, label ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM s""")
def cumulative_sizes(spark, d):
    """WIN-11, SRT-02: over one row per cluster."""
    s = embedded(spark, d).groupBy("label").agg(F.count("*").alias("size"))
    w = Window.orderBy(F.desc("size"), "label")
    return s.select("label", "size", F.row_number().over(w).cast("long").alias("place"), F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running"))


@query("""WITH r AS (SELECT source, avg(quality) AS rate FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1) SELECT source, round(rate, 6) AS rate, row_number() OVER (ORDER BY rate DESC NULLS LAST, source) AS place FROM r""")
def rank_nulls_last(spark, d):
    """WIN-09."""
    r = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id", "left").groupBy("source").agg(F.avg("quality").alias("rate"))
    return r.select("source", F.round("rate", 6).alias("rate"), F.row_number().over(Window.orderBy(F.col("rate").desc_nulls_last(), "source")).cast("long").alias("place"))


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(spark, d):
    """Filter, projection and grouped sums at volume."""
    rows = read(spark, d, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz" if dict(read(spark, d, "lineitem").dtypes)["l_shipdate"] == "timestamp_ntz" else "timestamp"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.count("*").alias("n"))


@query("""SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' GROUP BY 1""")
def revenue_by_nation(spark, d):
    """A chain of equi joins."""
    t = lambda n: read(spark, d, n)
    places = t("nation").join(t("region").where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = t("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    sold = t("orders").join(buyers, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "n_name")
    return t("lineitem").join(sold, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("""WITH e AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, user_id FROM events)
SELECT day, event_type, CAST(grouping(day, event_type) AS INT) AS grouped, count(*) AS n, true AS who_close, true AS middle_close FROM e GROUP BY CUBE (day, event_type)""")
def daily_sketches(spark, d):
    """AGG-38: a cube over days and kinds from daily sketches that are stored once, in two steps; estimates against exact counts and ranks."""
    path = new_path(spark, "sketches")
    e = read(spark, d, "events").select(F.to_date("ts").cast("string").alias("day"), "event_type", "user_id", "value")
    last = e.agg(F.max("day")).first()[0]
    for rows in (e.where(F.col("day") < last), e):
        sketches.update_days(rows, path, "day", ["event_type"], "user_id", "value")
    columns = ["day", "event_type"]
    found = sketches.over_days(spark, path, "day", sketches.cube_of(columns), columns)
    exact = e.cube(*columns).agg(F.grouping_id(*columns).cast("int").alias("g"), F.count_distinct("user_id").alias("users"), *[F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY value)").alias(f"p{int(100 * q)}") for q in (0.4, 0.6)])
    same = found["day"].eqNullSafe(exact["day"]) & found["event_type"].eqNullSafe(exact["event_type"]) & (found["grouped"] == exact["g"])
    close = F.abs(F.col("who") - F.col("users")) <= 4 * sketches.ERROR * F.col("users") + 1
    return found.join(exact, same).select(found["day"], found["event_type"], "grouped", "n", close.alias("who_close"), F.col("q50").between(F.col("p40"), F.col("p60")).alias("middle_close"))
