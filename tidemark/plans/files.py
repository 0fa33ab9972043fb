"""Sources and sinks: everything here is written to the shared folder and read back by the reader that belongs to it."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.parse import verdict_012
from tidemark.operators import clustering, evaluation, models, sampling
from tidemark.operators.views import EXPORTS, Layer, export_mode, export_view
from tidemark.plans.clusters import SMALL_SQL
from tidemark.plans.relational import first_n_per_batch, stratified_split, text_lookup_left
from tidemark.plans.tables import ANN, REACTIONS, annotations, embedded, reactions, read, runs, runs_sql
from tidemark.sources import batches, files
from tidemark.storage import new_path, remove, write_one, write_table

QUERIES, ORACLE_SQL = {}, {}
BATCH = "'b' || (doc_id % 4)"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _batch():
    return F.concat(F.lit("b"), (F.col("doc_id") % 4).cast("string")).alias("_batch")


@query("SELECT 'https://x.com/' || source || '/status/' || doc_id AS uri, nullif(text, '') AS text, CAST(doc_id AS VARCHAR) AS raw_id FROM documents")
def csv_posts(spark, d):
    """SRC-04."""
    path = new_path(spark, "csv")
    rows = read(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("username"), "text")
    rows.write.options(header="true", escape='"', quoteAll="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)
    return files.posts_from_csv(spark, path).select("uri", "text", F.get_json_object("raw", "$.id").alias("raw_id"))


@query(f"WITH {REACTIONS} SELECT CAST(subject AS VARCHAR) AS subject_uri, kind AS event_type, count(*) AS n, min(time_us) AS first FROM reactions GROUP BY 1, 2")
def json_reactions(spark, d):
    """SRC-05."""
    path = new_path(spark, "reactions")
    r = reactions(spark, d).select(F.col("subject").cast("string").alias("subject_uri"), F.col("kind").alias("event_type"), F.col("actor").cast("string").alias("actor_did"), "time_us")
    files.write_json(r, path, 100_000)
    return files.reactions_from_json(spark, path).groupBy("subject_uri", "event_type").agg(F.count("*").alias("n"), F.min("time_us").alias("first"))


@query(f"WITH {ANN} SELECT {BATCH} AS _batch, classifier_label, count(*) AS n, min(doc_id) AS first FROM documents JOIN ann ON id = doc_id GROUP BY 1, 2")
def layered_files(spark, d):
    """SRC-07/09/10: posts and an annotation layer as files of batches, read by name and joined by id."""
    root = new_path(spark, "datasets")
    posts = read(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", _batch())
    names = files.write_batches(posts, root, "posts")
    layer = read(spark, d, "labels").select("doc_id", _batch()).join(annotations(spark, d).withColumnRenamed("id", "doc_id"), "doc_id").select(F.col("doc_id").alias("id"), "classifier_label", "_batch")
    files.write_batches(layer, root, "posts", "judge")
    base = files.dataset(spark, root, "posts", names)
    view = export_view(base, [Layer(files.dataset(spark, root, "posts", annotator="judge"), ["classifier_label"])], ["_batch"])
    return view.groupBy("_batch", "classifier_label").agg(F.count("*").alias("n"), F.min("id").alias("first"))


@query(f"SELECT {BATCH} AS run_id, true AS completed, count(*) AS lines, count(*) OVER () AS manifests, count(*) OVER () AS n_completed FROM documents WHERE doc_id % 4 <> 3 GROUP BY 1")
def published_days(spark, d):
    """SNK-05, SRC-13, AGG-37: finished folders go out with their manifests, an unfinished one does not; lines of the chunks by folder, and
    what all manifests sum to. Files are copied by tasks."""
    source, target = new_path(spark, "days"), new_path(spark, "published")
    rows = read(spark, d, "documents").select("doc_id", "source", _batch())
    for k in range(4):
        files.write_json(rows.where(F.col("_batch") == f"b{k}"), f"{source}/b{k}", 100_000)
    remove(spark, f"{source}/b3/_SUCCESS")
    files.publish(spark, source, target)
    manifests = files.publish(spark, source, target)  # nothing is left to do
    chunks = files.line_counts(spark, f"{target}/*/chunk-*.jsonl").groupBy(F.substring_index("file", "/", 1).alias("run_id")).agg(F.count("*").alias("chunk_count"), F.sum("lines").alias("lines"))
    totals = files.manifest_totals(spark, f"{target}/*/run_manifest.json").select("manifests", F.col("completed").alias("n_completed"))  # one row
    return manifests.join(chunks, ["run_id", "chunk_count"]).join(totals).select("run_id", "completed", "lines", "manifests", "n_completed")


@query("""WITH l AS (SELECT doc_id, text, quality FROM documents LEFT JOIN labels USING (doc_id))
SELECT CASE WHEN doc_id % 2 = 0 THEN CASE WHEN quality = 1 THEN true END ELSE quality = 1 END AS veracity, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM l GROUP BY 1""")
def split_loader(spark, d):
    """SRC-14, PRJ-08, STR-07: files of a split whose schemas don't agree, `veracity` once as text and once as boolean."""
    root = new_path(spark, "hub")
    rows = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id", "left")
    even, odd = rows.where("doc_id % 2 = 0"), rows.where("doc_id % 2 = 1")
    write_table(even.select("text", F.when(F.col("quality") == 1, " True").otherwise("unknown").alias("veracity")), f"{root}/data/en/train-0.parquet")
    write_table(odd.select(F.col("text").alias("title"), F.col("text"), (F.col("quality") == 1).alias("veracity"), "doc_id"), f"{root}/data/en/train-1.parquet")
    write_one(rows.select(F.lit("other split").alias("text")).limit(1), f"{root}/data/en/test-0.parquet")
    write_one(rows.select(F.lit("other subset").alias("text")).limit(1), f"{root}/data/de/train-0.parquet")
    return files.load_split(spark, root, "en", "train").groupBy("veracity").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@query("SELECT CAST(NULL AS BOOLEAN) AS veracity, count(*) AS n FROM documents WHERE doc_id % 2 = 1")
def best_split(spark, d):
    """SRC-15: only the best file is read; without a veracity column there is no truth."""
    root = new_path(spark, "hub")
    rows = read(spark, d, "documents").select(F.col("text").alias("statement"), "doc_id")
    write_table(rows.where("doc_id % 2 = 0"), f"{root}/data/a-train.parquet")
    write_table(rows.where("doc_id % 2 = 1"), f"{root}/data/b-test.parquet")
    found = files.texts_of(files.read_files(spark, [f"{root}/{files.best_file(spark, root, None)}"]))
    return found.groupBy("veracity").agg(F.count("*").alias("n"))


@query(f"""WITH {runs_sql('s', 3)}, n AS (SELECT max(doc_id) + 1 AS n FROM labels), every AS (SELECT CAST(e AS INT) AS ex_idx, CAST(r AS INT) AS run FROM n, generate_series(0, n - 1) t(e), generate_series(0, 2) u(r))
SELECT every.ex_idx, every.run, CASE WHEN s.ex_idx % 7 <> 0 THEN validity END AS validity FROM every LEFT JOIN s ON s.ex_idx = every.ex_idx AND s.run = every.run""")
def missing_results(spark, d):
    """SRC-16: runs from JSON results; examples without a file have null verdicts."""
    path = new_path(spark, "results")
    rows = runs(spark, d, "s", 3)
    each = F.struct("run", "validity", F.lit("x").alias("explanation"), F.col("calls").alias("n_search_calls"))
    listed = rows.where("ex_idx % 7 <> 0").groupBy(F.col("ex_idx").alias("example_idx")).agg(F.array_sort(F.collect_list(each)).alias("runs"))
    files.write_json(listed.withColumn("pseudo_label", F.lit(True)), path, 1000)
    n = rows.agg(F.max("ex_idx")).first()[0]
    return files.complete_runs(files.example_runs(spark, path, one_each=False), (n if n is not None else -1) + 1, 3)


@query("""WITH s AS (SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1) SELECT source, n FROM s UNION ALL SELECT source || '+', -n FROM s WHERE n % 2 = 0""")
def merged_results(spark, d):
    """SRC-18: results that are one object or a list of them, each in a folder of its own."""
    path = new_path(spark, "merged")
    s = read(spark, d, "documents").where("source is not null").groupBy("source").agg(F.count("*").alias("n"))
    one, two = F.struct("source", "n"), F.struct(F.concat("source", F.lit("+")).alias("source"), (-F.col("n")).alias("n"))
    s.select(F.when(F.col("n") % 2 == 0, F.to_json(F.array(one, two))).otherwise(F.to_json(one)).alias("value"), F.col("source").alias("sub")).write.partitionBy("sub").text(path)
    return files.merged_results(spark, path, "source string, n long").select("source", "n")


@query("SELECT source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1")
def compacted_chunks(spark, d):
    """SNK-02: JSON chunks to one Parquet file."""
    chunks, target = new_path(spark, "chunks"), new_path(spark, "compact")
    files.write_json(read(spark, d, "documents").select("doc_id", "source", "n_chars"), chunks, 100)
    files.merge_chunks(spark, chunks, target, "doc_id long, source string, n_chars long")
    return spark.read.parquet(target).groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query(f"SELECT doc_id AS id, {BATCH} AS _batch, CASE WHEN regexp_matches(text, '\\S') THEN ('0x' || substr(md5(text), 1, 2))::INT % 3 END AS verdict FROM documents")
def resumed_annotations(spark, d):
    """SNK-03: two batches, then a run that goes on with the others, then one that finds nothing to do; each run is one job and commits a manifest."""
    path = new_path(spark, "annotated")
    view = read(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", _batch())
    done = [models.annotate_batches(view, path, "text", models.hashed_judge, "answer", T.StringType(), most) for most in (2, None, None)]
    if done[2] or done[0] > 2:
        raise AssertionError(f"batches written: {done}")
    return batches.read_runs(spark, path).select("id", "_batch", verdict_012(F.col("answer")).alias("verdict"))


@query(f"SELECT _batch AS batch, count(*) AS annotated, CAST(ceil(count(*) / 50.0) AS BIGINT) > 0 AS chunked, 1 AS runs FROM (SELECT {BATCH} AS _batch FROM documents) GROUP BY 1")
def manifest_sums(spark, d):
    """AGG-37, SRC-13: rows, files and runs of each batch by the manifests of two committed runs."""
    path = new_path(spark, "annotated")
    view = read(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", _batch())
    for most in (1, None):
        models.annotate_batches(view, path, "text", models.hashed_judge, "answer", T.StringType(), most, 50)
    found = batches.manifests(spark, path).groupBy("batch")
    return found.agg(F.sum("rows").alias("annotated"), (F.count_distinct("file") > 0).alias("chunked"), F.count_distinct("run_id").cast("int").alias("runs"))


@query("SELECT label AS id, to_json(list(vec_id ORDER BY vec_id)) AS ids, '\"c' || label || '\"' AS name FROM embeddings GROUP BY label")
def cluster_chunks(spark, d):
    """SNK-04: clusters as JSON chunks with values JSON-encoded."""
    path = new_path(spark, "clusters")
    c = read(spark, d, "embeddings").groupBy(F.col("label").alias("id")).agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    files.write_json(files.encode_columns(c.withColumn("name", F.concat(F.lit("c"), F.col("id").cast("string")))), path)
    return spark.read.schema("id long, ids string, name string").json(path)


@query(f"WITH {ANN} SELECT classifier_label, count(*) AS n, count(text) AS texts, min(uri) AS first FROM (SELECT CAST(doc_id AS VARCHAR) AS uri, text, classifier_label FROM documents JOIN ann ON id = doc_id WHERE classifier_label = '\"LABEL_1\"') GROUP BY 1")
def export_hits(spark, d):
    """SNK-06, FLT-02: the export mode of classifier hits over a dataset of files."""
    root = new_path(spark, "datasets")
    uri = F.col("doc_id").cast("string")
    posts = read(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", uri.alias("uri"), uri.alias("at_uri"), F.lit("2024-01-01").alias("created_at"), _batch())
    files.write_batches(posts, root, "posts")
    layer = annotations(spark, d).withColumn("classifier_probs", F.lit("[]")).withColumn("_batch", F.concat(F.lit("b"), (F.col("id") % 4).cast("string")))
    files.write_batches(layer, root, "posts", "classifier")
    target = new_path(spark, "export")
    export_mode(spark, root, "classifier_hits", "posts", target, annotator="classifier")
    return spark.read.parquet(target).groupBy("classifier_label").agg(F.count("*").alias("n"), F.count("text").alias("texts"), F.min("uri").alias("first"))


@query("""WITH c AS (SELECT 'd' || (doc_id % 3) AS date, doc_id FROM documents) SELECT subset, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM (SELECT 'default' AS subset, doc_id FROM c UNION ALL SELECT date, doc_id FROM c) GROUP BY 1""")
def export_dates(spark, d):
    """SNK-06: the export mode of summarised clusters, one subset for each date and one of all."""
    root, target = new_path(spark, "datasets"), new_path(spark, "export")
    date = F.concat(F.lit("d"), (F.col("doc_id") % 3).cast("string"))
    rows = read(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("claim"), F.col("source").alias("cluster_id"), date.alias("date"), F.lit("[]").alias("diverse_sample_ids"), F.lit(2).alias("post_count"), F.lit("[]").alias("original_texts"), _batch())
    files.write_batches(rows, root, "summaries")
    export_mode(spark, root, "clusters_summarized", "summaries", target)
    return spark.read.parquet(target).groupBy("subset").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query(f"WITH {ANN} SELECT source, CAST(count(*) AS VARCHAR) AS total, printf('%.2f', round(100.0 * count(*) FILTER (classifier_label = '\"LABEL_2\"') / count(*), 2)) AS pct FROM documents JOIN ann ON id = doc_id GROUP BY 1")
def stats_csv(spark, d):
    """SNK-07: shares with two digits in a CSV file."""
    path = new_path(spark, "stats")
    rows = read(spark, d, "documents").withColumnRenamed("doc_id", "id").join(annotations(spark, d), "id").groupBy("source").agg(F.count("*").alias("total"), F.count_if(F.col("classifier_label") == '"LABEL_2"').alias("hits"))
    files.write_csv(rows.select("source", "total", F.format_string("%.2f", F.round(100.0 * F.col("hits") / F.col("total"), 2)).alias("pct")), path)
    return spark.read.csv(path, header=True)


@query(f"WITH {REACTIONS}, m AS (SELECT subject, count(*) AS n FROM reactions GROUP BY 1) SELECT subject, n, text, text IS NOT NULL AS named FROM m LEFT JOIN benchmark ON item_id = subject")
def metrics_json(spark, d):
    """SNK-08, JOIN-04: `text` is left out of a line that has none."""
    path = new_path(spark, "metrics")
    files.write_json(text_lookup_left(spark, d), path, 100_000)
    return spark.read.text(path).select(F.from_json("value", "subject long, n long, text string").alias("j"), F.contains("value", F.lit('"text":')).alias("named")).select("j.*", "named")


@query("""WITH r AS (SELECT doc_id, quality, (row_number() OVER (PARTITION BY quality ORDER BY md5('5|' || doc_id), doc_id) - 1) / (count(*) OVER (PARTITION BY quality))::DOUBLE AS p FROM labels)
SELECT CASE WHEN p < 0.8 THEN 'train' WHEN p < 0.9 THEN 'val' ELSE 'test' END AS split, quality, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS ids FROM r GROUP BY 1, 2""")
def split_files(spark, d):
    """SNK-09: one folder for each part of a stratified split."""
    path = new_path(spark, "splits")
    stratified_split(spark, d).write.partitionBy("split").json(path)
    back = spark.read.schema("doc_id long, quality long, split string").json(path)
    return back.groupBy("split", "quality").agg(F.count("*").alias("n"), F.sum("doc_id").alias("ids"))


@query("""WITH r AS (SELECT source, doc_id, substr(text, 1, 60) AS text, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS pos FROM documents) SELECT source, doc_id, text, pos FROM r WHERE pos <= 3""")
def sample_json(spark, d):
    """SNK-10, WIN-10: the first rows of every batch as JSON."""
    path = new_path(spark, "samples")
    files.write_json(first_n_per_batch(spark, d), path)
    return spark.read.schema("source string, doc_id long, text string, pos long").json(path)


@query("""WITH c AS (SELECT source, list(md5(text)) AS t, count(*) AS size, row_number() OVER (ORDER BY count(*) DESC, source) - 1 AS p FROM documents WHERE text IS NOT NULL GROUP BY 1)
SELECT line, count(*) AS n FROM (SELECT '=== Cluster ' || p || ' (size: ' || size || ') ===' AS line FROM c UNION ALL SELECT '  ' || unnest(t) FROM c UNION ALL SELECT '' FROM c) GROUP BY 1""")
def cluster_dump(spark, d):
    """SNK-11: clusters as blocks of text."""
    path = new_path(spark, "dump")
    c = read(spark, d, "documents").where("text is not null").groupBy(F.col("source").alias("cluster")).agg(F.collect_list(F.md5(F.col("text").cast("binary"))).alias("texts"))
    files.write_dump(c, path)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


@query(f"""WITH {SMALL_SQL}, r AS (SELECT cluster, id, row_number() OVER (PARTITION BY cluster ORDER BY id) AS p FROM e)
SELECT b.cluster, size, round(max_sim, 6) AS max_sim, row_number() OVER (ORDER BY max_sim, b.cluster) - 1 AS rank, list_aggregate(list_sort(list(id)), 'string_agg', ',') AS ids FROM best b JOIN r ON r.cluster = b.cluster AND p <= 5 GROUP BY b.cluster, size, max_sim""")
def outlier_candidates(spark, d):
    """SNK-12, ML-17: clusters below the mean size by their similarity to the nearest large one, with their first texts, worst first, as JSON."""
    path = new_path(spark, "candidates")
    rows = embedded(spark, d).select("id", "v", F.col("label").cast("long").alias("cluster"))
    mean = rows.groupBy("cluster").count().agg(F.ceil(F.avg("count"))).first()[0]
    sims = clustering.small_cluster_matches(rows, mean or 0).select("cluster", "size", "max_sim")
    files.write_json(evaluation.outlier_candidates(sims, rows.select("cluster", "id", F.col("id").cast("string").alias("text")), "cluster", 5), path)
    back = spark.read.schema("cluster int, size long, max_sim double, rank long, texts array<string>").json(path)
    return back.select("cluster", "size", F.round("max_sim", 6).alias("max_sim"), "rank", F.array_join("texts", ",").alias("ids"))


@query("SELECT source, count(*) AS n FROM documents GROUP BY 1")
def cached_sweep(spark, d):
    """SNK-13: a table of counts is made once, read again, and made anew when asked."""
    path = new_path(spark, "sweep")
    counts = read(spark, d, "documents").groupBy("source")
    files.cached(spark, path, lambda: counts.agg(F.max("doc_id").alias("n")))
    if files.cached(spark, path, lambda: counts.agg(F.lit(-1).alias("n"))).where("n < 0").limit(1).count():
        raise AssertionError("made again without being asked")
    return files.cached(spark, path, lambda: counts.agg(F.count("*").alias("n")), regenerate=True).select("source", "n")


@query("SELECT mode, len AS n_columns, (SELECT count(*) FROM documents) AS n_rows FROM (VALUES ('classifier_hits', 4), ('raw_clusters', 3), ('clustered', 6), ('embedded_claims', 7), ('clusters_summarized', 7), ('clusters_summarized_kmeans', 7), ('meta_clusters', 4), ('double_summarized', 6)) v(mode, len)")
def export_modes(spark, d):
    """SNK-06: the named exports, and how many posts each would look at."""
    modes = spark.createDataFrame([(k, len(v["columns"])) for k, v in EXPORTS.items()], "mode string, n_columns int")
    return modes.join(read(spark, d, "documents").agg(F.count("*").alias("n_rows")))  # one row


@query("WITH e AS (SELECT CAST(ts AS DATE) AS day, event_id FROM events), f AS (SELECT DISTINCT day FROM e ORDER BY day LIMIT 3) SELECT CAST(day AS VARCHAR) AS day, count(*) AS n FROM e WHERE day IN (SELECT day FROM f) GROUP BY 1")
def first_days(spark, d):
    """SRT-04: a limit on days that have rows."""
    e = read(spark, d, "events").select(F.to_date("ts").alias("day"), "event_id")
    return sampling.first_days(e, "day", 3).groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN label < 5 THEN 'mon' ELSE 'tue' END AS day, label AS cluster, count(*) AS n FROM embeddings GROUP BY 1, 2")
def union_days(spark, d):
    """SET-05: clusters of several days under one another."""
    c = read(spark, d, "embeddings").groupBy(F.col("label").alias("cluster")).agg(F.count("*").alias("n"))
    return sampling.union_days({"mon": c.where("cluster < 5"), "tue": c.where("cluster >= 5")}).select("day", "cluster", "n")
