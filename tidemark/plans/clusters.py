"""Vectors, neighbour graphs and clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.vectors import centroids, cosine
from tidemark.operators import cells, clustering, models, neighbours, sampling, sweep
from tidemark.plans.tables import embedded, read
from tidemark.storage import cut

QUERIES, ORACLE_SQL = {}, {}
EPS, MIN_SAMPLES, K = 0.35, 3, 5


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


SIMS = "e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings), sims AS (SELECT a.id AS src, b.id AS dst, round(list_cosine_similarity(a.v, b.v), 12) AS sim FROM e a JOIN e b ON a.id <> b.id)"
TOP = f"{SIMS}, knn AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY sim DESC, dst) AS rank FROM sims)"


def _rows(spark, d):
    return embedded(spark, d).select("id", "v")


@query(f"WITH {SIMS} SELECT src AS a, dst AS b, round(sim, 6) AS sim FROM sims WHERE src < dst AND sim >= {EPS}")
def cosine_pairs(spark, d):
    """MTH-01, JOIN-14: pairs of at least this similarity."""
    return neighbours.pairs_above(_rows(spark, d), EPS).select("a", "b", F.round("sim", 6).alias("sim"))


@query(f"WITH {TOP} SELECT src, dst, CAST(rank AS INT) AS rank, round(sim, 6) AS sim FROM knn WHERE rank <= {K}")
def knn_topk(spark, d):
    """JOIN-12, WIN-08, MTH-02."""
    return neighbours.nearest(_rows(spark, d), K).select("src", "dst", "rank", F.round("sim", 6).alias("sim"))


def components_sql(links: str) -> str:
    """Least reachable id of every node of `links` (a, b), both ways."""
    return f"""both_ways AS (SELECT a, b FROM {links} UNION SELECT b, a FROM {links}), reach AS (SELECT a AS id, a AS r FROM both_ways UNION SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a),
comp AS (SELECT id, min(r) AS cluster FROM reach GROUP BY 1)"""


@query(f"WITH RECURSIVE {TOP}, kept AS (SELECT src, dst, sim FROM knn WHERE rank <= 1), pair AS (SELECT least(src, dst) AS a, greatest(src, dst) AS b, count(*) AS n, max(sim) AS sim FROM kept GROUP BY 1, 2), links AS (SELECT a, b FROM pair WHERE sim > 0 OR (n = 2 AND sim <> 0)), {components_sql('links')} SELECT e.id, coalesce(cluster, e.id) AS cluster FROM e LEFT JOIN comp ON comp.id = e.id")
def knn_components(spark, d):
    """ML-01/02/03, JOIN-16: one neighbour kept of K."""
    rows = _rows(spark, d)
    return neighbours.with_components(rows, neighbours.knn_graph(rows, K, 0.9))


WIDTH = " QUALIFY row_number() OVER (PARTITION BY src ORDER BY sim DESC, dst) <= least(500, greatest(200, (SELECT count(*) FROM e) // 1000))"
DBSCAN = f"""WITH RECURSIVE {SIMS}, near AS (SELECT src, dst, sim FROM sims WHERE sim >= {EPS}{WIDTH}), core AS (SELECT src AS id FROM near GROUP BY 1 HAVING count(*) >= {MIN_SAMPLES}),
links AS (SELECT src AS a, dst AS b FROM near WHERE src IN (SELECT id FROM core) AND dst IN (SELECT id FROM core)), {components_sql('links')}, named AS (SELECT core.id, coalesce(cluster, core.id) AS cluster FROM core LEFT JOIN comp USING (id)),
border AS (SELECT src AS id, arg_max(cluster, (sim, -dst)) AS cluster FROM near JOIN named ON named.id = dst WHERE src NOT IN (SELECT id FROM core) GROUP BY 1)
SELECT id, cluster, true AS core FROM named UNION ALL SELECT id, cluster, false FROM border"""


@query(DBSCAN)
def dbscan_labels(spark, d):
    """ML-09, JOIN-14/15, MTH-03: with the usual width of the search."""
    return neighbours.dbscan(_rows(spark, d), EPS, MIN_SAMPLES, 1)


@query(DBSCAN.replace(WIDTH, ""))
def dbscan_indexed(spark, d):
    """ML-09/10: clusters of all neighbours, without a width, through an inverted file that visits all cells where any may be."""
    rows = _rows(spark, d)
    index = cells.fit(rows, MIN_SAMPLES, EPS, recall=1.0)
    return neighbours.dbscan(rows, EPS, MIN_SAMPLES, 1, index=index)


@query(f"WITH {TOP}, q AS (SELECT * FROM knn WHERE rank <= 10 AND src % 100 = 0) SELECT (SELECT count(*) FROM e) AS vectors, (SELECT count(*) FROM e WHERE id % 100 = 0) AS queries, count(*) AS neighbours, true AS reached FROM q")
def index_recall(spark, d):
    """ML-10: ten neighbours of every row whose id is divisible by 100, by the index and by exact blocks; reached if it finds 95 % of them."""
    rows = _rows(spark, d)
    asked = rows.where("id % 100 = 0")
    index = cells.fit(rows, 10, recall=0.99)
    exact, found = neighbours.meet(asked, rows, 10), cells.search(index, 10, queries=asked)
    both = exact.select("src", "dst").join(found.select("src", "dst", F.lit(1).alias("hit")), ["src", "dst"], "left").agg(F.count("*").alias("neighbours"), F.count("hit").alias("hits"))
    sizes = rows.agg(F.count("*").alias("vectors"), F.count_if(F.col("id") % 100 == 0).alias("queries"))
    return sizes.join(both).select("vectors", "queries", "neighbours", (F.col("hits") >= 0.95 * F.col("neighbours")).alias("reached"))


@query("WITH x AS (SELECT label, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), m AS (SELECT label, i, avg(x) AS m FROM x GROUP BY 1, 2) SELECT label, round(sqrt(sum(m * m)), 9) AS length, round(max(m) FILTER (i = 1), 9) AS first, (SELECT count(*) FROM embeddings e WHERE e.label = m.label) AS size FROM m GROUP BY 1")
def cluster_centroids(spark, d):
    """AGG-14, ML-13."""
    c = centroids(embedded(spark, d), "label", "v")
    return c.select("label", F.round(F.sqrt(F.aggregate("centroid", F.lit(0.0), lambda s, x: s + x * x)), 9).alias("length"), F.round(F.get("centroid", F.lit(0)), 9).alias("first"), "size")


CENTROIDS = "e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label AS cluster FROM embeddings), x AS (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e), c AS (SELECT cluster, list(m ORDER BY i) AS c FROM (SELECT cluster, i, avg(x) AS m FROM x GROUP BY 1, 2) GROUP BY 1)"


def _clustered(spark, d):
    return embedded(spark, d).select("id", "v", F.col("label").alias("cluster"))


@query(f"WITH {CENTROIDS}, f AS (SELECT cluster, id, round(1 - list_cosine_similarity(v, c), 9) AS far FROM e JOIN c USING (cluster)), r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY far, id) AS rank FROM f) SELECT cluster, id, round(far, 6) AS far, CAST(rank AS INT) AS rank FROM r WHERE rank <= 5")
def central_sample(spark, d):
    """WIN-07, SMP-08."""
    return clustering.central(_clustered(spark, d), 5).select("cluster", "id", F.round("far", 6).alias("far"), "rank")


@query(f"""WITH {CENTROIDS}, s AS (SELECT cluster, count(*) AS size FROM e GROUP BY 1), mean AS (SELECT avg(size) AS m FROM s), small AS (SELECT * FROM s, mean WHERE size < ceil(m)), large AS (SELECT * FROM s, mean WHERE size >= ceil(m)),
p AS (SELECT small.cluster, small.size, large.cluster AS other, round(list_cosine_similarity(a.c, b.c), 9) AS sim FROM small JOIN c a ON a.cluster = small.cluster, large JOIN c b ON b.cluster = large.cluster)
SELECT cluster, size, round(max(sim), 6) AS max_sim, arg_max(other, (sim, -other)) AS nearest FROM p GROUP BY 1, 2""")
def nearest_large_cluster(spark, d):
    """JOIN-13, ML-05/08/17: clusters below the mean size."""
    rows = _clustered(spark, d)
    mean = rows.groupBy("cluster").count().agg(F.ceil(F.avg("count"))).first()[0]
    m = clustering.small_cluster_matches(rows, mean)
    return m.select("cluster", "size", F.round("max_sim", 6).alias("max_sim"), "nearest")


SIMHASH = """w AS (SELECT doc_id, unnest(list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')) AS w FROM documents),
bits AS (SELECT doc_id, i, sum(CASE WHEN (('0x' || substr(md5(w), 1, 4))::INT >> (16 - i)) & 1 = 1 THEN 1 ELSE -1 END) AS s FROM w, generate_series(1, 16) t(i) GROUP BY 1, 2),
hashed AS (SELECT d.doc_id, coalesce(sum(CASE WHEN s > 0 THEN 1 << (16 - i) ELSE 0 END), 0) AS bucket FROM documents d LEFT JOIN bits USING (doc_id) GROUP BY 1)"""


@query(f"""WITH {SIMHASH}, {CENTROIDS.replace('SELECT vec_id AS id, embedding::DOUBLE[] AS v, label AS cluster FROM embeddings', "SELECT vec_id AS id, embedding::DOUBLE[] AS v, CAST(regexp_extract(source, '([0-9]+)', 1) AS INT) AS cluster FROM embeddings JOIN documents ON doc_id = vec_id")},
f AS (SELECT id, cluster, bucket, round(1 - list_cosine_similarity(v, c), 9) AS far FROM e JOIN c USING (cluster) JOIN hashed ON doc_id = id),
r AS (SELECT *, row_number() OVER (PARTITION BY cluster, bucket ORDER BY far, id) AS r FROM f) SELECT id, cluster FROM r WHERE r = 1""")
def simhash_dedup(spark, d):
    """STR-12, WIN-06, ML-12: one row per source and simhash bucket, the vector nearest to its source's centroid."""
    docs = read(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "source")
    rows = docs.join(_rows(spark, d), "id").select("id", F.regexp_extract("source", r"(\d+)", 1).cast("int").alias("cluster"), "v", "text")
    return clustering.drop_near_copies(rows).select("id", "cluster")


SMALL_SQL = f"""{CENTROIDS}, s AS (SELECT cluster, count(*) AS size, list_aggregate(list_sort(list(id)), 'string_agg', ',') AS ids FROM e GROUP BY 1), mean AS (SELECT ceil(avg(size)) AS m FROM s),
p AS (SELECT small.cluster, small.size, small.ids, large.cluster AS other, large.size AS other_size, round(list_cosine_similarity(a.c, b.c), 9) AS sim FROM s small JOIN c a ON a.cluster = small.cluster, s large JOIN c b ON b.cluster = large.cluster, mean WHERE small.size < m AND large.size >= m),
best AS (SELECT cluster, size, ids, max(sim) AS max_sim, arg_max(other, (sim, -other)) AS nearest, arg_max(other_size, (sim, -other)) AS nearest_size FROM p GROUP BY 1, 2, 3)"""


@query(f"""WITH {SMALL_SQL}, t AS (SELECT median(max_sim) AS t FROM best)
SELECT (SELECT count(*) FROM s) AS n_before, (SELECT count(*) FROM best) AS n_small, (SELECT count(*) FROM best, t WHERE max_sim < t) AS n_dropped, (SELECT count(*) FROM s, mean WHERE size >= m) AS n_after, cluster, size, round(max_sim, 6) AS max_sim, nearest, nearest_size, ids FROM best""")
def clustering_diagnostics(spark, d):
    """ML-08, ML-05: clusters below the mean size with their nearest large one and their rows, and how many clusters stay when half of them go."""
    rows = _clustered(spark, d).withColumn("cluster", F.col("cluster").cast("long"))
    mean = rows.groupBy("cluster").count().agg(F.ceil(F.avg("count"))).first()[0]
    small, _ = cut(clustering.small_clusters(rows, mean or 0), "small")
    middle = small.agg(F.median("max_sim")).first()[0]
    merged = clustering.merge_small(rows, mean or 0, middle or 0.0)
    counts = rows.agg(F.count_distinct("cluster").alias("n_before")).join(small.agg(F.count("*").alias("n_small"), F.count_if(F.col("max_sim") < middle).alias("n_dropped"))).join(merged.agg(F.count_distinct("cluster").alias("n_after")))  # one row each
    return counts.join(small).select("n_before", "n_small", "n_dropped", "n_after", F.col("cluster").cast("int").alias("cluster"), "size", F.round("max_sim", 6).alias("max_sim"), F.col("nearest").cast("int").alias("nearest"), "nearest_size", F.array_join("ids", ",").alias("ids"))


@query(f"""WITH {CENTROIDS}, f AS (SELECT id, round(list_cosine_similarity(v, c), 9) AS sim FROM e JOIN c USING (cluster)), n AS (SELECT id, sim, sim < 0.3 AS below FROM f WHERE abs(sim - 0.3) <= 0.05),
k AS (SELECT count(*) FILTER (below) AS b, count(*) FILTER (NOT below) AS a FROM n), t AS (SELECT least(b, 40 - least(a, 20)) AS low, a FROM k), r AS (SELECT *, row_number() OVER (PARTITION BY below ORDER BY md5('18|' || id), id) AS r FROM n)
SELECT id, round(sim, 6) AS sim FROM r, t WHERE r <= CASE WHEN below THEN low ELSE least(a, 40 - low) END""")
def boundary_sample(spark, d):
    """SMP-07: forty vectors whose similarity to their centroid is near a threshold, half below it."""
    rows = _clustered(spark, d)
    near = rows.join(centroids(rows, "cluster", "v").select("cluster", "centroid"), "cluster").select("id", F.round(cosine(F.col("v"), F.col("centroid")), 9).alias("sim"))
    return sampling.boundary(near, "id", "sim", 0.3, 40).select("id", F.round("sim", 6).alias("sim"))


@query("""WITH c AS (SELECT conv_id, count(*) AS n FROM conversations WHERE length(trim(text)) > 0 GROUP BY 1), b AS (SELECT *, CASE WHEN n <= 4 THEN 0 WHEN n < 10 THEN 1 ELSE 2 END AS bin FROM c),
s AS (SELECT bin, count(*) AS size, least(count(*), greatest(1, round_even(40.0 * count(*) / (SELECT count(*) FROM b), 0))) AS wish FROM b GROUP BY 1), w AS (SELECT *, sum(wish) OVER (ORDER BY bin) AS upto FROM s),
g AS (SELECT bin, size, least(upto, 40) - least(upto - wish, 40) AS given FROM w), x AS (SELECT *, sum(size - given) OVER (ORDER BY size DESC, bin) AS spare, 40 - sum(given) OVER () AS rest FROM g),
t AS (SELECT bin, CASE WHEN (SELECT count(*) FROM b) <= 40 THEN size ELSE given + least(spare, rest) - least(spare - (size - given), rest) END AS take FROM x),
r AS (SELECT conv_id, n, bin, row_number() OVER (PARTITION BY bin ORDER BY md5('42|' || conv_id), conv_id) AS r FROM b) SELECT conv_id, least(n, 6) AS n FROM r JOIN t USING (bin) WHERE r <= take""")
def sampled_clusters(spark, d):
    """SMP-06: forty conversations as clusters of texts over three bins of size, with six texts at most."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"])
    c = read(spark, d, "conversations").groupBy("conv_id").agg(texts.alias("texts"))
    return sampling.sample_clusters(c, "conv_id", "texts", 40, 2, most_texts=6).select("conv_id", F.size("texts").cast("long").alias("n"))


@query()
def kmeans_clusters(spark, d):
    """ML-11, MTH-03."""
    return clustering.cluster_kmeans(_rows(spark, d))


@query()
def diverse_sample(spark, d):
    """WIN-14, SMP-08, SET-03."""
    return clustering.diverse(_clustered(spark, d), 5)


@query()
def cluster_pipeline(spark, d):
    """ML-04/05/06/07: neighbour graph, splitting, merging of small and of similar clusters."""
    return clustering.cluster_knn_graph(_rows(spark, d), drop_frac=0.9, min_size=5, max_size=60, outlier_threshold=0.2, merge_threshold=0.6)


@query()
def day_clusters(spark, d):
    """ML-14: density clusters of each day, near copies dropped, sampled and written by day. The day of a batch comes from its number."""
    number = F.regexp_extract("source", r"(\d+)", 1).try_cast("int")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.coalesce(number, F.lit(0)) % 2).alias("day")
    docs = read(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", day)
    return sweep.day_clusters(docs.join(_rows(spark, d), "id"), EPS, MIN_SAMPLES, MIN_SAMPLES)


@query()
def parameter_sweep(spark, d):
    """ML-15, AGG-33: clusters by k and drop_frac from one neighbour table at the largest k."""
    return sweep.cluster_counts(_rows(spark, d), (2, 3, 5, 10, 15, 20, 30), (0.0, 0.5, 0.8, 0.9, 0.95))


@query()
def judged_sweep(spark, d):
    """ML-16, UDF-07: drop_frac, min_size and threshold by the stand-in's verdicts on sampled clusters, all rows as one day."""
    docs = read(spark, d, "documents").select(F.col("doc_id").alias("id"), F.when(F.trim("text") != "", "text").alias("text"))  # texts stay out of the join
    rows = _rows(spark, d).join(docs, "id", "left")
    return sweep.judged_sweep(rows, (0.0, 0.5, 0.8, 0.9, 0.95, 0.99), (2, 3, 5, 10), (0.0, 0.2))


CLAIMS = """WITH c AS (SELECT conv_id, list(text ORDER BY turn, text) AS texts FROM conversations GROUP BY 1), e AS (SELECT conv_id, texts, unnest(range(0, least(2, len(texts)))) AS i FROM c)
SELECT conv_id, CAST(i AS INT) AS claim_no, 'Claim ' || array_to_string(regexp_extract_all(string_split(texts[i + 1], chr(10))[1], '[a-zA-Z]+')[1:6], ' ') AS claim, 1 AS post_count, md5(texts[i + 1]) AS texts, true AS is_relevant FROM e"""


@query(CLAIMS)
def claims(spark, d):
    """UDF-05, STR-05, SRT-06: claims of every conversation by the stand-in model; places that are out of range are left out."""
    texts = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"])
    c = read(spark, d, "conversations").groupBy("conv_id").agg(texts.alias("texts"))
    found = models.extract_claims(c, "conv_id", "texts", models.first_sentences)
    return found.select("conv_id", "claim_no", "claim", "post_count", F.md5(F.array_join("original_texts", "|").cast("binary")).alias("texts"), "is_relevant")


@query(CLAIMS)
def claims_by_function(spark, d):
    """UDF-05 as a table function over the conversations as partitions, in the order of their turns."""
    rows = read(spark, d, "conversations").select("conv_id", "turn", "text")
    found = models.claims_function("conv_id", "text", models.first_sentences)(rows.asTable().partitionBy("conv_id").orderBy("turn", "text"))
    return found.select("conv_id", "claim_no", "claim", "post_count", F.md5(F.array_join("original_texts", "|").cast("binary")).alias("texts"), F.lit(True).alias("is_relevant"))


@query()
def double_clustering(spark, d):
    """UDF-06, AGG-13: claims embedded by the stand-in, clustered again, with posts and claims of each meta-cluster."""
    from pyspark.sql import types as T

    from tidemark.storage import cut

    found = claims(spark, d).withColumn("id", F.xxhash64("conv_id", "claim_no"))
    rows, _ = cut(models.annotate(found.select("id", "claim", "post_count"), "claim", models.hashed_embedder, "v", T.ArrayType(T.DoubleType())), "claims")
    named = clustering.cluster_knn_graph(rows.select("id", "v"), k=10, drop_frac=0.9)
    both = rows.select("id", "claim", "post_count").join(named, "id")
    stacked = clustering.stack(both, "cluster", "id")
    return stacked.select("cluster", F.col("cluster_size").alias("num_claims"), F.aggregate("post_counts", F.lit(0).cast("long"), lambda s, x: s + x).alias("total_post_count"), F.array_join("claims", " | ").alias("claims"))


@query("SELECT item_id, CAST(r AS INT) AS run, ('0x' || substr(md5(text || ' #' || r), 1, 2))::INT % 3 AS verdict FROM benchmark, generate_series(0, 2) t(r)")
def judged_texts(spark, d):
    """UDF-01/08/13, STR-02: repeated verdicts of the stand-in judge on the benchmark."""
    from pyspark.sql import types as T

    from tidemark.functions.parse import verdict_012

    asked = models.repeat_runs(read(spark, d, "benchmark"), 3).withColumn("prompt", F.concat("text", F.lit(" #"), F.col("run").cast("string")))
    return models.annotate(asked, "prompt", models.hashed_judge, "answer", T.StringType()).select("item_id", "run", verdict_012(F.col("answer")).alias("verdict"))


@query(f"WITH {SIMS} SELECT count(*) AS n, round(max(sim), 6) AS most FROM sims WHERE src < dst")
def similarity_summary(spark, d):
    """MTH-01 over all pairs, block by block; only sums leave a block."""
    rows = _rows(spark, d)
    best = neighbours.nearest(rows, 1).agg(F.max("sim").alias("m"))
    n = rows.count()
    return best.select(F.lit(n * (n - 1) // 2).cast("long").alias("n"), F.round("m", 6).alias("most"))
