"""Model calls through their stand-ins, and the filters and reports around them."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import parse, vectors
from tidemark.operators import classifier, evaluation, models
from tidemark.operators.sampling import split
from tidemark.plans.tables import read, runs, runs_sql
from tidemark.storage import cut

QUERIES, ORACLE_SQL = {}, {}
#: The first byte of a digest of `x`, as SQL.
BYTE = "('0x' || substr(md5({x}), {at}, 2))::INT"
KNOWN = ["red widget", "Blue Gear", "old_ring", "(hot) rod", "plate", "a small bolt or two", "new anvil"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _bytes(x: str) -> str:
    return ", ".join(f"{BYTE.format(x=x, at=2 * i + 1)} + 1 AS b{i}" for i in range(3))


@query(f"SELECT item_id, CASE WHEN length(trim(text)) > 0 THEN 'stand-in ' ELSE 'empty text' END AS explanation, CASE WHEN length(trim(text)) > 0 THEN {BYTE.format(x='text', at=1)} % 3 END AS label FROM (SELECT item_id, CASE WHEN item_id % 10 = 0 THEN '' ELSE text END AS text FROM benchmark)")
def feasibility(spark, d):
    """UDF-01: explanation and label of the judge; empty texts are not sent."""
    rows = read(spark, d, "benchmark").select("item_id", F.when(F.col("item_id") % 10 == 0, "").otherwise(F.col("text")).alias("text"))
    return models.judge_feasibility(rows, "text", models.hashed_judge).drop("text")


@query(f"SELECT doc_id, CASE WHEN b0 >= b1 AND b0 >= b2 THEN 'LABEL_0' WHEN b1 >= b2 THEN 'LABEL_1' ELSE 'LABEL_2' END AS classifier_label, round(b0 / (b0 + b1 + b2)::DOUBLE, 9) AS p0, round(b2 / (b0 + b1 + b2)::DOUBLE, 9) AS p2 FROM (SELECT doc_id, {_bytes('text')} FROM documents WHERE regexp_matches(text, '\\S'))")
def classified(spark, d):
    """UDF-02: label and probabilities from the batch classifier."""
    rows = read(spark, d, "documents").where(F.col("text").rlike(r"\S")).select("doc_id", "text")
    found = models.annotate(rows, "text", models.retrying(models.hashed_classifier), "c", models.CLASSIFIED)
    return found.select("doc_id", "c.classifier_label", F.round(F.col("c.classifier_probs")[0], 9).alias("p0"), F.round(F.col("c.classifier_probs")[2], 9).alias("p2"))


@query("""SELECT doc_id, list_aggregate(list_sort(list_distinct(regexp_extract_all(text, '[A-Z][a-z]+'))), 'string_agg', ',') AS entities, list_aggregate(regexp_extract_all(text, '[a-zA-Z]+')[1:6], 'string_agg', ' ') AS summary FROM documents WHERE regexp_matches(text, '\\S')""")
def keywords(spark, d):
    """UDF-04, STR-05: entities and a summary from fenced answers."""
    rows = read(spark, d, "documents").where(F.col("text").rlike(r"\S")).select("doc_id", "text")
    found = models.extract_keywords(rows, "text", models.capital_words)
    empty = lambda c: F.when(c != "", c)
    return found.select("doc_id", empty(F.array_join("keywords.entities", ",")).alias("entities"), empty(F.col("keywords.summary")).alias("summary"))


AGENT = f"asked AS (SELECT item_id, CAST(r AS INT) AS run, {BYTE.format(x=chr(39).join(['text || ', ' #', ' || r']), at=1)} AS v, {BYTE.format(x=chr(39).join(['text || ', ' #', ' || r']), at=3)} AS c FROM (SELECT item_id, coalesce(text, '') AS text FROM benchmark), generate_series(0, 2) t(r))"


@query(f"WITH {AGENT} SELECT item_id, run, CASE WHEN v < 240 THEN CAST(v < 144 AS INT) END AS search, c % 16 AS n_search_calls, CASE WHEN v < 240 THEN CAST(v < 144 AS INT) END AS plain, 0 AS plain_calls FROM asked")
def agent_verdicts(spark, d):
    """UDF-09/10/12: verdicts of an agent with and without search, with the searches of each run."""
    from functools import partial

    rows = read(spark, d, "benchmark").select("item_id", "text")
    found = models.verdict_runs(rows, "text", models.hashed_agent, 3).select("item_id", "run", F.col("validity").alias("search"), "n_search_calls")
    plain = models.verdict_runs(rows, "text", partial(models.hashed_agent, searches=False), 3).select("item_id", "run", F.col("validity").alias("plain"), F.col("n_search_calls").alias("plain_calls"))
    return found.join(plain, ["item_id", "run"])


@query(f"WITH {AGENT} SELECT run, count(*) AS n, count(*) FILTER (v >= 240) AS failed, round(100.0 * avg(CASE WHEN v < 144 THEN 1 ELSE 0 END), 6) AS pct FROM asked GROUP BY 1")
def judge_rates(spark, d):
    """UDF-13, UDF-08: rates of a repeated judge where a failure counts as 0."""
    v = models.verdict_runs(read(spark, d, "benchmark").select("item_id", "text"), "text", models.hashed_agent, 3)
    return v.groupBy("run").agg(F.count("*").alias("n"), F.count_if(F.col("validity").isNull()).alias("failed"), F.round(100.0 * F.avg(F.coalesce("validity", F.lit(0))), 6).alias("pct"))


@query(f"SELECT doc_id, {BYTE.format(x='text', at=1)} % 3 AS prediction FROM documents WHERE regexp_matches(text, '\\S')")
def predicted_texts(spark, d):
    """JOIN-10: each distinct text is predicted once and its copies get the answer."""
    rows = read(spark, d, "documents").where(F.col("text").rlike(r"\S")).select("doc_id", "text")
    ask = lambda t: models.annotate(t, "text", models.hashed_judge, "answer", T.StringType())
    return evaluation.predict_unique(rows, "text", ask).select("doc_id", parse.verdict_012(F.col("answer")).alias("prediction"))


@query(f"""WITH {runs_sql('s')}, {runs_sql('p')}, l AS (SELECT doc_id AS ex_idx, quality, CASE WHEN doc_id % 5 > 0 THEN toxic END AS toxic FROM labels),
j AS (SELECT 'plain' AS judge, ex_idx, run, validity FROM p UNION ALL SELECT 'search', ex_idx, run, validity FROM s),
a AS (SELECT judge, run, avg(CASE WHEN validity = quality THEN 1 ELSE 0 END) AS q, avg(CASE WHEN toxic IS NOT NULL THEN CASE WHEN validity = toxic THEN 1 ELSE 0 END END) AS t FROM j JOIN l USING (ex_idx) WHERE validity IS NOT NULL GROUP BY 1, 2)
SELECT round(100.0 * avg(q) FILTER (judge = 'plain'), 6) AS plain_vs_quality, round(100.0 * avg(t) FILTER (judge = 'plain'), 6) AS plain_vs_toxic, round(100.0 * avg(q) FILTER (judge = 'search'), 6) AS search_vs_quality, round(100.0 * avg(t) FILTER (judge = 'search'), 6) AS search_vs_toxic,
(SELECT round(100.0 * avg(CASE WHEN quality = toxic THEN 1 ELSE 0 END) FILTER (toxic IS NOT NULL), 6) FROM l) AS quality_toxic FROM a""")
def comparison(spark, d):
    """AGG-26: two judges against two kinds of labels, and the agreement of the labels."""
    judges = runs(spark, d, "s").withColumn("judge", F.lit("search")).unionByName(runs(spark, d, "p").withColumn("judge", F.lit("plain")))
    labels = read(spark, d, "labels").select(F.col("doc_id").alias("ex_idx"), "quality", F.when(F.col("doc_id") % 5 > 0, F.col("toxic")).alias("toxic"))
    row = evaluation.comparison_row(judges, labels, "ex_idx")
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


@query(f"""WITH c AS (SELECT source AS cluster, count(*) AS size, round({BYTE.format(x='source', at=1)} / 255.0, 6) AS sim FROM documents WHERE source IS NOT NULL GROUP BY 1), t AS (SELECT unnest([0.3, 0.6, 0.95])::DOUBLE AS threshold),
j AS (SELECT threshold, count(*) AS sampled, count(*) FILTER ({BYTE.format(x='cluster', at=3)} % 3 = 0) AS n_noise FROM c, t WHERE abs(sim - threshold) <= 0.2 GROUP BY 1),
b AS (SELECT threshold, CAST(coalesce(sum(size) FILTER (sim < threshold), 0) AS BIGINT) AS dropped FROM c, t GROUP BY 1),
r AS (SELECT threshold, coalesce(sampled, 0) AS sampled, coalesce(n_noise, 0) AS n_noise, dropped, CASE WHEN sampled > 0 THEN 100.0 * n_noise / sampled ELSE 0 END AS pct FROM b LEFT JOIN j USING (threshold))
SELECT threshold, sampled, n_noise, round(pct, 6)::DOUBLE AS noise_pct, dropped, CASE WHEN pct > 0 THEN CAST(floor((1 - pct / 100) * dropped) AS BIGINT) ELSE 0 END AS est_fp FROM r""")
def noise_by_threshold(spark, d):
    """AGG-36: noise among judged clusters near a threshold, and items that it would drop wrongly."""
    byte = lambda at: F.conv(F.substring(F.md5(F.col("cluster").cast("binary")), at, 2), 16, 10).cast("int")
    c = read(spark, d, "documents").where("source is not null").groupBy(F.col("source").alias("cluster")).agg(F.count("*").alias("size"))
    c = c.withColumn("max_sim", F.round(byte(1) / 255.0, 6))
    levels = [0.3, 0.6, 0.95]
    near = c.withColumn("threshold", F.explode(F.array(*[F.lit(x) for x in levels]))).where(F.abs(F.col("max_sim") - F.col("threshold")) <= 0.2)
    judged = near.select("cluster", "threshold", F.when(byte(3) % 3 == 0, 0).otherwise(1).alias("verdict"))
    return evaluation.noise_rates(c, judged, levels).withColumn("noise_pct", F.round("noise_pct", 6))


PLAIN = "trim(regexp_replace(replace(replace(lower({x}), '(', ''), ')', ''), '\\s+', '-', 'g'), '-')"


@query(f"""WITH k AS (SELECT unnest({[*sorted(KNOWN)]}) AS k), pairs AS (SELECT p_partkey, p_name, k, {PLAIN.format(x='p_name')} AS own, {PLAIN.format(x='k')} AS other FROM part, k)
SELECT p_partkey, coalesce(min(k) FILTER (k = p_name), min(k) FILTER (other = own), min(k) FILTER (other = replace(own, '-', '_')), min(k) FILTER (contains(own, other) OR contains(other, own))) AS known FROM pairs GROUP BY 1""")
def matched_names(spark, d):
    """JOIN-18: names of parts against a folder's: exact, plain, underscored and partial matches, the first in order of each kind."""
    return read(spark, d, "part").select("p_partkey", parse.match_name(F.col("p_name"), KNOWN).alias("known"))


@query("SELECT doc_id, CASE WHEN regexp_matches(text, '\\S') THEN 128 END AS dims, CAST(NULL AS VARCHAR) AS error, regexp_matches(text, '\\S') AS alike FROM documents")
def embedded_texts(spark, d):
    """UDF-03, STM-06: vectors of all texts by concurrent requests, of unit length; equal texts have equal vectors."""
    rows = read(spark, d, "documents").select("doc_id", "text")
    found = models.annotate_concurrently(rows, "text", models.hashed_embedder, "v", T.ArrayType(T.DoubleType()), size=64)
    key = F.sha2(F.col("text").cast("binary"), 256).alias("text")
    named, _ = cut(found.select("doc_id", key, F.col("v_error").alias("error"), F.size("v").alias("dims"), F.hash("v").alias("h"), vectors.norm(F.col("v")).alias("length")), "vectors")  # read twice, asked for once
    same = named.groupBy(F.col("text").alias("_text")).agg((F.min("h") == F.max("h")).alias("same"))
    alike = F.col("same") & (F.abs(F.col("length") - 1) < 1e-6)
    return named.join(same, F.col("text") == F.col("_text"), "left").select("doc_id", F.when(F.col("dims") >= 0, F.col("dims")).alias("dims"), "error", F.when(F.col("text").isNotNull(), F.coalesce(alike, F.lit(False))).alias("alike"))


@query("SELECT source AS claim, count(*) AS post_count FROM documents WHERE n_chars > 1000 GROUP BY 1 HAVING count(*) >= 2")
def supported_claims(spark, d):
    """FLT-03: with a filter text, claims of at least two posts."""
    c = read(spark, d, "documents").where("n_chars > 1000").groupBy(F.col("source").alias("claim")).agg(F.count("*").alias("post_count"))
    return c.where(parse.supported(F.col("post_count"), "post_count > 1"))


@query("SELECT source AS annotator, CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 END AS label, count(*) AS n FROM documents WHERE source IN ('src0', 'src1') GROUP BY 1, 2")
def mapped_values(spark, d):
    """FLT-07: values of two annotators as labels; unmatched values are counted under null."""
    rows = read(spark, d, "documents").where(F.col("source").isin("src0", "src1"))
    return rows.groupBy(F.col("source").alias("annotator"), parse.mapped(F.col("lang"), {"en": 0, "de": 1}).alias("label")).agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT unnest([0.0, 0.5, 1.0])::DOUBLE AS drop_frac), b AS (SELECT DISTINCT CAST(count(*) % 4 AS INT) AS min_size FROM documents GROUP BY source), c AS (SELECT unnest([-0.1, 0.9])::DOUBLE AS threshold)
SELECT drop_frac, min_size, threshold, drop_frac < 1 AND min_size >= 2 AND threshold >= 0 AS ok FROM a, b, c""")
def sweep_arguments(spark, d):
    """FLT-11: which combinations of a sweep pass its checks, with least sizes from the sizes of sources."""
    sizes = sorted({r[0] for r in read(spark, d, "documents").groupBy("source").agg((F.count("*") % 4).cast("int").alias("n")).select("n").distinct().collect()})  # four at most

    def ok(r) -> bool:
        try:
            evaluation.check_sweep([r.drop_frac], [r.min_size], [r.threshold])
        except ValueError:
            return False
        return True

    combos = evaluation.grid(spark, drop_frac=[0.0, 0.5, 1.0], min_size=sizes, threshold=[-0.1, 0.9]).collect()
    return spark.createDataFrame([(r.drop_frac, r.min_size, r.threshold, ok(r)) for r in combos], "drop_frac double, min_size int, threshold double, ok boolean")


@query("""WITH e AS (SELECT CAST(ts AS DATE) AS day FROM events), r AS (SELECT max(day) AS today FROM e)
SELECT '2020-01-01to' || strftime(today - 14, '%Y-%m-%d') AS freshness, count(*) FILTER (day <= today - 14 AND day >= DATE '2020-01-01') AS stale, count(*) AS n FROM e, r GROUP BY 1""")
def stale_events(spark, d):
    """DAT-03: the stale range before the last day, and how many events are in it."""
    e = read(spark, d, "events").select(F.to_date("ts").alias("day"))
    today = e.agg(F.max("day").alias("today"))
    start, end = parse.stale_range(F.col("today"))
    rows = e.crossJoin(today).select("day", start.alias("start"), end.alias("end"))  # one row
    return rows.groupBy(parse.freshness(F.col("start"), F.col("end")).alias("freshness")).agg(F.count_if(F.col("day").between(F.to_date("start"), F.to_date("end"))).alias("stale"), F.count("*").alias("n"))


@query("SELECT conv_id, list_aggregate(flatten(list([role, CAST(turn AS VARCHAR)] ORDER BY turn)), 'string_agg', ',') AS flat FROM conversations GROUP BY 1")
def flat_turns(spark, d):
    """ARR-02: a list of lists as one."""
    pairs = F.array_sort(F.collect_list(F.struct("turn", "role")))
    lists = F.transform(pairs, lambda s: F.array(s["role"], s["turn"].cast("string")))
    return read(spark, d, "conversations").groupBy("conv_id").agg(lists.alias("l")).select("conv_id", F.array_join(parse.flat_columns(F.col("l")), ",").alias("flat"))


@query("SELECT doc_id, CASE lower(trim(t)) WHEN 'true' THEN true WHEN 'false' THEN false END AS truth, CAST(regexp_extract(l, '_([0-9]+)$', 1) AS INT) AS label FROM (SELECT doc_id, CASE quality WHEN 1 THEN ' TRUE' ELSE CASE toxic WHEN 1 THEN 'False ' ELSE 'mixed' END END AS t, 'LABEL_' || (quality + toxic) AS l FROM labels)")
def parsed_labels(spark, d):
    """STR-06/07: `LABEL_n` as a number, veracity as a boolean."""
    rows = read(spark, d, "labels")
    t = F.when(F.col("quality") == 1, " TRUE").when(F.col("toxic") == 1, "False ").otherwise("mixed")
    label = F.concat(F.lit("LABEL_"), (F.col("quality") + F.col("toxic")).cast("string"))
    return rows.select("doc_id", parse.true_false(t).alias("truth"), parse.label_number(label).alias("label"))


@query()
def trained_classifier(spark, d):
    """ML-18/19: a quality classifier trained on four fifths of the labelled texts; loss and accuracy on the rest."""
    rows = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id").select("doc_id", "text", F.col("quality").cast("int").alias("label"))
    parts = split(rows, "doc_id", "label", 11, 0.8, 0.0)
    model = classifier.train(parts.where("split = 'train'"))
    return classifier.evaluate(model, parts.where("split = 'test'"))
