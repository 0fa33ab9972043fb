"""Parsers, names, markup, arrays and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import parse
from tidemark.operators.clustering import simhash_buckets as simhashes
from tidemark.plans.tables import posts, read
from tidemark.sources.files import encode_columns, parse_logs

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


#: Verdict lines made of labels, in the forms that models write.
LINES = """lines AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'because | ' || quality WHEN 1 THEN 'a|b| ' || (quality + toxic) || ' ' WHEN 2 THEN 'Rating: ' || quality WHEN 3 THEN 'VERDICT : ' || toxic
 WHEN 4 THEN 'so it is ' || quality || ' I think' ELSE 'x | 7' END AS line FROM labels)"""


def _lines(spark, d):
    s = lambda c: F.col(c).cast("string")
    kind = F.col("doc_id") % 6
    line = (
        F.when(kind == 0, F.concat(F.lit("because | "), s("quality"))).when(kind == 1, F.concat(F.lit("a|b| "), (F.col("quality") + F.col("toxic")).cast("string"), F.lit(" ")))
        .when(kind == 2, F.concat(F.lit("Rating: "), s("quality"))).when(kind == 3, F.concat(F.lit("VERDICT : "), s("toxic"))).when(kind == 4, F.concat(F.lit("so it is "), s("quality"), F.lit(" I think"))).otherwise("x | 7")
    )
    return read(spark, d, "labels").select("doc_id", line.alias("line"))


@query(f"""WITH {LINES}, p AS (SELECT *, string_split(line, '|')[-1] AS tail, contains(line, '|') AS piped FROM lines)
SELECT doc_id, CASE WHEN piped THEN TRY_CAST(nullif(regexp_extract(tail, '\\b([0-2])\\b', 1), '') AS INT) END AS v012,
TRY_CAST(coalesce(CASE WHEN piped THEN nullif(regexp_extract(tail, '\\b([01])\\b', 1), '') END, nullif(regexp_extract(line, '(?i)(?:rating|validity|verdict)\\s*:\\s*([01])\\b', 1), ''), nullif(regexp_extract(line, '.*\\b([01])\\b', 1), '')) AS INT) AS v01,
TRY_CAST(coalesce(nullif(regexp_extract(tail, '([01])', 1), ''), nullif(regexp_extract(line, '([01])', 1), '')) AS INT) AS coherent FROM p""")
def parse_verdicts(spark, d):
    """STR-02/03/04."""
    c = F.col("line")
    return _lines(spark, d).select("doc_id", parse.verdict_012(c).alias("v012"), parse.verdict_01(c).alias("v01"), parse.verdict_coherent(c).alias("coherent"))


@query("""SELECT page_id, length(regexp_replace(html, '<[^>]+>', '', 'g')) AS n, md5(regexp_replace(html, '<[^>]+>', '', 'g')) AS digest, substr(replace(regexp_replace(html, '<[^>]+>', '', 'g'), chr(10), ' '), 1, 80) AS snippet FROM pages""")
def html_strip(spark, d):
    """STR-10/11."""
    t = parse.strip_tags(F.col("html"))
    return read(spark, d, "pages").select("page_id", F.length(t).cast("long").alias("n"), F.md5(t.cast("binary")).alias("digest"), parse.snippet(t).alias("snippet"))


@query("""SELECT page_id, regexp_replace(regexp_replace(url, '[^a-zA-Z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g') AS name, 'https://x.com/' || page_id || '/status/' || length(url) AS uri FROM pages""")
def safe_names(spark, d):
    """STR-08/14."""
    return read(spark, d, "pages").select("page_id", parse.safe_name(F.col("url")).alias("name"), F.concat(F.lit("https://x.com/"), F.col("page_id").cast("string"), F.lit("/status/"), F.length("url").cast("string")).alias("uri"))


@query("""WITH s AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%d') WHEN 2 THEN 'unknown day' ELSE 'short' END AS s FROM events)
SELECT event_id, coalesce(strftime(TRY_CAST(s AS TIMESTAMP), '%Y-%m-%d'), CASE WHEN length(s) >= 10 THEN substr(s, 1, 10) END) AS date FROM s""")
def lenient_dates(spark, d):
    """PRJ-07, DAT-04."""
    k, ts = F.col("event_id") % 4, F.col("ts")
    s = F.when(k == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).when(k == 1, F.date_format(ts, "yyyy-MM-dd")).when(k == 2, "unknown day").otherwise("short")
    return read(spark, d, "events").select("event_id", parse.lenient_date(s).alias("date"))


@query("""WITH c AS (SELECT conv_id, list(text ORDER BY turn) AS texts FROM conversations GROUP BY 1)
SELECT conv_id, array_to_string(list_transform(list_filter([1, 0, 3, 99], lambda i: i < len(texts)), lambda i: texts[i + 1]), '|') AS picked, len(texts) AS n FROM c""")
def array_gather(spark, d):
    """JOIN-08, ARR-01, AGG-12: places [1, 0, 3, 99] of each conversation's texts."""
    c = read(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]).alias("texts"))
    return c.select("conv_id", F.array_join(parse.gather(F.col("texts"), F.array(*[F.lit(i) for i in (1, 0, 3, 99)])), "|").alias("picked"), F.size("texts").cast("long").alias("n"))


@query("""WITH c AS (SELECT conv_id, list(text ORDER BY turn) AS texts FROM conversations GROUP BY 1)
SELECT conv_id, 'Posts:' || chr(10) || array_to_string(list_transform(range(0, least(len(texts), 50)), lambda i: '[' || i || '] ' || texts[i + 1]), chr(10) || chr(10)) AS prompt FROM c""")
def cluster_prompts(spark, d):
    """STR-01, SRT-09."""
    c = read(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda s: s["text"]).alias("texts"))
    return c.select("conv_id", parse.fill_prompt("Posts:\n{posts}", "posts", parse.numbered(F.slice("texts", 1, 50))).alias("prompt"))


@query("""WITH m AS (SELECT conv_id, map_from_entries(list(struct_pack(k := role, v := n) ORDER BY role)) AS m FROM (SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY 1, 2) GROUP BY 1)
SELECT conv_id, coalesce(m['user'], 0) AS users, coalesce(m['system'], 0) AS systems FROM m""")
def role_map(spark, d):
    """MAP-01: a count map with 0 for what is missing."""
    n = read(spark, d, "conversations").groupBy("conv_id", "role").agg(F.count("*").alias("n"))
    m = n.groupBy("conv_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("role", "n")))).alias("m"))
    at = lambda k: F.coalesce(F.try_element_at("m", F.lit(k)), F.lit(0).cast("long"))
    return m.select("conv_id", at("user").alias("users"), at("system").alias("systems"))


@query("SELECT doc_id AS id, '\"' || source || '\"' AS source, n_chars FROM documents")
def json_columns(spark, d):
    """JSN-02: text as JSON, numbers as they are."""
    return encode_columns(read(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", "n_chars"))


@query("""SELECT 'did:' || user_id AS did, 'at://did:' || user_id || '/app.bsky.feed.post/' || event_id AS at_uri, nullif(CASE WHEN value > 10 THEN event_type ELSE '' END, '') AS text, epoch_us(ts) AS time_us FROM events WHERE event_type <> 'error' AND event_type <> 'signup'""")
def post_events(spark, d):
    """PRJ-02, SRC-01: raw stream events of posts; updates and other kinds are left out."""
    e = read(spark, d, "events")
    op = F.when(F.col("event_type") == "error", "update").otherwise("create")
    kind = F.when(F.col("event_type") == "signup", "identity").otherwise("commit")
    record = F.struct(F.lit(parse.POST).alias("$type"), F.when(F.col("value") > 10, F.col("event_type")).otherwise("").alias("text"))
    commit = F.struct(F.lit(parse.POST).alias("collection"), op.alias("operation"), F.col("event_id").cast("string").alias("rkey"), record.alias("record"))
    raw = e.select(F.to_json(F.struct(kind.alias("kind"), F.unix_micros(F.col("ts").cast("timestamp")).alias("time_us"), F.concat(F.lit("did:"), F.col("user_id").cast("string")).alias("did"), commit.alias("commit"))).alias("value"))
    return parse.post_events(raw).select("did", "at_uri", "text", "time_us")


@query("""SELECT CAST(props->>'k' AS VARCHAR) AS subject_uri, CASE event_type WHEN 'click' THEN 'like' ELSE 'repost' END AS event_type, 'did:' || user_id AS actor_did, CASE WHEN value > 50 THEN 0 ELSE epoch_us(ts) END AS time_us FROM events WHERE event_type IN ('click', 'view')""")
def reaction_events(spark, d):
    """PRJ-03, SRC-02: raw reaction events; a missing time is 0."""
    e = read(spark, d, "events")
    col = F.when(F.col("event_type") == "click", parse.LIKE).when(F.col("event_type") == "view", parse.REPOST).otherwise(parse.POST)
    record = F.struct(F.struct(F.get_json_object("props", "$.k").alias("uri")).alias("subject"))
    commit = F.struct(col.alias("collection"), F.lit("create").alias("operation"), record.alias("record"))
    time = F.when(F.col("value") <= 50, F.unix_micros(F.col("ts").cast("timestamp")))
    raw = e.select(F.to_json(F.struct(F.lit("commit").alias("kind"), time.alias("time_us"), F.concat(F.lit("did:"), F.col("user_id").cast("string")).alias("did"), commit.alias("commit"))).alias("value"))
    return parse.reaction_events(raw).drop("created_at")


@query("SELECT 'p' || page_id AS uri, url AS text, CASE WHEN page_id % 2 = 0 THEN 1 ELSE 0 END AS n_langs FROM pages")
def feed_items(spark, d):
    """PRJ-04, JSN-03, SRC-03."""
    langs = F.when(F.col("page_id") % 2 == 0, F.array(F.lit("en")))
    raw = read(spark, d, "pages").select(F.to_json(F.struct(F.struct(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("uri"), F.struct(F.col("url").alias("text"), langs.alias("langs")).alias("record")).alias("post"))).alias("value"))
    return parse.feed_items(raw).select("uri", "text", F.size("langs").alias("n_langs"))


@query("""WITH w AS (SELECT doc_id, unnest(list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')) AS w FROM documents),
b AS (SELECT doc_id, i, sum(CASE WHEN (('0x' || substr(md5(w), 1, 4))::INT >> (16 - i)) & 1 = 1 THEN 1 ELSE -1 END) AS s FROM w, generate_series(1, 16) t(i) GROUP BY 1, 2)
SELECT d.doc_id, CAST(coalesce(sum(CASE WHEN s > 0 THEN 1 << (16 - i) ELSE 0 END), 0) AS INT) AS bucket FROM documents d LEFT JOIN b USING (doc_id) GROUP BY 1""")
def simhash_buckets(spark, d):
    """STR-12: top 16 bits of the simhash of whole texts."""
    return simhashes(read(spark, d, "documents"), "doc_id", "text")


@query("""SELECT CAST(s_nationkey AS INT) AS task, 2 AS epoch, 0.25::DOUBLE AS val_loss, count(*) AS n FROM supplier GROUP BY 1""")
def best_epochs(spark, d):
    """SRC-17, AGG-34, SRT-08: the best epoch of each training log, one log per supplier."""
    from tidemark.operators.evaluation import best_epoch

    line = "epoch {e}/3  train_loss=0.5  val_loss={v}  val_acc=0.9\n"
    log = F.concat(F.lit("Task "), F.col("s_nationkey").cast("string"), F.lit(" params: LR=5e-05 BATCH_SIZE=8\n" + "".join(line.format(e=e, v=v) for e, v in ((1, 0.5), (2, 0.25), (3, 0.25))) + "test_loss=0.3 test_acc=0.91\n"))
    epochs = parse_logs(read(spark, d, "supplier").select(log.alias("value")))
    n = epochs.groupBy("task").agg((F.count("*") / 3).cast("long").alias("n"))
    return best_epoch(epochs, "task").join(n, "task").select("task", "epoch", "val_loss", "n")


@query("SELECT source, count(DISTINCT text) AS texts, count(*) AS n FROM documents GROUP BY 1")
def unique_texts(spark, d):
    """AGG-11: key deduplication on text, whatever the number of copies."""
    p = posts(spark, d)
    once = p.select("_batch", "text").dropDuplicates(["_batch", "text"]).groupBy("_batch").agg(F.count("text").alias("texts"))
    return p.groupBy("_batch").agg(F.count("*").alias("n")).join(once, "_batch").select(F.col("_batch").alias("source"), "texts", "n")
