"""The given tables in the roles of posts, annotations, reactions, raters and runs, and the same as DuckDB common tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", F.col("source").alias("_batch"))


def annotations(spark: SparkSession, d: str) -> DataFrame:
    """LABEL_2: good and not toxic; LABEL_1: good and toxic; LABEL_0: the rest. JSON-quoted, as stored by annotators."""
    label = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "LABEL_2").when((F.col("quality") == 1) & (F.col("toxic") == 1), "LABEL_1").otherwise("LABEL_0")
    return read(spark, d, "labels").select(F.col("doc_id").alias("id"), F.concat(F.lit('"'), label, F.lit('"')).alias("classifier_label"))


def embedded(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"), "label")


def reactions(spark: SparkSession, d: str) -> DataFrame:
    """Clicks as likes and views as reposts of the subject in props.k."""
    kind = F.when(F.col("event_type") == "click", "like").when(F.col("event_type") == "view", "repost")
    rows = read(spark, d, "events").where(F.col("event_type").isin("click", "view"))
    return rows.select(F.get_json_object("props", "$.k").cast("long").alias("subject"), kind.alias("kind"), F.col("user_id").alias("actor"), F.unix_micros(F.col("ts").cast("timestamp")).alias("time_us"), "event_id")


def nibble(key: str, at: int = 1):
    return F.conv(F.substring(F.md5(F.col(key).cast("binary")), at, 1), 16, 10).cast("int")


def runs(spark: SparkSession, d: str, kind: str, n: int = 5) -> DataFrame:
    """(ex_idx, run, validity): verdicts of n runs over the labelled documents, made from digests; some failed."""
    rows = read(spark, d, "labels").select(F.col("doc_id").alias("ex_idx"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("run"))
    rows = rows.withColumn("k", F.concat_ws("|", F.lit(kind), F.col("ex_idx").cast("string"), F.col("run").cast("string")))
    v = F.when(nibble("k") == 15, None).otherwise((nibble("k") < 9).cast("int"))
    return rows.select("ex_idx", "run", v.alias("validity"), nibble("k", 2).alias("calls"))


POSTS = "posts AS (SELECT doc_id AS id, text, source AS _batch FROM documents)"
ANN = "ann AS (SELECT doc_id AS id, '\"' || CASE WHEN quality = 1 AND toxic = 0 THEN 'LABEL_2' WHEN quality = 1 AND toxic = 1 THEN 'LABEL_1' ELSE 'LABEL_0' END || '\"' AS classifier_label FROM labels)"
REACTIONS = "reactions AS (SELECT CAST(props->>'k' AS BIGINT) AS subject, CASE event_type WHEN 'click' THEN 'like' ELSE 'repost' END AS kind, user_id AS actor, epoch_us(ts) AS time_us, event_id FROM events WHERE event_type IN ('click', 'view'))"


def runs_sql(kind: str, n: int = 5) -> str:
    k = f"'{kind}|' || doc_id || '|' || r"
    return f"""{kind} AS (SELECT doc_id AS ex_idx, r AS run, CASE WHEN x = 15 THEN NULL WHEN x < 9 THEN 1 ELSE 0 END AS validity, calls
      FROM (SELECT doc_id, r, ('0x' || substr(md5({k}), 1, 1))::INT AS x, ('0x' || substr(md5({k}), 2, 1))::INT AS calls FROM labels, generate_series(0, {n - 1}) t(r)))"""
