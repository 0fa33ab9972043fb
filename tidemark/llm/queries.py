"""The operators of this package over their whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.alignment import aligned_tokens
from tidemark.llm.bpe import bpe_round_trip
from tidemark.llm.common import materialize, new_path
from tidemark.llm.decontaminate import CONTAMINATION_SQL, contamination, contamination_digest
from tidemark.llm.filter_audit import FILTER_AUDIT_SQL, filter_audit
from tidemark.llm.lang_id import classify, fit_profiles, fold
from tidemark.llm.lm_score import lm_scores
from tidemark.llm.media import encode_media, media_features
from tidemark.llm.mixing import mix
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.ngram_join import ngram_components
from tidemark.llm.suffix_dedup import remove_repeats
from tidemark.llm.token_output import token_index, write_tokens
from tidemark.llm.url_filters import filter_urls, host_of

#: First day of the dated lists and captures of op7.
FIRST_DAY = "2024-01-01"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe_round_trip(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = fit_profiles(docs, fold("doc_id", 5) != 0)
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(True))
    return classify(docs.select("doc_id", "text"), profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(table(spark, sf_dir, "documents"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, _ = materialize(encode_media(table(spark, sf_dir, "documents")), "media", packed=True)
    return media_features(stored)


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)


def _digest_int(c: Column, at: int) -> Column:
    return F.conv(F.substring(F.md5(c.cast("binary")), at, 4), 16, 10).cast("int")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages have no fetch time and no lists come with them: both are derived from digests of URLs and hosts.

    Every host of the pages, and every domain of two labels, has an entry in one of three lists, taken off and put back later.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.date_add(F.lit(FIRST_DAY).cast("date"), _digest_int(F.col("url"), 1) % 366))
    hosts = pages.select(host_of(F.col("url")).alias("domain")).where("domain is not null").distinct()
    domains = hosts.unionByName(hosts.select(F.substring_index("domain", ".", -2).alias("domain"))).distinct()
    start, held = _digest_int(F.col("domain"), 1) % 240, _digest_int(F.col("domain"), 5) % 60 + 1
    event = lambda after, action: F.struct(F.date_add(F.lit(FIRST_DAY).cast("date"), after).alias("day"), F.lit(action).alias("action"))
    turns = F.explode(F.array(event(start, "add"), event(start + held, "remove"), event(start + held + 90, "add"), event(start + held + 100, "remove")))
    events = domains.select(F.concat(F.lit("list"), _digest_int(F.col("domain"), 9) % 3).alias("list"), "domain", turns.alias("e")).select("list", "domain", "e.*")
    return filter_urls(captures, events).withColumn("fetched", F.col("fetched").cast("string"))


OP7_SQL = rf"""
WITH captures AS (
  SELECT page_id, nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '\.$', ''), '') AS host,
         DATE '{FIRST_DAY}' + CAST(('0x' || substr(md5(url), 1, 4))::INT % 366 AS INT) AS fetched
  FROM pages),
hosts AS (SELECT DISTINCT host AS domain FROM captures WHERE host IS NOT NULL),
domains AS (SELECT domain FROM hosts UNION SELECT array_to_string(string_split(domain, '.')[-2:], '.') FROM hosts),
entries AS (
  SELECT domain, 'list' || (('0x' || substr(md5(domain), 9, 4))::INT % 3) AS list, ('0x' || substr(md5(domain), 1, 4))::INT % 240 AS a,
         ('0x' || substr(md5(domain), 5, 4))::INT % 60 + 1 AS h
  FROM domains),
spans AS (
  SELECT list, domain, DATE '{FIRST_DAY}' + CAST(a AS INT) AS f, DATE '{FIRST_DAY}' + CAST(a + h AS INT) AS t FROM entries
  UNION ALL
  SELECT list, domain, DATE '{FIRST_DAY}' + CAST(a + h + 90 AS INT), DATE '{FIRST_DAY}' + CAST(a + h + 100 AS INT) FROM entries),
hits AS (
  SELECT c.host, c.fetched, count(DISTINCT s.list) AS n_lists, arg_max(s.domain, length(s.domain)) AS entry
  FROM (SELECT DISTINCT host, fetched FROM captures) c
  JOIN spans s ON (c.host = s.domain OR ends_with(c.host, '.' || s.domain)) AND s.f <= c.fetched AND c.fetched < s.t
  GROUP BY 1, 2)
SELECT page_id, c.host, CAST(c.fetched AS VARCHAR) AS fetched, entry IS NOT NULL AS blocked, entry, CAST(coalesce(n_lists, 0) AS BIGINT) AS n_lists
FROM captures c LEFT JOIN hits h ON c.host = h.host AND c.fetched = h.fetched
"""


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_index(spark, path)


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_media_columns": op4_media_columns,
    "op5_source_mixing": op5_source_mixing,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_url_filters": op7_url_filters,
    "op8_token_output": op8_token_output,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_filter_audit": op12_filter_audit,
    "op13_decontamination": op13_decontamination,
}
ORACLE_SQL: dict[str, str] = {"op7_url_filters": OP7_SQL, "op12_filter_audit": FILTER_AUDIT_SQL, "op13_decontamination": CONTAMINATION_SQL}
