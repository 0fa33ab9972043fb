"""A training-data pipeline over ``documents``: five stages, each one operator of the llm package.

Every stage but the last returns the columns of documents. Between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import bpe_round_trip
from tidemark.llm.common import materialize
from tidemark.llm.lang_id import classify, fit_profiles
from tidemark.llm.mixing import mix
from tidemark.llm.ngram_join import ngram_components
from tidemark.llm.suffix_dedup import remove_repeats

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _apart(docs: DataFrame, *inputs: str) -> DataFrame:
    """The inputs of an operator beside `row`, a struct of the other columns, so that no name the operator adds can meet theirs."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in inputs]
    return docs.select(*inputs, F.struct(F.lit(True).alias("_"), *others).alias("row"))


def _together(found: DataFrame, docs: DataFrame, *inputs: str) -> DataFrame:
    return found.select(*[F.col(c) if c in inputs else F.col(f"row.`{c}`") for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with some margin stay; those without letters, or between two languages, go.

    Null and empty texts have no letters and go; a tie of two languages has no margin and goes; repeated rows and null ids stay or go by
    their texts; whole texts of any length are read; an empty table stays empty. Columns of any other names are carried as they are.
    """
    found = classify(_apart(docs, "text"), fit_profiles(docs)).where("not rejected")
    return _together(found, docs, "text")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard 0.8 or more) the document of least id stays, with all its rows.

    Null texts and texts without words are alone and stay; rows that share an id are one document; rows with a null id stay; whole texts
    of any length are compared; an empty table stays empty. Only id and text are read to decide, so other columns can't be in the way.
    """
    kept = ngram_components(docs, width=5, percent=80).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").unionByName(docs.where("doc_id is null")).select(*[F.col(f"`{c}`") for c in docs.columns])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that an earlier document has are cut out; a character that a cut would split goes as a whole.

    Null texts stay null; rows that share an id don't take from one another; null ids come last; every row stays, if with an empty text;
    an empty table stays empty. n_chars follows the text; other columns are carried as they are.
    """
    cut = remove_repeats(docs, carry=True)
    changed = {"text": F.col("kept_text"), "n_chars": F.coalesce(F.length("kept_text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)}
    return cut.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it, rounded to whole documents.

    Texts without words have size 0 and are taken no times; a null source is a source; rows that share an id, null ids among them, are
    taken together; ties in the seeded order are broken by id; an empty table stays empty. Other columns are carried as they are.
    """
    inputs = ("doc_id", "text", "source")
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    mixed = mix(_apart(docs, *inputs)).withColumn("taken", times).where("taken > 0")
    return _together(mixed.withColumn("taken", F.explode(F.sequence(F.lit(1), F.col("taken")))), docs, *inputs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with digests of the ids and of the bytes they decode to.

    Null and empty texts have no ids; null ids and repeated rows stay; whole texts of any length; an empty table stays empty.
    """
    found = bpe_round_trip(docs, RANKS, public_tokenizers.PATTERN)
    return found.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"), "ids")


STAGES = [
    ("language id", language_id),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources", source_mix),
    ("byte-level BPE", tokens),
]
#: Compression, suffix arrays and merges are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
