"""Base tables with annotation layers: export views, annotation views and keyed deduplication."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class Layer:
    """One annotator's rows: the columns to take and a predicate that holds before rows of one id are merged."""

    rows: DataFrame
    columns: list[str]
    where: str | Column | None = None


def merge_rows(df: DataFrame, key: str = "id") -> DataFrame:
    """One row per key; of every other column the least non-null value, so that the result does not depend on order."""
    return df.groupBy(key).agg(*[F.min(c).alias(c) for c in df.columns if c != key])


def export_view(base: DataFrame, layers: list[Layer], columns: list[str], where: str | None = None) -> DataFrame:
    """base joined to every layer by id, each merged to one row per id after its own filter."""
    view = base if where is None else base.where(where)
    view = merge_rows(view.select("id", *columns))
    for layer in layers:
        rows = layer.rows if layer.where is None else layer.rows.where(layer.where)
        view = view.join(merge_rows(rows.select("id", *layer.columns)), "id")
    return view


def hash_share(c: Column, fraction: float, seed: int = 0) -> Column:
    """Whether a row falls in a share of all rows, by a digest of its id: the same rows on every run and engine."""
    digest = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), c.cast("string")).cast("binary")), 1, 8), 16, 10).cast("long")
    return digest < int(fraction * (1 << 32))


def annotation_view(base: DataFrame, layers: list[Layer], columns: list[str], done: DataFrame, fraction: float = 1.0, where: str | None = None) -> DataFrame:
    """An export view without the ids that the annotator has done; below fraction 1 a hash sample of it."""
    view = export_view(base, layers, columns, where).join(done.select("id").distinct(), "id", "left_anti")
    return view if fraction >= 1 else view.where(hash_share(F.col("id"), fraction))


def export_rows(base: DataFrame, columns: list[str], where: str | None = None, by: str | None = None, layers: Sequence[Layer] = ()) -> DataFrame:
    """An export view with a `subset` column: each value of the column `by`, and everything once more as `default`."""
    view = export_view(base, list(layers), columns, where)
    every = view.withColumn("subset", F.lit("default"))
    if by is None:
        return every
    return every.unionByName(view.where(F.col(by).isNotNull()).withColumn("subset", F.col(by).cast("string")))


def first_text(texts: DataFrame, wanted: DataFrame, key: str, text: str, order: str) -> DataFrame:
    """(key, text) for the wanted keys: of each the first non-empty text in order. Spark broadcasts the keys if they are few."""
    rows = texts.where(F.length(F.trim(text)) > 0).join(wanted.select(key).distinct(), key, "left_semi")
    return rows.groupBy(key).agg(F.min_by(text, order).alias(text))


# The columns of each named export, its filter and the column that makes its subsets, as export_rows takes them.
EXPORTS = {
    "classifier_hits": {"columns": ["created_at", "at_uri", "uri", "text"]},
    "raw_clusters": {"columns": ["id", "original_ids", "text"]},
    "clustered": {"columns": ["claim", "cluster_id", "id", "original_ids", "original_texts", "post_count"], "where": "post_count >= 2"},
    "embedded_claims": {"columns": ["claim", "claim_id", "cluster_id", "embedding_dim", "post_count", "original_ids", "original_texts"]},
    "clusters_summarized": {"columns": ["_batch", "claim", "cluster_id", "date", "diverse_sample_ids", "post_count", "original_texts"], "by": "date"},
    "clusters_summarized_kmeans": {"columns": ["_batch", "claim", "cluster_id", "date", "diverse_sample_ids", "post_count", "original_texts"], "by": "date"},
    "meta_clusters": {"columns": ["claim_id", "cluster_id", "num_claims", "total_post_count"]},
    "double_summarized": {"columns": ["claim", "cluster_id", "post_count", "original_ids", "original_texts", "date"]},
}
#: Of the first export: the annotator's columns and the label that makes a hit.
HIT_COLUMNS, HIT = ["classifier_label", "classifier_probs"], '"LABEL_1"'


def export_mode(spark: SparkSession, root: str, mode: str, name: str, target: str, annotator: str | None = None) -> None:
    """Write one of the named exports of a dataset of files to target, a folder for each subset."""
    from tidemark.sources.files import dataset, write_subsets

    layers = [Layer(dataset(spark, root, name, annotator=annotator), HIT_COLUMNS, F.col(HIT_COLUMNS[0]) == HIT)] if mode == "classifier_hits" else []
    chosen = EXPORTS[mode] | {"columns": [c for c in EXPORTS[mode]["columns"] if c != "id"]}
    write_subsets(export_rows(dataset(spark, root, name), layers=layers, **chosen), target)
