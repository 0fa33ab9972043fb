"""Runs that count when they are committed, and copies by tasks."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import storage
from tidemark.operators import models
from tidemark.sources import batches, files


def view_of(spark):
    return spark.createDataFrame([(i, f"text {i}", None if i % 5 == 4 else f"b{i % 5}") for i in range(100)], "id long, text string, _batch string").repartition(4)


def test_runs_resume_and_lose_no_batch(spark, tmp_path):
    path, view = f"file://{tmp_path}/out", view_of(spark)
    annotate = lambda model, most=None: models.annotate_batches(view, path, "text", model, "answer", T.StringType(), most, 7)

    def fails(texts):
        if any(t.endswith("7") for t in texts):
            raise OSError("down")
        return texts

    assert batches.read_runs(spark, path) is None and annotate(models.hashed_judge, 2) == 2
    with pytest.raises(Exception):  # noqa: B017, PT011  # whatever Spark makes of a task that fails
        annotate(fails)
    assert batches.read_runs(spark, path).count() == 40  # of the failed run nothing counts
    assert annotate(models.hashed_judge) == 3 and annotate(models.hashed_judge) == 0
    rows = batches.read_runs(spark, path)
    assert sorted(r.id for r in rows.collect()) == list(range(100)) and rows.where("_batch is null").count() == 20
    sums = {r.batch: r.n for r in batches.manifests(spark, path).groupBy("batch").agg(F.sum("rows").alias("n")).collect()}
    assert sums == {"b0": 20, "b1": 20, "b2": 20, "b3": 20, None: 20}
    assert batches.manifests(spark, path).groupBy("file").agg(F.sum("rows").alias("n")).agg(F.max("n")).first()[0] <= 7


def test_merged_files_have_null_batches_too(spark, tmp_path):
    root = f"file://{tmp_path}"
    assert files.write_batches(view_of(spark), root, "posts") == [None, "b0", "b1", "b2", "b3"]
    back = files.dataset(spark, root, "posts")
    assert sorted((r.id, r._batch) for r in back.collect()) == sorted((r.id, r._batch) for r in view_of(spark).collect())
    assert [f for f in storage.files_below(spark, f"{root}/posts") if not f.endswith("merged.parquet")] == []


def test_copies_by_tasks(spark, tmp_path):
    root, target = f"file://{tmp_path}/a", f"file://{tmp_path}/b"
    files.write_batches(view_of(spark), root, "posts")
    assert len(storage.copy_missing(spark, root, target)) == 5 and storage.copy_missing(spark, root, target) == []
    assert files.dataset(spark, target, "posts").count() == 100


def test_large_batches_are_folders_of_files(spark, tmp_path):
    root, target = f"file://{tmp_path}/a", f"file://{tmp_path}/b"
    rows = lambda df: sorted((r.id, r._batch) for r in df.collect())
    for size, several in ((200, True), (1 << 20, False), (200, True)):  # a batch written anew replaces what was there
        assert files.write_batches(view_of(spark), root, "posts", part_bytes=size) == [None, "b0", "b1", "b2", "b3"]
        names = [f for f in storage.files_below(spark, f"{root}/posts") if "/b0/" in f"/{f}"]
        assert (len(names) > 1) == several and all("merged.parquet" in f for f in names)
        assert rows(files.dataset(spark, root, "posts")) == rows(view_of(spark))
        assert rows(files.dataset(spark, root, "posts", ["b0"])) == rows(view_of(spark).where("_batch = 'b0'"))
        storage.copy_missing(spark, root, target)
        assert rows(files.dataset(spark, target, "posts")) == rows(view_of(spark)) and storage.copy_missing(spark, root, target) == []


def test_tables_of_a_split_have_several_files(spark):
    root = storage.new_path(spark, "split")
    storage.write_table(spark.range(100).selectExpr("cast(id as string) as claim").repartition(3), f"{root}/data/t/test-0.parquet")
    assert len([f for f in storage.files_below(spark, f"{root}/data/t/test-0.parquet") if f.startswith("part-")]) == 3
    assert files.dataset_files(spark, root, "t", "test") == ["data/t/test-0.parquet"] == [files.best_file(spark, root, "t")]
    assert files.load_split(spark, root, "t", "test").count() == 100
