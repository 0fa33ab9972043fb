"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or in local mode without one a temporary folder of this process."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not hasattr(shared_dir, "own"):
        shared_dir.own = tempfile.mkdtemp(prefix="tidemark-")
    return "file://" + shared_dir.own


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write df as Parquet and read it back, so that a lost executor costs what follows and not what came before."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _file_system(spark: SparkSession, path: str) -> tuple:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def files_below(spark: SparkSession, root: str) -> list[str]:
    """Paths of all files below a folder, relative to it, in order; whatever file system it is on."""
    fs, p = _file_system(spark, root)
    if not fs.exists(p):
        return []
    base, out, found = fs.getFileStatus(p).getPath().toString().rstrip("/") + "/", [], fs.listFiles(p, True)
    while found.hasNext():
        out.append(found.next().getPath().toString().removeprefix(base))
    return sorted(out)


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, a = _file_system(spark, source)
    b = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, such as a manifest."""
    fs, p = _file_system(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def _copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = []
        for source, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            (a, p), (b, q) = arrow_fs.FileSystem.from_uri(source), arrow_fs.FileSystem.from_uri(target)
            b.create_dir(q.rsplit("/", 1)[0], recursive=True)
            arrow_fs.copy_files(p, q, source_filesystem=a, destination_filesystem=b)
            sizes.append(b.get_file_info(q).size)
        yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(sizes, pa.int64())], ["target", "size"])


def copy_files(spark: SparkSession, pairs: list[tuple[str, str]]) -> int:
    """Copy files, given as pairs of names, by tasks that read and write them; the bytes copied. The driver sees names alone."""
    if not pairs:
        return 0
    named = spark.createDataFrame(pairs, "source string, target string").repartition(min(len(pairs), 4 * spark.sparkContext.defaultParallelism))
    return named.mapInArrow(_copied, "target string, size long").agg({"size": "sum"}).first()[0]


def write_one(df: DataFrame, target: str, kind: str = "parquet", **options: str) -> None:
    """df as one file of a given name: for files that a reader knows by name, such as a batch's merged.parquet."""
    spark, scratch = df.sparkSession, new_path(df.sparkSession, "one")
    df.coalesce(1).write.options(**options).format(kind).save(scratch)
    part = next(f for f in files_below(spark, scratch) if f.startswith("part-"))
    remove(spark, target)
    move(spark, f"{scratch}/{part}", target)
    remove(spark, scratch)


def write_table(df: DataFrame, target: str) -> None:
    """df as a Parquet table of a given name, a folder with as many files as df has tasks: for what may be larger than a task should hold."""
    remove(df.sparkSession, target)
    df.write.parquet(target)


def tables_below(spark: SparkSession, root: str) -> list[str]:
    """Names of the Parquet tables below a folder, relative to it, in order: files, and folders whose name ends as a file's."""
    names = {re.sub(r"\.parquet/.*", ".parquet", f) for f in files_below(spark, root)}
    return sorted(f for f in names if f.endswith(".parquet"))


def copy_missing(spark: SparkSession, source: str, target: str, name: str = "merged.parquet") -> list[str]:
    """Copy files of a name, or in folders of that name, below source to the same places below target, but for those that are there with
    the same size; what was copied. A table at the target with files that the source's has no more is copied anew."""
    out, held = [], [f for f in files_below(spark, source) if name in f.split("/")]
    table = lambda f: f"{f}/".partition(f"/{name}/")[0]
    tables = {table(f) for f in held}
    for t in {table(f) for f in set(files_below(spark, target)) - set(held) if name in f.split("/")} & tables:
        remove(spark, f"{target}/{t}/{name}")
    for f in held:
        (a, p), (b, q) = _file_system(spark, f"{source}/{f}"), _file_system(spark, f"{target}/{f}")
        if not b.exists(q) or a.getFileStatus(p).getLen() != b.getFileStatus(q).getLen():
            out.append(f)
    copy_files(spark, [(f"{source}/{f}", f"{target}/{f}") for f in out])
    return out
