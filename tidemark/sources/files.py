"""Batch sources and sinks: posts from CSV, reactions, datasets by batch, logs, results, manifests and exports."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.parse import found, text_column, true_false
from tidemark.sources.batches import NO_BATCH, write_run
from tidemark.storage import copy_files, exists, files_below, tables_below, write_text

#: Bytes of rows that one file of a batch holds.
PART_BYTES = 128 << 20
REACTION = "subject_uri string, event_type string, actor_did string, time_us long, created_at string"


def posts_from_csv(spark: SparkSession, path: str, id_col: str = "id", user_col: str = "username", text_col: str = "text", base: str = "https://x.com") -> DataFrame:
    """(uri, text, raw): posts of a CSV file with a header; raw has every column as JSON."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return rows.select(F.concat(F.lit(f"{base}/"), user_col, F.lit("/status/"), id_col).alias("uri"), F.col(text_col).alias("text"), F.to_json(F.struct(*rows.columns)).alias("raw"))


def reactions_from_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REACTION).json(path)


def dataset(spark: SparkSession, root: str, name: str, batches: list[str] | None = None, annotator: str | None = None) -> DataFrame:
    """Rows of {root}/{name}/[annotations/{annotator}/]{batch}/merged.parquet with their `_batch`; all batches, or those named."""
    base = f"{root}/{name}" + (f"/annotations/{annotator}" if annotator else "")
    paths = [f"{base}/{b}/merged.parquet" for b in batches] if batches else [f"{base}/*/merged.parquet"]
    rows = spark.read.option("mergeSchema", "true").parquet(*paths)
    return rows.withColumn("_batch", F.nullif(F.regexp_extract(F.input_file_name(), r"/([^/]+)/merged\.parquet", 1), F.lit(NO_BATCH)))


def batches(df: DataFrame) -> DataFrame:
    return df.select("_batch").distinct().orderBy("_batch")


def merge_chunks(spark: SparkSession, source: str, target: str, schema: str, files: int = 1) -> None:
    """Compact JSON chunks to Parquet."""
    spark.read.schema(schema).json(source).coalesce(files).write.mode("overwrite").parquet(target)


def manifest_totals(spark: SparkSession, path: str) -> DataFrame:
    """One row: chunks and annotated rows over all manifests; files that are no JSON count as corrupt."""
    rows = spark.read.schema("run_id string, completed boolean, chunk_count long, num_annotated long, _corrupt_record string").option("multiLine", "true").json(path)
    return rows.agg(F.coalesce(F.sum("chunk_count"), F.lit(0)).alias("chunks"), F.coalesce(F.sum("num_annotated"), F.lit(0)).alias("annotated"), F.count_if("completed").alias("completed"), F.count("*").alias("manifests"))


def training_logs(spark: SparkSession, path: str) -> DataFrame:
    """(task, params, epoch, train_loss, val_loss, val_acc, test_loss, test_acc): one row per epoch line of each log."""
    return parse_logs(spark.read.text(path, wholetext=True))


def parse_logs(texts: DataFrame, column: str = "value") -> DataFrame:
    """As training_logs, of a column of whole logs; a log without epochs has one row with null epoch."""
    num = r"([0-9.eE+-]+)"
    lines = F.regexp_extract_all(column, F.lit(r"(epoch\s+[0-9]+/[0-9]+.*)"), F.lit(1))
    rows = texts.select(
        found(r"Task (\d+)", F.col(column)).cast("int").alias("task"), found(r"params: ([^\n]*)", F.col(column)).alias("params"),
        found("test_loss=" + num, F.col(column)).cast("double").alias("test_loss"), found("test_acc=" + num, F.col(column)).cast("double").alias("test_acc"), F.explode_outer(lines).alias("line"),
    )
    value = lambda k: found(rf"{k}={num}", F.col("line")).cast("double").alias(k)
    return rows.select("task", "params", found(r"epoch\s+(\d+)/", F.col("line")).cast("int").alias("epoch"), value("train_loss"), value("val_loss"), value("val_acc"), "test_loss", "test_acc")


def example_runs(spark: SparkSession, path: str, one_each: bool = True) -> DataFrame:
    """(ex_idx, text, pseudo_label, run, validity, n_search_calls) from JSON files of one example each, or with one example a line."""
    rows = spark.read.schema("example_idx int, text string, pseudo_label boolean, runs array<struct<run: int, validity: int, explanation: string, n_search_calls: int>>").option("multiLine", str(one_each).lower()).json(path)
    return rows.select(F.col("example_idx").alias("ex_idx"), "text", "pseudo_label", F.explode("runs").alias("r")).select("ex_idx", "text", "pseudo_label", "r.run", "r.validity", "r.n_search_calls")


def encode_columns(df: DataFrame, key: str = "id") -> DataFrame:
    """Every column but the key as JSON text, strings too."""
    quote = lambda c: F.regexp_extract(F.to_json(F.struct(F.col(c).alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
    return df.select(*[F.col(c) if c == key or t not in ("string",) and not t.startswith(("array", "map", "struct")) else F.when(F.col(c).isNotNull(), quote(c)).alias(c) for c, t in df.dtypes])


def complete_runs(runs: DataFrame, n_examples: int, n_runs: int) -> DataFrame:
    """Every run of every example below n_examples: those without a file, or without that run, have a null verdict."""
    spark = runs.sparkSession
    every = spark.range(n_examples).select(F.col("id").cast("int").alias("ex_idx"), F.explode(F.sequence(F.lit(0), F.lit(n_runs - 1))).alias("run"))
    return every.join(runs.select("ex_idx", "run", "validity"), ["ex_idx", "run"], "left")


def dataset_files(spark: SparkSession, root: str, subset: str | None, split: str | None) -> list[str]:
    """Parquet files, or folders named as files, of a dataset's subset folder (below data/, else directly) with `{split}-` in their names. Names only
    are listed."""
    files = tables_below(spark, root)
    if subset:
        files = [f for f in files if f.startswith(f"data/{subset}/")] or [f for f in files if f.startswith(f"{subset}/")]
    return [f for f in files if split is None or f"{split}-" in f.rsplit("/", 1)[-1]]


def best_file(spark: SparkSession, root: str, subset: str | None, split: str = "test") -> str:
    """The first file, or folder named as one, below data/[subset/], those whose path names the split before all others."""
    base = f"data/{subset}/" if subset else "data/"
    files = [f for f in tables_below(spark, root) if f.startswith(base)]
    if not files:
        raise ValueError(f"no Parquet files below {root}/{base}")
    return min(files, key=lambda f: (split not in f, f))


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parquet files as one table. Where their schemas can't be merged, columns of different kinds become text, absent ones null."""
    try:
        rows = spark.read.option("mergeSchema", "true").parquet(*paths)
        rows.schema  # noqa: B018  # footers are read here
        return rows
    except (PySparkException, Py4JJavaError):
        kinds: dict[str, set] = {}
        alike: dict[str, list[str]] = {}
        for p in paths:  # files of one schema are read together
            schema = spark.read.parquet(p).schema
            alike.setdefault(schema.json(), []).append(p)
            for f in schema:
                kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
        out = None
        for group in alike.values():
            part = spark.read.parquet(*group)
            part = part.select(*[F.col(f"`{c}`").cast("string").alias(c) if len(kinds[c]) > 1 else F.col(f"`{c}`") for c in part.columns])
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out


def load_split(spark: SparkSession, root: str, subset: str | None = None, split: str | None = None) -> DataFrame:
    """(text, veracity) of a dataset's split from all its files; veracity is null where there is no such column or no true or false."""
    files = dataset_files(spark, root, subset, split)
    if not files:
        raise ValueError(f"no Parquet files in {root} for {subset}, {split}")
    return texts_of(read_files(spark, [f"{root}/{f}" for f in files]))


def texts_of(rows: DataFrame) -> DataFrame:
    truth = true_false(F.col("veracity").cast("string")) if "veracity" in rows.columns else F.lit(None).cast("boolean")
    return rows.select(F.col(text_column(rows.columns)).cast("string").alias("text"), truth.alias("veracity"))


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """(file, lines) of the JSON chunks that a path or pattern names."""
    rows = spark.read.text(path).select(F.regexp_extract(F.input_file_name(), r"([^/]+/[^/]+)$", 1).alias("file"))
    return rows.groupBy("file").agg(F.count("*").alias("lines"))


def merged_results(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON files that hold one object or a list of them each."""
    text = F.trim("value")
    items = F.when(text.startswith("["), F.from_json("value", f"array<struct<{schema}>>")).otherwise(F.array(F.from_json("value", schema)))
    return spark.read.text(path, wholetext=True).select(F.inline(items))


def write_batches(df: DataFrame, root: str, name: str, annotator: str | None = None, part_bytes: int = PART_BYTES) -> list[str]:
    """df by its `_batch` in the layout that `dataset` reads, in one job; the names of the batches, null for rows without one.

    A batch of up to part_bytes, measured, is one file; a larger one is dealt by its rows' digests to as many files as that makes.
    """
    base = f"{root}/{name}" + (f"/annotations/{annotator}" if annotator else "")
    size = lambda f: F.coalesce(F.octet_length(F.col(f.name) if f.dataType.simpleString() in ("string", "binary") else F.to_json(F.struct(f.name))), F.lit(0))
    wide = [f for f in df.schema if f.name != "_batch" and f.dataType.simpleString().startswith(("string", "binary", "array", "map", "struct"))]
    row = sum([size(f) for f in wide], F.lit(8 * len(df.columns)))
    parts = df.groupBy("_batch").agg(F.ceil(F.sum(row) / part_bytes).cast("int").alias("parts"), F.sum(row).alias("bytes")).orderBy("_batch").collect()  # one row for each batch
    if max((r.parts for r in parts), default=0) <= 1:
        write_run(df.repartition("_batch"), base, layout="merged")
    else:
        names = df.sparkSession.createDataFrame([(r[0], r.parts) for r in parts], T.StructType([T.StructField("_name", df.schema["_batch"].dataType), T.StructField("_parts", T.IntegerType())]))
        hashed = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
        dealt = df.join(names, F.col("_batch").eqNullSafe(F.col("_name"))).withColumn("_part", F.pmod(F.xxhash64(*hashed), F.col("_parts")))
        tasks = 2 * -(-sum(r.bytes for r in parts) // part_bytes)
        write_run(dealt.repartition(tasks, "_batch", "_part").select(*df.columns), base, layout="merged")
    return [r[0] for r in parts]


def finished(spark: SparkSession, root: str) -> list[str]:
    """Folders directly below root whose job has ended: Spark's committer has left _SUCCESS there."""
    return sorted({f.split("/")[0] for f in files_below(spark, root) if f.endswith("/_SUCCESS") and f.count("/") == 1})


def publish(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy the JSON chunks of finished folders to target, each with a manifest that names its run; the manifests' rows.

    A folder whose manifest is there already is not copied again. All files are copied in one job, by tasks.
    """
    days = [day for day in finished(spark, source) if not exists(spark, f"{target}/{day}/run_manifest.json")]
    chunks = {day: [f for f in files_below(spark, f"{source}/{day}") if f.endswith(".json")] for day in days}
    copy_files(spark, [(f"{source}/{day}/{f}", f"{target}/{day}/chunk-{i:05d}.jsonl") for day in days for i, f in enumerate(chunks[day])])
    for day in days:  # what makes a day count is written when all of it is there
        write_text(spark, f"{target}/{day}/run_manifest.json", json.dumps({"run_id": day, "completed": True, "chunk_count": len(chunks[day])}) + "\n")
    return spark.read.schema("run_id string, completed boolean, chunk_count long").json(f"{target}/*/run_manifest.json")


def cached(spark: SparkSession, path: str, make, regenerate: bool = False) -> DataFrame:
    """The table at path; made and written there first if it is absent or is to be made anew."""
    if regenerate or not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").json(path)
    return spark.read.json(path)


def write_dump(clusters: DataFrame, path: str, cluster: str = "cluster", texts: str = "texts") -> None:
    """One text block for each cluster, largest first: its number in that order and its size, its texts indented, an empty line."""
    lines = F.transform(F.filter(texts, lambda t: F.trim(t) != ""), lambda t: F.concat(F.lit("  "), F.trim(t), F.lit("\n")))
    place = F.row_number().over(Window.orderBy(F.size(texts).desc(), cluster)) - 1
    head = F.concat(F.lit("=== Cluster "), place.cast("string"), F.lit(" (size: "), F.size(texts).cast("string"), F.lit(") ===\n"))
    clusters.select(F.concat(head, F.array_join(lines, "")).alias("value"), place.alias("p")).orderBy("p").select("value").write.mode("overwrite").text(path)


def write_json(df: DataFrame, path: str, rows_per_file: int = 500) -> None:
    df.write.option("maxRecordsPerFile", rows_per_file).mode("overwrite").json(path)


def write_subsets(df: DataFrame, path: str, by: str = "subset") -> None:
    df.write.partitionBy(by).mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def describe(df: DataFrame, rows: int = 5, width: int = 120) -> DataFrame:
    """The first rows with every column as text of at most `width` characters."""
    return df.limit(rows).select(*[F.substring(F.col(c).cast("string"), 1, width).alias(c) for c in df.columns])
