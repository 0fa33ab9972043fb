"""A sink whose rows count once their run is committed: tasks write files, the run's manifest names them.

Tasks tell the driver the names of their files and how many rows of which batch they hold, nothing else. `commit` writes the manifest, or moves
files to their final names; `abort`, and a run that is killed, leave nothing that a reader would take.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

NAME, NO_BATCH = "tidemark_runs", "__HIVE_DEFAULT_PARTITION__"
MANIFEST = "run_id string, batch string, file string, rows long"


@dataclass
class Written(WriterCommitMessage):
    """(file, final name, batch, rows) of what a task wrote."""

    files: list[tuple[str, str, str | None, int]]


class RunWriter(DataSourceArrowWriter):
    def __init__(self, path: str, run: str, layout: str, rows_per_file: int) -> None:
        self.path, self.run, self.layout, self.rows_per_file = path.rstrip("/"), run, layout, rows_per_file

    def _to(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def _chunks(self, to: fs.FileSystem, base: str, batches: Iterator[pa.RecordBatch], done: list) -> None:
        """Files of at most rows_per_file rows, of whatever batches come; a file has an entry for each of its batches."""
        out, name, rows, held = None, "", 0, Counter()

        def close() -> None:
            out.close()
            done.extend((name, name, b, n) for b, n in sorted(held.items(), key=str))

        for batch in batches:
            while len(batch):
                if out is None:
                    name, rows, held = f"data/{self.run}-{uuid.uuid4().hex}.parquet", 0, Counter()
                    to.create_dir(f"{base}/data", recursive=True)
                    out = pq.ParquetWriter(f"{base}/{name}", batch.schema, filesystem=to)
                part = batch.slice(0, self.rows_per_file - rows)
                batch, rows = batch.slice(len(part)), rows + len(part)
                out.write_batch(part)
                held.update(part.column("_batch").to_pylist())
                if rows >= self.rows_per_file:
                    close()
                    out = None
        if out is not None:
            close()

    def _merged(self, to: fs.FileSystem, base: str, batches: Iterator[pa.RecordBatch], done: list) -> None:
        """One file for each batch of the task; what several tasks have of a batch becomes a folder of its name."""
        open_files: dict[str | None, list] = {}
        for batch in batches:
            rows = batch.drop_columns(["_batch"])
            for b in pc.unique(batch.column("_batch")).to_pylist():
                same = pc.is_null(batch.column("_batch")) if b is None else pc.fill_null(pc.equal(batch.column("_batch"), b), False)
                part = rows.filter(same)
                if b not in open_files:
                    folder = f"{NO_BATCH if b is None else b}"
                    to.create_dir(f"{base}/{folder}", recursive=True)
                    name = f"{folder}/.{self.run}-{uuid.uuid4().hex}"
                    open_files[b] = [pq.ParquetWriter(f"{base}/{name}", part.schema, filesystem=to), name, f"{folder}/merged.parquet", 0]
                open_files[b][0].write_batch(part)
                open_files[b][3] += len(part)
        for b, (out, name, final, n) in open_files.items():
            out.close()
            done.append((name, final, b, n))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        to, base = self._to()
        done: list = []
        (self._merged if self.layout == "merged" else self._chunks)(to, base, iterator, done)
        return Written(done)

    def commit(self, messages: list) -> None:
        to, base = self._to()
        files = [f for m in messages if m is not None for f in m.files]
        if self.layout == "merged":
            named: dict[str, list[str]] = {}
            for name, final, _, _ in files:
                named.setdefault(final, []).append(name)
            for final, parts in named.items():
                if to.get_file_info(f"{base}/{final}").type == fs.FileType.Directory:
                    to.delete_dir(f"{base}/{final}")
                if len(parts) == 1:
                    to.move(f"{base}/{parts[0]}", f"{base}/{final}")
                    continue
                if to.get_file_info(f"{base}/{final}").type == fs.FileType.File:
                    to.delete_file(f"{base}/{final}")
                to.create_dir(f"{base}/{final}", recursive=True)
                for i, name in enumerate(parts):
                    to.move(f"{base}/{name}", f"{base}/{final}/part-{i:05d}.parquet")
            return
        to.create_dir(f"{base}/_runs", recursive=True)
        body = "".join(json.dumps({"run_id": self.run, "batch": b, "file": name, "rows": n}) + "\n" for name, _, b, n in files)
        with to.open_output_stream(f"{base}/_runs/.{self.run}") as out:
            out.write(body.encode())
        to.move(f"{base}/_runs/.{self.run}", f"{base}/_runs/{self.run}.json")

    def abort(self, messages: list) -> None:
        to, base = self._to()
        for name in {f[0] for m in messages if m is not None for f in m.files}:
            if to.get_file_info(f"{base}/{name}").type != fs.FileType.NotFound:
                to.delete_file(f"{base}/{name}")


class Runs(DataSource):
    """Options: path, run (its name), layout (`chunks` or `merged`) and rows (of a file of chunks)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema, overwrite: bool) -> RunWriter:
        get = self.options.get
        return RunWriter(get("path"), get("run", uuid.uuid4().hex), get("layout", "chunks"), int(get("rows", 10_000)))


def write_run(rows: DataFrame, path: str, run: str | None = None, layout: str = "chunks", rows_per_file: int = 10_000) -> None:
    """Write rows with a `_batch` as one run, which counts when all of it is written."""
    rows.sparkSession.dataSource.register(Runs)
    rows = rows.withColumn("_batch", F.col("_batch").cast("string"))
    rows.write.format(NAME).mode("append").options(path=path, run=run or uuid.uuid4().hex, layout=layout, rows=str(rows_per_file)).save()


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, batch, file, rows) of the committed runs."""
    to, base = fs.FileSystem.from_uri(path)
    if to.get_file_info(f"{base}/_runs").type == fs.FileType.NotFound:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(f"{path}/_runs/*.json")


def read_runs(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The rows of all committed runs; None if there are none. Names of files are what the driver sees, as with any listing."""
    found = sorted(r.file for r in manifests(spark, path).select("file").distinct().collect())
    if not found:
        return None
    return (spark.read.schema(schema) if schema else spark.read).parquet(*[f"{path}/{f}" for f in found])
