"""Shared pieces: durable intermediate tables, sizing, and vectorised byte and word hashing."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.storage import new_path
from tidemark.storage import remove as drop  # noqa: F401  # the operators take it from here

#: ASCII white space that separates words: space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

WORD = r"[^\x20\x09-\x0D]+"

PACKED_ROWS = "uid long, size long, rows binary"
#: Tables of packed columns: small row groups, as a reader holds one at a time.
PACKED_LAYOUT = {"compression": "uncompressed", "parquet.enable.dictionary": "false", "parquet.block.size": str(16 << 20)}


def materialize(df: DataFrame, name: str = "step", partition_by: str | None = None, packed: bool = False) -> tuple[DataFrame, str]:
    """Write df as Parquet into the shared folder and read it back, which cuts its lineage. Packed columns are not compressed again."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    writer = df.write.options(**PACKED_LAYOUT) if packed else df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def local_table(spark: SparkSession, rows: list[tuple], fields: str) -> DataFrame:
    """A few rows of the driver as a table, by way of Arrow: from a list of rows Spark would start Python workers of another kind, which stay."""
    schema = StructType.fromDDL(fields)
    held = to_arrow_schema(schema)
    columns = list(zip(*rows, strict=True)) or [()] * len(held)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, held, strict=True)], schema=held), schema)


_KEPT: dict[str, dict] = {}
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it


def kept(owner: str) -> dict:
    """What tasks of one operator keep in a Python worker for the next. A worker outlives its step, so what another operator kept goes first."""
    if owner not in _KEPT:
        _KEPT.clear()
        give_back()
        _KEPT[owner] = {}
    return _KEPT[owner]


def give_back() -> None:
    """Free memory of this Python worker goes to the system; an idle worker would hold it beside those of the next steps."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def parts_of(n_bytes: int | None, bytes_each: int, least: int = 8) -> int:
    """How many parts of bytes_each a measured number of bytes makes."""
    return max(least, -(-(n_bytes or 0) // bytes_each))


def pieces(docs: DataFrame, bytes_each: int, text_col: str = "text", least: int = 8) -> int:
    """How many parts of about bytes_each the texts of docs make, by one aggregate that measures them."""
    return parts_of(docs.agg(F.sum(F.octet_length(text_col))).first()[0], bytes_each, least)


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in smaller ones, of at most `most` bytes in a string, binary or integer list column, or of one row, so
    that few rows are Python objects at once."""
    for batch in batches:
        values = batch.column(column)
        size = pc.multiply(pc.list_value_length(values), 4) if pa.types.is_list(values.type) else pc.binary_length(values)
        at = np.concatenate([[0], np.cumsum(pc.fill_null(size, 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
        for i, j in chunks(at, most):
            yield batch.slice(i, j - i)


def _pack_rows(column: int, most: int, shape: Callable[[pa.Table], pa.Table] | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    uid, held, size = (task.partitionId() if task else 0) << 32, [], 0

    def packed() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        data = pack_table(shape(rows) if shape else rows)
        return pa.RecordBatch.from_arrays([pa.array([uid], pa.int64()), pa.array([size], pa.int64()), pa.array([data], pa.binary())], ["uid", "size", "rows"])

    for batch in slices(batches, column, most):
        n = pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if held and size + n > most:
            yield packed()
            uid, held, size = uid + 1, [], 0
        held.append(batch)
        size += n
    if held:
        yield packed()


def pack_rows(df: DataFrame, text_col: str, most: int = 4 << 20, shape: Callable[[pa.Table], pa.Table] | None = None) -> tuple[DataFrame, str]:
    """A table of shards: (uid, size, rows), where rows has all columns of up to `most` bytes of text as a compressed Arrow stream, or
    what `shape` makes of them.

    Rows stay where they are read, nothing is shuffled; a longer text is a shard of its own. uid is unique within the table, and as
    the table is written once, it means the same rows whenever it is read.
    """
    rows = df.mapInArrow(on_batches("", _pack_rows, df.columns.index(text_col), most, shape), PACKED_ROWS)
    return materialize(rows, "shards", packed=True)


def pack_table(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def unpack_rows(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all().combine_chunks()


def select_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) alone, so that other columns, whatever their names, are neither read nor in the way."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes each, of one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values (splitmix)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stream(n: int, seed: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


BYTE_CODE = _stream(256, 7)
_BASE, _POWERS = 0x9E3779B97F4A7C15, {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Base**k and its inverse modulo 2**64 for k up to n."""
    if len(_POWERS.get("up", ())) <= n:
        m = max(n + 1, 1 << 16)
        for name, b in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            x = np.full(m, b, np.uint64)
            x[0] = 1
            _POWERS[name] = np.cumprod(x)
    return _POWERS["up"][: n + 1], _POWERS["down"][: n + 1]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums for span_hashes; entry i covers data[:i]."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODE[data] * up[: len(data)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes in [start, end): equal bytes, equal values."""
    _, down = powers(len(sums))
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of the words at [start, end): eight bytes at a time go through a bijective finaliser, so no word's bytes cancel out."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    out = mix64((end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    live, at = np.arange(len(start)), start
    while len(live):
        left = end[live] - at
        chunk = eight[at]
        short = left < 8
        chunk[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        out[live] = mix64((out[live] ^ chunk) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))
        more = left > 8
        live, at = live[more], at[more] + 8
    return out


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end, and how many come before each row's first (one more entry than rows)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:] = ~inside[:-1]
    after[:-1] = ~inside[1:]
    start = np.flatnonzero(inside & (before | edge[:-1]))
    end = np.flatnonzero(inside & (after | edge[1:])) + 1
    return start, end, np.searchsorted(start, offsets)


def words(data: np.ndarray, offsets: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each ASCII-lower-cased word, and how many words come before each row's first (one more entry than rows)."""
    start, end, before = word_places(data, offsets)
    return word_hashes(LOWER[data], start, end, seed), before


def on_batches(owner: str, f: Callable, *args) -> Callable:
    """f with its first arguments, as a plain function of a task's batches; owner is the operator whose kept things stay, if it keeps any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(owner)
        yield from f(*args, batches)
        give_back()

    return run


def on_group(f: Callable, *args) -> Callable:
    """f with its first arguments, as a plain function of one group's table."""

    def run(table: pa.Table) -> pa.Table:
        kept("")
        out = f(*args, table)
        give_back()
        return out

    return run


def on_cogroup(f: Callable, *args) -> Callable:
    """f with its first arguments, as a plain function of two tables of one group."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kept("")
        out = f(*args, left, right)
        give_back()
        return out

    return run


def pack_ints(values: np.ndarray) -> bytes:
    """Non-negative 64-bit values in as few bytes each as the largest needs."""
    wide = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(wide.max()).bit_length() + 7) // 8) if len(wide) else 1
    return bytes([width]) + wide.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_ints(data: bytes) -> np.ndarray:
    out = np.zeros(((len(data) - 1) // data[0], 8), np.uint8)
    out[:, : data[0]] = np.frombuffer(data, np.uint8, offset=1).reshape(-1, data[0])
    return out.view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit values by Elias and Fano: the base, then whole low bytes as they are and the rest as a bitmap of ones and zeros."""
    values = np.ascontiguousarray(values, "<u8")
    if not len(values):
        return bytes(17)
    base, rest = int(values[0]), values - values[0]
    gap = max(int(rest[-1]) // len(values), 1).bit_length()
    low = (gap + 4) // 8
    high = (rest >> np.uint64(8 * low) if low < 8 else np.zeros(len(rest), np.uint64)).astype(np.int64)
    ones = np.zeros(int(high[-1]) + len(values), np.uint8)
    ones[high + np.arange(len(values))] = 1
    return base.to_bytes(8, "little") + len(values).to_bytes(8, "little") + bytes([low]) + rest.view(np.uint8).reshape(-1, 8)[:, :low].tobytes() + np.packbits(ones).tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    base, n, low = int.from_bytes(data[:8], "little"), int.from_bytes(data[8:16], "little"), data[16]
    out = np.zeros((n, 8), np.uint8)
    if low:
        out[:, :low] = np.frombuffer(data, np.uint8, n * low, 17).reshape(n, low)
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=17 + n * low)))[:n]
    high = (ones - np.arange(n)).astype(np.uint64)
    return out.view("<u8").ravel() + (high << np.uint64(8 * low) if low < 8 else high) + np.uint64(base)
