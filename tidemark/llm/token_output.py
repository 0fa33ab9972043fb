"""Token ids as Parquet list columns, in document order, with small row groups and page indexes.

Ids are dictionary-encoded while a chunk's dictionary fits and delta-encoded beyond that (Parquet writer version 2); document
ids and offsets are delta-encoded. Row groups and pages are bounded, and the writer adds column and offset indexes, so that a
reader of a few documents, or of counts alone, touches few pages.
"""

from __future__ import annotations

import os
import string
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.alignment import chunk_starts
from tidemark.llm.bpe import Recent
from tidemark.llm.common import kept, on_batches, pieces, select_text, slices, utf8, word_hashes

LAYOUT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(16 << 20),
    "parquet.page.size": str(1 << 20),
    "parquet.page.row.count.limit": "500",
}
FIELDS = "doc_id long, part int, at long, n_tokens long, ids array<int>"
#: Bytes of the encoded chunks that a worker keeps, and of one of them with its ids; chunks that the library gets as one string.
CACHE_BYTES, LONG_BYTES, TOGETHER = 48 << 20, 1 << 8, 64
#: Bytes of a chunk beside its own and its ids: offsets, hash, row and last use.
ROW_BYTES = 36
#: ASCII letters; ASCII punctuation.
LETTER, MARKS = np.zeros(256, bool), np.zeros(256, bool)
LETTER[list(string.ascii_letters.encode())] = True
MARKS[list(string.punctuation.encode())] = True
#: Bytes of text whose chunks are looked up together.
SLICE_BYTES = 8 << 20


def _tokenizer(key: str, text: str) -> dict:
    built = kept("token_output")
    if built.get("key") != key:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        built.update(key=key, tokenizer=Tokenizer.from_str(text), cache=Chunks())
    return built


class Chunks:
    """Distinct chunks and their ids as Arrow columns, of `most` bytes at most between calls; those asked for last stay.

    The first is the chunk without bytes, which is a text's end. Chunks are found by a search among sorted hashes and compared as they are.
    """

    def __init__(self, most: int = CACHE_BYTES) -> None:
        self.most, self.end, self.turn = most, None, 0

    def begin(self, tokenizer, end: bytes) -> None:
        if self.end == end:
            return
        self.end = end
        self.keys, self.ids, self.used = pa.array([b""], pa.binary()), pa.array([end], pa.large_binary()), np.zeros(1, np.int64)
        self.hashes, self.row = self.hash(self.keys), np.zeros(1, np.int64)
        added = {i: t.content for i, t in tokenizer.get_added_tokens_decoder().items()}
        names = tokenizer.get_vocab()
        self.width = np.ones(max(names.values()) + 1, np.int64)
        for name, i in names.items():  # byte-level entries have one character for each byte
            self.width[i] = len(added[i].encode()) if i in added else len(name)
        self.marks = MARKS.copy()
        self.marks[list("".join(added.values()).encode())] = False

    def hash(self, keys: pa.Array) -> np.ndarray:
        data, at = utf8(keys)
        return word_hashes(data, at[:-1], np.minimum(at[1:], at[:-1] + LONG_BYTES), 1)

    def find(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The row of each chunk, or -1, and the chunks' hashes."""
        hashes = self.hash(keys)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        rows = np.where(self.hashes[at] == hashes, self.row[at], -1)
        hit = np.flatnonzero(rows >= 0)
        same = pc.equal(self.keys.take(pa.array(rows[hit])), keys.take(pa.array(hit))).to_numpy(zero_copy_only=False)
        rows[hit[~same]] = -1
        return rows, hashes

    def put(self, keys: pa.Array, ids: pa.Array, hashes: np.ndarray, asked: np.ndarray) -> None:
        """From now on ids are those of the chunks so far and of these keys; asked are the rows that were asked for."""
        n, self.turn = len(self.keys), self.turn + 1
        self.keys, self.ids, self.used = pa.concat_arrays([self.keys, keys]), ids, np.append(self.used, np.zeros(len(keys), np.int64))
        self.used[asked], self.used[0] = self.turn, self.turn + 1
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes, self.row = np.insert(self.hashes, at, hashes[order]), np.insert(self.row, at, n + order)
        cost = np.diff(utf8(self.keys)[1]) + np.diff(utf8(self.ids)[1]) + ROW_BYTES
        stay = cost <= LONG_BYTES  # long chunks hardly come again
        if cost[stay].sum() > self.most:
            last = np.argsort(-self.used, kind="stable")
            last = last[stay[last]]
            stay[last[np.cumsum(cost[last]) > self.most // 2]] = False
        stay[0] = True
        if not stay.all():
            held = stay[self.row]
            self.hashes, self.row = self.hashes[held], (np.cumsum(stay) - 1)[self.row[held]]
            self.keys, self.ids, self.used = self.keys.filter(pa.array(stay)), ids.filter(pa.array(stay)), self.used[stay]


def cut_places(data: np.ndarray, offsets: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Where chunks begin: at white space as chunk_starts has it, and at marks behind a letter, as no match of the pre-tokenizer goes on from
    a letter to anything else. Letters are those of ASCII and of U+00C0 to U+027F, on which all versions of Unicode agree."""
    at = np.flatnonzero(marks[data])
    at = at[at > 0]
    one, two = data[at - 1], data[np.maximum(at - 2, 0)]
    letter = LETTER[one] | (one >= 0x80) & (one < 0xC0) & (two >= 0xC3) & (two <= 0xC9) & ~((two == 0xC3) & ((one == 0x97) | (one == 0xB7)))
    start = np.zeros(len(data), bool)
    start[chunk_starts(data, offsets)] = True
    start[at[letter]] = True
    return np.flatnonzero(start)


def encode_chunks(chunks: pa.Array, tokenizer, width: np.ndarray, marks: np.ndarray) -> pa.Array:
    """Ids of distinct chunks as native 32-bit integers.

    The library gets strings of some chunks, as its calls cost more than a chunk. Chunks follow each other only where a text could be cut between them,
    and the widths of a string's tokens tell which are whose; where they don't add up, as in bytes that are not UTF-8, each chunk is a string.
    """
    data, at = utf8(chunks)
    raw, n = data.tobytes(), len(chunks)
    place = np.zeros(len(data) + 1, bool)
    place[cut_places(data, np.array([0, len(data)]), marks)] = True
    apart = ~place[at[:-1]]
    apart[::TOGETHER] = True
    while True:
        first, of = np.flatnonzero(apart), np.cumsum(apart) - 1
        edges = at[np.append(first, n)]
        texts, ids, counts = [raw[i:j].decode("utf-8", "replace") for i, j in zip(edges[:-1], edges[1:], strict=True)], array("i"), []
        for k in range(0, len(texts), 512):
            for e in tokenizer.encode_batch_fast(texts[k : k + 512], add_special_tokens=False):
                ids.extend(got := e.ids)
                counts.append(len(got))
        begin = np.append(0, np.cumsum(np.array(counts, np.int64)))
        ends = np.append(0, np.cumsum(width[np.frombuffer(ids, np.int32)] if ids else np.zeros(0, np.int64)))
        want = ends[begin[of]] + at[:-1] - edges[of]
        cut = np.searchsorted(ends, want)
        wrong = np.diff(ends[begin]) != np.diff(edges)
        wrong[of[ends[np.minimum(cut, len(ends) - 1)] != want]] = True
        wrong &= np.diff(np.append(first, n)) > 1
        if not wrong.any():
            break
        apart |= wrong[of]
    cut[first] = begin[:-1]
    return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer((np.append(cut, len(ids)) << 2).astype(np.int64).tobytes()), pa.py_buffer(ids.tobytes())])


def encode_texts(texts: pa.Array, tokenizer, cache: Chunks | Recent, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """Ids of whole texts, one after another and each with `end` behind it, and where each text's ids begin.

    No match of the pre-tokenizer goes on across a place where a blank, tab or line end follows something else than white space, or a mark a letter, nor do strings of special tokens,
    so chunks between such places are encoded alone, each once as long as `cache` holds it; of a cache that isn't a Chunks only the bound counts. A text's end is a chunk without bytes.
    """
    known = cache if isinstance(cache, Chunks) else Chunks(cache.most)
    known.begin(tokenizer, end)
    data, offsets = utf8(texts)
    starts = cut_places(data, offsets, known.marks)
    at = np.searchsorted(starts, offsets[1:], "left")
    edges = np.append(np.insert(starts, at, offsets[1:]), len(data)).astype(np.int32)
    chunks = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)])
    coded = chunks.dictionary_encode()
    rows, hashes = known.find(coded.dictionary)
    new = np.flatnonzero(rows < 0)
    rows[new] = len(known.keys) + np.arange(len(new))
    asked, found = coded.dictionary.take(pa.array(new)), known.ids
    if len(new):
        found = pa.concat_arrays([found, encode_chunks(asked, tokenizer, known.width, known.marks)])
    ids, cut = utf8(found.take(pa.array(rows[coded.indices.to_numpy()])))
    known.put(asked, found, hashes[new], rows)
    return ids.view(np.int32), np.append(0, cut[at + np.arange(len(at)) + 1]) >> 2


def _encode(key: str, shipped: Broadcast, end_id: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    built = _tokenizer(key, shipped.value)
    end, at = np.array([end_id], np.int32).tobytes(), 0
    for batch in slices(batches, 1, SLICE_BYTES):
        ids, edges = encode_texts(batch.column(1), built["tokenizer"], built["cache"], end)
        starts = pa.array(at + edges[:-1])
        at += len(ids)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), starts, pa.array(np.diff(edges)), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids))], ["doc_id", "part", "at", "n_tokens", "ids"])


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", bytes_each: int = 8 << 20) -> None:
    """Encode every whole text, add end_id to each document and write the ids to path in ascending document order.

    One file holds one range of document ids. Null and empty texts have the end id alone; a null document id comes first; repeated
    rows all stay, in no fixed order among equals; an empty table gives files without rows. Other columns are not read.
    Chunks between white space, or from a mark behind a letter on, are encoded by the library once as long as a worker keeps them, which gives the ids of
    the whole text because the byte-level pre-tokenizer never joins them; strings of special tokens have no blanks, their characters are no marks, and they are found as the library finds them.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        shipped = docs.sparkSession.sparkContext.broadcast(f.read())  # a public tokenizer's file, of fixed size
    ordered = select_text(docs, id_col, text_col).repartitionByRange(pieces(docs, bytes_each), "doc_id").sortWithinPartitions("doc_id")
    rows = ordered.select("doc_id", "text", F.spark_partition_id().alias("part"))
    rows.mapInArrow(on_batches("token_output", _encode, tokenizer_path, shipped, end_id), FIELDS).write.options(**LAYOUT).parquet(path)


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The rows of a token table, or those of a range of document ids: the filter reaches the page indexes."""
    found = spark.read.schema(FIELDS).parquet(path)
    if first is not None:
        found = found.where(F.col("doc_id") >= first)
    return found if last is None else found.where(F.col("doc_id") <= last)


def _checks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(3)
        values, at = ids.values.to_numpy(zero_copy_only=False).view("<u4"), ids.offsets.to_numpy()
        n = np.diff(at).astype(np.int64)
        crc = np.array([zlib.crc32(values[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)], np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(n), pa.array(crc)], ["doc_id", "part", "at", "n_tokens", "ids_crc32"])


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files.

    start counts the ids of all documents before it: its offset within its file plus the sizes of the files before, of which there
    is one row each.
    """
    rows = read_tokens(spark, path)
    sizes = rows.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = sizes.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    found = rows.select("doc_id", "part", "at", "ids").mapInArrow(_checks, "doc_id long, part int, at long, n_tokens long, ids_crc32 long")
    return found.join(before, "part").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
