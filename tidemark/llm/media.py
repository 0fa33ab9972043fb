"""Media columns: 8-bit grey PNG images in binary columns, decoded from their chunks, with low-frequency cosine hashes."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import select_text, slices, utf8

SIGNATURE = b"\x89PNG\r\n\x1a\n"
WIDTH = 64
#: Side of the square an image is averaged to, and of the block of low frequencies that makes the hash.
SIDE, LOW = 32, 8


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(samples: np.ndarray, level: int = 1) -> bytes:
    """A PNG of a (height, width) uint8 array; each row has the filter (none, sub or up) of the least sum of absolute values."""
    height, width = samples.shape
    lines = np.zeros((3, height, width), np.uint8)
    lines[0] = samples
    lines[1] = samples
    lines[1][:, 1:] -= samples[:, :-1]
    lines[2] = samples
    lines[2][1:] -= samples[:-1]
    cost = np.abs(lines.view(np.int8).astype(np.int16)).sum(axis=2, dtype=np.int64)
    kind = cost.argmin(axis=0)
    raw = np.empty((height, width + 1), np.uint8)
    raw[:, 0] = kind
    raw[:, 1:] = lines[kind, np.arange(height)]
    head = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(raw.tobytes(), level)) + _chunk(b"IEND", b"")


def unfilter(raw: np.ndarray, bpp: int = 1) -> np.ndarray:
    """Samples of (height, 1 + width) filtered lines. Runs of rows without a predecessor, and of `up` rows, are done at once."""
    kind, out = raw[:, 0], raw[:, 1:].copy()
    height, width = out.shape
    if (kind > 4).any():
        raise ValueError("unknown filter")
    sub = np.flatnonzero(kind == 1)
    if len(sub):
        if bpp == 1:
            out[sub] = np.cumsum(out[sub], axis=1, dtype=np.uint8)
        else:
            for c in range(bpp):
                out[sub, c::bpp] = np.cumsum(out[sub, c::bpp], axis=1, dtype=np.uint8)
    at = 0
    edges = np.flatnonzero(np.diff(kind)) + 1
    for stop in [*edges.tolist(), height]:
        if kind[at] == 2:
            if at:
                out[at] += out[at - 1]
            out[at:stop] = np.cumsum(out[at:stop], axis=0, dtype=np.uint8)
        elif kind[at] > 2:
            for y in range(at, stop):
                above = out[y - 1].astype(int).tolist() if y else [0] * width
                line = out[y].astype(int).tolist()
                for x in range(width):
                    a = line[x - bpp] if x >= bpp else 0
                    b, c = above[x], above[x - bpp] if x >= bpp else 0
                    if kind[y] == 3:
                        guess = (a + b) // 2
                    else:
                        p = a + b - c
                        pa_, pb, pc = abs(p - a), abs(p - b), abs(p - c)
                        guess = a if pa_ <= pb and pa_ <= pc else b if pb <= pc else c
                    line[x] = (line[x] + guess) & 255
                out[y] = line
        at = stop
    return out


def decode_png(data: bytes) -> np.ndarray:
    """Samples of an 8-bit grey, non-interlaced PNG. Raises ValueError for other files and for any wrong checksum."""
    if data[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, packed, head, ended = 8, [], None, False
    while at + 12 <= len(data) and not ended:
        (n,) = struct.unpack_from(">I", data, at)
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        if len(body) != n or struct.unpack_from(">I", data, at + 8 + n)[0] != zlib.crc32(data[at + 4 : at + 8 + n]):
            raise ValueError("wrong checksum in a chunk")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            packed.append(body)
        ended = kind == b"IEND"
        at += 12 + n
    if head is None or not ended or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not a complete 8-bit grey image")
    raw = zlib.decompress(b"".join(packed))
    if len(raw) != head[1] * (head[0] + 1):
        raise ValueError("wrong size")
    return unfilter(np.frombuffer(raw, np.uint8).reshape(head[1], head[0] + 1))


def _basis() -> np.ndarray:
    k, x = np.arange(LOW)[:, None], np.arange(SIDE)[None]
    return np.cos(np.pi * k * (2 * x + 1) / (2 * SIDE))


BASIS = _basis()


def _averages(height: int, side: int = SIDE) -> tuple[np.ndarray, np.ndarray]:
    """Rows at which each of `side` bands begins, and the bands' heights; low images repeat rows."""
    at = np.arange(side) * height // side
    return at, np.maximum(np.append(at[1:], height) - at, 1)


def cosine_hash(samples: np.ndarray) -> str:
    """16 hex digits: signs of the 8 x 8 lowest cosine-transform coefficients against the median of those without the constant."""
    rows, tall = _averages(samples.shape[0])
    cols, wide = _averages(samples.shape[1])
    small = np.add.reduceat(samples, rows, axis=0, dtype=np.int64)
    small = np.add.reduceat(small, cols, axis=1) / (tall[:, None] * wide)
    low = np.round(BASIS @ small @ BASIS.T, 6).ravel()
    return np.packbits(low > np.median(low[1:])).tobytes().hex()


def _encode(level: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1):
        data, at = utf8(batch.column(1))
        out = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            padded = np.zeros(max(WIDTH, -(-(b - a) // WIDTH) * WIDTH), np.uint8)
            padded[: b - a] = data[a:b]
            out.append(encode_png(padded.reshape(-1, WIDTH), level))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at)), pa.array(out, pa.binary())], ["doc_id", "n_bytes", "media"])


def encode_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: int = 1) -> DataFrame:
    """(doc_id, n_bytes, media): each text's UTF-8 bytes, zero-padded to a positive multiple of 64, as rows of a grey PNG.

    Null and empty texts make one row of zeros; a very long text is one tall image; repeated rows and null ids stay; an empty table
    stays empty; other columns are not read.
    """
    return select_text(docs, id_col, text_col).mapInArrow(partial(_encode, level), "doc_id long, n_bytes long, media binary")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 2):
        cols: tuple[list, ...] = ([], [], [], [], [], [])
        for media in batch.column(2):
            media = media.as_py()
            samples = decode_png(media) if media is not None else None
            payload = samples.tobytes() if samples is not None else None
            row = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), cosine_hash(samples)) if payload is not None else [None] * 6
            for c, v in zip(cols, row, strict=True):
                c.append(v)
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


def media_features(media: DataFrame) -> DataFrame:
    """Decode (doc_id, n_bytes, media) and digest the samples read back; a null image gives nulls, a damaged one raises ValueError."""
    return media.select("doc_id", "n_bytes", "media").mapInArrow(_features, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
