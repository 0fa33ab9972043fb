"""Removal of repeated passages by suffix arrays over shards.

Every window of `width` bytes has an anchor, the first of its substrings of 3/5 of that with the least hash. Equal windows have equal
anchors at equal places, so windows whose anchor occurs in one document only can't repeat: hash ranges of anchors say which do. A
shard sorts the suffixes of what remains by Larsson-Sadakane refinement and takes their common prefixes by Kasai's walk; the suffixes
that begin at anchors go, with the bytes around them and once for each distinct surrounding, to the hash ranges as sorted runs. There
the runs are merged by binary search, and prefixes and left sides that entries share give the least document of each window. Bytes
decide: hashes only choose what is compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.common import drop, materialize, mix64, on_batches, on_cogroup, on_group, pack_ints, pack_rows, pack_sorted, parts_of, prefix_sums, span_hashes, unpack_ints, unpack_rows, unpack_sorted, utf8

#: Bytes of text in a shard, bytes hashed at once, bytes of candidates in one suffix array, and bytes of text for each hash range.
SHARD, TEXT_STEP, ARRAY_STEP, RANGE = 4 << 20, 1 << 20, 1 << 20, 12 << 20
LANE = 512
LAST = np.iinfo(np.int64).max
_SIGN = np.uint64(1 << 63)
_PLACE = np.uint64((1 << 31) - 1)


def _slide(x: np.ndarray, n: int, f) -> np.ndarray:
    """f over every n neighbours; the result is n - 1 shorter."""
    done = 1
    while 2 * done <= n:
        x = f(x[:-done], x[done:])
        done *= 2
    return f(x[: len(x) - (n - done)], x[n - done :]) if n > done else x


def _runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def gram_width(width: int) -> int:
    return max(1, width * 3 // 5, width - 60)


def _anchors_of(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    gram = gram_width(width)
    n = len(data) - width + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    start = np.arange(len(data) - gram + 1)
    hashes = span_hashes(prefix_sums(data), start, start + gram)
    # The place in the low bits makes the first of equals the least.
    least = _slide((hashes & ~_PLACE) | start.astype(np.uint64), width - gram + 1, np.minimum)
    place = (least & _PLACE).astype(np.int64)
    window = np.arange(n)
    inside = at[np.searchsorted(at, window, "right")] >= window + width
    change = np.append(True, (place[1:] != place[:-1]) | (inside[1:] != inside[:-1]))
    low = np.flatnonzero(change)
    high = np.append(low[1:], n) - 1
    sound = inside[low]
    low, high = low[sound], high[sound]
    return place[low], low, high, mix64(hashes[place[low]] ^ _SIGN)  # the least of many are small: spread them again


def anchors(data: np.ndarray, at: np.ndarray, width: int, step: int = TEXT_STEP) -> tuple[np.ndarray, ...]:
    """(place, first window, last window, hash) of each anchor: the windows of `width` bytes within a row that have it."""
    out, i, rows = [], 0, len(at) - 1
    while i < rows:  # rows of up to `step` bytes at once, longer rows in overlapping parts
        j = max(i + 1, int(np.searchsorted(at, at[i] + step, "right")) - 1)
        a, b = int(at[i]), int(at[j])
        if b - a <= 2 * step:
            out.append([x if k == 3 else x + a for k, x in enumerate(_anchors_of(data[a:b], at[i : j + 1] - a, width))])
        else:
            for s in range(a, b, step):
                e = min(s + step + width - 1, b)
                if e - s >= width:
                    out.append([x if k == 3 else x + s for k, x in enumerate(_anchors_of(data[s:e], np.array([0, e - s]), width))])
        i = j
    place, low, high, code = (np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.uint64 if k == 3 else np.int64) for k in range(4))
    first = _runs(place)  # two parts may share an anchor
    return place[first], low[first], high[np.append(first[1:], len(place)) - 1] if len(first) else high, code[first]


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Suffixes of symbols below 511 in full order (Larsson-Sadakane: doubling, where only unsorted groups are refined).

    The order must be full: Kasai's walk relies on it that dropping the first symbol of two suffixes keeps their order.
    """
    n = len(data)
    padded = np.zeros(n + 7, np.uint64)
    padded[:n] = data.astype(np.uint64) + np.uint64(1)  # the end is less than any symbol
    key = np.zeros(n, np.uint64)
    for k in range(7):
        key = (key << np.uint64(9)) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    fresh = np.append(True, key[order][1:] != key[order][:-1])[:n]
    rank = np.empty(n, np.int64)
    group = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank[order] = group
    h = 7
    while True:
        alone = fresh & np.append(fresh[1:], True)[:n]
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        suffix = order[open_]
        follow = suffix + h
        after = np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        both = group[open_] * (n + 1) + after
        by = np.argsort(both, kind="stable")
        order[open_] = suffix[by]
        both = both[by]
        fresh[open_] = np.append(True, both[1:] != both[:-1])
        group = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        rank[order] = group
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length, up to `most`, of the prefix that each suffix in order shares with the one before it.

    Kasai's walk in text order, where a length falls by one at most from place to place; many stretches of the text walk at once.
    """
    n = len(data)
    padded = np.zeros(n + most + LANE + 1, data.dtype)
    padded[:n] = data
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int32)
    lane = np.arange(0, n, LANE)
    length = np.zeros(len(lane), np.int64)
    for step in range(min(LANE, n)):
        place = lane + step
        place = place[place < n]
        prior = before[place]
        now = np.maximum(length[: len(place)] - 1, 0)
        now[prior < 0] = 0
        limit = np.minimum(most, n - np.maximum(place, prior))
        live = np.flatnonzero((prior >= 0) & (now < limit))
        while len(live):
            same = padded[place[live] + now[live]] == padded[prior[live] + now[live]]
            live = live[same]
            now[live] += 1
            live = live[now[live] < limit[live]]
        length[: len(place)] = now
        out[place] = now
    return out[order]


def _shard(rows: bytes) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """All columns, the bytes, the offsets and the documents of a shard's rows."""
    table = unpack_rows(rows)
    data, at = utf8(table.column("text"))
    return table, data, at, table.column("doc").to_numpy()


def _asked(key: np.ndarray, row: np.ndarray, doc: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct anchor keys, whether several documents have them, and the key of each anchor by its number."""
    key, of = np.unique(key >> np.uint64(64 - bits), return_inverse=True)
    low, high = np.full(len(key), LAST), np.full(len(key), -LAST - 1)
    np.minimum.at(low, of, doc[row])
    np.maximum.at(high, of, doc[row])
    return key, low != high, of


def _edges(key: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Where sorted keys pass from one hash range to the next."""
    return np.searchsorted(key, np.array([-(-(k << bits) // buckets) for k in range(buckets)], np.uint64)).tolist() + [len(key)]


ASK = "bucket int, uid long, keys binary, several binary"


def _ask(width: int, step: int, buckets: int, bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchor keys of each shard, by hash range."""
    for batch in batches:
        for uid, rows in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
            _, data, at, doc = _shard(rows.as_buffer())
            place, _, _, code = anchors(data, at, width, step)
            key, several, _ = _asked(code, np.searchsorted(at, place, "right") - 1, doc, bits)
            edge = _edges(key, buckets, bits)
            out = [(k, uid, pack_sorted(key[a:b]), np.packbits(several[a:b]).tobytes()) for k, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if a < b]
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["bucket", "uid", "keys", "several"])


def _answer(table: pa.Table) -> pa.Table:
    """For each shard's keys of a hash range, which of them several documents have."""
    runs = [unpack_sorted(x) for x in table.column("keys").to_pylist()]
    several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(r)) for x, r in zip(table.column("several").to_pylist(), runs, strict=True)]).astype(bool)
    _, of, count = np.unique(np.concatenate(runs), return_inverse=True, return_counts=True)
    many = count > 1
    many[of[several]] = True
    bits = [np.packbits(x).tobytes() for x in np.split(many[of], np.cumsum([len(r) for r in runs])[:-1])]
    return pa.table({"uid": table.column("uid"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})


FIELDS = "bucket long, uid long, array int, run binary, docs binary"
KINDS = (("bucket", pa.int64()), ("uid", pa.int64()), ("array", pa.int32()), ("run", pa.binary()), ("docs", pa.binary()))


def _rows(rows: list[tuple]) -> pa.Table:
    return pa.table({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(KINDS)})


def _columns(matrix: np.ndarray) -> list[np.ndarray]:
    """Rows of bytes as big-endian integers, first bytes first: they compare like the bytes."""
    wide = np.zeros((len(matrix), -(-matrix.shape[1] // 8) * 8), np.uint8)
    wide[:, : matrix.shape[1]] = matrix
    return list(wide.view(">u8").astype(np.uint64).T)


def _squeeze(*parts: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join([len(p).to_bytes(4, "little") + p for p in parts]))


def _loosen(data: bytes) -> list[bytes]:
    data, out, at = zstandard.ZstdDecompressor().decompress(data), [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "little")
        out.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return out


def _entries(data: np.ndarray, stop: np.ndarray, doc: np.ndarray, anchor: tuple[np.ndarray, ...], width: int, buckets: int, uid: int, array: int) -> Iterator[tuple]:
    """Sorted runs of the suffixes at some anchors of a shard, by hash range; bucket -1 - uid keeps where they occur.

    stop and doc are the row end and document of each anchor.
    """
    place, low, high, bucket = anchor
    end = np.minimum(place + width, stop)
    first = np.flatnonzero(np.append(True, (low[1:] > np.maximum.accumulate(end)[:-1]) | (stop[1:] != stop[:-1])))
    begin, length = low[first], np.maximum.reduceat(end, first) - low[first]
    shift = np.cumsum(length + 1) - (length + 1)
    symbols = data[np.minimum(np.repeat(begin - shift, length + 1) + np.arange((length + 1).sum()), len(data) - 1)].astype(np.uint16) + np.uint16(1)
    symbols[shift + length] = 0  # less than any byte: a suffix ends with its row
    of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(place))))
    order = suffix_array(symbols)
    which = np.full(len(symbols), -1)
    which[place - begin[of] + shift[of]] = np.arange(len(place))
    at = np.flatnonzero(which[order] >= 0)
    by = which[order[at]]
    prefix = np.minimum.reduceat(common_prefixes(symbols, order, width + 1)[: at[-1] + 1], np.append(0, at[:-1] + 1))
    place, low, high, stop, doc, bucket = (x[by] for x in (place, low, high, stop, doc, bucket))
    # Suffixes with equal bytes up to the row's end, or for `width` bytes, are one group of the run.
    size = np.minimum(stop - place, width)
    group = np.cumsum(np.append(True, prefix[1:] < np.minimum(size[1:] + 1, width)))
    margin = width - gram_width(width)
    padded = np.zeros(len(data) + width + margin, np.uint8)
    padded[margin : margin + len(data)] = data
    right = np.lib.stride_tricks.sliding_window_view(padded[margin:], width)[place]
    right[np.arange(width, dtype=np.uint8) >= size[:, None].astype(np.uint8)] = 0
    left = np.lib.stride_tricks.sliding_window_view(padded, margin)[place][:, ::-1] if margin else np.zeros((len(place), 0), np.uint8)
    left = np.where(np.arange(margin, dtype=np.uint8) < (place - low)[:, None].astype(np.uint8), left, np.uint8(0))
    record = np.concatenate([right, size[:, None].astype(np.uint8), left, (place - high)[:, None].astype(np.uint8), (place - low)[:, None].astype(np.uint8)], axis=1)
    tail = _columns(record[:, width + 1 :])
    by = np.lexsort((*tail[::-1], group, bucket))
    place, low, high, doc, bucket, group, record = (x[by] for x in (place, low, high, doc, bucket, group, record))
    fresh = np.append(True, (group[1:] != group[:-1]) | (bucket[1:] != bucket[:-1]))
    for c in tail:
        fresh[1:] |= c[by][1:] != c[by][:-1]
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(fresh)))
    least = np.minimum.reduceat(doc, first)
    own = _squeeze(pack_ints(count), pack_ints(place), np.packbits(doc > np.repeat(least, count)).tobytes(), record[first, -2].tobytes(), record[first, -1].tobytes())
    yield (-1 - uid, uid, array, own, None)
    record, bucket = record[first], bucket[first]
    edge = np.append(_runs(bucket), len(bucket)).tolist()
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        docs = least[a:b].view(np.uint64) ^ _SIGN
        base = docs.min()
        yield (int(bucket[a]), uid, array, _squeeze(record[a:b].tobytes()), int(base).to_bytes(8, "little") + pack_ints(docs - base))


def _segment(width: int, step: int, most: int, buckets: int, bits: int, shards: pa.Table, answers: pa.Table) -> pa.Table:
    """Sort the suffixes of a shard's candidates, in arrays of bounded size."""
    out = []
    said = dict(zip(answers.column("bucket").to_pylist(), answers.column("bits").to_pylist(), strict=True))
    for uid, rows in zip(shards.column("uid").to_pylist(), shards.column("rows"), strict=True):
        _, data, at, doc = _shard(rows.as_buffer())
        place, low, high, code = anchors(data, at, width, step)
        row = np.searchsorted(at, place, "right") - 1
        key, _, of = _asked(code, row, doc, bits)
        edge = _edges(key, buckets, bits)
        many = np.zeros(len(key), bool)
        for k, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
            if a < b:
                many[a:b] = np.unpackbits(np.frombuffer(said[k], np.uint8), count=b - a).astype(bool)
        bucket = np.repeat(np.arange(buckets), np.diff(edge))[of] if len(of) else of
        pick = np.flatnonzero(many[of])
        if not len(pick):
            continue
        weight = np.cumsum(np.append(width, np.minimum(np.diff(place[pick]), 2 * width)))
        for array, part in enumerate(np.split(pick, _runs(weight // most)[1:])):
            out += _entries(data, at[row[part] + 1], doc[row[part]], (place[part], low[part], high[part], bucket[part]), width, buckets, uid, array)
    return _rows(out)


def _merged(keys: list[np.ndarray]) -> np.ndarray:
    """The order in which sorted runs, one after another, become one run: pairs are merged by binary search until one is left."""
    at = np.cumsum([0] + [len(k) for k in keys])
    held = [(k, np.arange(a, a + len(k))) for k, a in zip(keys, at, strict=False)]
    while len(held) > 1:
        after = []
        for (a, i), (b, j) in zip(held[::2], held[1::2], strict=False):
            to = np.searchsorted(a, b, "right") + np.arange(len(b))
            rest = np.ones(len(a) + len(b), bool)
            rest[to] = False
            key, index = np.empty(len(rest), a.dtype), np.empty(len(rest), np.int64)
            key[to], key[rest], index[to], index[rest] = b, a, j, i
            after.append((key, index))
        held = after + held[len(held) // 2 * 2 :]
    return held[0][1]


def _merge(width: int, table: pa.Table) -> pa.Table:
    """For each entry of a hash range a mask: bit r says that an earlier document has the window that begins r bytes before the anchor."""
    if table.column("bucket")[0].as_py() < 0:
        return table
    margin = width - gram_width(width)
    wide = width + margin + 3
    parts = [np.frombuffer(_loosen(x)[0], np.uint8).reshape(-1, wide) for x in table.column("run").to_pylist()]
    docs = np.concatenate([(unpack_ints(x[8:]) + np.uint64(int.from_bytes(x[:8], "little")) ^ _SIGN).view(np.int64) for x in table.column("docs").to_pylist()])
    order = _merged([np.ascontiguousarray(p[:, : width + 1]).view(f"S{width + 1}").ravel() for p in parts])
    record = np.concatenate(parts)[order]
    doc = docs[order]
    n = len(record)
    cut = lambda a: np.append(0, np.where((a[1:] == a[:-1]).all(axis=1), a.shape[1], (a[1:] != a[:-1]).argmax(axis=1)))
    prefix = cut(record[:, :width])
    left = record[:, width + 1 : width + 1 + margin]
    by = np.lexsort(_columns(left)[::-1]) if margin else np.arange(n)
    shared = cut(left[by]) if margin else np.zeros(n, np.int64)
    near, far = record[:, -2], record[:, -1]
    mask = np.zeros(n, np.uint64)
    side = np.empty(n, np.int64)
    for r in range(margin + 1):
        pick = np.flatnonzero((near <= r) & (r <= far))
        if len(pick):
            side[by] = np.cumsum(shared < r)
            both = np.cumsum(prefix < width - r)[pick] * (n + 1) + side[pick]
            to = np.argsort(both, kind="stable")
            first = _runs(both[to])
            least = np.repeat(np.minimum.reduceat(doc[pick[to]], first), np.diff(np.append(first, len(to))))
            mask[pick[to]] |= (doc[pick[to]] > least).astype(np.uint64) << np.uint64(r)
    back = np.empty(n, np.uint64)
    back[order] = mask
    masks = np.split(back, np.cumsum([len(p) for p in parts])[:-1])
    uids, arrays, buckets = (table.column(c).to_pylist() for c in ("uid", "array", "bucket"))
    return _rows([(b, u, a, _squeeze(pack_ints(m)), None) for b, u, a, m in zip(buckets, uids, arrays, masks, strict=True)])


def removed_bytes(width: int, n: int, parts: pa.Table) -> np.ndarray:
    """Which of a shard's n bytes are removed, from where its entries occur and their masks."""
    gone = np.zeros(n, bool)
    found = sorted(zip(*(parts.column(c).to_pylist() for c in ("array", "bucket", "run")), strict=True), key=lambda x: x[:2])
    for array in sorted({a for a, _, _ in found}):
        own = _loosen(next(x for a, b, x in found if a == array and b < 0))
        count, place = unpack_ints(own[0]).astype(np.int64), unpack_ints(own[1]).astype(np.int64)
        later = np.unpackbits(np.frombuffer(own[2], np.uint8), count=len(place)).astype(bool)
        near, far = (np.frombuffer(x, np.uint8).astype(np.uint64) for x in own[3:5])
        every = (np.uint64(2) << far) - (np.uint64(1) << near)
        mask = np.concatenate([unpack_ints(_loosen(x)[0]) for a, b, x in found if a == array and b >= 0])
        mask = np.where(later, np.repeat(every, count), np.repeat(mask, count))
        for r in range(width - gram_width(width) + 1):
            gone[place[(mask >> np.uint64(r)) & np.uint64(1) == 1] - r] = True
    place = np.arange(n, dtype=np.int32)
    return place - np.maximum.accumulate(np.where(gone, place, np.int32(-width))) < width if n else gone


def _finish(width: int, schema: pa.Schema, shards: pa.Table, parts: pa.Table) -> pa.Table:
    """The rows of a shard with what is left of their texts."""
    out = []
    for rows in shards.column("rows"):
        table, data, at, doc = _shard(rows.as_buffer())
        gone = removed_bytes(width, len(data), parts)
        sums = np.concatenate([[0], np.cumsum(gone)])
        rise = gone.copy()
        rise[1:] &= ~gone[:-1]
        rise[at[:-1][at[:-1] < len(data)]] = gone[at[:-1][at[:-1] < len(data)]]
        spans = np.concatenate([[0], np.cumsum(rise)])
        left = data[~gone].tobytes()
        edge = (at - sums[at]).tolist()
        kept = [left[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)]
        cols = {
            "doc_id": pa.array(doc, mask=doc == LAST),
            "n_bytes": pa.array(np.diff(at)),
            "n_removed": pa.array(np.diff(sums[at])),
            "n_spans": pa.array(np.diff(spans[at])),
            "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            "kept": pa.array(kept, pa.binary()),
        }
        if "row" in table.column_names:
            absent = table.column("text").is_null().to_numpy()
            cols["kept_text"] = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string(), mask=absent)
            cols["row"] = table.column("row")
        out.append(pa.table(cols).cast(schema))
    return pa.concat_tables(out)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, carry: bool = False, shard_bytes: int = SHARD, part_bytes: int = TEXT_STEP, array_bytes: int = ARRAY_STEP, spare_bits: int = 10) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row of docs; with carry also kept_text, null for a null text
    and without characters that a cut splits, and `row`, a struct of the other columns.

    Removed is each byte covered by `width` bytes that also start in a document of smaller id. Null and empty texts, and texts shorter
    than `width`, lose nothing; very long texts are shards of their own, hashed and sorted in parts. Rows that share an id are one
    document, so they don't take from one another; null ids come last and are one document. Repeated rows stay; an empty table stays
    empty. Without carry other columns are not read. A key of an anchor has spare_bits more bits than tell the windows of the corpus
    apart; fewer would only make more candidates. Records tell sizes in one byte, so a `width` above 255 is refused.
    """
    if not 0 < width <= 255:
        raise ValueError("width must be 1 to 255")
    spark = docs.sparkSession
    extra = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")] if carry else []
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.col(text_col).cast("string").alias("text"), *extra)
    shards, _ = pack_rows(rows, "text", shard_bytes)
    total = shards.agg(F.sum("size")).first()[0] or 0
    buckets, bits = parts_of(total, RANGE), min(63, max(8, total.bit_length() + spare_bits - 3))
    answers = shards.mapInArrow(on_batches("", _ask, width, part_bytes, buckets, bits), ASK).groupBy("bucket").applyInArrow(on_group(_answer), "uid long, bucket int, bits binary")
    answers, answers_at = materialize(answers, "anchors", packed=True)
    runs = shards.groupBy("uid").cogroup(answers.groupBy("uid")).applyInArrow(on_cogroup(_segment, width, part_bytes, array_bytes, buckets, bits), FIELDS)
    marks, _ = materialize(runs.groupBy("bucket").applyInArrow(on_group(_merge, width), FIELDS), "marks", packed=True)
    drop(spark, answers_at)
    schema = StructType.fromDDL("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    if carry:
        schema = schema.add("kept_text", "string").add("row", rows.schema["row"].dataType)
    return shards.groupBy("uid").cogroup(marks.groupBy("uid")).applyInArrow(on_cogroup(_finish, width, to_arrow_schema(schema)), schema)
