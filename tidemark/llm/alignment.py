"""Alignment of two tokenizers over the same bytes, and how often their tokens meet in a corpus.

Tokens of both end together at some byte offsets, which cut a text into groups; within a group every token of one side is linked with
every token of the other. What a pair of ids counts, and which pair is an id's best, is known only over all documents: each document's
pairs with their multiplicities are postings, which are shuffled by the id of the first side. There they meet the pairs' counts, and
go back as each document's contributions, which are summed.

Neither tokenizer has a token across a place where white space follows something else, so texts are cut there, and each distinct chunk
is encoded and aligned once for each cache of a worker. Where a chunk's bytes are not those of its tokens the whole text is asked.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, mix64, on_cogroup, pack_ints, pack_sorted, pack_table, parts_of, select_text, slices, unpack_ints, unpack_rows, unpack_sorted, utf8

#: Ids of the second side take so many bits of a pair.
SIDE_BITS = 16
#: Text of one shard of postings, pairs of one bucket of ids, postings of one group, and pairs a task sums before it sends them.
SHARD_BYTES, BUCKET_PAIRS, GROUP_POSTINGS, TASK_PAIRS = 8 << 20, 1 << 16, 1 << 22, 1 << 22
LEAST_BUCKETS = 24
#: Bytes of aligned chunks that a worker keeps.
CACHE_BYTES = 96 << 20
SHARD = "uid long, n long, digests binary, pairs binary, lens binary, docs binary, times binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_BUILT: dict = {}


class Tokenizers:
    """Both tokenizers with the bytes of their tokens, and the chunks a worker has aligned."""

    def __init__(self, byte_level: str, pieces: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in set(plain)]
        byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}  # how byte-level entries spell bytes
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = pa.array([bytes(byte[c] for c in t) if all(c in byte for c in t) else b"" for t in names], pa.binary())
        spelt = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = pa.array([bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(spelt)], pa.binary())
        self.blank = self.b.piece_to_id("▁")
        self.text = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.known, self.size = Aligned.empty(), 0

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that stand after a blank, their own first character if it is one, or after something else than white space.

        The model puts a blank before a text: that is the one a text begins with, and for others it is a token of its own, left out."""
        found = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        return [ids[1:] if t[0] != " " else ids or [self.blank] for t, ids in zip(texts, found, strict=True)]


class Aligned:
    """Per chunk: whether its tokens have its bytes, tokens of both sides, groups, links, the groups' text, and the linked pairs."""

    def __init__(self, sound: np.ndarray, counts: np.ndarray, text: list[bytes], lens: np.ndarray, pairs: np.ndarray) -> None:
        self.sound, self.counts, self.text, self.lens, self.pairs = sound, counts, text, lens, pairs

    @classmethod
    def empty(cls) -> Aligned:
        return cls(np.zeros(0, bool), np.zeros((0, 4), np.int64), [], np.zeros(0, np.int64), np.zeros(0, np.int64))

    def and_(self, other: Aligned) -> Aligned:
        both = lambda name: np.concatenate([getattr(self, name), getattr(other, name)])
        return Aligned(both("sound"), both("counts"), self.text + other.text, both("lens"), both("pairs"))


def _sound(ids: np.ndarray, n: np.ndarray, table: pa.Array, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which chunks their tokens' bytes spell, and each token's length."""
    spelt, at = utf8(table.take(pa.array(ids)))
    length, of = np.diff(at), np.repeat(np.arange(len(n)), n)
    good = np.bincount(of, length, len(n)).astype(np.int64) == size
    mine = spelt[np.repeat(good[of], length)]
    chunk = np.repeat(np.arange(len(n)), size)
    theirs = good[chunk]
    good[chunk[theirs][mine != data[theirs]]] = False
    return good, length


def align(own: Tokenizers, chunks: list[bytes]) -> Aligned:
    """Tokens, groups and links of each chunk on its own; a chunk that its tokens don't spell has none."""
    texts = [c.decode("utf-8", "replace") for c in chunks]
    a, b = own.encode_a(texts), own.encode_b(texts)
    size, data = np.array([len(c) for c in chunks], np.int64), np.frombuffer(b"".join(chunks), np.uint8)
    flat = lambda x: np.array([i for ids in x for i in ids], np.int64)
    ids_a, ids_b = flat(a), flat(b)
    n_a, n_b = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    good_a, len_a = _sound(ids_a, n_a, own.bytes_a, data, size)
    good_b, len_b = _sound(ids_b, n_b, own.bytes_b, data, size)
    sound = good_a & good_b
    of_a, of_b = np.repeat(np.arange(len(chunks)), n_a), np.repeat(np.arange(len(chunks)), n_b)
    keep_a, keep_b = sound[of_a], sound[of_b]
    ids_a, ids_b, of_a = ids_a[keep_a], ids_b[keep_b], of_a[keep_a]
    end_a, end_b = np.cumsum(len_a[keep_a]), np.cumsum(len_b[keep_b])
    common = np.intersect1d(end_a, end_b, assume_unique=True)
    in_a, in_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
    g_a, g_b = np.bincount(in_a, minlength=len(common)), np.bincount(in_b, minlength=len(common))
    at_a, at_b = np.cumsum(g_a) - g_a, np.cumsum(g_b) - g_b
    of_group = of_a[at_a] if len(common) else np.zeros(0, np.int64)
    per = lambda of, w=None: np.bincount(of, w, len(chunks)).astype(np.int64)
    counts = np.stack([n_a * sound, n_b * sound, per(of_group), per(of_group, g_a * g_b)], axis=1)
    times = g_b[in_a]
    b_at = np.repeat(at_b[in_a] - (np.cumsum(times) - times), times) + np.arange(int(times.sum()))
    pairs = np.repeat(ids_a, times) << SIDE_BITS | ids_b[b_at]
    say_a, say_b = [own.text[i] for i in ids_a.tolist()], [own.text[i] for i in ids_b.tolist()]
    groups = [f"{','.join(say_a[i : i + n])}|{','.join(say_b[j : j + m])};" for i, n, j, m in zip(at_a.tolist(), g_a.tolist(), at_b.tolist(), g_b.tolist(), strict=True)]
    ends = np.cumsum(counts[:, 2]).tolist()
    text = ["".join(groups[i:j]).encode() for i, j in zip([0, *ends[:-1]], ends, strict=True)]
    return Aligned(sound, counts, text, counts[:, 3], pairs)


def _look_up(own: Tokenizers, chunks: list[bytes]) -> np.ndarray:
    """Places of distinct chunks among the known ones, which the missing are added to."""
    missing = [c for c in chunks if c not in own.place]
    for i in range(0, len(missing), 8192):
        some = missing[i : i + 8192]
        found = align(own, some)
        own.place |= zip(some, range(len(own.place), len(own.place) + len(some)), strict=True)
        own.known = own.known.and_(found)
        own.size += sum(map(len, some)) + sum(map(len, found.text)) + 8 * len(found.pairs) + 250 * len(some)
    return np.array([own.place[c] for c in chunks], np.int64)


_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[*range(9, 14), *range(28, 33)]] = True


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin: at each text, and at blanks, tabs and line ends behind a character that no engine takes for white space."""
    before = np.roll(data, 1)
    second, third = np.roll(data, 2), np.roll(data, 3)
    wide = (second == 0xC2) & ((before == 0x85) | (before == 0xA0))
    wide |= (third == 0xE1) & ((second == 0x9A) & (before == 0x80) | (second == 0xA0) & (before == 0x8E))
    wide |= (third == 0xE2) & ((second == 0x80) & ((before <= 0x8F) | (before >= 0xA8) & (before <= 0xAF)) | (second == 0x81) & (before >= 0x9F) & (before <= 0xA4))
    wide |= (third == 0xE3) & (second == 0x80) & (before == 0x80) | (third == 0xEF) & (second == 0xBB) & (before == 0xBF)
    start = ((data == 32) | (data == 10) | (data == 9)) & ~_ASCII_SPACE[before] & ~wide
    start[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(start)


def _sum_equal(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of each weight."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return (keys[first], *[np.add.reduceat(w[order], first) if len(first) else w[:0] for w in weights])


def _spread(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of n entries each, one after another."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _shard(own: Tokenizers, carry: bool, ids: pa.Array, texts: pa.Array, uid: int) -> pa.RecordBatch:
    spaced = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
    data, offsets = utf8(spaced)
    n_docs, start = len(texts), chunk_starts(data, offsets)
    doc = np.searchsorted(offsets, start, "right") - 1
    ends = np.append(start, len(data)).astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())]).dictionary_encode()
    if own.size > CACHE_BYTES:
        own.clear()
    at = _look_up(own, coded.dictionary.to_pylist())
    chunk = at[coded.indices.to_numpy()]
    known, odd = own.known, np.unique(doc[~own.known.sound[chunk]])
    if len(odd):  # the whole text may still be what its tokens spell, if it was cut at a wrong place
        known = known.and_(align(own, [data[offsets[i] : offsets[i + 1]].tobytes() for i in odd.tolist()]))
        rest = ~np.isin(doc, odd)
        doc, chunk = np.append(doc[rest], odd), np.append(chunk[rest], len(own.known.sound) + np.arange(len(odd)))
        order = np.argsort(doc, kind="stable")
        doc, chunk = doc[order], chunk[order]
    counts = [np.bincount(doc, known.counts[chunk, j], n_docs).astype(np.int64) for j in range(4)]
    used, chunk = np.unique(chunk, return_inverse=True)
    said, cut = utf8(pa.array([known.text[i] for i in used.tolist()], pa.binary()).cast(pa.large_binary()).take(pa.array(chunk)))
    first = cut[np.searchsorted(doc, np.arange(n_docs + 1))].tolist()
    spans = [said[i : max(i, j - 1)].tobytes() for i, j in zip(first[:-1], first[1:], strict=True)]
    digest = [hashlib.sha256(s).hexdigest() if s else "" for s in spans]
    rows = {"doc_id": ids, "n_a": pa.array(counts[0]), "n_b": pa.array(counts[1]), "n_groups": pa.array(counts[2]), "n_links": pa.array(counts[3]), "groups_sha256": pa.array(digest, pa.string())}
    if carry:
        rows["groups"] = pa.array([s.decode() for s in spans], pa.string())

    first = np.cumsum(known.lens) - known.lens
    key, times = _sum_equal(doc * max(1, len(used)) + chunk, np.ones(len(doc), np.int64))
    of, which = key // max(1, len(used)), used[key % max(1, len(used))]
    lens = known.lens[which]
    pairs = known.pairs[_spread(first[which], lens)]
    key, times = _sum_equal(pairs * n_docs + np.repeat(of, lens), np.repeat(times, lens))
    pairs, (docs, times) = key // max(1, n_docs), (key % max(1, n_docs), times)
    pairs, lens = np.unique(pairs, return_counts=True)
    packed = [pack_table(pa.table(rows)), pack_sorted(pairs.astype(np.uint64)), pack_ints(lens), pack_ints(docs), pack_ints(times)]
    return pa.RecordBatch.from_arrays([pa.array([uid], pa.int64()), pa.array([len(docs)], pa.int64()), *[pa.array([x], pa.binary()) for x in packed]], ["uid", "n", "digests", "pairs", "lens", "docs", "times"])


def _align_docs(key: tuple, a: Broadcast, b: Broadcast, carry: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if _BUILT.get("key") != key:
        _BUILT.update(key=key, own=Tokenizers(a.value, b.value))
    task = TaskContext.get()
    uid = (task.partitionId() if task else 0) << 32
    for batch in slices(batches, 1, SHARD_BYTES):
        if len(batch):
            yield _shard(_BUILT["own"], carry, batch.column(0), batch.column(1), uid)
            uid += 1


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of the task's shards hold each pair, summed in the task as far as a bound of pairs allows."""
    held, n = [], 0

    def summed() -> tuple[np.ndarray, ...]:
        return _sum_equal(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))

    def rows(pairs: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], ["pair", "n"])

    for batch in batches:
        for pairs, lens in zip(batch.column(0), batch.column(1), strict=True):
            held.append((unpack_sorted(pairs.as_py()).astype(np.int64), unpack_ints(lens.as_py()).astype(np.int64)))
            n += len(held[-1][0])
            if n > TASK_PAIRS:
                held = [summed()]
                n = len(held[0][0])
                if n > TASK_PAIRS // 2:
                    yield rows(*held.pop())
                    n = 0
    if held:
        yield rows(*summed())


def _deal(buckets: int, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's postings by the bucket of their first id, a row for each bucket; shards are dealt to the parts of a bucket."""
    for batch in batches:
        for uid, pairs, lens, docs, times in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            pairs, lens, docs, times = unpack_sorted(pairs).astype(np.int64), unpack_ints(lens).astype(np.int64), unpack_ints(docs), unpack_ints(times)
            bucket, first = (pairs >> SIDE_BITS) % buckets, np.cumsum(lens) - lens
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            part = int(mix64(np.array([uid], np.uint64))[0] % np.uint64(parts))
            rows: list[list] = [[] for _ in range(4)]
            full = np.flatnonzero(np.diff(edges))
            for i in full.tolist():
                mine = order[edges[i] : edges[i + 1]]
                at = _spread(first[mine], lens[mine])
                for out, x in zip(rows, (pack_sorted(pairs[mine].astype(np.uint64)), pack_ints(lens[mine]), pack_ints(docs[at]), pack_ints(times[at])), strict=True):
                    out.append(x)
            n = len(full)
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(np.full(n, part), pa.int32()), pa.array(np.full(n, uid), pa.int64()), *[pa.array(r, pa.binary()) for r in rows]], ["bucket", "part", "uid", "pairs", "lens", "docs", "times"])


def _contribute(left: pa.Table, right: pa.Table) -> pa.Table:
    """What the pairs of one bucket of ids add to each document: links with the id's best pair, and counts over links.

    The bucket has all pairs of its ids, so their maximum is found here. Sums of counts go by halves, which doubles hold exactly."""
    pairs, n = right.column("pair").to_numpy(), right.column("n").to_numpy()
    order = np.argsort(pairs)
    pairs, n = pairs[order], n[order]
    side = pairs >> SIDE_BITS
    first = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]])) if len(pairs) else np.zeros(0, np.int64)
    most = np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(pairs)))) if len(pairs) else n
    uids, best, sums = [], [], []
    for row in left.to_batches():
        for uid, keys, lens, docs, times in zip(*[row.column(c).to_pylist() for c in ("uid", "pairs", "lens", "docs", "times")], strict=True):
            at = np.repeat(np.searchsorted(pairs, unpack_sorted(keys).astype(np.int64)), unpack_ints(lens).astype(np.int64))
            docs, times = unpack_ints(docs).astype(np.int64), unpack_ints(times).astype(np.int64)
            by_doc = lambda w: np.bincount(docs, w).astype(np.int64)  # noqa: B023, E731
            low, high = n[at] & 0xFFFFFF, n[at] >> 24
            uids.append(uid)
            best.append(by_doc(times * (n[at] == most[at])))
            sums.append(by_doc(times * low) + (by_doc(times * high) << 24))
    return pa.table({"uid": pa.array(uids, pa.int64()), "best": pa.array(best, pa.list_(pa.int64())), "sums": pa.array(sums, pa.list_(pa.int64()))})


def _finish(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of one shard with the sums of their contributions."""
    rows = unpack_rows(left.column("digests")[0].as_py())
    total = {"best": np.zeros(len(rows), np.int64), "sums": np.zeros(len(rows), np.int64)}
    for name, out in total.items():
        for x in right.column(name):
            x = np.asarray(x.values)
            out[: len(x)] += x
    rows = rows.append_column("n_best", pa.array(total["best"])).append_column("count_sum", pa.array(total["sums"]))
    names = [c.split()[0] for c in RESULT.split(", ")]
    return rows.select(names + [c for c in rows.column_names if c not in names])


def aligned_tokens(docs: DataFrame, byte_level_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row; with `carry` the groups' text as well.

    A is a byte-level vocabulary of the tokenizers library and encodes a blank and the text, B a sentencepiece model, which puts the blank
    there itself. Null and empty texts, and those that a side's tokens don't spell (characters that a model takes for a blank), have no
    tokens and zeros; null ids stay; each repeated row is a document of its own in the counts; whole texts of any length are encoded;
    ties for an id's highest count all count; an empty table gives no rows. Other columns are not read.

    A shard has one row of postings for each bucket of ids. The number of buckets follows that of distinct pairs, which the two vocabularies
    bound; a bucket whose postings are many is dealt by shards to several groups, each of which gets the bucket's counts, so an id that
    all documents have is no hot key.
    """
    sc = docs.sparkSession.sparkContext
    with open(byte_level_path, encoding="utf-8") as f, open(pieces_path, "rb") as g:
        a, b = sc.broadcast(f.read()), sc.broadcast(g.read())  # files of public tokenizers, of fixed size
    work = partial(_align_docs, (byte_level_path, pieces_path), a, b, carry)
    shards, _ = materialize(select_text(docs, id_col, text_col).mapInArrow(work, SHARD), "postings")
    partial_counts = shards.select("pairs", "lens").mapInArrow(_partial_counts, "pair long, n long")
    counts, _ = materialize(partial_counts.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    n_postings, n_pairs = shards.agg(F.sum("n")).first()[0], counts.count()
    buckets = parts_of(n_pairs, BUCKET_PAIRS, LEAST_BUCKETS)
    parts = parts_of(n_postings, buckets * GROUP_POSTINGS, 1)
    dealt = shards.select("uid", "pairs", "lens", "docs", "times").mapInArrow(partial(_deal, buckets, parts), "bucket int, part int, uid long, pairs binary, lens binary, docs binary, times binary")
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    known = counts.select((F.shiftright("pair", SIDE_BITS) % buckets).cast("int").alias("bucket"), every, "pair", "n")
    added = dealt.groupBy("bucket", "part").cogroup(known.groupBy("bucket", "part")).applyInArrow(on_cogroup(_contribute), "uid long, best array<long>, sums array<long>")
    result = RESULT + (", groups string" if carry else "")
    return shards.select("uid", "digests").groupBy("uid").cogroup(added.groupBy("uid")).applyInArrow(on_cogroup(_finish), result)
