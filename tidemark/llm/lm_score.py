"""Language-model scoring with a weighted backoff automaton.

N-grams are counted over the whole training part and smoothed with a Dirichlet prior towards the next shorter history:
p(w | h) = (c(h w) + mu p(w | h')) / (c(h) + mu), down to add-one word frequencies. As an automaton, each counted history is a state,
each counted n-gram an arc with the logarithm of that value, and where a state has no arc for a word, its failure arc of weight
log(mu / (c(h) + mu)) leads to the state of the shorter history. A text is walked once from left to right, carrying its state.

The model is never in one place. Texts are packed into shards; hash ranges of words give each word a number and its count, hash ranges
of n-grams, named by the numbers of their words, give counts over all shards, and a shard makes the part of the automaton that its
own texts can reach. Words and n-grams are compared as they are, not by hashes.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop, materialize, mix64, on_cogroup, on_group, pack_ints, pack_rows, pack_sorted, pack_table, parts_of, unpack_ints, unpack_rows, unpack_sorted

#: Bytes of text in a shard, for each hash range of words, and for each of n-grams.
SHARD, WORD_RANGE, GRAM_RANGE = 4 << 20, 16 << 20, 8 << 20
MU = 100.0
#: The end of a text as a word of its own: white space is never in a word.
END = b"\n"
#: Numbers of words: 0 for those that training texts don't have, 1 for the begin of a text, the others from 2 on.
UNKNOWN, BEGIN = 0, 1


def text_symbols(texts: pa.ChunkedArray | pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words in the order they come in, symbols of all texts (2 and a word's place) with their ends, and where texts begin.

    split() without arguments cuts bytes at space and \\t to \\r, lower() changes A-Z alone; null texts have their end alone.
    """
    index: defaultdict = defaultdict()
    index.default_factory = index.__len__
    index[END]
    rows, end = [], np.zeros(1, np.int32)
    for t in texts.cast(pa.binary()).to_pylist():
        words = (t or b"").lower().split()
        rows += [np.fromiter(map(index.__getitem__, words), np.int32, len(words)), end]
    starts = np.zeros(len(rows) // 2 + 1, np.int64)
    np.cumsum([len(r) + 1 for r in rows[::2]], out=starts[1:])
    return list(index), (np.concatenate(rows) if rows else np.zeros(0, np.int32)) + np.int32(2), starts


def _as_symbols(rows: pa.Table) -> pa.Table:
    """(doc_id, taught, symbols) of a shard's rows; the words go with the schema."""
    words, symbols, starts = text_symbols(rows.column("text"))
    lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(symbols))
    return pa.table({"doc_id": rows.column("doc_id"), "taught": rows.column("taught"), "symbols": lists}).replace_schema_metadata({b"words": _squeeze(b" ".join(words))})


def _read_symbols(rows: bytes) -> tuple[pa.Table, list[bytes], np.ndarray, np.ndarray]:
    """The rows of a shard, its words, the symbols of all rows and where rows begin."""
    table = unpack_rows(rows)
    column = table.column("symbols").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    starts = column.offsets.to_numpy()
    return table, _loosen((table.schema.metadata or {}).get(b"words", _squeeze(b""))).split(b" "), column.flatten().to_numpy(), starts - starts[0]


def _ranges(words: list[bytes], buckets: int) -> tuple[np.ndarray, list[int]]:
    """The order of words by hash range, and where ranges begin in it."""
    bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()


def _batch(names: tuple[str, ...], kinds: tuple, rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], list(names))


ASK = "bucket int, uid long, keys binary, counts binary"
ASKED = (("bucket", "uid", "keys", "counts"), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))
ANSWER = "uid long, level int, bucket int, names binary, totals binary, n long, v long"
ANSWERED = (("uid", "level", "bucket", "names", "totals", "n", "v"), (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()))


def _squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _loosen(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _ask_words(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each shard and how often its training texts have them, by hash range."""
    for batch in batches:
        for uid, rows in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
            table, words, symbols, starts = _read_symbols(rows.as_buffer())
            use = np.repeat(table.column("taught").to_numpy(), np.diff(starts))
            count = np.bincount(symbols[use] - 2, minlength=len(words))
            order, edge = _ranges(words, buckets)
            parts = [(k, order[a:b].tolist()) for k, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)) if a < b]
            yield _batch(*ASKED, [(k, uid, _squeeze(b" ".join([words[i] for i in at])), _squeeze(pack_ints(count[at]))) for k, at in parts])


def _name_words(buckets: int, table: pa.Table) -> pa.Table:
    """Numbers and counts of the words of a hash range, for each shard; uid -1 has the counts of all its tokens and words."""
    bucket = table.column("bucket")[0].as_py()
    keys = [_loosen(x).split(b" ") for x in table.column("keys").to_pylist()]
    total: dict[bytes, int] = {}
    for words, counts in zip(keys, table.column("counts").to_pylist(), strict=True):
        for w, c in zip(words, unpack_ints(_loosen(counts)).tolist(), strict=True):
            total[w] = total.get(w, 0) + c
    known = sorted(w for w, c in total.items() if c)
    name = {w: i * buckets + bucket + 2 for i, w in enumerate(known)}
    rows = [(-1, 1, bucket, None, None, sum(total.values()), len(known))]
    for uid, words in zip(table.column("uid").to_pylist(), keys, strict=True):
        names, totals = np.array([name.get(w, UNKNOWN) for w in words], np.uint64), np.array([total[w] for w in words], np.uint64)
        rows.append((uid, 1, bucket, _squeeze(pack_ints(names)), _squeeze(pack_ints(totals)), 0, 0))
    return pa.Table.from_batches([_batch(*ANSWERED, rows)])


NUMBERED = "uid long, size long, rows binary, names binary, totals binary"


def _number(buckets: int, shards: pa.Table, answers: pa.Table) -> pa.Table:
    """A shard's texts as symbols: 0 for words that training texts don't have, else 2 and the place among its other words."""
    out = []
    for uid, size, rows in zip(shards.column("uid").to_pylist(), shards.column("size").to_pylist(), shards.column("rows"), strict=True):
        table, words, symbols, starts = _read_symbols(rows.as_buffer())
        order, _ = _ranges(words, buckets)
        said = sorted(zip(*(answers.column(c).to_pylist() for c in ("bucket", "names", "totals")), strict=True))
        name, total = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
        name[order] = np.concatenate([unpack_ints(_loosen(n)) for _, n, _ in said])
        total[order] = np.concatenate([unpack_ints(_loosen(t)) for _, _, t in said])
        known = np.flatnonzero(total)
        known = known[np.argsort(name[known])]  # symbols in the order of numbers, so that n-grams are in one order by either
        place = np.zeros(len(words), np.int32)
        place[known] = np.arange(2, len(known) + 2)
        lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(place[symbols - 2]))
        kept = pa.table({"doc_id": table.column("doc_id"), "taught": table.column("taught"), "symbols": lists})
        # As many begins as ends, which is the first word.
        out.append((uid, size, pack_table(kept), _squeeze(pack_ints(np.append(np.uint64(BEGIN), name[known]))), _squeeze(pack_ints(np.append(total[0], total[known])))))
    return pa.Table.from_batches([_batch(("uid", "size", "rows", "names", "totals"), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), out)])


class Texts(NamedTuple):
    """A shard's texts as symbols: BEGIN, words and end of each row. name has the numbers of symbols, total their counts in all training
    texts."""

    table: pa.Table
    taught: np.ndarray
    symbols: np.ndarray
    starts: np.ndarray
    name: np.ndarray
    total: np.ndarray


def _texts(rows: bytes, names: bytes, totals: bytes) -> Texts:
    table, _, found, begin = _read_symbols(rows)
    starts = begin.astype(np.int64) + np.arange(len(begin))
    symbols = np.full(starts[-1], BEGIN, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[starts[:-1]] = False
    symbols[inside] = found
    name = np.append(np.uint64(UNKNOWN), unpack_ints(_loosen(names)))
    total = np.append(0, unpack_ints(_loosen(totals)).astype(np.int64))
    return Texts(table, table.column("taught").to_numpy(), symbols, starts, name, total)


def _all_texts(shards: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, Texts]]:
    for uid, rows, names, totals in zip(shards.column("uid").to_pylist(), *(shards.column(c) for c in ("rows", "names", "totals")), strict=True):
        yield uid, _texts(rows.as_buffer(), names.as_buffer(), totals.as_buffer())


def _grams(texts: Texts, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where n-grams of known words end, the first of these places for each distinct one, and the number of the one at each place."""
    depth = np.arange(len(texts.symbols)) - np.repeat(texts.starts[:-1], np.diff(texts.starts))
    place = np.flatnonzero(depth >= level - 1)
    for k in range(level):
        place = place[texts.symbols[place - k] != UNKNOWN]
    code, span = texts.symbols[place - level + 1], len(texts.name)
    for k in range(level - 2, -1, -1):
        if len(code) and int(code.max()) >= (1 << 62) // span:
            _, code = np.unique(code, return_inverse=True)
        code = code * span + texts.symbols[place - k]
    _, first, of = np.unique(code, return_index=True, return_inverse=True)
    return place, place[first], of


def _dealt(texts: Texts, ends: np.ndarray, level: int, buckets: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The order of distinct n-grams by hash range and then as they are, by numbers; where ranges begin in it; numbers of their words."""
    columns = [texts.name[texts.symbols[ends - k]] for k in range(level - 1, -1, -1)]
    mixed = np.zeros(len(ends), np.uint64)
    for c in columns:
        mixed = mix64(mixed + c + np.uint64(0x9E3779B97F4A7C15))
    bucket = (mixed % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1)), columns


def _ask_grams(level: int, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the distinct n-grams of known words in each shard's training texts, by hash range."""
    for batch in batches:
        for uid, texts in _all_texts(batch):
            place, ends, of = _grams(texts, level)
            count = np.bincount(of, weights=np.repeat(texts.taught, np.diff(texts.starts))[place], minlength=len(ends)).astype(np.int64)
            order, edge, columns = _dealt(texts, ends, level, buckets)
            out = []
            for k in np.flatnonzero(np.diff(edge)).tolist():
                x = order[edge[k] : edge[k + 1]]
                parts = [pack_sorted(columns[0][x]), *[pack_ints(c[x]) for c in columns[1:]]]
                out.append((k, uid, b"".join([len(p).to_bytes(4, "little") + p for p in parts]), _squeeze(pack_ints(count[x]))))
            yield _batch(*ASKED, out)


def _columns(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n = int.from_bytes(data[at : at + 4], "little")
        part = data[at + 4 : at + 4 + n]
        out.append(unpack_ints(part) if out else unpack_sorted(part))
        at += 4 + n
    return out


def _sum_grams(level: int, table: pa.Table) -> pa.Table:
    """Counts over all shards of the n-grams of a hash range, in each shard's order."""
    asked = [_columns(x) for x in table.column("keys").to_pylist()]
    code = np.concatenate([a[0] for a in asked])
    for k in range(1, level):
        column = np.concatenate([a[k] for a in asked])
        span = int(column.max()) + 1
        if int(code.max()) >= (1 << 63) // span:
            _, code = np.unique(code, return_inverse=True)
            code = code.astype(np.uint64)
            if len(code) >= (1 << 63) // span:
                raise ValueError("too many words for one hash range of n-grams")
        code = code * np.uint64(span) + column
    _, of = np.unique(code, return_inverse=True)
    total = np.bincount(of, weights=np.concatenate([unpack_ints(_loosen(x)) for x in table.column("counts").to_pylist()])).astype(np.int64)
    bucket = table.column("bucket")[0].as_py()
    parts = np.split(total[of], np.cumsum([len(a[0]) for a in asked])[:-1])
    return pa.Table.from_batches([_batch(*ANSWERED, [(u, level, bucket, None, _squeeze(pack_ints(t)), 0, 0) for u, t in zip(table.column("uid").to_pylist(), parts, strict=True)])])


class BackoffAutomaton:
    """States, arcs and failure arcs, with logarithms to base 10.

    State 0 is the empty history and has an arc for every symbol. arcs leads from state * width + symbol to an arc's number.
    """

    def __init__(self, width: int) -> None:
        self.width = width
        self.arcs: dict[int, int] = {}
        self.weight: list[float] = []
        self.target: list[int] = []
        self.fail, self.fail_weight = [0], [0.0]
        self.begin = 0

    def add_states(self, fail: np.ndarray, fail_weight: np.ndarray) -> int:
        """The number of the first of some new states."""
        self.fail += fail.tolist()
        self.fail_weight += fail_weight.tolist()
        return len(self.fail) - len(fail)

    def add_arcs(self, state: np.ndarray, symbol: np.ndarray, weight: np.ndarray, target: np.ndarray) -> None:
        self.arcs.update(zip((state * self.width + symbol).tolist(), range(len(self.weight), len(self.weight) + len(weight)), strict=True))
        self.weight += weight.tolist()
        self.target += (target * self.width).tolist()  # where the state's arcs begin among the keys

    def read(self, symbols: list[int]) -> float:
        """Walk one text from its begin and add up the weights of the arcs and failure arcs taken."""
        arc_of, weight, target, fail, fail_weight = self.arcs.get, self.weight, self.target, self.fail, self.fail_weight
        state, total = self.begin * self.width, 0.0
        for symbol in symbols:
            while (arc := arc_of(state + symbol)) is None:
                total += fail_weight[state // self.width]
                state = fail[state // self.width] * self.width
            total += weight[arc]
            state = target[arc]
        return total


def build_automaton(texts: Texts, order: int, mu: float, rest: int, totals: dict[int, np.ndarray]) -> tuple[BackoffAutomaton, np.ndarray]:
    """The part of the model that the texts reach, and the weight of each symbol at state 0.

    totals has, for each level from 2 on, the counts of the texts' distinct n-grams as _grams numbers them.
    """
    machine = BackoffAutomaton(len(texts.name))
    base = np.log10((texts.total + 1) / rest)
    symbol = np.arange(len(base))
    state = np.zeros(len(base), np.int64)  # of the history that is this symbol alone
    if order > 1:
        known = np.flatnonzero(texts.total > 0)
        state[known] = machine.add_states(np.zeros(len(known), np.int64), np.log10(mu / (texts.total[known] + mu))) + np.arange(len(known))
        machine.begin = int(state[BEGIN])
    words = symbol[symbol != BEGIN]
    machine.add_arcs(np.zeros(len(words), np.int64), words, base[words], state[words])
    # Of the n-gram that ends at each place: its state, its count and the weight of its arc, for the level below.
    states, counts, weights = state[texts.symbols], texts.total[texts.symbols], base[texts.symbols]
    for level in range(2, order + 1):
        place, ends, of = _grams(texts, level)
        total = totals[level]
        seen = np.flatnonzero(total > 0)
        end = ends[seen]
        weight = np.log10((total[seen] + mu * 10.0 ** weights[end]) / (counts[end - 1] + mu))
        target = states[end]
        if level < order:
            target = machine.add_states(states[end], np.log10(mu / (total[seen] + mu))) + np.arange(len(seen))
        machine.add_arcs(states[end - 1], texts.symbols[end], weight, target)
        if level < order:
            fill = lambda values, kind: np.concatenate([values, [0]]).astype(kind)[slot]
            slot = np.full(len(texts.symbols), len(seen))
            at = np.full(len(total), len(seen))
            at[seen] = np.arange(len(seen))
            slot[place] = at[of]
            states, counts, weights = fill(target, np.int64), fill(total[seen], np.int64), fill(weight, np.float64)
    return machine, base


def _score(order: int, mu: float, n_words: int, n_kinds: int, buckets: int, shards: pa.Table, answers: pa.Table) -> pa.Table:
    out = []
    for _, texts in _all_texts(shards):
        totals = {}
        for level in range(2, order + 1):
            _, ends, _ = _grams(texts, level)
            by, _, _ = _dealt(texts, ends, level, buckets)
            said = sorted((b, t) for k, b, t in zip(*(answers.column(c).to_pylist() for c in ("level", "bucket", "totals")), strict=True) if k == level)
            totals[level] = np.zeros(len(ends), np.int64)
            if said:
                totals[level][by] = np.concatenate([unpack_ints(_loosen(t)) for _, t in said]).astype(np.int64)
        machine, base = build_automaton(texts, order, mu, n_words + n_kinds + 1, totals)
        starts = texts.starts
        edge = starts.tolist()
        score = [machine.read(texts.symbols[a + 1 : b].tolist()) for a, b in zip(edge[:-1], edge[1:], strict=True)]
        word = texts.symbols != BEGIN
        add = lambda x, begin=starts[:-1], word=word: np.add.reduceat(np.where(word, x, 0), begin) if len(begin) else np.zeros(0)
        out.append(pa.table({
            "doc_id": texts.table.column("doc_id"),
            "held_out": pa.array(~texts.taught),
            "n_tokens": pa.array(np.diff(starts) - 1),
            "n_known": pa.array(add(texts.symbols != UNKNOWN).astype(np.int64)),
            "train_tokens": pa.array(np.full(len(starts) - 1, n_words, np.int64)),
            "base_score": pa.array(add(base[texts.symbols]).astype(np.float64)),
            "score": pa.array(score, pa.float64()),
        }))
    return pa.concat_tables(out)


def lm_scores(docs: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2, mu: float = MU, shard_bytes: int = SHARD) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of docs.

    Rows where learn_from holds teach the model; where it is null or false they are held out. Tokens are words (runs of anything but
    ASCII white space, A-Z lower-cased) and one end. Null and empty texts have the end alone; a very long text is a shard of its own;
    null ids stay; repeated rows stay and teach repeatedly. If nothing is taught, every score is that of an empty model; an empty
    table stays empty. Other columns are not read. All n-grams up to `order` words are counted, none is pruned.
    """
    spark = docs.sparkSession
    shards, shards_at = pack_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(learn_from.cast("boolean"), F.lit(False)).alias("taught")), "text", shard_bytes, _as_symbols)
    size = shards.agg(F.sum("size")).first()[0]
    word_buckets, buckets = parts_of(size, WORD_RANGE), parts_of(size, GRAM_RANGE)
    words = shards.mapInArrow(partial(_ask_words, word_buckets), ASK).groupBy("bucket").applyInArrow(on_group(_name_words, word_buckets), ANSWER)
    words, words_at = materialize(words, "words", packed=True)
    n, v = words.where("uid = -1").agg(F.sum("n"), F.sum("v")).first()
    numbered = shards.groupBy("uid").cogroup(words.where("uid >= 0").groupBy("uid")).applyInArrow(on_cogroup(_number, word_buckets), NUMBERED)
    numbered, _ = materialize(numbered, "numbered", packed=True)
    drop(spark, shards_at, words_at)
    answers = spark.createDataFrame([], ANSWER)
    for level in range(2, order + 1):
        asked = numbered.mapInArrow(partial(_ask_grams, level, buckets), ASK)
        summed, _ = materialize(asked.groupBy("bucket").applyInArrow(on_group(_sum_grams, level), ANSWER), "grams", packed=True)
        answers = summed if level == 2 else answers.unionByName(summed)
    fields = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return numbered.groupBy("uid").cogroup(answers.groupBy("uid")).applyInArrow(on_cogroup(_score, order, mu, n or 0, v or 0, buckets), fields)
