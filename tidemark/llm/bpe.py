"""Byte-level BPE by backtracking over longest matches.

Tokens are stored in an Aho-Corasick automaton under the Latin-1 reading of their bytes. A piece of text is encoded left to
right with the longest token at each place; where the token and its predecessor could not stand side by side in a merged text,
the next shorter one is tried, and where none is left the predecessor is taken back. A place that failed is not tried again, so
the work is linear in the piece. Whether two tokens may be adjacent depends on the two alone and is memoised.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame

from tidemark.llm.common import kept, on_batches, select_text, slices

#: Bytes of each generation of a Python worker's caches, as they are counted, and most remembered pairs of tokens.
CACHE_BYTES, PAIRS = 24 << 20, 200_000
#: The white space of Unicode's White_Space property, which is what the pattern's \s means to the library.
BLANK = "\t\n\x0b\x0c\r \x85\xa0  -     　"


def read_ranks(lines: list[bytes]) -> dict[bytes, int]:
    """Ranks by token from the lines of a rank file (base64 of the bytes, a blank, the rank)."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class Recent:
    """A bounded cache of two generations: what is asked for again moves to the young one, the old one is dropped when that is full."""

    def __init__(self, most: int = CACHE_BYTES) -> None:
        self.young, self.old, self.most, self.size = {}, {}, most, 0

    def get(self, key):
        if (got := self.young.get(key)) is None and (got := self.old.get(key)) is not None:
            self.put(key, got)
        return got

    def put(self, key: str, value: bytes) -> None:
        cost = 2 * len(key) + len(value) + 200  # with the objects and their place in the table
        if cost > self.most // 8:  # long chunks hardly come again
            return
        if self.size + cost > self.most:
            self.old, self.young, self.size = self.young, {}, 0
        self.young[key] = value
        self.size += cost


class Bpe:
    """Encoder and decoder for one table of ranks; a rank is the token's id, and lower ranks merge first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        if len(ranks) < 256 or any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte must be a token")
        self.ranks = ranks
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.split = regex.compile(pattern.replace(r"[^\s", f"[^{BLANK}").replace(r"(?!\S)", f"(?=[{BLANK}]|\\Z)").replace(r"\s", f"[{BLANK}]")).findall
        self.trie = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.trie.add_word(token.decode("latin-1"), (rank, len(token)))
        self.trie.make_automaton()
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.fits: dict[int, bool] = {}
        self.shorter: list[int | None] = [None] * (max(ranks.values()) + 1)
        self.width = [len(self.bytes_of.get(r, b"")) for r in range(max(ranks.values()) + 1)]
        for token, rank in ranks.items():
            self.shorter[rank] = next((ranks[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in ranks), None)
        self.pieces = Recent()

    def _merged(self, data: bytes, below: float = float("inf")) -> list[bytes]:
        """Merging by definition: of all adjacent pairs the one of least rank first, the leftmost of equals."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if token not in self.halves:
            data = self.bytes_of[token]
            parts = self._merged(data, token) if len(data) > 1 else [data]
            if len(data) > 1 and len(parts) != 2:
                raise ValueError(f"token {token} is not the merge of two tokens of lower rank")
            self.halves[token] = tuple(self.ranks[p] for p in parts) if len(parts) == 2 else None
        return self.halves[token]

    def adjacent(self, left: int, right: int) -> bool:
        """Whether merging would leave left and right side by side.

        Undoes merges from the latest to the earliest, always on the side whose token is of higher rank: at each moment the two
        tokens at the boundary are what stood there when that token was made, so a merge of the two of lower rank would have
        come before it.
        """
        fits = self.fits.get(left << 32 | right)
        if fits is None:
            a, b, before, fits = left, right, float("inf"), True
            while True:
                both = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
                if both is not None and both < before:
                    fits = False
                    break
                ha, hb = self._halves(a), self._halves(b)
                if ha is None and hb is None:
                    break
                if hb is None or ha is not None and a > b:  # the left token is the later merge
                    before, a = a, ha[1]
                else:  # of equal merges the left one came first, so undo the right one first
                    before, b = b + 0.5, hb[0]
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            self.fits[left << 32 | right] = fits
        return fits

    def piece(self, data: bytes) -> list[int]:
        """Token ids of one match of the pattern."""
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        n, fits, width, shorter = len(data), self.fits, self.width, self.shorter
        longest: list[int | None] = [None] * (n + 1)
        for end, (rank, w) in self.trie.iter(data.decode("latin-1")):
            longest[end + 1 - w] = rank  # ends only grow, so the last is the longest
        out: list[int] = []
        shut, at, token, left = set(), 0, longest[0], None
        while token is not None:
            end = at + width[token]
            if end not in shut:
                if left is None:
                    fit = True
                elif (fit := fits.get(left << 32 | token)) is None:
                    fit = self.adjacent(left, token)
                if fit:
                    out.append(token)
                    left, at, token = token, end, longest[end]
                    continue
            if (token := shorter[token]) is None:
                shut.add(at)
                if not out:
                    raise ValueError("no sequence of tokens fits")
                token = out.pop()
                left = out[-1] if out else None
                at -= width[token]
        return out

    def packed(self, text: str) -> bytes:
        """The ids of a text as native 32-bit integers."""
        out = []
        for p in self.split(text):
            if (ids := self.pieces.get(p)) is None:
                ids = array("i", self.piece(p.encode())).tobytes()
                self.pieces.put(p, ids)
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return memoryview(self.packed(text)).cast("i").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])


_STOPS = frozenset(".,;:!?")


def _one(cache: Recent, c: str, make: Callable[[str], bytes]) -> bytes:
    if (got := cache.get(c)) is None:
        got = make(c)
        cache.put(c, got)
    return got


def cached_chunks(text: str, cache: Recent, make: Callable[[str], bytes]) -> list[bytes] | None:
    """make() of each chunk of a text that is cut before every blank between two visible characters, by way of a cache.

    A match of the pattern takes at most one leading blank and none crosses such a cut, so chunks can be encoded alone. None
    where another white-space character stands beside a blank: there a match depends on more than its chunk.
    """
    parts = text.replace(" ", "\0 ").split("\0") if "\0" not in text else None
    if parts is None:
        return None
    young, out = cache.young, []
    for c in parts:
        if (got := young.get(c)) is None:
            if (got := cache.get(c)) is None:
                if c[:1] == " " and (len(c) == 1 or c[1].isspace()) or not c and len(parts) > 1:
                    return None
                if c[-1:] in _STOPS and c[c[:1] == " " : -1].isalpha():
                    # Letters and a stop are two matches: the word is likelier to come again alone.
                    got = b"".join([_one(cache, c[:-1], make), _one(cache, c[-1], make)])
                else:
                    got = make(c)
                    cache.put(c, got)
            young = cache.young
        out.append(got)
    return out


def id_lists(packed: list[bytes]) -> pa.Array:
    """A list column from rows of packed ids."""
    at = np.zeros(len(packed) + 1, np.int64)
    np.cumsum([len(x) >> 2 for x in packed], out=at[1:])
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def _encode(key: tuple[str, str], shipped: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    built = kept("bpe")
    if built.get("key") != key:
        built.update(key=key, bpe=Bpe(read_ranks(shipped.value), key[1]), cache=Recent())
    bpe, cache = built["bpe"], built["cache"]
    for batch in slices(batches, 1):
        out = []
        for text in batch.column(1).to_pylist():
            parts = cached_chunks(text, cache, bpe.packed)
            out.append(b"".join(parts) if parts is not None else bpe.packed(text))
        yield pa.RecordBatch.from_arrays([batch.column(0), id_lists(out)], ["doc_id", "ids"])


def _decode(ranks_path: str, shipped: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    built = kept("bpe")
    if built.get("names") != ranks_path:
        ranks = read_ranks(shipped.value)
        tokens, names = np.empty(max(ranks.values()) + 1, object), np.empty(max(ranks.values()) + 1, object)
        for t, r in ranks.items():
            tokens[r], names[r] = t, str(r)
        built.update(names=ranks_path, tables=(tokens, names))
    tokens, names = built["tables"]
    for batch in slices(batches, 1, 1 << 20):
        n, data, digest = [], [], []
        for row in batch.column(1):
            ids = row.values.to_numpy(zero_copy_only=False) if row.is_valid else np.zeros(0, np.int32)
            if len(ids) and ids.min() < 0:
                raise KeyError(int(ids.min()))
            n.append(len(ids))
            data.append(b"".join(tokens[ids].tolist()))
            digest.append(hashlib.sha256(",".join(names[ids].tolist()).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(data, pa.binary()), pa.array(digest, pa.string()), batch.column(1)], ["doc_id", "n_tokens", "decoded", "ids_sha256", "ids"])


def bpe_encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) for every row of docs: whole texts, each match of the pattern encoded separately, no special tokens.

    Null and empty texts have no ids; null ids of documents stay null; repeated rows stay. Other columns are not read. The rank
    file is one of a public tokenizer, of fixed size, and travels with the task.
    """
    with open(ranks_path, "rb") as f:
        lines = f.read().splitlines()
    shipped = docs.sparkSession.sparkContext.broadcast(lines)

    run = on_batches("bpe", _encode, (ranks_path, pattern), shipped)
    return select_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, n_tokens, decoded, ids_sha256, ids): the bytes the ids stand for, and a digest of the decimal ids joined by commas.

    Null ids count as none. An id outside the table raises KeyError.
    """
    with open(ranks_path, "rb") as f:
        lines = f.read().splitlines()
    shipped = encoded.sparkSession.sparkContext.broadcast(lines)

    run = on_batches("bpe", _decode, ranks_path, shipped)
    return encoded.select(id_col, ids_col).mapInArrow(run, "doc_id long, n_tokens long, decoded binary, ids_sha256 string, ids array<int>")


def _both(key: tuple[str, str], shipped: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _decode(key[0], shipped, _encode(key, shipped, batches))


def bpe_round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """bpe_decode of bpe_encode in one pass: ids don't travel between workers, and one worker for each task holds the tables."""
    with open(ranks_path, "rb") as f:
        lines = f.read().splitlines()
    shipped = docs.sparkSession.sparkContext.broadcast(lines)

    run = on_batches("bpe", _both, (ranks_path, pattern), shipped)
    return select_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, decoded binary, ids_sha256 string, ids array<int>")
