"""Token alignment against whole-text encoding with loops over byte offsets."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import alignment, queries

D = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
ODD = [
    "", None, " ", "  ", "\n", "a", "don't stop", " two  blanks   three ", "tab\tline\n\nnext\r\nlast\r", "a<|endoftext|> <s></s><unk> <pad>", "x▁y z▁", "日本語 の テキスト と emoji 🎉🎊 ok",
    "nbsp here   and　wide  em x y   z", "\x00nul \x1c \x1f end", "é" * 50, "word " * 300, "a" * 3000, "q\x85 r\x85", "zero​ width​ ", "﻿ bom﻿ x", "mid;\r\n};\r  x",
]


def brute(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, sha256) of each text."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    spell = alignment.Tokenizers(open(A, encoding="utf-8").read(), open(B, "rb").read())
    per, out = [], []
    for text in texts:
        groups = []
        if text:
            want = (" " + text).encode()
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            bytes_a, bytes_b = [spell.bytes_a[i].as_py() for i in ids_a], [spell.bytes_b[i].as_py() for i in ids_b]
            if b"".join(bytes_a) == want == b"".join(bytes_b):
                ends = set(np.cumsum([len(x) for x in bytes_a]).tolist()) & set(np.cumsum([len(x) for x in bytes_b]).tolist())
                cut = lambda ids, parts: [[ids[i] for i in np.flatnonzero(np.searchsorted(sorted(ends), np.cumsum([len(x) for x in parts])) == g)] for g in range(len(ends))]  # noqa: E731, B023
                groups = list(zip(cut(ids_a, bytes_a), cut(ids_b, bytes_b), strict=True))
        per.append(groups)
    links = [Counter((x, y) for left, right in groups for x in left for y in right) for groups in per]
    holds = Counter(p for c in links for p in c)
    most = defaultdict(int)
    for (x, _), n in holds.items():
        most[x] = max(most[x], n)
    for groups, c in zip(per, links, strict=True):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(m for p, m in c.items() if holds[p] == most[p[0]])
        out.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(c.values()), best, sum(m * holds[p] for p, m in c.items()), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


def compared(df, rows):
    got = sorted((tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in df.collect()), key=str)
    assert got == sorted(((i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows]), strict=True)), key=str)


def test_query_against_whole_texts(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{D}/documents.parquet").collect()]
    compared(queries.QUERIES["op11_token_alignment"](spark, D), rows)


@pytest.mark.parametrize("bounds", [{}, {"SHARD_BYTES": 64, "GROUP_POSTINGS": 20, "LEAST_BUCKETS": 3, "TASK_PAIRS": 40, "CACHE_BYTES": 2000}])
def test_odd_texts_repeated_rows_and_hot_groups(spark, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(alignment, name, value)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id word"), (3, "a"), (3, "word " * 300), (99, "word " * 300)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, uid string, pairs int").repartition(3)
    compared(alignment.aligned_tokens(docs, A, B), rows)


def test_groups_are_carried_and_an_empty_table_is_empty(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in alignment.aligned_tokens(docs, A, B, carry=True).collect()}
    assert found[2].groups == "" and hashlib.sha256(found[1].groups.encode()).hexdigest() == found[1].groups_sha256
    assert alignment.aligned_tokens(docs.where(F.lit(False)), A, B).collect() == []


def test_chunks_give_the_ids_of_whole_texts():
    own = alignment.Tokenizers(open(A, encoding="utf-8").read(), open(B, "rb").read())
    rng = np.random.default_rng(5)
    parts = [" ", "  ", "\n", "\t", "\r", "\r\n", "a", "Word", "don't", "é", "日本", ".", ";", "}\r", " ", " ", "\x85", "\x1c", "12", "🎉", "<s>", "​", " ", "᠎"]
    for _ in range(1500):
        text = " " + "".join(rng.choice(parts, rng.integers(1, 9)))
        data = np.frombuffer(text.encode(), np.uint8)
        at = [*alignment.chunk_starts(data, np.array([0, len(data)])).tolist(), len(data)]
        chunks = [data[i:j].tobytes().decode() for i, j in zip(at[:-1], at[1:], strict=True)]
        assert [i for x in own.encode_a(chunks) for i in x] == own.encode_a([text])[0], repr(text)
        assert [i for x in own.encode_b(chunks) for i in x] == own.b.encode(text[1:]), repr(text)


def test_op8_chunks_give_the_ids_of_whole_texts():
    """Special tokens' strings, all kinds of white space and a cache that is too small, against one call of the library for each text."""
    import pyarrow as pa

    from tidemark.llm import token_output
    from tidemark.llm.bpe import Recent

    tokenizer, rng = Tokenizer.from_file(A), np.random.default_rng(2)
    parts = [" ", "  ", "\n", "\t", "\r", "\r\n", "a", "Word", "don't", "é", "日本", ".", ";", "\u00a0", "\u3000", "\x85", "\x1c", "12", "<|endoftext|>", "<|endof", "text|>", "\u200b", "Ж"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 9))) for _ in range(2000)] + ["", None, ""]
    ids, at = token_output.encode_texts(pa.array(texts), tokenizer, Recent(1 << 14), np.array([7], np.int32).tobytes())
    for i, text in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 7], repr(text)
    assert token_output.encode_texts(pa.array([], pa.string()), tokenizer, Recent())[1].tolist() == [0]


class Counted:
    """A tokenizer that counts the strings it is asked for, by its own calls or its model's."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer, self.model, self.asked = tokenizer, self, 0

    def __getattr__(self, name: str):
        return getattr(self.tokenizer, name)

    def tokenize(self, word: str) -> list:
        self.asked += 1
        return self.tokenizer.model.tokenize(word)

    def encode_batch_fast(self, texts: list[str], **settings) -> list:
        self.asked += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **settings)


def test_op8_asks_for_many_words_at_once_and_for_each_word_once():
    import pyarrow as pa

    from tidemark.llm import token_output
    from tidemark.llm.bpe import Recent

    words = [f"{a}{b}{c}" for a in "abcdefghijklmnop" for b in "abcdefghijklmno" for c in "éabcdefghij"]
    texts = [f"x {w}. Then {w}, and {w}!" for w in words]
    tokenizer = Counted(Tokenizer.from_file(A))
    want = [i for t in texts for i in tokenizer.encode(t, add_special_tokens=False).ids]
    assert token_output.encode_texts(pa.array(texts), tokenizer, Recent())[0].tolist() == want
    assert tokenizer.asked < len(words) // 32, "a call's own cost is more than a word's"
    known = token_output.Chunks()
    token_output.encode_texts(pa.array(texts), tokenizer, known)
    tokenizer.asked = 0
    assert token_output.encode_texts(pa.array([t + t for t in texts]), tokenizer, known)[0].tolist() == [i for t in texts for i in tokenizer.encode(t + t, add_special_tokens=False).ids]
    assert tokenizer.asked <= 2  # the words that begin a text behind a mark: "!x"


def test_op8_chunks_of_one_hash(monkeypatch):
    """Hashes only choose: where all chunks share one, or long ones begin alike, each still gets its own ids."""
    import pyarrow as pa

    from tidemark.llm import token_output

    tokenizer, known = Tokenizer.from_file(A), token_output.Chunks(1 << 14)
    monkeypatch.setattr(token_output, "word_hashes", lambda data, start, end, seed: np.full(len(start), 5, np.uint64))
    for k in range(20):
        texts = [f"one two w{i * k} {'x' * 400}{i}" for i in range(50)] + [""]
        ids, at = token_output.encode_texts(pa.array(texts), tokenizer, known)
        assert [ids[i:j].tolist() for i, j in zip(at[:-1], at[1:], strict=True)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_op8_chunks_between_calls_and_bytes_that_are_not_utf8():
    """Marks behind letters and other characters, long chunks, bytes that are not UTF-8, and chunks that are dropped and asked for again."""
    import pyarrow as pa

    from tidemark.llm import token_output

    tokenizer, rng = Tokenizer.from_file(A), np.random.default_rng(3)
    text = [" ", "  ", "\n", "\t", "a", "Word", "don't", "'s", "'", "é", "÷", "×", "ũ", "e\u0301", "日本", "Ж", ".", ",", "...", "!", "|", "<", "1", "<|endoftext|>", "<|endof", "text|>", "\u00a0", "x" * 3000]
    parts = [x.encode() for x in text] + [b"\xff", b"\xc3", b"\xa9", b"\xe2\x80", b"\0"]
    for most in (1 << 12, 1 << 15, 32 << 20):
        known = token_output.Chunks(most)
        for valid in (True, False, True, False):
            texts = [b"".join(parts[i] for i in rng.integers(0, len(text) if valid else len(parts), rng.integers(0, 12))) for _ in range(400)]
            ids, at = token_output.encode_texts(pa.array(texts, pa.binary()), tokenizer, known, np.array([7], np.int32).tobytes())
            for i, t in enumerate(texts):
                assert ids[at[i] : at[i + 1]].tolist() == [*tokenizer.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids, 7], repr(t)
            assert known.keys[0].as_py() == b"" and len(known.keys) == len(known.ids) == len(known.used) == len(set(known.keys.to_pylist()))
            assert (known.find(known.keys)[0] == np.arange(len(known.keys))).all()
            assert sum(len(k) + len(v) + token_output.ROW_BYTES for k, v in zip(known.keys.to_pylist()[1:], known.ids.to_pylist()[1:], strict=True)) <= most


def test_op3_refuses_widths_that_its_records_cannot_hold(spark):
    from tidemark.llm import suffix_dedup

    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string"), width=260)
