"""Each operator against brute force, round trips or the public libraries, with nulls, empty and repeated rows and clashing columns."""

import gc
import hashlib
import os
import random
import re
import weakref
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import functions as F

from tidemark.llm import bpe as bpe_module, common, lang_id, media, mixing, near_dedup, ngram_join, suffix_dedup, token_output, url_filters
from tidemark.llm.bpe import Bpe, bpe_decode, bpe_encode, read_ranks
from tidemark.operators.components import connected_components
from tidemark.llm.lm_score import BackoffAutomaton, lm_scores

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def corpus(seed=0, n=60):
    """Random texts with copies, near copies, shared passages, nulls, empty and short texts."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdéß ") for _ in range(r.randint(1, 6))).strip() or "x" for _ in range(300)]
    make = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    passage, base = make(30), make(80).split()
    out = []
    for i in range(n):
        kind = i % 8
        if kind == 0:
            out.append(make(40) + " " + passage + " " + make(20))
        elif kind == 1:
            copy = list(base)
            copy[r.randrange(len(copy))] = "edit"
            out.append(" ".join(copy))
        elif kind == 2:
            out.append(r.choice([None, "", " \t\n", "One", "One two THREE", "🙂"]))
        elif kind == 3:
            out.append(" ".join(base))
        else:
            out.append(make(r.randint(3, 90)))
    return out


def documents(spark, texts, source=None):
    """With names that operators use inside, in columns of other kinds."""
    rows = [(i, t, "en", (source or (lambda i: f"s{i % 3}"))(i), len(t or ""), i * 2, "x", [i]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard int, spans string, ids array<int>")


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


def test_components(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = dict(map(tuple, connected_components(e).collect()))
    assert got == {i: 0 for i in range(51)} | {100: 100, 101: 100}


def test_sorted_ints():
    rng = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 1), (5, 3), (1000, 10), (1000, 1 << 20), (3000, 1 << 37), (1000, 1 << 63), (2, (1 << 64) - 1)):
        a = np.sort(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
        assert common.unpack_sorted(common.pack_sorted(a)).tolist() == a.tolist()


def test_packed_ints():
    for v in ([], [0], [1, 255, 256], [2**64 - 1, 3]):
        a = np.array(v, np.uint64)
        assert common.unpack_ints(common.pack_ints(a)).tolist() == v


def test_word_hashes_follow_words():
    texts = ["The  cat\tsat", "the cat\nsat on", "", "été THE"]
    data = "".join(texts).encode()
    at = np.cumsum([0] + [len(t.encode()) for t in texts])
    h, before = common.words(np.frombuffer(data, np.uint8), at)
    assert np.diff(before).tolist() == [len(words(t)) for t in texts]
    flat = [w for t in texts for w in words(t)]
    assert len(set(zip(flat, h.tolist()))) == len(set(flat)) == len(set(h.tolist()))


def test_word_hashes_tell_structured_words_apart():
    """Two words of one length whose sums of powers of an odd base agree modulo 2**64."""
    swap = bytes.maketrans(b"ab", b"ba")
    a = bytes(b"ab"[bin(i).count("1") & 1] for i in range(1024))
    text = a + b" " + a.translate(swap)
    h, _ = common.words(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert h[0] != h[1]


# 1


def test_language_id(spark):
    r = random.Random(1)
    vocabulary = {"aa": [f"bla{i}" for i in range(40)], "bb": [f"über{i}" for i in range(40)]}
    rows = [(i, " ".join(r.choice(vocabulary[x]) for _ in range(30)), x) for i in range(80) for x in ["aa" if i % 2 else "bb"]]
    rows += [(100, None, "aa"), (101, "123 !", "bb"), (102, "bla1 " * 5000, None), (None, "bla2", "aa"), (103, "", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    profiles = lang_id.fit_profiles(docs, lang_id.fold("doc_id", 5) != 0)
    assert sorted(profiles) == ["aa", "bb"]
    got = {x.doc_id: x for x in lang_id.classify(docs, profiles).collect()}
    assert all(got[i].lang_pred == ("aa" if i % 2 else "bb") for i in range(80)) and got[102].lang_pred == "aa"
    assert all(got[i].lang_pred == "und" and got[i].rejected and got[i].score == 0 for i in (100, 101, 103))
    assert all(0 <= x.score <= 1 for x in got.values()) and len(got) == len(rows)
    assert lang_id.fit_profiles(docs.where("doc_id > 999")) == {}
    assert lang_id.classify(docs, {}).where("lang_pred <> 'und'").count() == 0


def test_language_id_equals_brute_force(spark):
    """Sample, dictionaries and least sums once more, text by text."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    key = lambda i: (lambda k: k - (1 << 64) if k >> 63 else k)(xxhash.xxh64_intdigest(str(i).encode(), 42))
    sample = {}
    for r in rows:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 5 and regex.search(r"\p{L}", r.text or ""):
            slot = (r.lang, key(r.doc_id) % lang_id.SAMPLE_DOCS)
            sample[slot] = min(sample.get(slot, (1 << 64, "")), (key(r.doc_id), r.text))
    langs = sorted({x for x, _ in sample})
    packs = {}
    for x in langs:
        data = b"\n".join(t.lower().encode() for _, t in sorted(v for k, v in sample.items() if k[0] == x))
        packs[x] = zstandard.ZstdCompressor(level=5, dict_data=zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False, write_dict_id=False)
    got = {r.doc_id: (r.lang_pred, r.score, r.rejected) for r in lang_id.classify(docs, lang_id.fit_profiles(docs, lang_id.fold("doc_id", 5) != 0)).collect()}
    for r in rows:
        if not regex.search(r"\p{L}", r.text or ""):
            assert got[r.doc_id] == ("und", 0.0, True)
            continue
        data = r.text.lower().encode()
        sizes = sorted((sum(len(packs[x].compress(data[i : i + 2048])) for i in range(0, len(data), 2048)), x) for x in langs)
        margin = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
        assert got[r.doc_id] == (sizes[0][1], pytest.approx(margin), margin < lang_id.MIN_MARGIN)


def test_language_id_letters_and_ties(spark):
    docs = spark.createDataFrame([(1, "½ ² Ⅷ ٣ _"), (2, "ª"), (3, "same words"), (3, "same words")], "doc_id long, text string")
    got = sorted((r.doc_id, r.lang_pred, r.rejected) for r in lang_id.classify(docs, {"b": b"same words here", "a": b"same words here"}).collect())
    assert got == [(1, "und", True), (2, "a", True), (3, "a", True), (3, "a", True)]


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    profiles = lang_id.fit_profiles(docs, lang_id.fold("doc_id", 5) != 0)
    held = lang_id.classify(docs.where(lang_id.fold("doc_id", 5) == 0), profiles)
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95


# 2


def brute_groups(texts, width, percent):
    sets = {}
    for i, t in enumerate(texts):
        w = words(t)
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("seed", "width", "percent"), [(0, 4, 85), (1, 5, 80)])
def test_ngram_join(spark, seed, width, percent, monkeypatch):
    monkeypatch.setattr(ngram_join, "SHORT_LIST", 3)
    monkeypatch.setattr(ngram_join, "LIST_BLOCK", 4)
    texts = corpus(seed, 72)
    got = by_id(ngram_join.ngram_components(documents(spark, texts), width=width, percent=percent), "n_shingles", "component_id")
    assert got == brute_groups(texts, width, percent)


def test_ngram_join_structured_and_long_words(spark):
    swap = str.maketrans("ab", "ba")
    a = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    texts = [f"x {a} y z", f"x {a.translate(swap)} y z", "w " * 30000, "w " * 20000 + "v", " ".join(f"w{i}" for i in range(20000)), " ".join(f"w{i}" for i in range(20500))]
    got = by_id(ngram_join.ngram_components(documents(spark, texts)), "n_shingles", "component_id")
    assert got == brute_groups(texts, 4, 85) and got[0][1] != got[1][1] and got[5][1] == 4


def test_ngram_join_colliding_hashes(spark, monkeypatch):
    """Search with hashes of four bits: candidates abound, links do not."""
    texts = ["a b c d e f g h", "a b c d e f g i", "z y x w v u t s", "a b c d e f g h k"]
    table = pa.table({"text": texts, "doc_id": list(range(4)), "component": list(range(4)), "query": [True] * 4, "stored": [True] * 4})
    honest = ngram_join.mix64
    monkeypatch.setattr(ngram_join, "mix64", lambda x: honest(x) % np.uint64(16))
    found = ngram_join._search(2, 60, table).to_pylist()
    groups = {i: i for i in range(4)}
    for r in found:
        low, high = sorted((groups[r["a"]], groups[r["b"]]))
        groups = {i: low if g == high else g for i, g in groups.items()}
    assert groups == {i: g for i, (_, g) in brute_groups(texts, 2, 60).items()}


def test_ngram_join_edges(spark):
    docs = spark.createDataFrame([(5, "a b c d e"), (5, "a b c d e"), (3, "A B C D E"), (None, "a b c d e"), (9, None), (None, None)], "doc_id long, text string")
    got = [tuple(r) for r in ngram_join.ngram_components(docs).collect()]
    assert len(got) == 6 and set(got) == {(5, 2, 3), (3, 2, 3), (None, 2, 3), (9, 0, 9), (None, 0, None)}
    assert ngram_join.ngram_components(docs.where("doc_id = 77")).count() == 0


def test_divide_skip():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(30)]
    index = ngram_join.DivideSkip(sets)
    for need in (1, 5, 15, 25):
        for i, s in enumerate(sets):
            want = {j: len(np.intersect1d(s, t)) for j, t in enumerate(sets) if j != i and len(np.intersect1d(s, t)) >= need}
            assert index.search(s, need, i) == want
    assert index.search(np.array([999, 1000], np.uint64), 1) == {}


# 3


def brute_repeats(rows, width):
    seen, out = {}, []
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - width + 1):
            if seen.get(b[k : k + width], i) < i:
                gone[k : k + width] = b"\1" * width
        for k in range(len(b) - width + 1):
            seen.setdefault(b[k : k + width], i)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_suffix_dedup(spark, seed, monkeypatch):
    texts = corpus(seed, 64) + ["ab" * 200, "ab" * 150, "a" * 49, "b" * 50, "b" * 50 + "c"]
    got = by_id(suffix_dedup.remove_repeats(documents(spark, texts)), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == {r[0]: r[1:] for r in brute_repeats(list(enumerate(texts)), 50)}


@pytest.mark.parametrize(("array", "step", "shard", "spare"), [(200, 1500, 3000, 10), (700, 64, 900, -20), (1 << 20, 1 << 20, 1, 0)])
def test_suffix_dedup_parts(spark, array, step, shard, spare):
    """Several arrays in a shard, long texts in parts, many shards, and keys so short that most anchors collide."""
    texts = corpus(7, 64) + ["ab" * 200, "b" * 50, "b" * 50 + "c", "\0" * 80, "x" + "\0" * 60, "\0" * 79 + "y"]
    docs = documents(spark, texts)
    got = by_id(suffix_dedup.remove_repeats(docs, shard_bytes=shard, part_bytes=step, array_bytes=array, spare_bits=spare), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == {r[0]: r[1:] for r in brute_repeats(list(enumerate(texts)), 50)}


@pytest.mark.parametrize("width", [3, 20, 130])
def test_suffix_dedup_widths(spark, width):
    texts = corpus(8, 40)
    got = by_id(suffix_dedup.remove_repeats(documents(spark, texts), width=width), "n_removed", "n_spans")
    assert got == {r[0]: r[2:4] for r in brute_repeats(list(enumerate(texts)), width)}


def test_suffix_dedup_edges(spark):
    p = "0123456789" * 6
    docs = spark.createDataFrame([(2, p), (2, p), (None, p + "z"), (2, p + "!"), (4, None), (-5, "q" + p[:50]), (5, "")], "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("doc", F.lit("d"))
    got = suffix_dedup.remove_repeats(docs, carry=True).select("doc_id", "n_removed", "kept_text", "row.spans", "row.doc").collect()
    want = [(2, 60, "", 1), (2, 60, "", 1), (None, 60, "z", 1), (2, 60, "!", 1), (4, 0, None, 1), (-5, 0, "q" + p[:50], 1), (5, 0, "", 1)]
    assert sorted(map(str, map(tuple, got))) == sorted(str((*w, "d")) for w in want)
    assert suffix_dedup.remove_repeats(docs.where("doc_id = 9")).count() == 0


def test_suffix_array():
    data = np.frombuffer(b"banana" * 9 + bytes(range(40)) + b"banana" * 5, np.uint8)
    order = suffix_dedup.suffix_array(data)
    text = data.tobytes()
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    lcp = suffix_dedup.common_prefixes(data, order, 50)
    for k in range(1, len(order)):
        a, b = text[order[k - 1] :], text[order[k] :]
        assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) if lcp[k] < 50 else a[:50] == b[:50]


# 4


@pytest.mark.parametrize("kind", range(5))
def test_png_filters(kind):
    rng = np.random.default_rng(kind)
    samples = rng.integers(0, 256, (9, 64)).astype(np.uint8)
    raw = np.zeros((9, 65), np.uint8)
    raw[:, 0] = kind
    s = samples.astype(int)
    for y in range(9):
        for x in range(64):
            a, b = (s[y, x - 1] if x else 0), (s[y - 1, x] if y else 0)
            c = s[y - 1, x - 1] if x and y else 0
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            raw[y, x + 1] = (s[y, x] - [0, a, b, (a + b) // 2, paeth][kind]) % 256
    assert (media.unfilter(raw) == samples).all()


def test_media(spark):
    texts = corpus(2, 24) + ["x" * 64, "y" * 30000]
    got = by_id(media.media_features(media.encode_media(documents(spark, texts))), "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "feature")
    for i, t in enumerate(texts):
        b = (t or "").encode()
        p = b + bytes(max(64, -(-len(b) // 64) * 64) - len(b))
        assert got[i][:4] == (len(b), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:])) and len(got[i][4]) == 16
    assert got[3][4] == got[11][4]
    png = media.encode_png(np.zeros((1, 64), np.uint8))
    with pytest.raises(ValueError, match="checksum"):
        media.decode_png(png[:40] + bytes([png[40] ^ 1]) + png[41:])


# 5


def brute_targets(sizes):
    """Targets of sources in code point order, in fractions: shares are taken again until no target is above three times its size."""
    from fractions import Fraction

    weight, done = {s: Fraction(i % 3 + 1) for i, s in enumerate(sizes)}, {}
    while True:
        open_ = [s for s in sizes if s not in done]
        left = Fraction(sum(sizes.values())) - sum(done.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return {s: float(x) for s, x in (share | done).items()}
        done |= {s: Fraction(3 * sizes[s]) for s in over}


def test_targets_and_flow():
    t = mixing.fill_targets({"a": 100, "b": 10, None: 10}, {"a": 1, "b": 2, None: 3})
    assert t == {"a": 60.0, "b": 30.0, None: 30.0}
    words_, of, targets = mixing.plan_mix({("a",): 10, ("a", "b"): 10, ("b",): 10}, {"a": 5, "b": 1})
    assert of == {"a": 20, "b": 20} and words_[("a",)] + words_[("a", "b")] + words_[("b",)] == round(targets["a"]) + round(targets["b"])
    assert mixing.min_cost_flow([("s", "a", 5, 0), ("s", "b", 5, 2), ("a", "t", 3, 0), ("b", "t", 9, 0)], "s", "t")[0] == 8


def test_mixing(spark):
    texts = corpus(3, 80)
    docs = documents(spark, texts, lambda i: [None, "a", "b", "b", "b", "b", "b", "c"][i % 8]).withColumn("taken", F.lit("clash"))
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.orderBy(F.desc("doc_id"))).collect()
    assert {r.doc_id: r.taken for r in got} == {r.doc_id: r.taken for r in again} and len(got) == 80
    sizes = {}
    for r in got:
        assert r["size"] == len(words(r.text)) and 0 <= r.taken <= 3 * r["size"] and r.ids == [r.doc_id]
        sizes.setdefault(r.source, []).append(r)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = brute_targets({s: sum(r["size"] for r in sizes[s]) for s in order})
    for s, rows in sizes.items():
        assert rows[0].target == pytest.approx(want[s]) and rows[0].source_size == sum(r["size"] for r in rows)
        assert abs(sum(r.taken for r in rows) - want[s]) <= 1.5
    assert mixing.mix(docs.where("doc_id < 0")).count() == 0


def test_mixing_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["a", "b"] if i % 2 else ["a"]) for i in range(40)] + [(99, None, [])]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, s array<string>"), sources=F.col("s"), weights={"a": 1, "b": 9, None: 1}).collect()
    assert sum(r.taken for r in got) > 0 and all(r.taken <= 3 * r["size"] for r in got)


# 6


def brute_lm(texts, taught, mu, order=2):
    import math
    from collections import Counter

    seq = [["<s>", *words(t), None] for t in texts]
    counts = Counter()
    for s, k in zip(seq, taught):
        if k:
            counts.update(tuple(s[i : i + n]) for n in range(1, order + 1) for i in range(len(s) - n + 1))
    vocabulary = {g[0] for g in counts if len(g) == 1} - {"<s>"}
    n, v, out = sum(counts[w,] for w in vocabulary), len(vocabulary), []

    def chance(history, w):
        if not history:
            return (counts[w,] + 1) / (n + v + 1)
        return (counts[(*history, w)] + mu * chance(history[1:], w)) / (counts[history] + mu)

    for s in seq:
        base = sum(math.log10((counts[w,] + 1) / (n + v + 1)) for w in s[1:])
        score = sum(math.log10(chance(tuple(s[max(0, i - order + 1) : i]), s[i])) for i in range(1, len(s)))
        out.append((len(s) - 1, sum(counts[w,] > 0 for w in s[1:]), n, base, score))
    return out


@pytest.mark.parametrize(("order", "shard"), [(1, 1 << 20), (2, 1 << 20), (2, 700), (3, 2000)])
def test_lm(spark, order, shard):
    texts = corpus(4, 56) + ["Zz " * 4000, "ab\x1cc ab\x1cc \x85\xa0d", "only here"]
    docs = documents(spark, texts)
    got = by_id(lm_scores(docs, lang_id.fold("doc_id", 7) != 2, order=order, shard_bytes=shard), "n_tokens", "n_known", "train_tokens", "base_score", "score", "held_out")
    taught = [zlib.crc32(str(i).encode()) % 7 != 2 for i in range(len(texts))]
    for i, want in enumerate(brute_lm(texts, taught, 100.0, order)):
        assert got[i][:3] == want[:3] and got[i][3] == pytest.approx(want[3]) and got[i][4] == pytest.approx(want[4]) and got[i][5] == (not taught[i])


def test_lm_edges(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a c"), (4, None), (5, "")], "doc_id long, text string").withColumn("taught", F.lit("clash"))
    got = sorted((r.doc_id or 0, r.n_tokens, r.held_out, round(r.score, 9)) for r in lm_scores(docs, F.col("doc_id") < 3).collect())
    want = brute_lm(["a c", "a b", "a b", "", ""], [False, True, True, False, False], 100.0)
    assert got == [(i, w[0], h, round(w[4], 9)) for i, w, h in zip((0, 1, 1, 4, 5), want, (True, False, False, True, True))]
    empty = lm_scores(docs, F.lit(False)).collect()
    assert len(empty) == 5 and all(r.train_tokens == 0 and r.score == 0 for r in empty)
    assert lm_scores(docs.where("doc_id < 0"), F.lit(True)).count() == 0


def test_automaton_by_hand():
    """Two states besides the empty history; every step of a walk is looked up by hand."""
    machine = BackoffAutomaton(4)
    first = machine.add_states(np.array([0, 0]), np.array([-0.5, -0.25]))
    machine.begin = first
    machine.add_arcs(np.zeros(3, int), np.array([0, 2, 3]), np.array([-9.0, -2.0, -3.0]), np.array([0, first + 1, 0]))
    machine.add_arcs(np.array([first, first + 1]), np.array([2, 3]), np.array([-0.125, -1.0]), np.array([first + 1, 0]))
    assert machine.read([2, 3]) == -1.125  # arcs of the begin and of 2
    assert machine.read([3]) == -3.5  # failure of the begin, arc of the empty history
    assert machine.read([2, 0, 3]) == -0.125 - 0.25 - 9 - 3 and machine.read([]) == 0
    assert machine.fail == [0, 0, 0]


# 7


def test_url_filters(spark):
    events = spark.createDataFrame([("l", "Bad.org", "2024-01-05", "add"), ("l", "bad.org", "2024-01-10", "remove"), ("m", "x.bad.org", "2024-01-01", "add"), ("l", None, "2024-01-01", "add")], "list string, domain string, day string, action string").withColumn("day", F.to_date("day"))
    rows = [(1, "http://u@A.bad.org.:80/p", "2024-01-05"), (2, "http://bad.org", "2024-01-10"), (3, "https://x.bad.org?q", "2024-01-07"), (4, None, "2024-01-07"), (5, "bad.org", "2024-01-07"), (6, "http://notbad.org", "2024-01-07"), (7, "http://bad.org", None), (1, "http://a.bad.org", "2024-01-04")]
    got = url_filters.filter_urls(spark.createDataFrame(rows, "page_id long, url string, fetched string").withColumn("fetched", F.to_date("fetched")).withColumn("entry", F.lit(1)), events)
    assert sorted((r.page_id, r.blocked, r.entry, r.n_lists) for r in got.collect()) == [(1, False, None, 0), (1, True, "bad.org", 1), (2, False, None, 0), (3, True, "x.bad.org", 2), (4, False, None, 0), (5, False, None, 0), (6, False, None, 0), (7, False, None, 0)]


# 8


def test_token_output(spark):
    from tokenizers import Tokenizer

    texts = corpus(5, 40) + ["Don't  stop\n \n now", "a\0b c", "<|endoftext|> x", "x <|endoftext|> y", "a<|endoftext|><|endoftext|>.b <|endoftext|>"]
    path = common.new_path(spark, "tokens")
    name = public_tokenizers.path("byte_bpe_50k.json")
    token_output.write_tokens(documents(spark, texts).orderBy(F.rand(1)), path, name, bytes_each=2000)
    t = Tokenizer.from_file(name)
    got, start = by_id(token_output.token_index(spark, path), "start", "n_tokens", "ids_crc32"), 0
    for i, text in enumerate(texts):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        assert got[i] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert sorted(r.doc_id for r in token_output.read_tokens(spark, path, 5, 9).collect()) == [5, 6, 7, 8, 9]
    files = [f for f in sorted(os.listdir(path.removeprefix("file://"))) if f.endswith(".parquet")]
    meta = pq.read_metadata(f"{path.removeprefix('file://')}/{files[-1]}")
    ids = next(meta.row_group(0).column(i) for i in range(meta.num_columns) if "ids" in meta.row_group(0).column(i).path_in_schema)
    assert ids.has_offset_index and any("DICTIONARY" in e or "DELTA" in e for e in ids.encodings)


# 9


@pytest.fixture(scope="module")
def bpe():
    with open(RANKS, "rb") as f:
        lines = f.read().splitlines()
    ranks = read_ranks(lines)
    return Bpe(ranks, public_tokenizers.PATTERN), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_library(bpe):
    ours, library = bpe
    r = random.Random(0)
    parts = ["a", "th", "ion", " ", "  ", "\n", " \n", "'s", "'re", "é", "ß", "日本", "🙂", "1", "23", "!", "...", "\xa0", "\x1c", "\x85", "\t", "_", "x" * 40, "́", "İ", "\0", ",", "."]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        assert ours.encode(text) == library.encode_ordinary(text)
        assert ours.decode(ours.encode(text)) == text.encode()


def test_bpe_operator(spark, bpe):
    texts = corpus(6, 40) + ["Don't  stop\n \n now ", " lead", "a\0b c", "x" * 3000]
    encoded = bpe_encode(documents(spark, texts), RANKS, public_tokenizers.PATTERN)
    got = by_id(bpe_decode(encoded, RANKS), "n_tokens", "ids_sha256", "decoded")
    for i, t in enumerate(texts):
        ids = bpe[1].encode_ordinary(t or "")
        assert got[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), (t or "").encode())


# 10


def test_near_duplicates(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", 40)
    monkeypatch.setattr(near_dedup, "ASK_BLOCKS", 2)
    rng = np.random.default_rng(0)
    base = rng.normal(size=(150, 16))
    near = base[:40] + rng.normal(size=(40, 16)) * 0.02
    hot = base[0] + rng.normal(size=(60, 16)) * 0.01
    v = np.concatenate([base, near, hot, base[:5], base[:3] * 2])
    rows = [(i, x.tolist(), i % 2 if i < 150 else (i - 150) % 2 if i < 190 else 0) for i, x in enumerate(v)]
    odd = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] + [1.0] * 15, 0), (903, v[0].tolist(), None), (904, [], 0), (905, v[0].tolist()[:8], 0), (906, [None] + [1.0] * 15, 0)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int").withColumn("component", F.lit("clash"))
    rows_found = near_dedup.near_duplicates(df, shard_rows=64).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in rows_found}
    assert all((r.recall or 1.0) >= near_dedup.RECALL and (r.recall is None) == (r.exact is None) == (r.vec_id >= 900 and r.vec_id != 905) for r in rows_found)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    link = (u @ u.T >= 0.98 - 1e-12) & (label[:, None] == label[None])
    for i in range(len(v)):
        seen, todo = {i}, [i]
        while todo:
            new = set(np.flatnonzero(link[todo.pop()]).tolist()) - seen
            seen |= new
            todo += new
        assert got[i] == (int(link[i].sum()) - 1, min(seen), min(seen) == i)
    assert all(got[i] == (0, i, True) for i, _, _ in odd)
    assert near_dedup.near_duplicates(df.where("vec_id < 0")).count() == 0


def test_small_world_recall():
    rng = np.random.default_rng(1)
    u = rng.normal(size=(800, 24)).astype(np.float32)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    graph = near_dedup.SmallWorld(u)
    found, _ = graph.search(u[::20], 64)
    hits = sum(len(set(near[:10].tolist()) & set(np.argsort(-(u @ u[i]))[:10].tolist())) for i, near in zip(range(0, 800, 20), found))
    assert hits >= 0.9 * 400


def test_range_search_beyond_the_widest_beam():
    """Where the graph leads nowhere, the whole block is compared with the whole shard."""
    rng = np.random.default_rng(2)
    u = np.repeat(rng.normal(size=(100, 16)), 3, axis=0) + rng.normal(size=(300, 16)) * 0.005
    u = (u / np.linalg.norm(u, axis=1, keepdims=True)).astype(np.float32)
    graph = near_dedup.SmallWorld(u)
    graph.links = [np.full_like(x, -1) for x in graph.links]
    found, recall, _ = near_dedup.range_search(graph, u, 0.98)
    assert [f.tolist() for f in found] == [np.flatnonzero(u @ q >= 0.98 - 1e-5).tolist() for q in u] and recall == 1.0


def test_range_search_audits_queries_without_links():
    """Audited queries have no link here, all others have one that the graph does not reach."""
    rng = np.random.default_rng(3)
    u = rng.normal(size=(300, 16))
    u = (u / np.linalg.norm(u, axis=1, keepdims=True)).astype(np.float32)
    graph = near_dedup.SmallWorld(u)
    graph.links = [np.full_like(x, -1) for x in graph.links]
    queries = u[:160].copy()
    queries[:: near_dedup.AUDIT_EVERY] *= -1
    exact = [np.flatnonzero(u @ q >= 0.98 - 1e-5).tolist() for q in queries]
    assert not any(exact[:: near_dedup.AUDIT_EVERY]) and sum(map(len, exact)) >= 150
    assert [f.tolist() for f in near_dedup.range_search(graph, queries, 0.98)[0]] == exact


# the pipeline


def test_pipeline_stages(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES][1] == "n-gram Jaccard join" and len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = found
        found, _ = common.materialize(stage(spark, before, ""), "t")
        assert found.columns == docs.columns
        if name == "language id":
            kept = {r.doc_id for r in found.collect()}
            clean = [r for r in before.collect() if len(words(r.text)) >= 20 and r.lang]
            assert sum(r.doc_id in kept for r in clean) >= 0.97 * len(clean)
            assert not any(r.doc_id in kept for r in before.collect() if not regex.search(r"\p{L}", r.text or ""))
        if name == "n-gram Jaccard join":
            rows = sorted((r.doc_id, r.text) for r in before.collect())
            groups = brute_groups([t for _, t in rows], 5, 80)
            assert sorted(r.doc_id for r in found.collect()) == [rows[i][0] for i, (_, g) in groups.items() if g == i]
        if name == "suffix-array dedup":
            want = {r[0]: r[1] - r[2] for r in brute_repeats([(r.doc_id, r.text) for r in before.collect()], 50)}
            assert all(want[r.doc_id] - 6 <= len(r.text.encode()) <= want[r.doc_id] and r.n_chars == len(r.text) for r in found.collect())
        if name == "mixing sources":
            rows, have = before.collect(), Counter(r.doc_id for r in found.collect())
            assert all(have[r.doc_id] <= 3 and (words(r.text) or not have[r.doc_id]) for r in rows)
            size = lambda counts, source: sum(len(words(r.text)) * counts[r.doc_id] for r in rows if r.source == source)
            once, order = Counter(r.doc_id for r in rows), sorted({r.source for r in rows}, key=lambda s: (s is None, s or ""))
            want = brute_targets({s: size(once, s) for s in order})
            longest = max(len(words(r.text)) for r in rows)
            assert all(abs(size(have, s) - want[s]) <= longest for s in order)
    last = corpus_pipeline.STAGES[-1][1](spark, found, "").collect()
    assert len(last) == found.count() and {r.doc_id: r.decoded_sha256 for r in last} == {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in found.collect()}


def test_pipeline_edges(spark):
    """Nulls in every column, repeated rows, a long text and columns with names that operators use, through all stages."""
    import corpus_pipeline

    r = random.Random(5)
    text = lambda k: " ".join(r.choice(["river", "stone", "cloud", "walks", "under", "bright", "seven", "morning"]) + str(r.randrange(99)) for _ in range(k))
    rows = [(i, text(40), "en" if i % 2 else "de", f"s{i % 3}", 1) for i in range(40)]
    rows += [(None, text(30), None, None, None), (41, None, "en", "s1", 0), (42, "", None, "s1", 0), (7, rows[7][1], "en", "s1", 1), (43, text(30000), "en", None, None), (None, None, None, None, None)]
    names = ("lang_pred", "score", "rejected", "times", "use", "size", "source_size", "target", "taken", "row", "doc", "uid", "kept_text", "component_id", "digest")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({n: F.lit(f"own {n}") for n in names})
    for table in (docs, docs.where("doc_id < 0")):
        found, _ = common.materialize(table, "edges")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found, _ = common.materialize(stage(spark, found, ""), "edges")
            assert found.columns == docs.columns, name
            assert all(x[n] == f"own {n}" for x in found.collect() for n in names), name
            assert found.count() > 30 or table is not docs, name
        last = corpus_pipeline.STAGES[-1][1](spark, found, "")
        assert last.count() == found.count()


def test_a_worker_keeps_tables_of_one_operator():
    """A Python worker outlives the step that used it: the tables of one operator don't stay beside the memory of the next."""
    before = {id(o) for o in gc.get_objects() if isinstance(o, Bpe)}
    with open(RANKS, "rb") as f:
        shipped = SimpleNamespace(value=f.read().splitlines())
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1], pa.int64()), "text": ["some words, some more"]})
    run = lambda: list(bpe_module._both((RANKS, public_tokenizers.PATTERN), shipped, iter([batch])))[0].column("ids").to_pylist()
    found = run()
    made = [weakref.ref(o) for o in gc.get_objects() if isinstance(o, Bpe) and id(o) not in before]
    assert found and made
    table = pa.table({"a": [1]})
    assert common.on_group(lambda t: t)(table) is table
    gc.collect()
    assert all(r() is None for r in made)
    assert run() == found


def test_mix_starts_no_workers_of_another_kind(spark):
    docs = spark.range(20).selectExpr("id as doc_id", "'a b c' as text", "concat('s', id % 3) as source")
    mixed = mixing.mix(docs)
    assert mixed.count() == 20
    assert "LogicalRDD" not in mixed._jdf.queryExecution().optimizedPlan().toString()


def test_local_table(spark):
    fields = "a string, b long, c double"
    for rows in ([], [("x", 1, 0.5), (None, None, None)]):
        made = common.local_table(spark, rows, fields)
        assert made.schema.simpleString() == "struct<a:string,b:bigint,c:double>" and [tuple(r) for r in made.collect()] == rows
