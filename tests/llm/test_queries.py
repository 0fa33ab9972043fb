"""The queries op1 to op10 over whole small tables against plain computations, and edges that need a table of their own."""

import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_llm import brute_groups, brute_lm, brute_repeats, brute_targets, by_id, words

from tidemark.llm import common, media, mixing, near_dedup, queries, suffix_dedup, token_output, url_filters
from tidemark.llm.bpe import bpe_decode, bpe_encode, bpe_round_trip, read_ranks

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return sorted(spark.read.parquet(f"{D}/documents.parquet").collect(), key=lambda r: r.doc_id)


def run(spark, name):
    return queries.QUERIES[name](spark, D)


def fold(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_op1(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op1_language_id").collect()}
    assert set(got) == {r.doc_id for r in docs} and all(got[r.doc_id].held_out == (fold(r.doc_id, 5) == 0) for r in docs)
    langs = {r.lang for r in docs if r.lang and fold(r.doc_id, 5)}
    assert {r.lang_pred for r in got.values()} <= langs | {"und"} and all(0 <= r.score <= 1 for r in got.values())
    known = [r for r in docs if r.lang and len(words(r.text)) > 10]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in known) >= 0.95 * len(known)


def test_op2(spark, docs):
    groups = brute_groups([r.text for r in docs], 4, 85)
    got = by_id(run(spark, "op2_ngram_jaccard_join"), "n_shingles", "component_id")
    assert got == {docs[i].doc_id: (n, docs[g].doc_id) for i, (n, g) in groups.items()}


def test_op3(spark, docs):
    got = by_id(run(spark, "op3_suffix_array_dedup"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == {r[0]: r[1:] for r in brute_repeats([(r.doc_id, r.text) for r in docs], 50)}


def plain_hash(payload):
    """The cosine hash by loops over coefficients, from the payload as rows of 64 samples."""
    x = np.frombuffer(payload, np.uint8).reshape(-1, 64).astype(float)
    small = np.zeros((32, 32))
    for i in range(32):
        a = i * len(x) // 32
        b = max((i + 1) * len(x) // 32, a + 1)
        for j in range(32):
            small[i, j] = x[a:b, 2 * j : 2 * j + 2].mean()
    low = np.array([[sum(math.cos(math.pi * u * (2 * i + 1) / 64) * float(small[i] @ [math.cos(math.pi * v * (2 * j + 1) / 64) for j in range(32)]) for i in range(32)) for v in range(8)] for u in range(8)])
    low = np.round(low, 6).ravel()
    return np.packbits(low > np.median(low[1:])).tobytes().hex()


def test_op4(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op4_media_columns").collect()}
    stored = {r.doc_id: bytes(r.media) for r in media.encode_media(spark.read.parquet(f"{D}/documents.parquet")).collect()}
    wrong = 0
    for r in docs:
        data = (r.text or "").encode()
        payload = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
        g, image = got[r.doc_id], stored[r.doc_id]
        assert (g.n_bytes, g.payload_bytes, g.payload_sha256, g.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (g.media_bytes, g.media_sha256) == (len(image), hashlib.sha256(image).hexdigest())
        wrong += g.feature != plain_hash(payload)
    assert wrong <= 2  # a coefficient at the median may round either way


def test_op5(spark, docs):
    got = {r.doc_id: r for r in run(spark, "op5_source_mixing").collect()}
    size = {r.doc_id: len(words(r.text)) for r in docs}
    order = sorted({r.source for r in docs}, key=lambda s: (s is None, s or ""))
    sizes = {s: sum(size[r.doc_id] for r in docs if r.source == s) for s in order}
    want = brute_targets(sizes)
    for r in docs:
        g = got[r.doc_id]
        assert g["size"] == size[r.doc_id] and g.source_size == sizes[r.source] and g.target == pytest.approx(want[r.source]) and 0 <= g.taken <= 3 * g["size"]
    for s in order:
        assert abs(sum(got[r.doc_id].taken for r in docs if r.source == s) - want[s]) <= 1
    assert {i: (g.taken,) for i, g in got.items()} == by_id(run(spark, "op5_source_mixing"), "taken")


def test_op6(spark, docs):
    taught = [fold(r.doc_id, 7) != 2 for r in docs]
    got = by_id(run(spark, "op6_lm_scoring"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "held_out")
    for r, t, want in zip(docs, taught, brute_lm([r.text for r in docs], taught, 100.0), strict=True):
        g = got[r.doc_id]
        assert g[:3] == want[:3] and g[3] == pytest.approx(want[3]) and g[4] == pytest.approx(want[4]) and g[5] == (not t)
    held = [got[r.doc_id] for r, t in zip(docs, taught, strict=True) if not t]
    assert sum(g[4] for g in held) > sum(g[3] for g in held)  # the model beats its base where it has not learned


def test_op8(spark, docs):
    from tokenizers import Tokenizer

    t, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    got = by_id(run(spark, "op8_token_output"), "start", "n_tokens", "ids_crc32")
    for r in docs:
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 0]
        assert got[r.doc_id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


@pytest.fixture(scope="module")
def library():
    with open(queries.RANKS, "rb") as f:
        return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(f.read().splitlines()), special_tokens={})


def test_op9(spark, docs, library):
    got = by_id(run(spark, "op9_byte_bpe"), "n_tokens", "ids_sha256", "decoded_sha256")
    for r in docs:
        ids = library.encode_ordinary(r.text or "")
        assert got[r.doc_id] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())


def test_op10(spark):
    rows = sorted(spark.read.parquet(f"{D}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    v, label = np.array([r.embedding for r in rows], float), [r.label for r in rows]
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    link = (u @ u.T >= 0.98) & np.array([[a is not None and a == b for b in label] for a in label])
    np.fill_diagonal(link, False)
    group = list(range(len(rows)))
    for _ in rows:
        group = [min([group[i], *(group[j] for j in np.flatnonzero(link[i]))]) for i in range(len(rows))]
    got = by_id(run(spark, "op10_embedding_near_dedup").withColumnRenamed("vec_id", "doc_id"), "n_links", "component_id", "kept")
    assert got == {r.vec_id: (int(link[i].sum()), rows[group[i]].vec_id, group[i] == i) for i, r in enumerate(rows)}


# edges

KINDS = "doc_id long, text string, source string"


def odd(spark):
    """Null ids, repeated rows and ids, empty and null texts."""
    return spark.createDataFrame([(None, "a b", "s"), (None, "a b", "s"), (7, "c d e", None), (7, "c d e", None), (7, "other words here", "s"), (8, "", "t"), (9, None, "t")], KINDS).withColumn("ids", F.lit("clash"))


def test_media_edges(spark):
    got = media.media_features(media.encode_media(odd(spark))).collect()
    assert sorted((r.doc_id or 0, r.n_bytes) for r in got) == [(0, 3), (0, 3), (7, 5), (7, 5), (7, 16), (8, 0), (9, 0)]
    assert len({r.feature for r in got if r.n_bytes == 3}) == 1
    assert media.media_features(media.encode_media(odd(spark).where("doc_id < 0"))).count() == 0
    assert media.media_features(spark.createDataFrame([(1, 2, None)], "doc_id long, n_bytes long, media binary")).first().payload_bytes is None


def test_mixing_edges(spark):
    docs = odd(spark).unionByName(spark.createDataFrame([(50, "w " * 60000, "s"), (51, "w " * 100, "t")], KINDS), allowMissingColumns=True)
    got = mixing.mix(docs).collect()
    assert len(got) == 9 and all(0 <= r.taken <= 3 * r["size"] for r in got) and {r["size"] for r in got if r.doc_id in (8, 9)} == {0}
    for source in ("s", "t", None):
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 4
    assert len({r.taken for r in got if r.doc_id is None}) == 1
    assert mixing.mix(docs.where("doc_id = 8")).first().taken == 0


def test_url_filter_edges(spark):
    kinds = "page_id long, url string, fetched date"
    events = spark.createDataFrame([("a", "x.org", "add", "2024-01-01"), ("b", "x.org", "add", "2024-01-01"), ("b", "x.org", "remove", "2024-01-01"), ("a", "y.x.org", "add", "2024-01-01")], "list string, domain string, action string, day string").withColumn("day", F.to_date("day"))
    page = spark.createDataFrame([(1, "http://y.x.org", None), (2, "http://z.x.org/" + "p" * 5000, None), (2, "http://z.x.org/" + "p" * 5000, None)], kinds).withColumn("fetched", F.to_date(F.lit("2024-02-01")))
    got = sorted((r.page_id, r.blocked, r.entry, r.n_lists) for r in url_filters.filter_urls(page, events).collect())
    assert got == [(1, True, "y.x.org", 1), (2, True, "x.org", 1), (2, True, "x.org", 1)]  # of a day's events of one entry `remove` counts
    assert url_filters.filter_urls(page.where("page_id < 0"), events).count() == 0
    assert [r.blocked for r in url_filters.filter_urls(page, events.where("list = 'none'")).collect()] == [False] * 3


def test_token_output_edges(spark):
    for rows, n in ((odd(spark), 7), (odd(spark).where("doc_id < 0"), 0)):
        path = common.new_path(spark, "tokens")
        token_output.write_tokens(rows, path, public_tokenizers.path("byte_bpe_50k.json"), bytes_each=4)
        got = token_output.token_index(spark, path).collect()
        assert len(got) == n
        at = 0
        for r in sorted(got, key=lambda r: r.start):
            assert r.start == at
            at += r.n_tokens
        assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted([r.doc_id for r in got], key=lambda i: (i is not None, i))


def test_bpe_edges(spark, library):
    texts = ["x" * 60000, "ab" * 20000, "\xa0" * 9000, "é" * 9000, "".join(chr(0x4E00 + i * 7 % 5000) for i in range(9000)), " " * 9000 + "x", "á" * 5000]
    docs = odd(spark).unionByName(spark.createDataFrame([(100 + i, t, "s") for i, t in enumerate(texts)], KINDS), allowMissingColumns=True)
    got = bpe_round_trip(docs, queries.RANKS, public_tokenizers.PATTERN).collect()
    assert len(got) == 7 + len(texts) and sum(r.doc_id is None for r in got) == 2
    for r in got:
        if r.doc_id is not None and r.doc_id >= 100:
            assert list(r.ids) == library.encode_ordinary(texts[r.doc_id - 100]) and bytes(r.decoded).decode() == texts[r.doc_id - 100]
    apart = bpe_decode(bpe_encode(docs, queries.RANKS, public_tokenizers.PATTERN), queries.RANKS).collect()
    assert sorted(map(str, apart)) == sorted(map(str, got))
    assert bpe_round_trip(docs.where("doc_id < 0"), queries.RANKS, public_tokenizers.PATTERN).count() == 0


def test_near_duplicates_edges(spark):
    up, down = [1.0, 0.0], [0.98, math.sqrt(1 - 0.98**2)]
    rows = [(1, up, 0), (1, up, 0), (2, down, 0), (None, up, 0), (3, [2.0, 0.0], 0), (4, [0.0, 1.0], 0), (5, [1.0] + [0.0] * 4999, 1), (6, [2.0] + [0.0] * 4999, 1)]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())
    tie = float(np.dot(up, np.array(down) / np.linalg.norm(down))) >= 0.98
    assert got == [(0, 0, None, None), (1, 2 + tie, 1, True), (1, 2 + tie, 1, True), (2, 3 * tie, 1 if tie else 2, not tie), (3, 2 + tie, 1, False), (4, 0, 4, True), (5, 1, 5, True), (6, 1, 5, False)]


def test_suffix_dedup_very_long_text(spark):
    base = "".join(f"{i * 7919 % 100003} " for i in range(60000))
    rows = [(1, base), (2, "x" + base[1000:200000] + "y"), (3, "tail" + base[-70:])]
    got = by_id(suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), part_bytes=1 << 16, array_bytes=1 << 15, shard_bytes=1 << 16), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == {r[0]: r[1:] for r in brute_repeats(rows, 50)}
