"""N-gram Jaccard join by T-occurrence search.

Documents become sets of hashed word shingles; equal sets are one class. In a global order (frequent shingles last), linked sets share
at least l members among the first n - T + l of each, where T is the least overlap of a set of n with any partner; l is a fixed share
of n here. So classes that can link meet in inverted lists of those first members, often enough. Blocks of classes that meet are
searched with DivideSkip: the short inverted lists of a query are heap-merged, the long ones are binary-probed, and classes that
reach the required overlap are retained and compared exactly.

Lists of up to SHORT_LIST classes send all their classes to be compared. Longer lists, as of large groups of near copies, first link
neighbours in order of size; after components of these links are known, only lists that hold several components are searched in
full, in blocks of bounded size, so a group costs no more than its rows once it hangs together.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, drop, materialize, mix64, on_batches, on_group, pieces, select_text, utf8, words
from tidemark.operators.components import connected_components

SHORT_LIST = 6
#: First members that two linked sets of n share at least: 1 + n // SHARE.
SHARE = 12
#: Most frequent shingles that go last in the order, and how often they occur at least; the table has a fixed size.
HOT, HOT_FROM = 1 << 16, 32
#: Bytes of text, and shingles, that one step of a task handles.
TEXT_STEP, COUNT_STEP = 2 << 20, 1 << 21
#: Classes of a block of a long list, and places that the rows of a hot shingle or family are dealt to.
LIST_BLOCK, SALT = 512, 16
#: Weight of the cost of a probe against a merge step in DivideSkip's choice of long lists.
MU = 0.05


def shingles(data: np.ndarray, at: np.ndarray, width: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's shingles of `width` words, and where rows begin; fewer words are one shingle, no words none."""
    found, before = words(data, at, seed)
    code = mix64(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
    n = max(len(found) - width + 1, 0)
    rolled = np.zeros(n, np.uint64)
    for k in range(width):
        rolled += found[k : k + n] * code[k]
    rolled = mix64(rolled)
    out = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(rolled[a : b - width + 1])
        else:
            out.append(mix64((found[a:b] * code[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))[: b > a])
    return (np.concatenate(out) if out else rolled), np.concatenate([[0], np.cumsum([len(x) for x in out], dtype=np.int64)])


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each row's shingles."""
    found, begin = shingles(data, at, width)
    return [np.unique(found[a:b]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]


def exact_shingles(text: bytes, width: int) -> set[tuple[bytes, ...]]:
    """The shingles themselves; lower() and split() of bytes treat ASCII letters and white space alone."""
    found = text.lower().split()
    return {tuple(found[k : k + width]) for k in range(max(1, len(found) - width + 1))} if found else set()


def least_overlap(n: int, percent: int) -> int:
    """The overlap that any link of a set of n members has at least."""
    return -(-percent * n // 100)


def linked(n: int, m: int, both: int, percent: int) -> bool:
    return 100 * both >= percent * (n + m - both) and both > 0


class DivideSkip:
    """Inverted lists over sets of hashes, with T-occurrence search."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.n = max(len(sets), 1)
        members = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.lexsort((owners, members))
        self.owners = owners[order]
        self.tokens, self.start = np.unique(members[order], return_index=True)
        self.end = np.append(self.start[1:], len(members))
        self.postings = np.repeat(np.arange(len(self.tokens)), self.end - self.start) * self.n + self.owners

    def search(self, query: np.ndarray, need: int, itself: int = -1, alive: np.ndarray | None = None) -> dict[int, int]:
        """Overlap of every indexed set, but `itself` and those that are not alive, that shares at least `need` members with the query."""
        if not len(self.tokens):
            return {}
        at = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        at = at[self.tokens[at] == query]
        size = self.end[at] - self.start[at]
        if itself >= 0:
            at, size = at[size > 1], size[size > 1]
        if len(at) < max(need, 1):
            return {}
        at = at[np.argsort(-size, kind="stable")]
        longest = int(self.end[at[0]] - self.start[at[0]])
        skip = max(0, min(need - 1, int(need / (MU * math.log2(longest + 1) + 1))))
        long, short = at[:skip], at[skip:]
        lists = [self.owners[self.start[i] : self.end[i]] for i in short.tolist()]
        if alive is not None:
            lists = [x[alive[x]] for x in lists]
        counts: dict[int, int] = {}
        for owner in heapq.merge(*[x.tolist() for x in lists if len(x)]):
            counts[owner] = counts.get(owner, 0) + 1
        out = {}
        for owner, count in counts.items():
            if count >= need - skip and owner != itself:
                keys = long * self.n + owner
                place = np.searchsorted(self.postings, keys)
                place[place == len(self.postings)] = 0
                count += int((self.postings[place] == keys).sum())
                if count >= need:
                    out[owner] = count
        return out


def _frequent(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that occur in several of the documents a step holds, with how many."""

    def counted(sets: list[np.ndarray]) -> pa.RecordBatch:
        token, n = np.unique(np.concatenate(sets), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(token[n > 1].view(np.int64)), pa.array(n[n > 1].astype(np.int64))], ["token", "n"])

    held, size = [], 0
    for batch in batches:
        data, at = utf8(batch.column(1))
        for i, j in chunks(at, TEXT_STEP):
            sets = shingle_sets(data[at[i] : at[j]], at[i : j + 1] - at[i], width)
            held += sets
            size += sum(map(len, sets))
            if size > COUNT_STEP:
                yield counted(held)
                held, size = [], 0
    if held:
        yield counted(held)


def _digests(data: np.ndarray, at: np.ndarray, width: int, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of each set of shingles. The second goes back to the words with another hash."""
    found, begin = shingles(data, at, width)
    other, _ = shingles(data, at, width, seed=2)
    one, two = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
    for k, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)):
        _, first = np.unique(found[a:b], return_index=True)
        one[k] = mix64(sets[k] ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(first))
        two[k] = mix64(other[a:b][first] ^ np.uint64(0x5A5A5A5A5A5A5A5A)).sum(dtype=np.uint64)
    return mix64(one).view(np.int64), mix64(two).view(np.int64)


def _post(width: int, percent: int, buckets: int, shipped: Broadcast, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed rows: buckets below 0 have (doc ids, set sizes, two digests); the others have (shingles, set sizes, digests) of first members."""
    hot = shipped.value
    for batch in batches:
        data, at = utf8(batch.column(1))
        ids = batch.column(0)
        for i, j in chunks(at, TEXT_STEP):
            part, edge = data[at[i] : at[j]], at[i : j + 1] - at[i]
            sets = shingle_sets(part, edge, width)
            size = np.array([len(s) for s in sets], np.int32)
            digest, check = _digests(part, edge, width, sets)
            own = ids.slice(i, j - i)
            out = [(-1 - int(abs(int(digest[0])) % buckets), np.array(own.fill_null(0).to_numpy(zero_copy_only=False), np.int64).tobytes(), np.where(own.is_null().to_numpy(zero_copy_only=False), -1 - size, size).astype(np.int32).tobytes(), digest.tobytes(), check.tobytes())]
            first, of = [], []
            _, once = np.unique(digest, return_index=True)
            once = once[size[once] > 0]
            for k in once.tolist():
                s = sets[k]
                p = min(len(s), len(s) - least_overlap(len(s), percent) + 1 + len(s) // SHARE)
                if len(hot):
                    place = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                    late = hot[place] == s
                    s = np.concatenate([s[~late], s[late]])[:p]
                first.append(s[:p])
                of.append(p)
            if first:
                token, owner = np.concatenate(first), np.repeat(once, of)
                bucket = (token >> np.uint64(40)).astype(np.int64) % buckets
                order = np.argsort(bucket, kind="stable")
                token, owner, bucket = token[order], owner[order], bucket[order]
                edge = np.searchsorted(bucket, np.arange(buckets + 1))
                for b in np.flatnonzero(np.diff(edge)).tolist():
                    x = slice(edge[b], edge[b + 1])
                    out.append((b, token[x].tobytes(), size[owner[x]].tobytes(), digest[owner[x]].tobytes(), None))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], ["bucket", "a", "n", "digest", "check"])


def _joined(table: pa.Table | pa.RecordBatch, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype)


MET = "kind int, token long, n long, a long, b long"
PAIR, LONG, ROW, SHARED = range(4)


def _meet(percent: int, table: pa.Table) -> pa.Table:
    """PAIR: classes a and b to compare, which share n members of short lists here. LONG: class a, of size n, in the long list of a
    token. SHARED: class a shares n of its first members here. ROW: document a has a set of n members with digests `token` and b."""
    digest, size = _joined(table, "digest", np.int64), _joined(table, "n", np.int32).astype(np.int64)
    if table.column("bucket")[0].as_py() < 0:
        ids = pa.array(_joined(table, "a", np.int64), mask=size < 0)
        return pa.table({"kind": pa.array(np.full(len(size), ROW, np.int32)), "token": pa.array(digest), "n": pa.array(np.where(size < 0, -1 - size, size)), "a": ids, "b": pa.array(_joined(table, "check", np.int64))})
    token = _joined(table, "a", np.uint64)
    order = np.lexsort((digest, size, token))
    token, size, digest = token[order], size[order], digest[order]
    fresh = np.ones(len(token), bool)
    fresh[1:] = (token[1:] != token[:-1]) | (digest[1:] != digest[:-1])
    token, size, digest = token[fresh], size[fresh], digest[fresh]
    edge = np.append(np.flatnonzero(np.append(True, token[1:] != token[:-1])), len(token))
    length = np.repeat(np.diff(edge), np.diff(edge))
    token, size, digest, length = (x[length > 1] for x in (token, size, digest, length))
    pairs = []
    for k in range(1, SHORT_LIST):
        i = np.flatnonzero((token[:-k] == token[k:]) & (100 * size[:-k] >= percent * size[k:]) & ((length[:-k] <= SHORT_LIST) | (k == 1)))
        pairs.append(np.stack([digest[i], digest[i + k], length[i] <= SHORT_LIST], axis=1))
    pairs = np.concatenate(pairs)
    pair, of = np.unique(pairs[:, :2], axis=0, return_inverse=True)
    long = np.flatnonzero(length > SHORT_LIST)
    own, shared = np.unique(digest, return_counts=True)
    kinds = np.repeat(np.array([PAIR, LONG, SHARED], np.int32), [len(pair), len(long), len(own)])
    return pa.table({
        "kind": pa.array(kinds),
        "token": pa.array(np.concatenate([np.zeros(len(pair), np.int64), token[long].view(np.int64), np.zeros(len(own), np.int64)])),
        "n": pa.array(np.concatenate([np.bincount(of.ravel(), weights=pairs[:, 2], minlength=len(pair)).astype(np.int64), size[long], shared.astype(np.int64)])),
        "a": pa.array(np.concatenate([pair[:, 0], digest[long], own])),
        "b": pa.array(np.concatenate([pair[:, 1], np.zeros(len(long) + len(own), np.int64)]), mask=kinds != PAIR),
    })


def _search(width: int, percent: int, table: pa.Table) -> pa.Table:
    """Links from a block's queries to its stored rows, as far as they join components that were apart. Words confirm each link."""
    data, at = utf8(table.column("text"))
    sets = []
    for i, j in chunks(at, TEXT_STEP):
        sets += shingle_sets(data[at[i] : at[j]], at[i : j + 1] - at[i], width)
    ids, group, query, stored = (table.column(c).to_pylist() for c in ("doc_id", "component", "query", "stored"))
    kept = [i for i in range(len(ids)) if stored[i]]
    place = {i: k for k, i in enumerate(kept)}
    index, out = DivideSkip([sets[i] for i in kept]), []
    _, label = np.unique(np.array(group, np.int64), return_inverse=True)
    exact = lambda i: exact_shingles(data[at[i] : at[i + 1]].tobytes(), width)
    for i, s in enumerate(sets):
        if query[i] and len(s):
            alive = label[kept] != label[i]
            near = index.search(s, least_overlap(len(s), percent), place.get(i, -1), alive) if alive.any() else {}
            own = None
            for k, both in near.items():
                j = kept[k]
                if label[i] != label[j] and linked(len(s), len(sets[j]), both, percent):
                    own = own or exact(i)
                    theirs = exact(j)
                    if linked(len(own), len(theirs), len(own & theirs), percent):
                        label[label == label[j]] = label[i]
                        out.append((ids[i], ids[j]))
    a, b = zip(*out, strict=True) if out else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _links(docs: DataFrame, needed: DataFrame, width: int, percent: int) -> DataFrame:
    """Search blocks: needed has (block, doc_id, component, query, stored); its texts are read again from docs."""
    flags = [F.first("component").alias("component"), F.max("query").alias("query"), F.max("stored").alias("stored")]
    held = docs.join(needed.groupBy("block", "doc_id").agg(*flags), "doc_id").select("block", "doc_id", "component", "query", "stored", "text")
    return held.groupBy("block").applyInArrow(on_group(_search, width, percent), "a long, b long")


def _salted(many: DataFrame, few: DataFrame, key: str, by: str) -> DataFrame:
    """many joined to few by a key that may be hot: its rows are dealt to SALT places by another column, and each row of few goes to all."""
    salt = F.pmod(F.xxhash64(by, F.lit(3)), F.lit(SALT)).cast("int")
    every = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return many.withColumn("_salt", salt).join(every, [key, "_salt"]).drop("_salt")


def _parts(family: DataFrame) -> DataFrame:
    """family (family, doc_id, n, ...) with `part`: blocks of LIST_BLOCK in order of size. Places are counted within each size and moved on
    by how many are smaller, so that no task sorts a family."""
    sizes = family.groupBy("family", "n").agg(F.count("*").alias("c"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy("family").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = family.join(sizes.select("family", "n", before.alias("before")), ["family", "n"])
    place = F.col("before") + F.row_number().over(Window.partitionBy("family", "n").orderBy("doc_id")) - 1
    return found.withColumn("part", F.floor(place / LIST_BLOCK)).drop("before")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs: components of links between sets of word shingles.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Two documents link when 100 * |both| >= percent * |either|.
    Null texts and texts without words have an empty set and stay alone; fewer than `width` words are one shingle. Rows that share
    an id are one document to links; a row with a null id is compared like any other but gets a null component when it is alone with
    other null ids. Repeated rows stay; very long texts are read whole; an empty table stays empty. Other columns are not read.
    Candidates are found by 64-bit hashes of shingles, in which two sets of one first digest may share entries; sets are equal when
    two independent digests are, and links are confirmed by the words themselves.
    """
    spark, docs = docs.sparkSession, select_text(docs, id_col, text_col)
    counts = docs.mapInArrow(on_batches("", _frequent, width), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    hot = counts.where(F.col("n") >= HOT_FROM).orderBy(F.desc("n"), "token").limit(HOT).select("token").toPandas()["token"].to_numpy(np.int64)
    shipped = spark.sparkContext.broadcast(np.sort(hot.view(np.uint64)))
    buckets = pieces(docs, 4 << 20)
    packed = docs.mapInArrow(on_batches("", _post, width, percent, buckets, shipped), "bucket int, a binary, n binary, digest binary, check binary")
    found, found_at = materialize(packed.groupBy("bucket").applyInArrow(on_group(_meet, percent), MET), "meetings", "kind")
    rows = found.where(F.col("kind") == ROW).select(F.col("a").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("token").alias("digest"), F.col("b").alias("check"))
    long = found.where(F.col("kind") == LONG).select("token", F.col("a").alias("digest"))
    classes = rows.where("n_shingles > 0 and doc_id is not null").groupBy("digest", "check").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"))
    shared = found.where(F.col("kind") == SHARED).groupBy(F.col("a").alias("digest")).agg(F.sum("n").alias("shared"))
    classes = classes.join(shared, "digest", "left").join(long.groupBy("digest").agg(F.count("*").alias("long")), "digest", "left")
    classes, classes_at = materialize(classes.fillna(0).withColumn("least", 1 + F.floor(F.col("n") / SHARE)), "classes")
    pairs = found.where(F.col("kind") == PAIR).groupBy("a", "b").agg(F.sum("n").alias("short"))
    end = lambda side, name: classes.select(F.col("digest").alias(side), F.col("doc_id").alias(name), F.col("shared").alias(f"{name}_shared"), F.col("long").alias(f"{name}_long"), F.col("least").alias(f"{name}_least"))
    ends = pairs.join(end("a", "x"), "a").join(end("b", "y"), "b")
    ends = ends.where("least(x_least, y_least) <= least(x_shared, y_shared) and least(x_least, y_least) <= short + least(x_long, y_long)")
    block = F.pmod(F.xxhash64("x"), F.lit(buckets))
    near = ends.select(block.alias("block"), F.explode(F.array(*[F.struct(F.col(c).alias("doc_id"), F.col(c).alias("component"), F.lit(c == "x").alias("query"), F.lit(c == "y").alias("stored")) for c in "xy"])).alias("e")).select("block", "e.*")
    links, links_at = materialize(_links(docs, near, width, percent), "near")
    group, group_at = materialize(connected_components(links), "groups")
    # Long lists whose classes are in several components: in order of size, in blocks of which each two whose sizes allow a link meet.
    # Partners are of similar size, so both share at least `percent` of what the larger must share.
    able = classes.where(100 * F.col("shared") >= percent * (F.col("least") - 1)).select("digest", "doc_id", "n")
    long = long.join(able, "digest").join(group.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    long = long.select("token", "n", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    long, long_at = materialize(long, "long")
    heads = long.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("doc_id").alias("head"))
    heads = heads.where("low <> high").select("token", "head")
    # Lists of one family mostly begin with the same documents: they are joined to one list under the least head of any list that
    # holds their own head, so that a family is searched about once and not for each of its shingles.
    held = _salted(long, heads, "token", "doc_id").groupBy("head", "doc_id").agg(F.first("component").alias("component"), F.first("n").alias("n"))
    held, held_at = materialize(held, "heads")
    lower = held.join(held.select(F.col("head").alias("doc_id")).distinct(), "doc_id", "left_semi").groupBy(F.col("doc_id").alias("head")).agg(F.min("head").alias("first"))
    family = _salted(held, lower, "head", "doc_id").groupBy(F.col("first").alias("family"), "doc_id").agg(F.first("component").alias("component"), F.first("n").alias("n"))
    mixed = family.groupBy("family").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("family")
    left, left_at = materialize(_salted(family, mixed, "family", "doc_id"), "open")
    placed, placed_at = materialize(_parts(left), "placed")
    spans = placed.groupBy("family", "part").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    s, t = spans.alias("s"), spans.alias("t")
    meet = s.join(t, (F.col("s.family") == F.col("t.family")) & (F.col("s.part") <= F.col("t.part")) & (100 * F.col("s.high") >= percent * F.col("t.low")))
    meet = meet.select(F.col("s.family").alias("family"), F.col("s.part").alias("p"), F.col("t.part").alias("q"), F.xxhash64("s.family", "s.part", "t.part").alias("block"))
    side = lambda part, query: placed.join(meet.select("family", F.col(part).alias("part"), "block"), ["family", "part"]).select("block", "doc_id", "component", F.lit(query).alias("query"), F.lit(not query).alias("stored"))
    needed = side("p", True).unionByName(side("q", False))
    more, more_at = materialize(_links(docs, needed, width, percent), "far")
    final, final_at = materialize(connected_components(links.unionByName(more)), "groups")
    named = classes.join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("digest", "check", F.coalesce("component", "doc_id").alias("component"))
    named, _ = materialize(named, "named")
    drop(spark, classes_at, links_at, group_at, long_at, held_at, left_at, placed_at, more_at, final_at)
    out = rows.join(named, ["digest", "check"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))
