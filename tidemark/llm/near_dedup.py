"""Embedding near-duplicates by navigable small-world graphs.

Equal vectors of a label are one class. The classes of a label are dealt to shards, each shard gets a hierarchical navigable
small-world graph (Malkov and Yashunin, 2016), and blocks of classes query every shard of their label. A block's beam is doubled
until an audit of some of its queries against all of the shard's vectors reaches the wanted recall, of links and of nearest neighbours,
as many queries have no link in a shard. A block that fails with the widest beam is compared with the whole shard; so is a query whose
beam holds nothing but links, as it may have more of them. Cosines are verified in double precision.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop, materialize, mix64, on_cogroup, on_group
from tidemark.operators.components import UnionFind, connected_components

#: Classes of a shard, and of a block of queries.
SHARD_ROWS, BLOCK_ROWS = 8192, 1024
#: Blocks of queries that one group streams past a shard.
ASK_BLOCKS = 64
M, BUILD_BEAM, FIRST_BEAM, MOST_BEAM = 12, 48, 24, 192
#: Nodes that come into a graph together, and nodes of a beam that are expanded together.
BATCH, WIDE = 512, 4
#: One query in so many is audited, by its links and by so many nearest neighbours.
AUDIT_EVERY, NEAREST, RECALL = 16, 8, 0.99


def _best(sims: np.ndarray, n: int) -> np.ndarray:
    """Columns of the n greatest of each row, in no order."""
    return np.argpartition(-sims, n - 1, axis=1)[:, :n] if n < sims.shape[1] else np.tile(np.arange(sims.shape[1]), (len(sims), 1))


def _descending(ids: np.ndarray, sims: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


class SmallWorld:
    """A graph over unit vectors; nearness is the inner product.

    links has, for each layer, a row of neighbours for every node, -1 where there are fewer. Nodes come in from the highest layer down,
    so the entry is the first; those of one batch search the graph side by side and are candidates of one another.
    """

    def __init__(self, unit: np.ndarray, m: int = M, beam: int = BUILD_BEAM, batch: int = BATCH) -> None:
        self.unit, self.m = unit, m
        n = len(unit)
        draw = (mix64(np.arange(1, n + 1, dtype=np.uint64)) >> np.uint64(11)).astype(float) / 2**53
        self.level = np.floor(-np.log(np.maximum(draw, 1e-12)) / math.log(m)).astype(int)
        self.links = [np.full((n, m * (2 if layer == 0 else 1)), -1, np.int32) for layer in range(int(self.level.max(initial=0)) + 1)]
        order = np.lexsort((np.arange(n), -self.level))
        self.entry = int(order[0]) if n else 0
        at = 1
        while at < n:
            self._insert(order[at : at + min(batch, at)], beam)
            at += min(batch, at)

    def _insert(self, nodes: np.ndarray, beam: int) -> None:
        q, near = self.unit[nodes], np.full((len(nodes), 1), self.entry)
        for layer in range(len(self.links) - 1, -1, -1):
            own = self.level[nodes] >= layer
            if not own.all():
                found, _ = self.search_layer(q[~own], near[~own][:, :1], 1, layer)
                near[~own] = -1
                near[~own, :1] = found
            if own.any():
                mine = nodes[own]
                found, sims = self.search_layer(q[own], near[own], beam, layer)
                among = q[own] @ q[own].T
                np.fill_diagonal(among, -np.inf)
                pick = _best(among, min(beam, len(mine)))
                ids, sims = _descending(np.concatenate([found, mine[pick]], axis=1), np.concatenate([sims, np.take_along_axis(among, pick, 1)], axis=1))
                ids[sims == -np.inf] = -1
                chosen = self._spread(ids[:, :beam], sims[:, :beam], self.m)
                self.links[layer][mine, : self.m] = chosen
                self._link_back(layer, mine, chosen)
                wide = np.full((len(nodes), max(near.shape[1], found.shape[1])), -1)
                wide[~own, : near.shape[1]] = near[~own]
                wide[own, : found.shape[1]] = found
                near = wide

    def _link_back(self, layer: int, nodes: np.ndarray, chosen: np.ndarray) -> None:
        """Each chosen neighbour links to the nodes that chose it; those with too many links choose among them."""
        links, dim = self.links[layer], self.unit.shape[1]
        row, col = np.nonzero(chosen >= 0)
        to = chosen[row, col]
        by = np.argsort(to, kind="stable")
        to, source = to[by], nodes[row[by]]
        target, first, count = np.unique(to, return_index=True, return_counts=True)
        place = np.arange(len(to)) - np.repeat(first, count)
        order = np.argsort(count, kind="stable")
        cap, at = links.shape[1], 0
        while at < len(order):  # targets of like numbers of new links together, in blocks of bounded size
            end = at + 1
            while end < len(order) and (end - at + 1) * (cap + count[order[end]]) * dim <= 1 << 22:
                end += 1
            some = order[at:end]
            wide = np.full((len(some), cap + int(count[some].max())), -1, np.int64)
            wide[:, :cap] = links[target[some]]
            slot = np.full(len(target), -1)
            slot[some] = np.arange(len(some))
            mine = np.flatnonzero(slot[np.repeat(np.arange(len(target)), count)] >= 0)
            wide[slot[np.repeat(np.arange(len(target)), count)[mine]], cap + place[mine]] = source[mine]
            sims = np.einsum("rcd,rd->rc", self.unit[wide], self.unit[target[some]])
            sims[wide < 0] = -np.inf
            wide, sims = _descending(wide, sims)
            full = (wide >= 0).sum(axis=1) > cap
            kept = wide[:, :cap].copy()
            if full.any():
                kept[full] = self._spread(wide[full], sims[full], cap)
            links[target[some]] = kept
            at = end

    def _spread(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Of candidates from near to far those nearer to the node than to one another; the nearest of the rest fill up."""
        rows, width = ids.shape
        vectors = self.unit[ids]
        among = vectors @ vectors.transpose(0, 2, 1)
        kept, count, closest = np.zeros((rows, width), bool), np.zeros(rows, int), np.full((rows, width), -np.inf, np.float32)
        for j in range(width):
            ok = (ids[:, j] >= 0) & (count < most) & (closest[:, j] <= sims[:, j])
            kept[:, j] = ok
            count += ok
            closest[ok] = np.maximum(closest[ok], among[ok, j])
        order = np.argsort(np.where(ids < 0, 2 * width, np.where(kept, 0, width)) + np.arange(width), axis=1)[:, :most]
        out = np.full((rows, most), -1, np.int64)
        out[:, : order.shape[1]] = np.take_along_axis(ids, order, 1)
        return out

    def search_layer(self, q: np.ndarray, start: np.ndarray, beam: int, layer: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes near to each query and their nearness, up to `beam`, nearest first; -1 and -inf where there are fewer.

        The queries go side by side: each step expands the WIDE best nodes of every beam that are not yet expanded.
        """
        links, unit, n = self.links[layer], self.unit, len(q)
        seen = np.zeros((n, len(unit)), bool)
        beam = min(beam, len(unit))
        width = max(beam, start.shape[1])
        ids, sims = np.full((n, width), -1, np.int64), np.full((n, width), -np.inf, np.float32)
        ids[:, : start.shape[1]] = start
        row, col = np.nonzero(start >= 0)
        sims[row, col] = np.einsum("rd,rd->r", unit[start[row, col]], q[row])
        seen[row, start[row, col]] = True
        ids, sims = _descending(ids, sims)
        ids, sims = ids[:, :beam].copy(), sims[:, :beam].copy()
        done = ids < 0
        live = np.arange(n)
        while True:
            open_ = np.where(done[live], -np.inf, sims[live])
            pick = _best(open_, min(WIDE, beam))
            good = np.take_along_axis(open_, pick, 1) > -np.inf
            some = good.any(axis=1)
            live, pick, good = live[some], pick[some], good[some]
            if not len(live):
                break
            node = np.where(good, ids[live[:, None], pick], -1)
            done[live[:, None], pick] |= good
            new = np.where(node[:, :, None] >= 0, links[node], -1).reshape(len(live), -1)
            new.sort(axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            fresh = (new >= 0) & ~seen[live[:, None], new]
            most = int(fresh.sum(axis=1).max())
            if not most:
                continue
            order = np.argsort(~fresh, axis=1, kind="stable")[:, :most]
            new, fresh = np.take_along_axis(new, order, 1), np.take_along_axis(fresh, order, 1)
            row, col = np.nonzero(fresh)
            seen[live[row], new[row, col]] = True
            near = np.full(new.shape, -np.inf, np.float32)
            near[row, col] = np.einsum("rd,rd->r", unit[new[row, col]], q[live[row]])
            every = np.concatenate([sims[live], near], axis=1)
            top = _best(every, beam)
            sims[live] = np.take_along_axis(every, top, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], new], axis=1), top, 1)
            done[live] = np.take_along_axis(np.concatenate([done[live], ~fresh], axis=1), top, 1)
        return _descending(ids, sims)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes near to each of some queries, and their nearness, nearest first."""
        near = np.full((len(q), 1), self.entry)
        for layer in range(len(self.links) - 1, 0, -1):
            near, _ = self.search_layer(q, near, 1, layer)
        return self.search_layer(q, near, beam, 0)


def range_search(graph: SmallWorld, queries: np.ndarray, least: float) -> tuple[list[np.ndarray], float, int]:
    """Of each unit query, the nodes of inner product `least` or more; the audited recall, and the beam that reached it."""
    slack, beam, n = least - 1e-5, FIRST_BEAM, min(NEAREST, len(graph.unit))
    audit = np.arange(0, len(queries), AUDIT_EVERY)
    sims = queries[audit] @ graph.unit.T
    truth = [set(np.flatnonzero(s >= slack).tolist()) for s in sims]
    edge = np.partition(sims, -n, axis=1)[:, -n] - 1e-6
    wanted = sum(map(len, truth))

    def links(which: np.ndarray, beam: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Links, and the nearness of what the beam holds; where that is nothing but links, the whole shard was compared."""
        ids, near = graph.search(queries[which], beam)
        found = [i[s >= slack] for i, s in zip(ids, near, strict=True)]
        if ids.shape[1] < len(graph.unit):
            for k in np.flatnonzero(near[:, -1] >= slack).tolist():
                found[k] = np.flatnonzero(graph.unit @ queries[which[k]] >= slack)
        return found, near

    while True:
        found, near = links(audit, beam)
        linked = sum(len(t & set(f.tolist())) for t, f in zip(truth, found, strict=True))
        close = int((near[:, :n] >= edge[:, None]).sum())
        recall = min(linked / wanted if wanted else 1.0, close / (n * len(truth)) if truth else 1.0)
        if recall >= RECALL:
            rest = np.setdiff1d(np.arange(len(queries)), audit)
            out = dict(zip(audit.tolist(), found, strict=True)) | (dict(zip(rest.tolist(), links(rest, beam)[0], strict=True)) if len(rest) else {})
            return [out[i] for i in range(len(queries))], recall, beam
        if beam >= MOST_BEAM:
            return [np.flatnonzero(graph.unit @ q >= slack) for q in queries], 1.0, len(graph.unit)
        beam *= 2


def _vectors(table: pa.Table) -> np.ndarray:
    return np.asarray(table.column("vector").combine_chunks().flatten(), np.float64).reshape(len(table), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _packed(table: pa.Table, part: str, graph: bytes | None, order: np.ndarray) -> pa.Table:
    """A shard or a block as one row."""
    first = table.slice(0, 1)
    blobs = (table.column("id").to_numpy()[order], table.column("copies").to_numpy()[order], _unit(_vectors(table)[order]))
    out = first.select(["label", "dim", part])
    for name, blob in zip(("ids", "copies", "vectors"), blobs, strict=True):
        out = out.append_column(name, pa.array([blob.tobytes()], pa.binary()))
    return out.append_column("graph", pa.array([graph], pa.binary()))


def _build(table: pa.Table) -> pa.Table:
    order = np.argsort(table.column("id").to_numpy())
    graph = SmallWorld(_unit(_vectors(table)[order]).astype(np.float32))
    return _packed(table, "shard", pickle.dumps((graph.entry, graph.links)), order)


def _block(table: pa.Table) -> pa.Table:
    return _packed(table, "block", None, np.argsort(table.column("id").to_numpy()))


def _match(least: float, shard: pa.Table, asks: pa.Table) -> pa.Table:
    """Blocks of queries, one after another, past the graph of a shard: link counts of the queries, links that join their components, the
    audited recall and whether the whole shard was compared."""
    rows: list[tuple] = []
    for r in shard.to_pylist():  # one row
        ids, copies, unit = (np.frombuffer(r[c], t) for c, t in (("ids", np.int64), ("copies", np.int64), ("vectors", np.float64)))
        unit = unit.reshape(-1, r["dim"])
        graph = SmallWorld.__new__(SmallWorld)
        graph.unit = unit.astype(np.float32)
        graph.entry, graph.links = pickle.loads(r["graph"])
        for ask_ids, ask_vectors in zip(asks.column("ask_ids"), asks.column("ask_vectors"), strict=True):
            own, block = np.frombuffer(ask_ids.as_py(), np.int64), np.frombuffer(ask_vectors.as_py(), np.float64).reshape(-1, r["dim"])
            found, recall, beam = range_search(graph, block.astype(np.float32), least)
            groups, exact = UnionFind(), beam >= len(unit)
            for q, u, near in zip(own.tolist(), block, found, strict=True):
                near = near[(ids[near] != q) & (unit[near] @ u >= least)]
                rows.append((q, int(copies[near].sum()), None, recall, exact))
                rows += [(q, 0, k, recall, exact) for k in ids[near].tolist() if groups.union(q, k)]
    columns = zip(*rows, strict=True) if rows else ((), (), (), (), ())
    kinds = (("a", pa.int64()), ("n", pa.int64()), ("b", pa.int64()), ("recall", pa.float64()), ("exact", pa.bool_()))
    return pa.table({name: pa.array(c, kind) for (name, kind), c in zip(kinds, columns, strict=True)})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.98, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept, recall, exact) for every row of vectors.

    recall is the least that an audit found for the searches of the row, and exact says that one of them compared a whole shard; both
    are null for rows that aren't searched for.
    Rows link when their labels are equal and not null, their vectors have one length, and their cosine is `least` or more. Vectors
    that are null, empty, zero, or hold nulls or non-finite numbers link with nothing, and so do rows with a null id, whose component and
    kept are null. Repeated rows are rows of their own to n_links; rows that share an
    id but not a vector are one node, whose links are added up. Long vectors are compared whole; an empty
    table stays empty. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.transform(vector_col, lambda x: x.cast("double")).alias("vector"))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))) & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    classes = rows.where("sound").groupBy("label", "vector").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    classes, classes_at = materialize(classes.withColumn("dim", F.size("vector")), "classes")
    sizes = classes.groupBy("label", "dim").agg(F.count("*").alias("n")).select("label", "dim", F.ceil(F.col("n") / shard_rows).cast("int").alias("shards"), F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"))
    dealt = classes.join(sizes, ["label", "dim"])
    key = F.xxhash64(F.col("id"), F.lit(5))
    shard, block = F.pmod(key, "shards"), F.pmod(F.xxhash64(F.col("id"), F.lit(11)), "blocks")
    kind = classes.schema["label"].dataType.simpleString()
    fields = "ids binary, copies binary, vectors binary, graph binary"
    dealt = dealt.select("label", "dim", "id", "copies", "vector", shard.cast("int").alias("shard"), block.cast("int").alias("block"))
    graphs = dealt.groupBy("label", "dim", "shard").applyInArrow(on_group(_build), f"label {kind}, dim int, shard int, {fields}")
    graphs, graphs_at = materialize(graphs, "graphs")
    asks = dealt.groupBy("label", "dim", "block").applyInArrow(on_group(_block), f"label {kind}, dim int, block int, {fields}")
    asks = asks.select("label", "dim", "block", F.col("ids").alias("ask_ids"), F.col("vectors").alias("ask_vectors"))
    asks, asks_at = materialize(asks, "asks")
    # A shard's graph meets up to ASK_BLOCKS blocks of its label in one group, which streams them past it; blocks go to every shard, so that
    # no label is one key.
    parts = sizes.select("label", "dim", "shards", F.ceil(F.col("blocks") / ASK_BLOCKS).cast("int").alias("parts"))
    every = asks.join(parts.select("label", "dim", "shards"), ["label", "dim"]).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    every = every.withColumn("part", F.floor(F.col("block") / ASK_BLOCKS).cast("int")).select("label", "dim", "shard", "part", "ask_ids", "ask_vectors")
    copies = graphs.join(parts.select("label", "dim", "parts"), ["label", "dim"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("label", "dim", "shard", "part", "ids", "copies", "vectors", "graph")
    by = ("label", "dim", "shard", "part")
    found = copies.groupBy(*by).cogroup(every.groupBy(*by)).applyInArrow(on_cogroup(_match, least), "a long, n long, b long, recall double, exact boolean")
    found, found_at = materialize(found, "found")
    groups, groups_at = materialize(connected_components(found.where("b is not null")), "groups")
    missed = F.when(F.min("recall") < RECALL, F.raise_error(F.lit("links of a query were searched below the wanted recall")).cast("long"))
    counts = found.groupBy(F.col("a").alias("id")).agg(F.coalesce(missed, F.sum("n")).alias("others"), F.min("recall").alias("recall"), F.max("exact").alias("exact"))
    named = classes.join(counts, "id", "left").join(groups.withColumnRenamed("node", "id"), "id", "left")
    named, _ = materialize(named.select("label", "vector", "copies", F.coalesce("others", F.lit(0)).alias("others"), F.coalesce("component", "id").alias("component"), "recall", "exact"), "named")
    drop(spark, classes_at, graphs_at, asks_at, found_at, groups_at)
    # A row that isn't sound may share a label and vector with a class: only sound ones are in it.
    out = rows.join(named.withColumn("sound", F.lit(True)), ["label", "vector", "sound"], "left")
    links = F.when(F.col("sound"), F.coalesce(F.col("copies") - 1 + F.col("others"), F.lit(0))).otherwise(0)
    component = F.when(F.col("sound"), F.coalesce("component", "vec_id")).otherwise(F.col("vec_id"))
    return out.select("vec_id", links.cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"), F.when(F.col("sound"), F.col("recall")).alias("recall"), F.when(F.col("sound"), F.col("exact")).alias("exact"))
