"""Exact nearest neighbours in blocks, and graphs made of them."""

from __future__ import annotations

from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.vectors import kept_neighbours, search_width
from tidemark.operators.components import connected_components, least_labels
from tidemark.storage import cut

if TYPE_CHECKING:
    from tidemark.operators.cells import Cells

BLOCK_ROWS = 4096
#: Rows of a block that is as large as a task should hold, numbers of its vectors and finds; blocks that larger tables have at least, for tasks.
MOST_ROWS, BLOCK_NUMBERS, BLOCK_FINDS, LEAST_BLOCKS = 1 << 14, 1 << 20, 1 << 23, 6
#: Up to so many edges of forests, 16 bytes each, components are found by one task.
ONE_TASK_EDGES = 1 << 21


def top(left: np.ndarray, left_ids: np.ndarray, right: np.ndarray, right_ids: np.ndarray, k: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(src, dst, sim): of each row on the left, of unit length as those on the right, the k most similar ones of another id at `least` or more; of
    equals the least id."""
    src, dst, sim = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    order = np.argsort(right_ids, kind="stable")
    rough, slack = right.astype(np.float32), (right.shape[1] + 8) * 2.0**-22  # single precision is off by less, and only leaves out what can't be found
    bad = np.flatnonzero(~np.isfinite(right).all(axis=1))
    step = max(16, min(512, (1 << 21) // max(1, len(right))))
    groups = min(len(right), max(256, 8 * k))
    for start in range(0, len(left) if len(right) else 0, step):
        part, ids = left[start : start + step], left_ids[start : start + step]
        sims = part.astype(np.float32) @ rough.T
        own = np.searchsorted(right_ids, ids, "left", order), np.searchsorted(right_ids, ids, "right", order)
        for i in np.flatnonzero(own[0] < own[1]).tolist():
            sims[i, order[own[0][i] : own[1][i]]] = -np.inf
        sims[:, bad] = -np.inf
        low = np.full((len(part), 1), least, np.float64)
        if k < len(right):  # the k-th of the most similar rows of each group is no more than the k-th of all rows
            wide = len(right) // groups
            best = sims[:, : groups * wide].reshape(len(part), wide, groups).max(axis=1)
            low = np.maximum(low, np.partition(best, -k, axis=1)[:, -k, None])
        i, j = np.divmod(np.flatnonzero(sims >= (low - slack).astype(np.float32)), len(right))
        if len(i) > sims.size // 8:
            found = (part @ right.T)[i, j]
        else:
            found = np.concatenate([np.einsum("ij,ij->i", part[i[x : x + 65536]], right[j[x : x + 65536]]) for x in range(0, len(i), 65536)] or [np.zeros(0)])
        found = np.round(found, 12)
        held = (found >= least) & np.isfinite(sims[i, j])
        i, j, found = i[held], j[held], found[held]
        at = np.lexsort((right_ids[j], -found, i))
        i, j, found = i[at], j[at], found[at]
        keep = np.arange(len(i)) - np.searchsorted(i, np.arange(len(part)))[i] < k
        src.append(ids[i[keep]])
        dst.append(right_ids[j[keep]])
        sim.append(found[keep])
    return np.concatenate(src), np.concatenate(dst), np.concatenate(sim)


def joined(label: np.ndarray, left: np.ndarray, left_at: np.ndarray, right: np.ndarray, right_at: np.ndarray, least: float) -> np.ndarray:
    """Labels, the least place of each place's component, after places are joined whose rows, of unit length, are as similar as `least`. Only pairs that
    aren't joined yet are compared in double precision."""
    rough, slack = right.astype(np.float32), (right.shape[1] + 8) * 2.0**-22 if len(right) else 0
    step = max(16, min(4096, (1 << 21) // max(1, len(right))))
    for start in range(0, len(left) if len(right) else 0, step):
        part, at = left[start : start + step], left_at[start : start + step]
        i, j = np.divmod(np.flatnonzero(part.astype(np.float32) @ rough.T >= np.float32(least - slack)), len(right))
        for x in range(0, len(i), 65536):
            some = slice(x, x + 65536)
            apart = label[at[i[some]]] != label[right_at[j[some]]]
            a, b = i[some][apart], j[some][apart]
            near = np.round(np.einsum("ij,ij->i", part[a], right[b]), 12) >= least
            if near.any():
                label = least_labels(len(label), label[at[a[near]]], label[right_at[b[near]]])[label]
    return label


def unit_rows(column: pa.ChunkedArray) -> np.ndarray:
    rows = np.asarray(column.combine_chunks().flatten(), np.float64).reshape(len(column), -1)
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-12)


def _top(k: int, least: float, table: pa.Table) -> pa.Table:
    """top of the rows of side 0 among those of side 1."""
    side, ids, rows = table.column("side").to_numpy(), table.column("id").to_numpy(), unit_rows(table.column("v"))
    src, dst, sim = top(rows[side == 0], ids[side == 0], rows[side == 1], ids[side == 1], k, least)
    return pa.table({"src": pa.array(src), "dst": pa.array(dst), "sim": pa.array(sim)})


def blocks(block_rows: int | None, k: int) -> Column:
    """How many blocks the rows of a group make. Every row is copied to each block of the other side, so they are as large as a task can hold."""
    n = F.count("*")
    if block_rows:
        return F.ceil(n / block_rows).cast("int")
    wide = F.greatest(F.lit(BLOCK_ROWS), F.least(F.lit(min(MOST_ROWS, BLOCK_FINDS // k)), F.floor(F.lit(BLOCK_NUMBERS) / F.max(F.size("v")))))
    return F.greatest(F.ceil(n / wide), F.least(F.ceil(n / BLOCK_ROWS), F.lit(LEAST_BLOCKS))).cast("int")


def first_finds(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k most similar of several finds (src, dst, sim) for each src; of equals the least dst."""
    src, dst, sim = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((dst, -sim, src))
    src, dst, sim = src[order], dst[order], sim[order]
    keep = np.arange(len(src)) - np.searchsorted(src, src) < k
    return src[keep], dst[keep], sim[keep]


def ranked(found: DataFrame, k: int) -> DataFrame:
    """(src, dst, sim, rank): the k most similar of all finds for each src."""
    rank = F.row_number().over(Window.partitionBy("src").orderBy(F.desc("sim"), "dst"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def meet(queries: DataFrame, base: DataFrame, k: int, least: float = -2.0, block_rows: int | None = None, by: str | None = None) -> DataFrame:
    """(src, dst, sim, rank): the k most similar rows of base for each row of queries, both (id, v); with `by`, of rows equal in it.

    Both sides are dealt to blocks of bounded size and each two blocks meet in one task, so no task or broadcast holds all vectors. With
    `by` the blocks are counted for each of its values, so small groups are not copied and large ones are split. A row of queries
    may come in several groups, whose finds are ranked together; each block pair gives k rows for each of its rows.
    """
    keys = [by] if by else []
    rows = [x.where("v is not null and size(v) > 0").select(F.col("id").cast("long").alias("id"), "v", *keys) for x in (queries, base)]
    if by:
        parts = [x.groupBy(by).agg(blocks(block_rows, k).alias(name)) for x, name in zip(rows, ("left", "right"), strict=True)]
        sizes, _ = cut(parts[0].join(parts[1], by), "sizes")  # so the planner knows how small it is, and rows of a group aren't brought together
        rows = [x.join(sizes, by) for x in rows]
    else:
        counts = [max(1, x.agg(blocks(block_rows, k)).first()[0] or 0) for x in rows]
        rows = [x.withColumns({"left": F.lit(counts[0]), "right": F.lit(counts[1])}) for x in rows]
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows[0].select("id", "v", *keys, F.lit(0).alias("side"), block("left").alias("i"), every("right").alias("j"))
    right = rows[1].select("id", "v", *keys, F.lit(1).alias("side"), block("right").alias("j"), every("left").alias("i")).select(left.columns)

    def found_in(table: pa.Table) -> pa.Table:
        return _top(k, least, table)

    both = left.unionByName(right).repartition("i", "j", *keys)  # else rows joined by a key stay together, all blocks of it in one task
    return ranked(both.groupBy("i", "j", *keys).applyInArrow(found_in, "src long, dst long, sim double"), k)


def nearest(vectors: DataFrame, k: int, least: float = -2.0, block_rows: int | None = None, by: str | None = None, index: Cells | None = None) -> DataFrame:
    """(src, dst, sim, rank): the k most similar of all rows for each row of (id, v), by exact cosine; with `by`, of rows equal in it.

    With an index (cells.fit) a row meets the rows of the cells it visits alone, and finds what the index's audit promises.
    """
    if index is not None:
        from tidemark.operators.cells import search

        return search(index, k, least, block_rows=block_rows)
    return meet(vectors, vectors, k, least, block_rows, by)


def pairs_above(vectors: DataFrame, least: float, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b, sim), a < b: every pair of rows at `least` or more, without ranks, so a block's result is what reaches the threshold.

    Blocks of one row order meet once: of two blocks only one is the left of the other.
    """
    rows = vectors.where("v is not null and size(v) > 0").select(F.col("id").cast("long").alias("id"), "v")
    blocks = max(1, -(-rows.count() // block_rows))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    left = rows.select("id", "v", F.lit(0).alias("side"), block.alias("i"), F.explode(F.sequence(block, F.lit(blocks - 1))).alias("j"))
    right = rows.select("id", "v", F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), block)).alias("i"), block.alias("j"))

    def above(table: pa.Table) -> pa.Table:
        found = _top(max(1, len(table)), least, table)
        src, dst = found.column("src").to_numpy(), found.column("dst").to_numpy()
        if found.num_rows and pc.min_max(table.column("i"))["min"].as_py() == pc.min_max(table.column("j"))["min"].as_py():
            found = found.filter(pa.array(src < dst))  # a block with itself finds each pair from both sides
            src, dst = found.column("src").to_numpy(), found.column("dst").to_numpy()
        return pa.table({"a": np.minimum(src, dst), "b": np.maximum(src, dst), "sim": found.column("sim")})

    return left.unionByName(right).groupBy("i", "j").applyInArrow(above, "a long, b long, sim double")


def symmetric(edges: DataFrame) -> DataFrame:
    """(a, b, sim) once for each pair: the larger of both directions, where a direction that is missing counts as 0."""
    pair = edges.groupBy(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(F.count("*").alias("n"), F.max("sim").alias("sim"))
    return pair.where("sim > 0 or (n = 2 and sim <> 0)").select("a", "b", "sim")


def with_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, cluster): the least id of each node's component; nodes without links are their own."""
    found = connected_components(edges, one_task=ONE_TASK_EDGES)
    return nodes.select("id").join(found.withColumnRenamed("node", "id").hint("merge"), "id", "left").select("id", F.coalesce("component", "id").alias("cluster"))


def knn_graph(vectors: DataFrame, k: int, drop_frac: float = 0.9, index: Cells | None = None) -> DataFrame:
    return symmetric(nearest(vectors, kept_neighbours(k, drop_frac), index=index))


def dbscan(vectors: DataFrame, eps: float = 0.7, min_samples: int = 5, min_cluster_size: int = 1, width: int | None = None, by: str | None = None, index: Cells | None = None) -> DataFrame:
    """(id, cluster, core): density clusters on cosine; noise is left out. With `by`, rows that are equal in it are clustered apart.

    With an index (cells.fit) there is no width: all cells that may hold a neighbour are visited, min_samples neighbours tell what is a core, as other
    rows have fewer, and cores are linked by all their pairs, of which each task keeps a forest.

    A core has min_samples neighbours of similarity eps among its nearest `width`, not counting itself. Cores that are neighbours share
    a cluster; another row with a core neighbour joins that of the most similar. Below two cores there are no clusters.
    """
    if index is not None:
        from tidemark.operators.cells import links, search

        found = search(index, max(1, min_samples), eps, every=True)
    else:
        found = nearest(vectors, width or search_width(vectors.count()), eps, by=by)
    dense = F.count("*").over(Window.partitionBy("src")) >= min_samples  # as rows of a source are together when they are ranked
    near, _ = cut(found.select("src", "dst", "sim", "rank", dense.alias("core")), "near")
    cores = near.where("core and rank = 1").select(F.col("src").alias("id"))
    if by:
        cores = cores.join(vectors.select("id", by), "id")
        cores = cores.join(cores.groupBy(by).agg(F.count("*").alias("n")).where("n > 1"), by, "left_semi").select("id")
    if cores.limit(2).count() < 2:
        return vectors.sparkSession.createDataFrame([], "id long, cluster long, core boolean")
    to_core = near.join(cores.withColumnRenamed("id", "dst"), "dst", "left_semi")
    inner = to_core.where("core").select(F.col("src").alias("a"), F.col("dst").alias("b")) if index is None else links(index, cores, eps).toDF("a", "b")
    named = with_components(cores, inner)
    outer = to_core.where("not core").join(named.withColumnRenamed("id", "dst"), "dst")
    border = outer.groupBy("src").agg(F.max_by("cluster", F.struct("sim", -F.col("dst"))).alias("cluster"))
    both = named.withColumn("core", F.lit(True)).unionByName(border.select(F.col("src").alias("id"), "cluster", F.lit(False).alias("core")))
    large = both.groupBy("cluster").agg(F.count("*").alias("n")).where(F.col("n") >= min_cluster_size).select("cluster")
    return both.join(large, "cluster", "left_semi").select("id", "cluster", "core")
