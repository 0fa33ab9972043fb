"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.storage import cut, remove

#: Edges, 16 bytes each, that a task holds while it reduces a partition's to a forest.
FOREST_EDGES = 1 << 20


class UnionFind:
    """Disjoint sets over any hashable nodes; a set's root is its smallest node."""

    def __init__(self) -> None:
        self.parent: dict = {}

    def find(self, x):
        parent, root = self.parent, x
        while (up := parent.get(root, root)) != root:
            root = up
        while (up := parent.get(x, x)) != root:
            parent[x] = root
            x = up
        return root

    def union(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        if b < a:
            a, b = b, a
        self.parent[b] = a
        self.parent.setdefault(a, a)
        return True


def least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node that each of the nodes 0 to n - 1 reaches by links a, b: roots that are linked join the least, until none are."""
    label = np.arange(n)
    while True:
        x, y = label[a], label[b]
        if not (live := x != y).any():
            return label
        a, b, x, y = a[live], b[live], x[live], y[live]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label != (up := label[label])).any():
            label = up


def _stars(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """All edges as stars of their components: as many rows as nodes, not as links."""
    ends = [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in batches] or [np.zeros(0, np.int64)]) for i in (0, 1)]
    nodes, at = np.unique(np.concatenate(ends), return_inverse=True)
    root = nodes[least_labels(len(nodes), at[: len(ends[0])], at[len(ends[0]) :])]
    leaf = root != nodes
    return pa.RecordBatch.from_arrays([pa.array(nodes[leaf]), pa.array(root[leaf])], ["u", "v"])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's edges as stars of components, of up to FOREST_EDGES edges at once."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= FOREST_EDGES:
            held = [_stars(held)]
            n = len(held[0])
            if 2 * n > FOREST_EDGES:
                yield held.pop()
                n = 0
    yield _stars(held)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(low.hint("merge"), "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return low.select("u", F.col("m").alias("v")).unionByName(moved).distinct()


def _whole_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield _stars(list(batches))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60, one_task: int = 0) -> DataFrame:
    """(node, component) for every node with a link; component is the smallest node reachable.

    Nulls and self links are ignored; repeated links count once; no links give an empty table.
    Each round is written to the shared folder, so a lost executor costs one round. Up to `one_task` edges, counted after each
    partition's are reduced to a forest, one task finds all at once. Rounds merge their joins, as a row for each node would be broadcast by the driver.
    """
    spark = edges.sparkSession
    edges = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u is not null and v is not null and u <> v")
    now, path = cut(edges.mapInArrow(_forest, "u long, v long"), "links")
    mark = None
    if one_task and now.limit(one_task + 1).count() <= one_task:
        after, new = cut(now.coalesce(1).mapInArrow(_whole_forest, "u long, v long"), "links")
        remove(spark, path)
        return _members(after)
    for _ in range(most_rounds):
        after, new = cut(_small_star(_large_star(now)), "links")
        remove(spark, path)
        now, path = after, new
        row = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (row[0], row[1]) == mark:
            break
        mark = (row[0], row[1])
    else:
        raise RuntimeError("components did not settle")
    return _members(now)


def _members(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
