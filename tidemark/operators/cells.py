"""An inverted file over vectors: cells around centres, of which a search visits the nearest few.

Centres are fitted on a bounded sample; every vector is in the cell of its most similar centre. How many cells a search has to visit is
measured, not assumed: queries of an audit are compared with all rows, and the cells that hold their true neighbours tell the recall of
every number of visits at once. With as many cells as the root of the rows, a search compares about probes * rows ** 1.5 pairs, and moves
no more than exact blocks do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from tidemark.functions.vectors import unit
from tidemark.operators import neighbours
from tidemark.storage import cut

#: Rows that centres are fitted on, and rows that an audit compares with all: those of least digest.
SAMPLE_ROWS, AUDIT_ROWS = 1 << 16, 1000


@dataclass
class Cells:
    """A fitted index of a table's vectors: centres, cells to visit, and what the audit found with so many."""

    rows: DataFrame
    centres: np.ndarray
    probes: int
    recall: float
    audited: int


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-12)


def _matrix(column: pa.Array) -> np.ndarray:
    return _unit(np.asarray(column.flatten(), np.float64).reshape(len(column), -1))


def _order(v: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The n most similar centres of each vector, the most similar first."""
    out = []
    for start in range(0, len(v), 4096):
        sims = v[start : start + 4096] @ centres.T
        out.append(np.argsort(-sims, axis=1, kind="stable")[:, :n] if n > 1 else sims.argmax(axis=1)[:, None])
    return np.concatenate(out) if out else np.zeros((0, n), np.int64)


def visited(rows: DataFrame, centres: np.ndarray, n: int) -> DataFrame:
    """The rows of (id, v, ...) with `cells`, their n most similar centres."""
    shipped = rows.sparkSession.sparkContext.broadcast(centres)  # at most a sixteenth of the sample's rows

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _order(_matrix(batch.column("v")), shipped.value, n) if len(batch) else np.zeros((0, n), np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, n), pa.int32()), pa.array(found.ravel(), pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "cells"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(work, f"{fields}, cells array<int>")


def _split(centres: np.ndarray, sample: np.ndarray, most: int, rounds: int = 8) -> np.ndarray:
    """Centres, those whose cell has over `most` sampled rows replaced by spread rows of the cell, unless its rows are all alike."""
    done: set[bytes] = set()
    for _ in range(rounds):
        at = _order(sample, centres, 1)[:, 0]
        size = np.bincount(at, minlength=len(centres))
        large = [c for c in np.flatnonzero(size > most).tolist() if centres[c].tobytes() not in done]
        if not large:
            break
        kept = [np.delete(centres, large, axis=0)]
        for c in large:
            rows = np.unique(sample[at == c], axis=0)
            spread = rows[np.linspace(0, len(rows) - 1, min(len(rows), -(-int(size[c]) // most) * 2)).astype(int)]
            done |= {x.tobytes() for x in spread} if len(rows) == 1 else set()
            kept.append(spread)
        centres = np.concatenate(kept)
    return centres


def fit(vectors: DataFrame, k: int, least: float = -2.0, cells: int | None = None, recall: float = 0.95, seed: int = 42) -> Cells:
    """An index whose searches for the k nearest at `least` or more find at least `recall` of the audit's neighbours.

    Null and empty vectors are left out. Cells are as many as the root of the rows, at most one for 16 rows of the sample; those that hold much more
    than their part of the sample are split. The audit takes ids divisible by 100, or where these are few any ids, up to AUDIT_ROWS; on a
    table of no more rows than that the recall is that of the whole search.
    """
    rows, _ = cut(vectors.where("v is not null and size(v) > 0").select(F.col("id").cast("long").alias("id"), "v"), "vectors")
    n = rows.count()
    if not n:
        return Cells(rows.withColumn("cell", F.lit(0)), np.zeros((1, 1)), 1, 1.0, 0)
    digest = F.xxhash64("id", F.lit(seed))
    sample = rows.orderBy(digest).limit(SAMPLE_ROWS).select("id", unit(F.col("v")).alias("v")) if n > SAMPLE_ROWS else rows.select("id", unit(F.col("v")).alias("v"))
    sample, _ = cut(sample, "sample")
    count = cells or max(1, min(math.ceil(math.sqrt(n)), min(n, SAMPLE_ROWS) // 16))
    model = KMeans(k=count, seed=seed, maxIter=10, initMode="random").fit(sample.withColumn("features", array_to_vector(F.col("v")))) if count > 1 else None
    drawn = np.stack(sample.orderBy("id").toPandas()["v"])  # the bounded sample
    centres = _unit(np.stack(model.clusterCenters())) if model else drawn[:1]
    centres = _split(centres, drawn, max(16, 8 * len(drawn) // len(centres)))
    placed, _ = cut(visited(rows, centres, 1).select("id", "v", F.col("cells")[0].alias("cell")), "cells")

    first = F.when(F.col("id") % 100 == 0, 0).otherwise(1)
    few = rows.where("id % 100 = 0").limit(AUDIT_ROWS).count() < AUDIT_ROWS
    audit = (rows if few else rows.where("id % 100 = 0")).orderBy(first, digest).limit(AUDIT_ROWS)
    true = neighbours.meet(audit, rows, k, least).select("src", "dst")
    asked = visited(audit, centres, len(centres)).select(F.col("id").alias("src"), "cells")
    at = true.join(placed.select(F.col("id").alias("dst"), "cell"), "dst").join(asked, "src").select(F.array_position("cells", F.col("cell")).alias("at"))
    places = {r["at"]: r["count"] for r in at.groupBy("at").count().collect()}  # one row for each cell
    total, seen, probes = sum(places.values()), 0, 0
    while probes < len(centres) and (not total or seen < recall * total):
        probes += 1
        seen += places.get(probes, 0)
        if not total:
            break
    return Cells(placed, centres, max(1, probes), seen / total if total else 1.0, total)


def reach(index: Cells, least: float) -> np.ndarray:
    """For each cell the angle between its centre and a vector beyond which none of its rows can be as similar to that as `least`; -1 without rows."""
    shipped = index.rows.sparkSession.sparkContext.broadcast(index.centres)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, cell = _matrix(batch.column("v")), batch.column("cell").to_numpy()
            angle = np.where(v.any(axis=1), np.arccos(np.clip((v * shipped.value[cell]).sum(axis=1), -1, 1)), np.pi)
            far = np.full(len(shipped.value), -1.0)
            np.fmax.at(far, cell, angle)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(cell), pa.int32()), pa.array(far[np.unique(cell)])], ["cell", "far"])

    found = index.rows.select("v", "cell").mapInArrow(work, "cell int, far double").groupBy("cell").agg(F.max("far").alias("far")).collect()  # one row for each cell
    out = np.full(len(index.centres), -1.0)
    for r in found:
        out[r["cell"]] = r["far"] + math.acos(max(-1.0, min(1.0, least))) + 1e-6 if r["far"] >= 0 else -1.0
    return out


def _deal(rows: DataFrame, centres: np.ndarray, n: int, slots: np.ndarray, within: np.ndarray | None = None) -> DataFrame:
    """(id, v, part, cells): each row of (id, v) once for each part that holds any of its n most similar cells, with those of them that are there; or of
    all cells whose centres are within those angles.

    Slots are the pairs (part, cell), in order, of parts that hold rows of a cell."""
    shipped = rows.sparkSession.sparkContext.broadcast((centres, slots, within))  # a slot for each cell and one for each part at most

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, slots, within = shipped.value
        step = max(1, (1 << 20) // len(centres))
        for batch in batches:
            for start in range(0, len(batch) if len(slots) else 0, step):
                some = batch.slice(start, step)
                v = _matrix(some.column("v"))
                if within is None:
                    visits = np.zeros((len(some), len(centres)), bool)
                    np.put_along_axis(visits, _order(v, centres, n), True, axis=1)
                else:
                    visits = np.arccos(np.clip(v @ centres.T, -1, 1)) <= within
                    visits[~v.any(axis=1)] = within >= 0
                row, slot = np.nonzero(visits[:, slots[:, 1]])
                part = slots[slot, 0]
                new = np.flatnonzero(np.diff(row, prepend=-1) | np.diff(part, prepend=-1))
                held = pa.ListArray.from_arrays(pa.array(np.append(new, len(row)), pa.int32()), pa.array(slots[slot, 1], pa.int32()))
                parts = pa.StructArray.from_arrays([pa.array(part[new], pa.int32()), held], ["part", "cells"])
                found = pa.ListArray.from_arrays(pa.array(np.searchsorted(row[new], np.arange(len(some) + 1)), pa.int32()), parts)
                yield pa.RecordBatch.from_arrays([some.column("id"), some.column("v"), found], ["id", "v", "at"])

    kind = rows.schema["v"].dataType.simpleString()
    dealt = rows.select("id", "v").mapInArrow(work, f"id long, v {kind}, at array<struct<part: int, cells: array<int>>>")
    return dealt.select("id", "v", F.explode("at").alias("at")).select("id", "v", "at.part", "at.cells")


def _top(k: int, least: float, table: pa.Table) -> pa.Table:
    """The k most similar rows of side 1 for each row of side 0, among those in cells that it visits."""
    side, ids, rows = table.column("side").to_numpy(), table.column("id").to_numpy(), neighbours.unit_rows(table.column("v"))
    lists = table.column("cells").combine_chunks()
    at, cell = np.repeat(np.arange(len(table)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
    order = np.argsort(cell, kind="stable")
    found, held = [], 0
    for one in np.split(at[order], np.flatnonzero(np.diff(cell[order])) + 1):
        left, right = one[side[one] == 0], one[side[one] == 1]
        found.append(neighbours.top(rows[left], ids[left], rows[right], ids[right], k, least))
        held += len(found[-1][0])
        if held > neighbours.BLOCK_FINDS:
            found = [neighbours.first_finds(found, k)]
            held = len(found[0][0])
    src, dst, sim = neighbours.first_finds(found, k)
    return pa.table({"src": pa.array(src), "dst": pa.array(dst), "sim": pa.array(sim)})


def _links(least: float, table: pa.Table) -> pa.Table:
    """(u, v): the components of all pairs at `least` or more of rows of side 0 and rows of side 1 in cells they visit, as stars."""
    side, rows = table.column("side").to_numpy(), neighbours.unit_rows(table.column("v"))
    nodes, node = np.unique(table.column("id").to_numpy(), return_inverse=True)
    lists = table.column("cells").combine_chunks()
    at, cell = np.repeat(np.arange(len(table)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
    order = np.argsort(cell, kind="stable")
    label = np.arange(len(nodes))
    for one in np.split(at[order], np.flatnonzero(np.diff(cell[order])) + 1):
        left, right = one[side[one] == 0], one[side[one] == 1]
        label = neighbours.joined(label, rows[left], node[left], rows[right], node[right], least)
    leaf = label != np.arange(len(nodes))
    return pa.table({"u": nodes[leaf], "v": nodes[label[leaf]]})


def search(index: Cells, k: int, least: float = -2.0, queries: DataFrame | None = None, block_rows: int | None = None, every: bool = False) -> DataFrame:
    """(src, dst, sim, rank) of the queries, all rows unless said, among the rows of the cells they visit; with `every` these are all cells that may
    hold a row at `least` or more, so that none is lost.

    Cells are laid out one after another and cut into parts as large as blocks of an exact search. A query goes once to each part that it
    visits any cell of, and a part to each block of its queries, so that however many cells are visited, rows aren't copied more often than
    exact blocks copy them."""

    def found_in(table: pa.Table) -> pa.Table:
        return _top(k, least, table)

    met = _meet(index, queries if queries is not None else index.rows, k, block_rows, reach(index, least) if every else None)
    return neighbours.ranked(met.applyInArrow(found_in, "src long, dst long, sim double"), k)


def links(index: Cells, ids: DataFrame, least: float, block_rows: int | None = None) -> DataFrame:
    """(u, v): links that join the rows of `ids` (id) which are joined by pairs at `least` or more; of each two parts of rows no more than it has rows,
    however many pairs there are."""
    held, _ = cut(index.rows.join(ids, "id", "left_semi"), "held")
    some = Cells(held, index.centres, index.probes, index.recall, index.audited)

    def found_in(table: pa.Table) -> pa.Table:
        return _links(least, table)

    return _meet(some, held, 1, block_rows, reach(some, least)).applyInArrow(found_in, "u long, v long")


def _meet(index: Cells, queries: DataFrame, k: int, block_rows: int | None, within: np.ndarray | None) -> GroupedData:
    """Queries (side 0) and rows of parts of cells (side 1) in groups that a task holds."""
    asked = queries.where("v is not null and size(v) > 0").select(F.col("id").cast("long").alias("id"), "v")
    counted = neighbours.blocks(block_rows, k).alias("blocks"), F.count("*").alias("n")
    wide, long = (max(1, -(-r.n // max(1, r.blocks or 0))) for r in (x.agg(*counted).first() for x in (asked, index.rows)))
    sizes = sorted((r["cell"], r["count"]) for r in index.rows.groupBy("cell").count().collect())  # one row for each cell
    cell, size = np.array(sizes, np.int64).reshape(-1, 2).T
    start = np.cumsum(size) - size
    slots = np.array(sorted((p, c) for c, a, n in zip(cell.tolist(), start.tolist(), size.tolist(), strict=True) for p in range(a // long, (a + n - 1) // long + 1)), np.int64).reshape(-1, 2)
    spans = asked.sparkSession.createDataFrame(list(zip(cell.tolist(), start.tolist(), size.tolist(), strict=True)), "cell int, start long, n long")
    dealt = _deal(asked, index.centres, index.probes, slots, within)
    visits, _ = cut(dealt.groupBy("part").agg(F.ceil(F.count("*") / wide).cast("int").alias("left")), "visits")  # one row for each part
    place = F.col("start") + F.pmod(F.xxhash64("id"), F.col("n"))
    base = index.rows.join(F.broadcast(spans), "cell").select("id", "v", F.floor(place / long).cast("int").alias("part"), F.array("cell").alias("cells"))
    left = dealt.join(F.broadcast(visits), "part").select("id", "v", "part", "cells", F.lit(0).alias("side"), F.pmod(F.xxhash64("id"), F.col("left")).cast("int").alias("i"))
    right = base.join(F.broadcast(visits), "part").select("id", "v", "part", "cells", F.lit(1).alias("side"), F.explode(F.sequence(F.lit(0), F.col("left") - 1)).alias("i"))
    return left.unionByName(right).groupBy("i", "part")


def compared(index: Cells, queries: DataFrame | None = None) -> DataFrame:
    """One row: how many pairs a search compares."""
    asked = visited(queries if queries is not None else index.rows.select("id", "v"), index.centres, index.probes)
    visits = asked.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count("*").alias("q"))
    return visits.join(index.rows.groupBy("cell").agg(F.count("*").alias("b")), "cell").agg(F.coalesce(F.sum(F.col("q") * F.col("b")), F.lit(0)).alias("compared"))
