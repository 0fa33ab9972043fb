"""States of long sequences, which no task holds: chunks are combined as matrices of costs.

What a chunk of gaps adds to the cost of being in state q behind it, if one was in p before it, is a matrix; matrices combine by sums and minima. So
all chunks are costed side by side, a scan over a key's matrices gives the true cost of every state before each chunk, all chunks go
forward again from there with their best predecessors, and a scan back gives each chunk's last state, from which it walks back alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.storage import cut

#: Chunks that go side by side in a task.
ABREAST = 64


def _ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lists as rows of one array, filled up with zeros, and their lengths."""
    at = np.asarray(column.offsets)
    lens, flat = np.diff(at), np.asarray(column.flatten(), np.float64)
    out = np.zeros((len(lens), int(lens.max(initial=0))))
    out[np.arange(out.shape[1]) < lens[:, None]] = flat
    return out, lens


def _forward(gaps: np.ndarray, lens: np.ndarray, starts: np.ndarray, base: np.ndarray, cost: np.ndarray, s: float, gamma: float, keep: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Costs behind each row's gaps, from `cost` before them; where `starts` says that nothing is before, the first gap costs no rise.

    With keep also the best predecessors, by gap, row and state; of equal costs the lowest."""
    states = cost.shape[1]
    rate = base[:, None] * s ** np.arange(states)
    log, rise = np.log(rate), gamma * np.maximum(np.arange(states)[:, None] - np.arange(states)[None], 0)
    back = np.zeros((gaps.shape[1], len(gaps), states), np.int8) if keep else None
    for i in range(gaps.shape[1]):
        way = cost[:, None, :] + rise
        best = way.argmin(axis=2)
        least = np.take_along_axis(way, best[..., None], 2)[..., 0]
        if i == 0:
            least = np.where(starts[:, None], 0.0, least)
        live = (i < lens)[:, None]
        cost = np.where(live, least - log + rate * gaps[:, i, None], cost)
        if back is not None:
            back[i] = np.where(live, best, np.arange(states))
    return cost, back


def _walk(back: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States at each gap, by gap and row, and the state before the first, from those at the end; a row's steps beyond its length stand still."""
    out = np.zeros(back.shape[:2], np.int8)
    rows = np.arange(back.shape[1])
    for i in range(len(back) - 1, -1, -1):
        out[i] = last
        last = back[i, rows, last]
    return out, last


def _each(rows: DataFrame, f: Callable[[pa.RecordBatch], list[pa.Array]], fields: str, carry: tuple[str, ...]) -> DataFrame:
    """f's columns beside the carried ones, for a few rows at a time."""
    names = [x.split()[0] for x in fields.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, len(batch), ABREAST):
                some = batch.slice(i, ABREAST)
                yield pa.RecordBatch.from_arrays([*[some.column(c) for c in carry], *f(some)], [*carry, *names])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(work, f"{kinds}, {fields}")


def _lists(x: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel(), kind))


def chunks(events: DataFrame, long: DataFrame, key: str, time_us: str, chunk: int) -> DataFrame:
    """(key, part, at, n, gaps, base) of the events of long keys, dealt by key and time; a part's first gap reaches back to the part before."""
    same = events.join(long.select(F.col(key).alias("_k"), "n"), F.col(key).eqNullSafe(F.col("_k")))
    total = long.agg(F.sum("n")).first()[0]
    dealt, _ = cut(same.select(key, "n", F.col(time_us).alias("t")).repartitionByRange(-(-total // chunk), key, "t").withColumn("part", F.spark_partition_id()), "dealt")
    rows = dealt.groupBy(key, "part").agg(F.max("n").alias("n"), F.array_sort(F.collect_list("t")).alias("t"))
    by_key = Window.partitionBy(key).orderBy("part")
    before = F.lag(F.element_at("t", -1)).over(by_key)
    whole = F.when(before.isNull(), F.col("t")).otherwise(F.concat(F.array(before), F.col("t")))
    rows = rows.withColumn("t", whole)
    gaps = F.zip_with(F.slice("t", 2, F.size("t")), F.slice("t", 1, F.size("t") - 1), lambda b, a: F.greatest((b - a) / 1e6, F.lit(0.0)))
    rows = rows.select(key, "part", "n", gaps.alias("gaps")).where("size(gaps) > 0")
    sums = F.aggregate("gaps", F.lit(0.0), lambda x, g: x + g)
    rows = rows.withColumns({"at": F.coalesce(F.sum(F.size("gaps")).over(by_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "span": F.sum(sums).over(Window.partitionBy(key))})
    base = F.when(F.col("span") > 0, (F.col("n") - 1) / F.col("span")).otherwise(1.0)
    return cut(rows.select(key, "part", "at", "n", "gaps", base.alias("base")), "chunks")[0]


def long_states(events: DataFrame, long: DataFrame, key: str, time_us: str, s: float, gamma: float, states: int, chunk: int) -> DataFrame:
    """(key, part, at, n, gaps, states) of the keys in long (key, n); costs are equal to those of one pass but for rounding."""
    rows = chunks(events, long, key, time_us, chunk)
    kind = rows.schema[key].dataType.simpleString()
    first = lambda batch: batch.column("at").to_numpy(zero_copy_only=False) == 0

    def matrix(batch: pa.RecordBatch) -> list[pa.Array]:
        gaps, lens = _ragged(batch.column("gaps"))
        each = lambda x: np.repeat(x, states, axis=0)
        only = np.where(np.tile(np.eye(states, dtype=bool), (len(gaps), 1)), 0.0, np.inf)
        cost, _ = _forward(each(gaps), each(lens), each(first(batch)), each(batch.column("base").to_numpy()), only, s, gamma)
        return [_lists(cost.reshape(len(gaps), -1), pa.float64())]

    def entries(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        cost, out = np.zeros(states), []
        for m in table.column("matrix"):
            out.append(cost)
            cost = (cost[:, None] + np.asarray(m.values).reshape(states, states)).min(axis=0)
        return table.select([key, "part"]).append_column("entry", pa.array([x.tolist() for x in out], pa.list_(pa.float64())))

    def forward(batch: pa.RecordBatch) -> list[pa.Array]:
        gaps, lens = _ragged(batch.column("gaps"))
        entry, _ = _ragged(batch.column("entry"))
        cost, back = _forward(gaps, lens, first(batch), batch.column("base").to_numpy(), entry, s, gamma, keep=True)
        before = np.stack([_walk(back, np.full(len(gaps), q))[1] for q in range(states)], axis=1)
        steps = [back[:n, i].tobytes() for i, n in enumerate(lens.tolist())]
        return [_lists(before, pa.int32()), pa.array(cost.argmin(axis=1), pa.int32()), pa.array(steps, pa.binary())]

    def exits(table: pa.Table) -> pa.Table:
        table = table.sort_by([("part", "descending")])
        last, out = None, []
        for cheapest, before in zip(table.column("cheapest").to_pylist(), table.column("before").to_pylist(), strict=True):
            out.append(cheapest if last is None else last)
            last = before[out[-1]]
        return table.select([key, "part"]).append_column("last", pa.array(out, pa.int32()))

    def trace(batch: pa.RecordBatch) -> list[pa.Array]:
        found = []
        for steps, last in zip(batch.column("steps").to_pylist(), batch.column("last").to_pylist(), strict=True):
            back = np.frombuffer(steps, np.int8).reshape(-1, 1, states)
            found.append(_walk(back, np.array([last]))[0][:, 0].tolist())
        return [pa.array(found, pa.list_(pa.int32()))]

    # A key's matrices, one for each of its chunks, are what one task sees of it.
    matrices = _each(rows.select(key, "part", "at", "gaps", "base"), matrix, "matrix array<double>", (key, "part"))
    entry = matrices.groupBy(key).applyInArrow(entries, f"`{key}` {kind}, part int, entry array<double>")
    same = lambda a, b: a[key].eqNullSafe(b[key]) & (a["part"] == b["part"])
    with_entry = rows.join(entry, same(rows, entry)).select(rows[key], rows["part"], "at", "n", "gaps", "base", "entry")
    stepped, _ = cut(_each(with_entry, forward, "before array<int>, cheapest int, steps binary", (key, "part", "at", "n", "gaps")), "steps")
    ends = stepped.select(key, "part", "cheapest", "before").groupBy(key).applyInArrow(exits, f"`{key}` {kind}, part int, last int")
    with_last = stepped.join(ends, same(stepped, ends)).select(stepped[key], stepped["part"], "at", "n", "gaps", "steps", "last")
    return _each(with_last, trace, "states array<int>", (key, "part", "at", "n", "gaps"))
