"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by the set of sources they belong to. Words flow from each such pattern to the quotas of its sources;
the first, second and third use of a pattern's words are arcs of rising cost, so repetition is spread before it is deepened.
The flow fixes how often each pattern is used in whole passes, and seeded document order fixes who is in the last, partial pass.
"""

from __future__ import annotations

import json
from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, drop, local_table, materialize

#: Slices of each pattern's hash range in the search for the last document of a partial pass.
SLICES = 4096
MAX_USES = 3
#: Most patterns whose limits are sent to every task, so that texts need not move.
BROADCAST_ROWS = 20_000


def fill_targets(sizes: dict, weights: dict, most: float = MAX_USES) -> dict:
    """Share the sum of sizes by weight; a target stops at most times its size and its excess is shared by weight again."""
    left, open_, out = float(sum(sizes.values())), sorted(sizes, key=lambda s: (s is None, s or "")), {}
    while open_:
        total = sum(weights[s] for s in open_)
        full = [s for s in open_ if left * weights[s] / total > most * sizes[s]]
        if not full:
            return out | {s: left * weights[s] / total for s in open_}
        out |= {s: float(most * sizes[s]) for s in full}
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in out]
    return out


def min_cost_flow(arcs: list[tuple], start, end) -> tuple[int, dict[int, int]]:
    """Most flow at least cost by successive shortest paths; arcs are (from, to, capacity, cost) with whole capacities."""
    out_of: dict = {}
    room, heads, costs = [], [], []
    for u, v, cap, cost in arcs:
        for a, b, c, w in ((u, v, cap, cost), (v, u, 0, -cost)):
            out_of.setdefault(a, []).append(len(room))
            heads.append(b)
            room.append(c)
            costs.append(w)
    total = 0
    while True:
        best, via, queue, waiting = {start: 0}, {}, deque([start]), {start}
        while queue:
            u = queue.popleft()
            waiting.discard(u)
            for e in out_of.get(u, ()):
                v = heads[e]
                if room[e] > 0 and best[u] + costs[e] < best.get(v, float("inf")):
                    best[v], via[v] = best[u] + costs[e], e
                    if v not in waiting:
                        waiting.add(v)
                        queue.append(v)
        if end not in via:
            return total, {i: room[2 * i + 1] for i in range(len(arcs))}
        path, v = [], end
        while v != start:
            path.append(via[v])
            v = heads[via[v] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push
        total += push


def plan_mix(sizes: dict[tuple, int], weights: dict | None = None, most: int = MAX_USES) -> tuple[dict, dict, dict]:
    """Words to take of each pattern, and the size and target of each source. A pattern is a tuple of sources; None is one.

    Without weights, sources by code point, None last, weigh 1, 2, 3 and so on in turn.
    """
    of: dict = {}
    for pattern, n in sizes.items():
        for s in pattern:
            of[s] = of.get(s, 0) + n
    order = sorted(of, key=lambda s: (s is None, s or ""))
    targets = fill_targets(of, weights or {s: i % 3 + 1 for i, s in enumerate(order)}, most)
    arcs = [("start", ("p", p), n, use) for p, n in sizes.items() for use in range(most)]
    arcs += [(("p", p), ("s", s), most * n, 0) for p, n in sizes.items() for s in p]
    arcs += [(("s", s), "end", round(targets[s]), 0) for s in order]
    _, flow = min_cost_flow(arcs, "start", "end")
    words = dict.fromkeys(sizes, 0)
    for i, (u, v, _, _) in enumerate(arcs):
        if u == "start":
            words[v[1]] += flow[i]
    return words, of, targets


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sources: Column | None = None, weights: dict | None = None, seed: int = 17) -> DataFrame:
    """docs with size, source_size, target and taken: how many words of each row the mix takes, repeats counted.

    sources is a column with one source or an array of them (default: `source`); null is a source of its own, and so is an empty
    array. source_size and target are those of the row's first source by code point; very long texts count whole. Size is the number of words, 0 for null
    texts; such rows take nothing. Rows are taken whole, at most three times each, but for the one id of each pattern at which its
    partial pass ends: that takes the words still wanted. Rows that share an id are taken together, and null ids count as one. An empty table stays empty.
    Columns of the four names in docs are replaced. One row for each pattern and slice is aggregated; the driver sees one row for
    each pattern.
    """
    spark = docs.sparkSession
    source = F.col("source") if sources is None else sources
    kind = docs.select(source.alias("s")).schema["s"].dataType.typeName()
    listed = F.array_sort(F.array_distinct(source)) if kind == "array" else F.array(source)
    listed = F.when(F.size(listed) > 0, listed).otherwise(F.array(F.lit(None).cast("string")))
    names = ["size", "source_size", "target", "taken"]
    own = [c for c in docs.columns if c not in names]
    tag = "_tm"
    while any(c.startswith(tag) for c in own):
        tag += "_"
    size, pattern, key, ident = f"{tag}_size", f"{tag}_pattern", f"{tag}_key", f"{tag}_id"
    rows = docs.withColumns({size: F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long"), pattern: F.to_json(listed, {"ignoreNullFields": "false"}), ident: F.coalesce(F.col(id_col).cast("string"), F.lit(""))})
    rows = rows.withColumn(key, F.xxhash64(F.lit(seed), ident))
    rows = rows.select(*[F.col(f"`{c}`") for c in own], size, pattern, key, ident)
    slice_ = F.shiftrightunsigned(F.col(key), 64 - SLICES.bit_length() + 1)
    # Texts are read here and for the result; sums and the ends of partial passes come from this table of sizes.
    sized, sized_at = materialize(rows.select(pattern, size, key, ident), "sizes")
    sums = sized.groupBy(pattern, slice_.alias("slice")).agg(F.sum(size).alias("n"))
    totals = {r[0]: r[1] for r in sums.groupBy(pattern).agg(F.sum("n")).collect()}
    unpack = lambda p: tuple(json.loads(p))
    words, of, targets = plan_mix({unpack(p): n for p, n in totals.items()}, weights)
    plan = []
    for p, n in totals.items():
        passes, rest = divmod(words[unpack(p)], n) if n else (0, 0)
        plan.append((p, of[unpack(p)[0]], targets[unpack(p)[0]], passes, rest))
    fields = f"{pattern} string, source_size long, target double, passes long, rest long"
    planned = local_table(spark, plan, fields)
    # The slice in which each pattern's partial pass ends, then the id in it.
    before = F.sum("n").over(Window.partitionBy(pattern).orderBy("slice")) - F.col("n")
    ends = sums.withColumn("before", before).join(planned.where("rest > 0"), pattern).where("before < rest and before + n >= rest").select(pattern, "slice", (F.col("rest") - F.col("before")).alias("want"))
    inside = sized.withColumn("slice", slice_).join(ends, [pattern, "slice"])
    each = inside.groupBy(pattern, "want", key, ident).agg(F.sum(size).alias("n"))
    running = F.sum("n").over(Window.partitionBy(pattern).orderBy(key, ident))
    last = each.withColumn("sum", running).where((F.col("sum") - F.col("n") < F.col("want")) & (F.col("sum") >= F.col("want")))
    last = last.select(pattern, F.col(key).alias("k"), F.col(ident).alias("i"), (F.col("want") - F.col("sum") + F.col("n")).alias("left"), "n")
    found = {r[0]: r[1:] for r in ends.select(pattern, "slice").join(last, pattern).select(pattern, "slice", "k", "i", "left", "n").collect()}
    drop(spark, sized_at)
    cuts = [(p, size_, target, passes, *found.get(p, (-1, None, None, 0, 1))) for p, size_, target, passes, _ in plan]
    limits = local_table(spark, cuts, f"{pattern} string, source_size long, target double, {tag}_passes long, {tag}_slice long, {tag}_k long, {tag}_i string, {tag}_left long, {tag}_n long")
    if len(cuts) <= BROADCAST_ROWS:  # else the join decides by what it finds
        limits = F.broadcast(limits)
    here, there = F.struct(F.col(key).alias("a"), F.col(ident).alias("b")), F.struct(F.col(f"{tag}_k").alias("a"), F.col(f"{tag}_i").alias("b"))
    part = F.floor(F.col(size) * F.col(f"{tag}_left") / F.col(f"{tag}_n"))
    inside = F.when(here < there, F.col(size)).when(here == there, part).otherwise(0)
    extra = F.when(slice_ < F.col(f"{tag}_slice"), F.col(size)).when(slice_ == F.col(f"{tag}_slice"), inside).otherwise(0)
    joined = rows.join(limits, pattern, "left")
    return joined.select(*[F.col(f"`{c}`") for c in own], F.col(size).alias("size"), "source_size", "target", (F.col(size) * F.col(f"{tag}_passes") + extra).cast("long").alias("taken"))
