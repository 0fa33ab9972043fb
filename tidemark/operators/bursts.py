"""Bursts in event sequences: gaps, states of Kleinberg's automaton, segments and metrics."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.storage import cut

#: Least events of a key with states, and most of one part.
MIN_EVENTS, CHUNK = 3, 4096
#: So many long keys are broadcast at most.
BROADCAST_KEYS = 1 << 16


def interarrival(events: DataFrame, key: str, time_us: str) -> DataFrame:
    """(key, pos, time_us, gap): seconds since the key's event before, never negative; null for the first."""
    w = Window.partitionBy(key).orderBy(time_us)
    before = F.lag(time_us).over(w)
    gap = F.when(before.isNotNull(), F.greatest((F.col(time_us) - before) / 1e6, F.lit(0.0)))
    return events.select(key, time_us, F.row_number().over(w).alias("pos"), gap.alias("gap"))


def sequences(events: DataFrame, key: str, time_us: str, least: int = MIN_EVENTS) -> DataFrame:
    """(key, n, gaps): each key's gaps in order, of keys with enough events."""
    times = events.groupBy(key).agg(F.count("*").alias("n"), F.array_sort(F.collect_list(time_us)).alias("t")).where(F.col("n") >= least)
    gaps = F.zip_with(F.slice("t", 2, F.size("t") - 1), F.slice("t", 1, F.size("t") - 1), lambda b, a: F.greatest((b - a) / 1e6, F.lit(0.0)))
    return times.select(key, "n", gaps.alias("gaps"))


def viterbi(gaps: np.ndarray, s: float = 2.0, gamma: float = 1.0, base_rate: float | None = None, states: int = 10) -> np.ndarray:
    """The cheapest state for each gap; of equal costs the lowest state.

    State q expects gaps of rate base * s**q; rising by d states costs gamma * d, falling nothing. Best predecessors come from a
    running minimum on either side of each state.
    """
    total = float(np.sum(gaps))
    rate = (base_rate if base_rate is not None else (len(gaps) / total if total > 0 else 1.0)) * s ** np.arange(states)
    rise = gamma * np.maximum(np.arange(states)[:, None] - np.arange(states)[None], 0)
    cost, back = -np.log(rate) + rate * gaps[0], np.zeros((len(gaps), states), np.int64)
    for i in range(1, len(gaps)):
        way = cost[None] + rise
        back[i] = way.argmin(axis=1)
        cost = way[np.arange(states), back[i]] - np.log(rate) + rate * gaps[i]
    out = np.zeros(len(gaps), np.int64)
    out[-1] = cost.argmin()
    for i in range(len(gaps) - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def _state_path(gaps: Column, s: float, gamma: float, states: int) -> Column:
    """viterbi as an expression: costs go forward over the gaps, a number holds a step's best predecessors in four bits each, and the
    path goes back over the reversed numbers."""
    each = list(range(states))
    rises = F.array(*[F.array(*[F.lit(gamma * max(q - p, 0)) for p in each]) for q in each])
    total = F.aggregate(gaps, F.lit(0.0), lambda x, g: x + g)
    base = F.when(total > 0, F.size(gaps) / total).otherwise(1.0)
    rates = F.array(*[base * F.lit(float(s**q)) for q in each])
    bound = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))  # noqa: E731  a value that is used more than once
    lowest = lambda ways: F.transform(ways, lambda w: bound(F.array_min(w), lambda m: F.struct(m.alias("m"), (F.array_position(w, m) - 1).alias("p"))))

    def step(rate: Column):
        def advance(acc: Column, gap: Column) -> Column:
            ways = F.transform(rises, lambda rise: F.zip_with(acc["cost"], rise, lambda c, r: c + r))

            def onward(best: Column) -> Column:
                cost = F.zip_with(best, rate, lambda x, r: x["m"] - F.log(r) + r * gap)
                back = F.aggregate(F.zip_with(best, F.array(*[F.lit(16**q) for q in each]), lambda x, w: x["p"] * w), F.lit(0).cast("long"), lambda x, y: x + y)
                return F.struct(cost.alias("cost"), F.array_append(acc["back"], back).alias("back"))

            return bound(lowest(ways), onward)

        return advance

    first = lambda rate: F.struct(F.transform(rate, lambda r: -F.log(r) + r * F.get(gaps, F.lit(0))).alias("cost"), F.array().cast("array<bigint>").alias("back"))
    forward = bound(rates, lambda rate: F.aggregate(F.slice(gaps, 2, F.size(gaps)), first(rate), step(rate)))

    def path(done: Column) -> Column:
        last = (F.array_position(done["cost"], F.array_min(done["cost"])) - 1).cast("int")
        before = lambda at, back: F.call_function("shiftright", back, at * 4).bitwiseAND(F.lit(15)).cast("int")
        walk = lambda acc, back: bound(before(acc["at"], back), lambda p: F.struct(p.alias("at"), F.array_append(acc["path"], p).alias("path")))
        return F.reverse(F.aggregate(F.reverse(done["back"]), F.struct(last.alias("at"), F.array(last).alias("path")), walk)["path"])

    return bound(forward, path)


def burst_states(events: DataFrame, key: str, time_us: str, s: float = 2.0, gamma: float = 1.0, states: int = 10, least: int = MIN_EVENTS, chunk: int = CHUNK) -> DataFrame:
    """(key, part, at, n, gaps, states) of keys with at least two gaps: a part is a run of a key's gaps that begins with the one numbered `at`.

    Keys of up to `chunk` events have one part, whose path is an expression. The events of longer ones are dealt by key and time to parts of about
    that size, whose costs are combined (tidemark.operators.long_bursts), so no task holds a key.
    """
    if states > 15:
        raise ValueError("a number has room for 15 states")
    from tidemark.operators.long_bursts import long_states

    counts = events.groupBy(key).agg(F.count("*").alias("n"))
    long, _ = cut(counts.where(F.col("n") > chunk), "long-keys")
    if n_long := long.count():
        named = long.select(F.col(key).alias("_k"))
        others = events.join(F.broadcast(named) if n_long <= BROADCAST_KEYS else named, F.col(key).eqNullSafe(F.col("_k")), "left_anti")
    rows = sequences(others if n_long else events, key, time_us, least).where(F.size("gaps") >= 2)
    short = rows.select(key, F.lit(0).alias("part"), F.lit(0).cast("long").alias("at"), "n", "gaps").withColumn("states", _state_path(F.col("gaps"), s, gamma, states))
    if not n_long:
        return short
    return short.unionByName(long_states(events, long, key, time_us, s, gamma, states, chunk))


def burst_segments(states: DataFrame, key: str) -> DataFrame:
    """(key, start, end, max_state, duration, energy): maximal runs of gaps in state 1 or above.

    Runs are found within each part; those that meet where parts do are one.
    """
    each = states.select(key, "part", "at", F.posexplode(F.arrays_zip("gaps", "states")).alias("i", "g")).select(key, "part", (F.col("at") + F.col("i")).alias("i"), F.col("g.gaps").alias("gap"), F.col("g.states").alias("state"))
    island = F.count_if(F.col("state") == 0).over(Window.partitionBy(key, "part").orderBy("i"))
    runs = each.withColumn("island", island).where("state >= 1").groupBy(key, "part", "island").agg(F.min("i").alias("start"), F.max("i").alias("end"), F.max("state").alias("max_state"), F.sum("gap").alias("duration"))
    by_key = Window.partitionBy(key).orderBy("start")
    apart = runs.withColumn("new", F.when(F.lag("end").over(by_key) + 1 == F.col("start"), 0).otherwise(1)).withColumn("run", F.sum("new").over(by_key))
    whole = apart.groupBy(key, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("max_state").alias("max_state"), F.sum("duration").alias("duration"))
    return whole.select(key, "start", "end", "max_state", "duration", (F.col("max_state") * F.col("duration")).alias("energy"))


def burst_metrics(states: DataFrame, key: str) -> DataFrame:
    """Per key: reactions, span, base rate, highest state, energy, weighted count and number of bursts."""
    segments = burst_segments(states, key).groupBy(key).agg(F.max("max_state").alias("m"), F.sum("energy").alias("e"), F.sum("max_state").alias("w"), F.count("*").alias("c"))
    sums = states.groupBy(key).agg(F.max("n").alias("num_reactions"), F.sum(F.size("gaps")).alias("gaps"), F.sum(F.aggregate("gaps", F.lit(0.0), lambda a, x: a + x)).alias("time_span_s"))
    rows = sums.withColumn("base_rate", F.when(F.col("time_span_s") > 0, F.col("gaps") / F.col("time_span_s")).otherwise(1.0))
    zero = lambda c, t: F.coalesce(F.col(c).cast(t), F.lit(0).cast(t))
    return rows.join(segments, key, "left").select(key, "num_reactions", "time_span_s", "base_rate", zero("m", "long").alias("max_burst_weight"), zero("e", "double").alias("total_burst_energy"), zero("w", "long").alias("weighted_burst_count"), zero("c", "long").alias("num_bursts"))
