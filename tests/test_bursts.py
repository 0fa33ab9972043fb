"""Burst states as an expression and over chunks, against one pass in numpy."""

import numpy as np
import pytest

from tidemark.operators import bursts


def events_of(seed, sizes):
    rng = np.random.default_rng(seed)
    rows, want = [], {}
    for k, n in sizes.items():
        scale = np.where(rng.random(n) < 0.02, 1, 0).cumsum() % 3
        t = np.cumsum(rng.exponential(1e6, n) * np.array([1.0, 0.05, 0.4])[scale]).astype(int)
        t[n // 3 : n // 3 + 3] = t[n // 3]  # equal times
        t.sort()
        rows += [(k, int(x)) for x in t]
        gaps = np.maximum(np.diff(t) / 1e6, 0)
        if len(gaps) >= 2:
            want[k] = (gaps, bursts.viterbi(gaps))
    order = rng.permutation(len(rows))
    return [rows[i] for i in order], want


def joined(df):
    got = {}
    for r in sorted(df.collect(), key=lambda r: (str(r.k), r.at)):
        gaps, states = got.setdefault(r.k, ([], []))
        assert r.at == len(gaps)
        gaps += r.gaps
        states += r.states
    return got


@pytest.mark.parametrize(("seed", "chunk"), [(0, 4096), (1, 50), (2, 7), (3, 200)])
def test_states_equal_one_pass(spark, seed, chunk):
    rows, want = events_of(seed, {"a": 3, "b": 2, "c": 40, "d": 333, None: 120, "e": 900})
    events = spark.createDataFrame(rows, "k string, t long").repartition(3)
    got = joined(bursts.burst_states(events, "k", "t", chunk=chunk))
    assert set(got) == set(want)
    for k, (gaps, states) in want.items():
        assert got[k][0] == gaps.tolist() and got[k][1] == states.tolist(), k


def test_a_long_key_uses_many_tasks_and_its_bursts_are_whole(spark):
    rows, want = events_of(5, {"a": 2500, "b": 30})
    events = spark.createDataFrame(rows, "k string, t long")
    cut, whole = bursts.burst_states(events, "k", "t", chunk=100), bursts.burst_states(events, "k", "t")
    assert cut.where("k = 'a'").count() >= 20 and whole.where("k = 'a'").count() == 1
    seen = lambda states: sorted((r.k, r.start, r.end, r.max_state, round(r.duration, 6)) for r in bursts.burst_segments(states, "k").collect())
    assert seen(cut) == seen(whole) and len(seen(cut)) > 5
    numbers = lambda states: sorted((r.k, r.num_reactions, round(r.time_span_s, 6), round(r.base_rate, 9), r.max_burst_weight, round(r.total_burst_energy, 5), r.num_bursts) for r in bursts.burst_metrics(states, "k").collect())
    assert numbers(cut) == numbers(whole)


def test_no_python_in_the_plan(spark):
    events = spark.createDataFrame([("a", 1), ("a", 5), ("a", 6)], "k string, t long")
    metrics = bursts.burst_metrics(bursts.burst_states(events, "k", "t"), "k")
    plan = metrics._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and metrics.count() == 1
    with pytest.raises(ValueError):
        bursts.burst_states(events, "k", "t", states=16)
