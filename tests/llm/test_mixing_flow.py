"""The flow of a mix over overlapping sources against all ways to share out a few words."""

import itertools

import numpy as np
import pytest

from tidemark.llm import mixing


def plain_best(sizes, targets, most):
    """(words, cost) of the best way: most words, then least cost, where a pattern's words cost 0, 1, 2 ... in its passes."""
    patterns = sorted(sizes, key=str)
    ways = []
    for p in patterns:
        each = [range(min(most * sizes[p], round(targets[s])) + 1) for s in p]
        ways.append([x for x in itertools.product(*each) if sum(x) <= most * sizes[p]])
    best = (0, 0)
    for choice in itertools.product(*ways):
        got = dict.fromkeys(targets, 0)
        for p, x in zip(patterns, choice, strict=True):
            for s, n in zip(p, x, strict=True):
                got[s] += n
        if all(got[s] <= round(targets[s]) for s in targets):
            cost = sum(sum(k // sizes[p] for k in range(sum(x))) for p, x in zip(patterns, choice, strict=True) if sizes[p])
            best = max(best, (sum(got.values()), -cost))
    return best[0], -best[1]


@pytest.mark.parametrize("seed", range(12))
def test_flow_is_the_cheapest(seed):
    rng = np.random.default_rng(seed)
    names = [("a",), ("b",), ("a", "b"), ("b", None)][: 3 + seed % 2]
    sizes = {p: int(rng.integers(0 if seed % 3 == 0 else 1, 4)) for p in names}
    weights = {"a": int(rng.integers(1, 9)), "b": int(rng.integers(1, 9)), None: 3}
    words, of, targets = mixing.plan_mix(sizes, weights)
    assert of == {s: sum(n for p, n in sizes.items() if s in p) for s in of}
    cost = sum(sum(k // sizes[p] for k in range(words[p])) for p in words if sizes[p])
    assert (sum(words.values()), cost) == plain_best(sizes, targets, mixing.MAX_USES)
    assert all(words[p] <= mixing.MAX_USES * sizes[p] for p in sizes)
