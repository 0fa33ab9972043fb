"""Requests in batches, and claims as a table function."""

import time

import pytest
from pyspark.sql import types as T

from tidemark.operators import models


def test_requests_go_out_by_size_and_age():
    asked = []

    def model(values):
        asked.append(list(values))
        if "bad" in values:
            raise OSError("down")
        return [v.upper() for v in values] if "short" not in values else []

    b = models.Batcher(model, 3, 0.2, 2)
    first = [b.add(v) for v in ("a", "b", "c", "d")]
    assert [f.result(5) for f in first[:3]] == ["A", "B", "C"] and first[3].result(5) == "D"  # the fourth went when it was old enough
    failed = [b.add(v) for v in ("x", "bad", "y")]
    with pytest.raises(OSError):
        failed[0].result(5)
    few = b.add("short")
    with pytest.raises(ValueError):
        few.result(5)
    b.close()
    assert sorted(map(len, asked)) == [1, 1, 3, 3]


def test_a_slow_and_failing_endpoint(spark):
    def model(values):
        time.sleep(0.3)
        if any(v == "t13" for v in values):
            raise OSError("down")
        return [len(v) for v in values]

    rows = spark.createDataFrame([(i, f"t{i}" if i % 10 else "" if i else None) for i in range(80)], "id long, t string").coalesce(1)
    start = time.time()
    got = {r.id: r for r in models.annotate_concurrently(rows, "t", model, "n", T.IntegerType(), size=4, wait=0.2, workers=8).collect()}
    assert time.time() - start < 15
    lost = {i for i, r in got.items() if r.n_error}
    assert len(got) == 80 and 13 in lost and len(lost) <= 4 and all("down" in got[i].n_error and got[i].n is None for i in lost)
    assert all(got[i].n == len(f"t{i}") for i in got if i % 10 and i not in lost) and got[0].n is None and got[10].n is None and not got[10].n_error


def test_claims_of_partitions(spark):
    def model(prompts):
        if "fails" in prompts[0]:
            raise OSError
        if "broken" in prompts[0]:
            return ["nothing to read"]
        return models.first_sentences(prompts)

    rows = spark.createDataFrame([(1, 0, "one two"), (1, 1, "three"), (1, 2, None), (2, 0, "it fails"), (3, 0, "broken"), (4, 0, "four")], "k long, n int, t string")
    found = models.claims_function("k", "t", model)(rows.asTable().partitionBy("k").orderBy("n"))
    assert sorted((r.k, r.claim_no, r.claim, r.original_texts) for r in found.collect()) == [(1, 0, "Claim one two", ["one two"]), (1, 1, "Claim three", ["three"]), (4, 0, "Claim four", ["four"])]
