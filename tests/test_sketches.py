"""Sketches against exact counts, and days that are not read again."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import sketches


def test_ranges_come_from_stored_days(spark, tmp_path):
    rng = np.random.default_rng(0)
    rows = [(f"d{i % 4}", "ab"[i % 2] if i % 11 else None, int(rng.integers(0, 3000)) if i % 13 else None, float(rng.normal())) for i in range(20_000)]
    events = spark.createDataFrame(rows, "day string, kind string, who long, x double")
    path = f"file://{tmp_path}/sketches"
    assert sketches.update_days(events.where("day < 'd3'"), path, "day", ["kind"], "who", "x") == 3
    assert sketches.update_days(events.where("day >= 'd2'"), path, "day", ["kind"], "who", "x") == 1  # a stored day is not made again
    assert sketches.update_days(events, path, "day", ["kind"], "who", "x") == 0
    columns = ["day", "kind"]
    got = {(r.day, r.kind, r.grouped): r for r in sketches.over_days(spark, path, "day", sketches.cube_of(columns), columns, quantiles=(0.1, 0.5)).collect()}
    exact: dict = {}
    for day, kind, who, x in rows:
        for key in ((day, kind, 0), (day, None, 1), (None, kind, 2), (None, None, 3)):
            exact.setdefault(key, []).append((who, x))
    assert set(got) == set(exact)
    for key, values in exact.items():
        true, x = len({w for w, _ in values} - {None}), np.sort([v for _, v in values])
        assert got[key].n == len(values) and abs(got[key].who - true) <= 4 * sketches.ERROR * true + 1
        for q, v in ((0.1, got[key].q10), (0.5, got[key].q50)):
            assert abs(np.searchsorted(x, v) / len(x) - q) <= 2 * sketches.RANK_ERROR
    part = sketches.over_days(spark, path, "day", [[]], columns, F.col("day").between("d1", "d2")).first()
    assert part.n == 10_000 and part.grouped == 3
