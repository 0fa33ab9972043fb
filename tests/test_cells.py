"""The inverted file against exact search, and block joins by group."""

import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.operators import cells, neighbours


def planted(n, seed=0, dim=24, spread=0.25, groups=None):
    """Rows around centres whose number follows the root of n."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups or int(n**0.5), dim))
    return centres[rng.integers(0, len(centres), n)] + spread * rng.normal(size=(n, dim))


def table(spark, v, by=None):
    rows = [(i, x.tolist(), *([by(i)] if by else [])) for i, x in enumerate(v)]
    return spark.createDataFrame(rows, "id long, v array<double>" + (", day string" if by else ""))


def brute(v, k, least=-2.0):
    u = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    sims = np.round(u @ u.T, 12)
    np.fill_diagonal(sims, -np.inf)
    return {(i, int(j)) for i in range(len(v)) for j in np.lexsort((np.arange(len(v)), -sims[i]))[:k] if sims[i, j] >= least}


def test_search_finds_what_the_audit_promises(spark):
    v = planted(3000)
    rows = table(spark, v)
    index = cells.fit(rows, 8, recall=0.97)
    found = {(r.src, r.dst) for r in cells.search(index, 8).collect()}
    true = brute(v, 8)
    assert index.audited == 8 * cells.AUDIT_ROWS and index.recall >= 0.97 and len(found & true) >= 0.95 * len(true)
    assert cells.compared(index).first()[0] < 0.2 * len(v) ** 2


def test_pairs_grow_slower_than_the_square(spark):
    n = {size: cells.compared(cells.fit(table(spark, planted(size, size)), 8)).first()[0] for size in (1000, 4000)}
    assert n[4000] < 10 * n[1000]  # the square would be 16 times


def test_dbscan_by_index_is_exact_where_all_rows_are_audited(spark):
    v = planted(400, 3, groups=12)
    rows = table(spark, v)
    index = cells.fit(rows, 200, 0.8, recall=1.0)
    plain = {(r.id, r.cluster, r.core) for r in neighbours.dbscan(rows, 0.8, 4).collect()}
    assert {(r.id, r.cluster, r.core) for r in neighbours.dbscan(rows, 0.8, 4, index=index).collect()} == plain and plain


def test_dbscan_by_index_has_no_width(spark):
    """Two dense groups whose rows have more neighbours in their own than any search width, and all neighbours in the other."""
    rng, turn = np.random.default_rng(4), np.pi / 9
    v = np.repeat([[1.0, 0, 0], [np.cos(turn), np.sin(turn), 0], [0, 0, 1]], [260, 260, 3], axis=0) + 0.01 * rng.normal(size=(523, 3))
    rows = table(spark, v)
    index = cells.fit(rows, 4, 0.9, recall=1.0)
    got = {(r.id, r.cluster, r.core) for r in neighbours.dbscan(rows, 0.9, 4, index=index).collect()}
    assert got == {(i, 0, True) for i in range(520)}
    index.probes = 1
    found = {(r.src, r.dst) for r in cells.search(index, 300, 0.9, every=True, block_rows=90).collect()}
    assert found == brute(v, 300, 0.9)


def test_equal_vectors_nulls_and_nothing(spark):
    rows = table(spark, np.ones((300, 4))).unionByName(spark.createDataFrame([(900, None), (901, [])], "id long, v array<double>"))
    index = cells.fit(rows, 3, recall=1.0)
    assert {r.src for r in cells.search(index, 3).collect()} == set(range(300)) and index.recall == 1.0
    assert cells.search(cells.fit(rows.where("id > 899"), 3), 3).collect() == []


def test_dense_cells_are_split():
    rng = np.random.default_rng(1)
    sample = cells._unit(np.concatenate([rng.normal(size=8) + 0.05 * rng.normal(size=(900, 8)), rng.normal(size=(100, 8))]))
    centres = cells._split(sample[[0, 950]], sample, 100)
    assert np.bincount(cells._order(sample, centres, 1)[:, 0]).max() <= 150
    same = np.repeat(sample[:1], 500, axis=0)
    assert len(cells._split(same[:1], same, 10)) == 1


@pytest.mark.parametrize("block_rows", [7, 40, 1000])
def test_groups_have_blocks_of_their_own(spark, block_rows):
    v, day = planted(120, 5, groups=6), lambda i: "abc"[min(2, i // 20)] if i != 7 else "z"
    got = {(r.src, r.dst) for r in neighbours.nearest(table(spark, v, day), 4, block_rows=block_rows, by="day").collect()}
    want = set()
    for name in "abcz":
        ids = [i for i in range(120) if day(i) == name]
        want |= {(ids[i], ids[j]) for i, j in brute(v[ids], 4)}
    assert got == want


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_pairs_above(spark, block_rows):
    v = planted(90, 6, groups=9)
    got = sorted((r.a, r.b) for r in neighbours.pairs_above(table(spark, v), 0.7, block_rows).collect())
    assert got == sorted((a, b) for a, b in brute(v, 90, 0.7) if a < b) and got


@pytest.mark.parametrize("probes", [3, 40, 60])
def test_search_sees_the_cells_it_visits(spark, probes):
    v = planted(700, 7, groups=9)
    rows = table(spark, v)
    index = cells.fit(rows, 5, cells=60)
    index.probes = min(probes, len(index.centres))
    u = cells._unit(v)
    at, near = cells._order(u, index.centres, 1)[:, 0], cells._order(u, index.centres, index.probes)
    sims = np.round(u @ u.T, 12)
    sims[~(near[:, None, :] == at[None, :, None]).any(axis=2)] = -np.inf
    np.fill_diagonal(sims, -np.inf)
    want = {(i, int(j), r + 1) for i in range(len(v)) for r, j in enumerate(np.lexsort((np.arange(len(v)), -sims[i]))[:5]) if np.isfinite(sims[i, j])}
    for block_rows in (None, 64, 7):
        assert {(r.src, r.dst, r["rank"]) for r in cells.search(index, 5, block_rows=block_rows).collect()} == want


def test_queries_are_copied_for_parts_not_for_cells(spark, monkeypatch):
    rows = table(spark, np.random.default_rng(8).normal(size=(900, 16)))  # no structure, so nearly all cells are visited
    index = cells.fit(rows, 50, recall=1.0)
    dealt, deal = [], cells._deal
    monkeypatch.setattr(cells, "_deal", lambda *a: dealt.append(deal(*a)) or dealt[-1])
    assert cells.search(index, 50, block_rows=300).count() == 900 * 50
    assert index.probes > 10 and dealt[0].count() <= 900 * 3


def test_a_task_keeps_so_many_finds(monkeypatch):
    v = planted(300, 9)
    u, ids, cell = cells._unit(v), np.arange(300), np.arange(300) % 20
    table = pa.table({"side": np.repeat([0, 1], 300), "id": np.tile(ids, 2), "v": [*u.tolist()] * 2, "cells": [[*range(20)]] * 300 + [[c] for c in cell.tolist()]})
    monkeypatch.setattr(neighbours, "BLOCK_FINDS", 5000)
    got = cells._top(6, -2.0, table).to_pydict()
    assert {*zip(got["src"], got["dst"], strict=True)} == brute(v, 6) and len(got["src"]) == 1800


def test_queries_without_a_vector(spark):
    v = planted(300, 9)
    rows = table(spark, v)
    index = cells.fit(rows, 6, recall=1.0)
    asked = rows.where("id < 50").unionByName(spark.createDataFrame([(900, None), (901, [])], "id long, v array<double>"))
    assert {r.src for r in cells.search(index, 6, queries=asked).collect()} == set(range(50))


def test_blocks_of_a_group_are_dealt_to_tasks(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = table(spark, planted(60, 2), lambda i: "ab"[i % 2])
        found = neighbours.meet(rows, rows, 3, block_rows=10, by="day")
        plan = found._jdf.queryExecution().executedPlan().toString().split("FlatMapGroupsInArrow")[1]
        assert re.search(r"Exchange hashpartitioning\((i|j|day)#\d+, (i|j|day)#\d+, (i|j|day)#\d+", plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found = neighbours.meet(rows, rows, 3, block_rows=10, by="day")
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
