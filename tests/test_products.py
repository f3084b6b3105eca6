"""Bounded search against all products."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tastegraph.operators import factors, products
from tastegraph.plans import tables

rng = np.random.default_rng(3)


def plain(askers, items, k):
    ids = np.array(sorted(items))
    m = np.array([items[i] for i in ids])
    out = {}
    for a, v in askers.items():
        s = m @ np.array(v)
        out[a] = [(int(ids[j]), s[j]) for j in np.lexsort((ids, -s))[:k]]
    return out


def table(spark, vectors):
    return spark.createDataFrame([(i, list(map(float, v))) for i, v in vectors.items()], "id long, vector array<double>")


@pytest.mark.parametrize("kind", ["normal", "few", "equal", "negative", "short tail"])
def test_against_all_products(spark, monkeypatch, kind):
    monkeypatch.setattr(products, "SHARD_ROWS", 90)
    monkeypatch.setattr(products, "ASKER_ROWS", 40)
    monkeypatch.setattr(products, "CHUNK_ROWS", 16)
    width, count = (2, 6) if kind == "few" else (7, 400)
    items = {i: rng.integers(-4, 5, width) if kind == "equal" else rng.standard_normal(width) for i in range(count)}
    askers = {i + 1000: rng.integers(-4, 5, width) if kind == "equal" else rng.standard_normal(width) for i in range(90)}
    if kind == "negative":
        items, askers = {i: -abs(v) for i, v in items.items()}, {i: abs(v) for i, v in askers.items()}
    if kind == "short tail":
        items = {i: v * (3.0 if i < 30 else 0.1) for i, v in items.items()}
    best, work = products.largest_products(table(spark, askers), table(spark, items), 5, first_items=32)
    got = {}
    for r in best.orderBy("asker", "rank").collect():
        got.setdefault(r.asker, []).append((r.item, r.score))
        assert r.rank == len(got[r.asker])
    want = plain(askers, items, 5)
    assert {a: [i for i, _ in v] for a, v in got.items()} == {a: [i for i, _ in v] for a, v in want.items()}
    assert all(abs(x - y) < 1e-9 for a in want for (_, x), (_, y) in zip(got[a], want[a], strict=True))
    row = work.first()
    assert row.pairs == len(items) * len(askers) and row.scored <= row.pairs
    if kind == "short tail":
        assert row.scored < 0.2 * row.pairs


def test_nulls_and_empty_sides(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (None, [1.0, 1.0])], "id long, vector array<double>")
    none = one.limit(0)
    best, work = products.largest_products(one, one)
    assert [(r.asker, r.item, r.score) for r in best.collect()] == [(1, 1, 5.0)] and work.first().scored == 1
    for pair in ((none, one), (one, none), (none, none)):
        best, work = products.largest_products(*pair)
        assert best.collect() == [] and work.first().scored == 0


def test_lists_of_a_fitted_model(spark, folder):
    model = factors.als_fit(tables.ratings(spark, folder))
    for bounded, whole, own, other in (
        (factors.best_items_for_users, factors.recommend_items_for_all_users, "userId", "movieId"),
        (factors.best_users_for_items, factors.recommend_users_for_all_items, "movieId", "userId"),
    ):
        got = {}
        for r in bounded(model)[0].orderBy(own, "rank").collect():
            got.setdefault(r[own], []).append((r[other], r.score))
        for r in whole(model).collect():
            want = [(e[other], e["rating"]) for e in r.recommendations]
            assert all(abs(x - y) < 1e-4 for (_, x), (_, y) in zip(got[r[own]], want, strict=True))
            last = want[-1][1]
            assert {i for i, s in got[r[own]] if s > last + 1e-4} == {i for i, s in want if s > last + 1e-4}


def test_lists_for_all_are_those_of_the_model_without_its_cross_join(spark, folder):
    model = factors.als_fit(tables.ratings(spark, folder))
    for bounded, whole, other in (
        (factors.recommend_items_for_all_users(model, 7), model.recommendForAllUsers(7), "movieId"),
        (factors.recommend_users_for_all_items(model, 7), model.recommendForAllItems(7), "userId"),
    ):
        plan = bounded._jdf.queryExecution().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan and bounded.dtypes == whole.dtypes
        got, want = ({r[0]: [(e[other], e["rating"]) for e in r.recommendations] for r in t.collect()} for t in (bounded, whole))
        assert set(got) == set(want)
        for own, listed in want.items():
            assert all(abs(x - y) < 1e-4 for (_, x), (_, y) in zip(got[own], listed, strict=True))
            assert {i for i, s in got[own] if s > listed[-1][1] + 1e-4} == {i for i, s in listed if s > listed[-1][1] + 1e-4}


def _tables(askers, items, width, seed=1):
    draw = np.random.default_rng(seed)

    def table(n, **more):
        rows = np.round(draw.normal(size=(n, width)), 2)
        rows[: n // 4] = rows[n // 4: 2 * (n // 4)]  # equal vectors: ties go to the smaller id
        rows /= np.linalg.norm(rows, axis=1, keepdims=True)
        return pa.table({"id": np.arange(n), "vector": pa.array(list(rows)), "length": np.linalg.norm(rows, axis=1), **more})

    return table(items), table(askers, limit=np.full(askers, -np.inf))


def test_shard_holds_only_the_best():
    """Unit vectors, where nothing is left out by its length: no task holds all pairs and their vectors (F20)."""
    items, askers = _tables(1_024, 4_096, 64)
    tracemalloc.start()
    got = products._best(items, askers, 10, np.eye(64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20
    p, q = (np.stack(t["vector"].to_numpy()) for t in (items, askers))
    for i in (0, 5, 300, 1_023):
        score = np.einsum("ij,ij->i", np.repeat(q[i:i + 1], len(p), 0), p)
        want = np.lexsort((np.arange(len(p)), -score))[:10]
        own = [r["item"] for r in got.to_pylist() if r["asker"] == i]
        assert own == want.tolist()
