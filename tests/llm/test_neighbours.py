"""NN-descent links against all pairs, audited recall, and edge cases."""

import numpy as np
import pytest

from tastegraph.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, component_id int"


def plain(ids, m, cosine):
    m = np.asarray(m, np.float64)
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    near = u @ u.T >= cosine
    label = np.array(ids)
    while True:
        new = np.array([label[near[k]].min() for k in range(len(ids))])
        if (new == label).all():
            return {(int(i), int(near[k].sum()) - 1, int(label[k])) for k, i in enumerate(ids)}
        label = new


def planted(seed, spread):
    """Lonely vectors, tight and loose groups, equal vectors."""
    draw = np.random.default_rng(seed)
    m = [draw.standard_normal(24) for _ in range(250)]
    for size in (2, 3, 40, 120):
        centre = draw.standard_normal(24)
        m += [centre + spread * draw.standard_normal(24) for _ in range(size)]
    m += [m[0]] * 20 + [2.5 * m[1]]
    return [np.float32(x).tolist() for x in m]


@pytest.mark.parametrize(("seed", "spread"), [(1, 0.03), (2, 0.15), (3, 0.22)])
def test_against_all_pairs(spark, seed, spread):
    m = planted(seed, spread)
    ids = [int(x) for x in np.random.default_rng(9).permutation(len(m)) * 2]
    recalls = []
    got = neighbours.linked(spark.createDataFrame([(i, v, 1) for i, v in zip(ids, m, strict=True)], SCHEMA), report=recalls.append).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == plain(ids, m, 0.95)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got) and recalls[0] >= 0.98


def test_saturated_lists_grow(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BALL_ROUNDS", 0)
    monkeypatch.setattr(neighbours, "NEIGHBOURS", 4)
    monkeypatch.setattr(neighbours, "LEAF", 32)
    m = planted(4, 0.05)
    frame = spark.createDataFrame([(i, v, 1) for i, v in enumerate(m)], SCHEMA)
    got = neighbours.linked(frame).collect()
    want = plain(list(range(len(m))), m, 0.95)
    found = {(r.vec_id, r.n_links, r.component_id) for r in got}
    assert len(found & want) >= 0.95 * len(want)


def test_saturated_lists_end_exact(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BALL_ROUNDS", 0)
    monkeypatch.setattr(neighbours, "ROUNDS", 1)
    draw = np.random.default_rng(6)
    centre = draw.standard_normal(24)
    m = [np.float32(centre + 0.22 * draw.standard_normal(24)).tolist() for _ in range(200)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in enumerate(m)], SCHEMA)
    got = neighbours.linked(frame).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == plain(list(range(len(m))), m, 0.95)


def test_audit_sees_losses_between_lonely_nodes(spark):
    draw = np.random.default_rng(7)
    m = draw.standard_normal((800, 24))
    m[1::100] = m[0::100] * 2
    leaders = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "node long, vector array<double>")
    assert neighbours.audit(spark.createDataFrame([], "u long, v long, cosine double"), leaders, 0.9) == 0
    pairs = {(r.u, r.v) for r in neighbours.exact(leaders.where("node % 100 = 0"), leaders, 0.9).collect()}
    assert pairs == {p for k in range(0, 800, 100) for p in ((k, k + 1), (k + 1, k))}


def test_edges(spark):
    rows = [(1, [1.0, 0.0], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [float("nan"), 1.0], 1), (5, [None, 1.0], 1), (6, [float("inf"), 1.0], 1),
            (7, [1e-30, 0.0], 1), (None, [1.0, 0.0], 1), (9, [1.0], 1), (9, [1.0], 1), (8, [], 1), (10, [-1.0, 0.0], 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r.vec_id or 0, r.n_links, r.component_id) for r in neighbours.linked(frame).collect()), key=str)
    want = [(1, 3, 1), (2, 0, 2), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 3, 1), (0, 0, None), (9, 3, 1), (9, 3, 1), (8, 0, 8), (10, 0, 10)]
    assert got == sorted(want, key=str)
    assert neighbours.linked(frame.where("false")).count() == 0
    assert neighbours.linked(frame.where("vec_id = 1")).head().n_links == 0
