"""The hash join of all items against all pairs."""

import numpy as np
import pytest

from tastegraph.operators import embeddings

rng = np.random.default_rng(11)


def groups(count=40, size=6, width=8, spread=0.05):
    centres = rng.standard_normal((count, width))
    return [(c + spread * rng.standard_normal(width)).tolist() for c in centres for _ in range(size)]


def plain(vectors, limit):
    m = np.array(vectors)
    d = np.sqrt(((m[:, None] - m[None]) ** 2).sum(axis=2))
    return {(i, j): d[i, j] for i in range(len(m)) for j in range(i + 1, len(m)) if d[i, j] <= limit}


def table(spark, vectors):
    return spark.createDataFrame(list(enumerate(vectors)), "id long, vector array<double>")


@pytest.mark.parametrize("block_rows", [512, 5])
def test_join_finds_near_items_only(spark, block_rows):
    vectors = groups()
    _, pairs, report = embeddings.similar_pairs(table(spark, vectors), 0.5, recall=0.95, block_rows=block_rows)
    want, rows = plain(vectors, 0.5), pairs.collect()
    got = {(r.low, r.high): r.distance for r in rows}
    assert len(got) == len(rows) and set(got) <= set(want)
    assert all(abs(d - want[p]) < 1e-9 for p, d in got.items())
    assert len(got) >= 0.9 * len(want) and len(want) > 400
    row = report.first()
    assert row.found_pairs >= 0.95 * row.true_pairs and row.classes == len(vectors) and row.tables > 0


def test_copies_form_classes(spark):
    vectors = groups(5, 3) + [[1.0] * 8] * 700 + [[1.01] * 8]
    classes, pairs, _ = embeddings.similar_pairs(table(spark, vectors), 0.5, block_rows=50)
    held = {r.id: (r.classId, r.members) for r in classes.collect()}
    assert len(held) == len(vectors) and held[700] == (15, 700) and held[0] == (0, 1)
    got = {(r.low, r.high) for r in pairs.collect()}
    assert (15, 715) in got and not [p for p in got if 15 < p[0] < 715]


def test_audit_adds_tables_or_compares_all(spark, monkeypatch):
    vectors = groups(20, 4)
    monkeypatch.setattr(embeddings, "_collision", lambda *a: 0.999)  # far too hopeful: one table of many projections
    _, pairs, report = embeddings.similar_pairs(table(spark, vectors), 0.5, recall=0.99, width=60, bucket_length=0.3)
    assert {(r.low, r.high) for r in pairs.collect()} == set(plain(vectors, 0.5)) and report.first().tables == 0


def test_missing_vectors_and_empty_table(spark):
    some = spark.createDataFrame([(1, [0.0, 0.0]), (2, None), (3, [0.0, 0.1])], "id long, vector array<double>")
    classes, pairs, _ = embeddings.similar_pairs(some, 0.5)
    assert {r.id for r in classes.collect()} == {1, 3} and [(r.low, r.high) for r in pairs.collect()] == [(1, 3)]
    classes, pairs, report = embeddings.similar_pairs(some.limit(0), 0.5)
    assert classes.collect() == [] and pairs.collect() == [] and report.first().true_pairs == 0


@pytest.mark.parametrize("shard_rows", [50_000, 30])
def test_wide_buckets_do_not_meet_more_pairs_than_there_are(spark, monkeypatch, shard_rows):
    vectors = groups(30, 5)
    monkeypatch.setattr(embeddings, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(embeddings, "_met_pairs", None)  # every table would have all vectors in a handful of buckets
    _, pairs, report = embeddings.similar_pairs(table(spark, vectors), 0.5, recall=0.9999, width=1, bucket_length=50.0)
    got = {(r.low, r.high): r.distance for r in pairs.collect()}
    want = plain(vectors, 0.5)
    assert set(got) == set(want) and pairs.count() == len(got) and all(abs(got[p] - want[p]) < 1e-12 for p in want)
    assert report.first().tables == 0 and report.first().found_pairs == report.first().true_pairs
