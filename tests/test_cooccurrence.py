"""Pair counts against plain loops; vectors that tell clusters apart."""

import random
from collections import Counter

import numpy as np
import pytest

from tastegraph.operators import embeddings


def clustered(seed=2, users=80):
    """Users like movies of one of four clusters of ten."""
    rnd = random.Random(seed)
    return [(u, 10 * (u % 4) + m, 5.0 if rnd.random() < 0.9 else 1.0, t) for u in range(users) for t, m in enumerate(rnd.sample(range(10), 8))]


@pytest.mark.parametrize("hot_rows", [2_000_000, 5])
@pytest.mark.parametrize("window", [1, 3, 20])
def test_window_pairs(spark, ratings_of, window, hot_rows):
    rows = clustered()
    want = Counter()
    for user in {r[0] for r in rows}:
        seen = [m for _, m in sorted((t, m) for u, m, r, t in rows if u == user and r >= 3.5)]
        for i, a in enumerate(seen):
            for b in seen[i + 1:i + 1 + window]:
                want[a, b] += 1
                want[b, a] += 1
    got = embeddings.window_pairs(ratings_of(rows), window, hot_rows=hot_rows).collect()
    assert {(r.src, r.dst): r.cnt for r in got} == want


def test_vectors_know_clusters(spark, ratings_of):
    vectors = embeddings.cooccurrence_vectors(embeddings.window_pairs(ratings_of(clustered())), size=8)
    assert dict(vectors.dtypes) == {"id": "string", "vector": "array<float>"} and vectors.count() == 40
    near = embeddings.nearest_by_cosine(vectors, vectors, 5).collect()
    same = [int(r["query"]) // 10 == int(r["id"]) // 10 for r in near]
    assert sum(same) >= 0.95 * len(same)
    row = embeddings.neighbour_overlap(vectors, vectors, 5).first()
    assert (row["items"], row["overlap"]) == (40, 1.0)


@pytest.mark.parametrize("kind", [np.int64, object])
def test_first_of_a_row_is_the_head_of_the_sorted_row(kind):
    """Ties, rows without a cosine, several rows of the query, fewer rows than asked for."""
    rng = np.random.default_rng(4)
    for size in (0, 1, 5, 6, 60):
        for _ in range(20):
            ids = rng.integers(0, max(size // 2, 1), size).astype(str if kind is object else kind).astype(kind)
            cos = rng.integers(-3, 4, size) / 4
            cos[rng.random(size) < 0.1] = np.nan
            query = ids[0] if size else 1
            others = ids != query
            order = np.lexsort((ids[others], -cos[others]))[:5]
            names, got, values = embeddings._first(query, ids, cos, 5)
            assert list(got) == list(ids[others][order]) and set(names) <= {query}
            np.testing.assert_array_equal(values, cos[others][order])


@pytest.mark.parametrize("missing", [0, 0.002])
def test_first_of_a_long_row_is_the_head_of_the_sorted_row(missing):
    rng = np.random.default_rng(6)
    for steps in (4, 1_000_000):  # many ties, none
        ids, cos = rng.permutation(3_000), rng.integers(-steps, steps, 3_000) / steps
        cos[rng.random(3_000) < missing] = np.nan
        order = np.lexsort((ids, -cos))
        order = order[ids[order] != ids[7]][:5]
        _, got, values = embeddings._first(ids[7], ids, cos, 5)
        assert list(got) == list(ids[order])
        np.testing.assert_array_equal(values, cos[order])
        if not missing:
            assert len(embeddings._as_good(cos, 6)) < 3_000


def test_items_are_sent_to_no_more_blocks_than_needed(spark, monkeypatch):
    """Every item goes to every block of queries, so blocks grow with the queries; up to a shard's rows each (F2)."""
    rng = np.random.default_rng(8)
    table = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(300)], "id bigint, vector array<double>")
    monkeypatch.setattr(embeddings, "MOST_BLOCKS", 3)
    blocks = lambda **sizes: embeddings.nearest_by_cosine(table, table, 2, **sizes)._jdf.queryExecution().logical().toString()
    assert "sequence(0, 2" in blocks(shard_rows=1_000, block_rows=10) and "sequence(0, 29" not in blocks(shard_rows=1_000, block_rows=10)
    assert "sequence(0, 9" in blocks(shard_rows=30, block_rows=10)
    found = [embeddings.nearest_by_cosine(table, table, 2, **sizes).collect() for sizes in ({}, {"shard_rows": 30, "block_rows": 10})]
    whole, cut = ({(r["query"], r["rank"]): r["id"] for r in rows} for rows in found)
    assert whole == cut and len(whole) == 600


def test_an_embedding_table_does_not_come_from_the_driver_again(spark, ratings_of):
    model = embeddings.item2vec(ratings_of(clustered()), iterations=1)
    plan = embeddings.embedding_table(model)._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and "LogicalRDD" not in plan and "parquet" in plan.lower()
