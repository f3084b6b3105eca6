"""Missing and odd ratings in rolling statistics; sizes that must not change results."""

import math

import numpy as np

from tastegraph.operators import embeddings, graph, samples, split
from tastegraph.plans import tables


def movie_stats(spark, values, history):
    rows = spark.createDataFrame([(k, 1, v, k) for k, v in enumerate(values)], "userId long, movieId long, rating double, timestamp long")
    got = samples.movie_rolling_features(rows, history).orderBy("timestamp").collect()
    return [(r.movieRatingCount, r.movieAvgRating) for r in got]


def test_rows_without_a_rating_count(spark):
    assert movie_stats(spark, [4.0, None, 5.0], 100) == [(0, 0.0), (1, 4.0), (2, 4.0)]


def test_one_odd_rating_leaves_the_frame_again(spark):
    for odd in (math.nan, math.inf, -math.inf):
        got = movie_stats(spark, [3.0] * 3 + [odd] + [3.0] * 7, 3)
        assert [m for _, m in got] == [0.0, 3.0, 3.0, 3.0, 0.0, 0.0, 0.0, 3.0, 3.0, 3.0, 3.0]


def test_shuffle_split_names_every_row(spark):
    rows = spark.range(100)
    got = split.seeded_shuffle_split(rows, ["id"], 30, 20).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in got} == {"train": 30, "test": 20, "rest": 50}


def test_parts_keep_neighbours(spark, ratings_of):
    rated = ratings_of([(1, k, 5.0, k) for k in range(23)])
    near = lambda lists: {(a, b) for x in lists for i, a in enumerate(x) for b in x[max(0, i - 2):i + 3] if a != b}
    whole = [r.movieIds for r in graph.user_sequences(rated).collect()]
    parts = [r.movieIds for r in graph.user_sequences(rated, part_rows=6, overlap=2).collect()]
    assert len(parts) == 4 and near(parts) == near(whole)


def test_any_number_of_queries(spark, folder):
    items = tables.table(spark, folder, "embeddings").select("vec_id", "embedding")
    small = embeddings.nearest_by_cosine(items, items, 3, "vec_id", "embedding", shard_rows=100, block_rows=60)
    rows = items.collect()
    m = np.array([r.embedding for r in rows], float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    scores = m @ m.T
    np.fill_diagonal(scores, -2)
    best = {rows[k].vec_id: [rows[j].vec_id for j in np.argsort(-scores[k])[:3]] for k in range(len(rows))}
    got = {}
    for r in small.orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append(r["id"])
    assert got == best


def test_walkers_are_sent_to_the_edges(spark, folder, monkeypatch):
    from tastegraph.operators import walks

    plans, taken = [], walks._step

    def step(store, frontier, send):
        moved = taken(store, frontier, send)
        plans.append(moved._jdf.queryExecution().executedPlan().toString())
        return moved

    monkeypatch.setattr(walks, "_step", step)
    assert walks.random_walks(tables.ratings(spark, folder), 500, 6).count() == 500
    assert len(plans) == 5
    for plan in plans:
        assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan
        assert plan.count("Exchange") == plan.count("BroadcastExchange") == 1
