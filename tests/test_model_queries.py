"""What is determined about queries that fit a model: keys, sizes, orders and ranges."""

from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from tastegraph.operators import samples, split
from tastegraph.plans import tables


def rows(spark, folder, name):
    return entry.queries()[name](spark, folder).collect()


@pytest.fixture(scope="module")
def sets(spark, folder):
    rated = tables.ratings(spark, folder)
    train, test = split.random_split(rated, ["userId", "movieId"], 0.8, 42)
    return train.collect(), test.collect()


def test_als_tables(spark, folder, sets):
    train, test = sets
    users, movies = {r.userId for r in train}, {r.movieId for r in train}
    factors = {(r.kind, r.id): np.array(r.features) for r in rows(spark, folder, "als_factors")}
    assert {k for k in factors} == {("user", u) for u in users} | {("item", m) for m in movies}
    assert all(len(v) == 10 for v in factors.values())
    got = {(r.userId, r.movieId) for r in rows(spark, folder, "als_predict")}
    assert got == {(r.userId, r.movieId) for r in test if r.userId in users and r.movieId in movies}
    for name, own, other, key, listed in (
        ("recommend_items_for_all_users", "user", "item", "userId", "movieId"), ("recommend_users_for_all_items", "item", "user", "movieId", "userId"),
    ):
        found = rows(spark, folder, name)
        assert {r[key] for r in found} == (users if own == "user" else movies)
        for r in found[:200]:
            ids, scores = [x[listed] for x in r.recommendations], [x["rating"] for x in r.recommendations]
            assert len(set(ids)) == len(ids) == 10 and scores == sorted(scores, reverse=True)
            assert np.allclose(scores, [factors[own, r[key]] @ factors[other, i] for i in ids], atol=1e-3)


@pytest.mark.parametrize("name", ["ctr_logistic", "ctr_mlp", "ctr_fm"])
def test_scores_of_rankers(spark, folder, name):
    rated, films = tables.ratings(spark, folder), tables.movies(spark, folder)
    _, test = split.time_split(samples.rating_samples(rated, films), 0.8)
    got = rows(spark, folder, name)
    assert {(r.userId, r.movieId) for r in got} == {(r.userId, r.movieId) for r in test.select("userId", "movieId").collect()}
    assert all(0 <= r.score <= 1 for r in got)


def test_words_that_are_frequent_enough_have_vectors(spark, folder):
    liked = tables.ratings(spark, folder).where("rating >= 3.5").collect()
    often = {str(m) for m, n in Counter(r.movieId for r in liked).items() if n >= 5}
    table = rows(spark, folder, "embedding_table")
    assert {r.id for r in table} == often and all(r.length == 10 for r in table)


def test_hash_neighbours_have_exact_distances(spark, folder):
    items = {r.vec_id: np.array(r.embedding, float) for r in tables.table(spark, folder, "embeddings").collect()}
    centre = np.mean(list(items.values()), axis=0)
    got = rows(spark, folder, "lsh_neighbors")
    assert 0 < len(got) <= 5
    assert all(abs(r.distance - np.linalg.norm(items[r.vec_id] - centre)) < 1e-6 for r in got)
