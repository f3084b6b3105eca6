import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tastegraph.operators import embeddings, factors, metrics, rankers, samples, split
from tastegraph.plans import tables


@pytest.fixture(scope="module")
def clustered(spark):
    """Users like either even or odd movies; ratings follow that taste."""
    rows = []
    for user in range(80):
        for k in range(30):
            movie = (user * 7 + k * 11) % 40
            rows.append((user, movie, 5.0 if movie % 2 == user % 2 else 1.0, 1000 + k * 100 + user))
    return spark.createDataFrame(rows, "userId bigint, movieId bigint, rating double, timestamp bigint").dropDuplicates(
        ["userId", "movieId"]
    )


def test_als_beats_the_mean(spark, clustered):
    train, test = split.random_split(clustered, ["userId", "movieId"])
    figure = metrics.rmse(factors.als_predict(factors.als_fit(train), test)).first()[0]
    assert figure < 1.0 < test.agg(F.stddev_pop("rating")).first()[0]


def test_recommendations_have_k_entries(spark, clustered):
    model = factors.als_fit(clustered)
    rows = factors.recommend_items_for_all_users(model, 10).collect()
    assert len(rows) == 80 and all(len(r.recommendations) == 10 for r in rows)
    users = factors.first_ids(clustered, "userId", 3)
    assert sorted(r.userId for r in factors.recommend_for_user_subset(model, users).collect()) == [0, 1, 2]
    assert factors.als_factors(model).count() == 120


def test_cross_validation_reports_each_setting(spark, clustered):
    rows = factors.als_cross_validate(clustered, {"regParam": [0.01, 0.1]}, folds=3).collect()
    assert len(rows) == 2 and all(0 < r.rmse < 3 for r in rows)


def test_item2vec_neighbours_share_taste(spark, clustered):
    model = embeddings.item2vec(clustered, iterations=30)
    table = embeddings.embedding_table(model)
    assert all(len(r.vector) == 10 for r in table.collect())
    found = embeddings.synonyms(model, spark.createDataFrame([("2",), ("no such",)], "id string"), 5).collect()
    assert len(found) == 5 and {r["query"] for r in found} == {"2"}
    assert sum(int(r.id) % 2 == 0 for r in found) >= 4


def test_cosine_topk_matches_numpy(spark, folder):
    items = tables.table(spark, folder, "embeddings")
    rows = items.select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    vectors = np.array([r.embedding for r in rows], dtype="float64")
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    queries = items.filter(F.col("vec_id").isin([3, 4]))
    got = embeddings.nearest_by_cosine(items.repartition(6), queries, 7, "vec_id", "embedding").collect()
    for q in (3, 4):
        scores = vectors @ vectors[ids == q][0]
        want = [i for i in ids[np.argsort(-scores)] if i != q][:7]
        assert [r.id for r in sorted(got, key=lambda r: r.rank) if r["query"] == q] == want


def test_lsh_recall(spark, folder):
    items = tables.table(spark, folder, "embeddings")
    rows = items.select("vec_id", "embedding").collect()
    query = [float(v) for v in rows[0].embedding]
    exact = sorted(rows, key=lambda r: np.linalg.norm(np.array(r.embedding) - query))[:5]
    found = embeddings.lsh_neighbors(items, query, 5, "vec_id", vector="embedding").collect()
    assert rows[0].vec_id in {r.vec_id for r in found}
    assert len({r.vec_id for r in found} & {r.vec_id for r in exact}) >= 2
    assert all(len(r.buckets) == 3 for r in embeddings.lsh_buckets(items, "vec_id", vector="embedding").collect())


@pytest.fixture(scope="module")
def sets(spark, clustered):
    movies = spark.createDataFrame(
        [(m, f"M ({1980 + m})", "Action|Drama" if m % 2 else "Comedy") for m in range(40)],
        "movieId bigint, title string, genres string",
    )
    table = samples.rating_samples(clustered, movies)
    train, test = split.time_split(table)
    return rankers.ranker_features(train), rankers.ranker_features(test)


def auc(scored):
    return metrics.binary_metrics(scored).first().roc_auc


def test_fm_and_logistic_rank(spark, sets):
    train, test = sets
    assert auc(rankers.score_batch(rankers.ctr_fm(train, iterations=60), test)) > 0.8
    assert 0 <= auc(rankers.score_batch(rankers.ctr_logistic(train, 10), test)) <= 1
    assert auc(rankers.score_batch(rankers.ctr_fm_full(train, 8, iterations=20), test)) > 0.6


def test_deep_rankers_use_factors(spark, sets, clustered):
    train, test = sets
    model = factors.als_fit(train)
    train, test = rankers.with_factors(train, model), rankers.with_factors(test, model)
    scored = rankers.score_batch(rankers.ctr_mlp(train, hidden=16, iterations=60), test)
    assert auc(scored) > 0.8
    assert scored.filter((F.col("score") >= 0.5) != (F.col("predicted") == "Good Rating")).isEmpty()
    assert auc(rankers.score_batch(rankers.ctr_wide_deep(train, hidden=16, iterations=60), test)) > 0.8


def test_crosses(spark, folder):
    records = tables.user_item_records(spark, folder)
    train, test = split.random_split(records, ["user_id", "movie_id"])
    train, test = rankers.record_features(train, 16), rankers.record_features(test, 16)
    runs = rankers.repeated_runs(train, test, ["none", "low_rank"], 2, iterations=5)
    assert runs.count() == 4 and runs.filter("rmse <= 0").isEmpty()
    full = rankers.rating_cross_regression(train, "full", iterations=3)
    assert full.stages[-1].numFeatures == 6 * 16 + rankers.CROSS_SPACE
    strength = rankers.pair_interaction_strength(rankers.rating_cross_regression(train, "low_rank", iterations=5), 16)
    rows = {(r.feature1, r.feature2): r.strength for r in strength.collect()}
    assert len(rows) == 36
    assert rows["movie_id", "user_id"] == pytest.approx(rows["user_id", "movie_id"])
    with pytest.raises(ValueError):
        rankers.rating_cross_regression(train, "other")


def test_crosses_keep_all_codes_in_a_sparse_space(spark, folder):
    from tastegraph.plans import tables

    records = rankers.record_features(tables.user_item_records(spark, folder), 4096)
    sizes = {}
    for crosses in ("none", "full", "low_rank"):
        model = rankers.rating_cross_regression(records, crosses, iterations=2, rank=4)
        first = model.transform(records).select("features", "user_idCode").first()
        sizes[crosses] = first.features.size
        base = {int(i) for i in first.features.indices if i < 6 * 4096}
        assert len(base) == 6 and 4096 + first.user_idCode in base  # the same codes in every kind of crosses
    assert sizes == {"none": 6 * 4096, "full": 6 * 4096 + rankers.CROSS_SPACE, "low_rank": 6 * 4096}
    assert records.select("user_idCode").distinct().count() > 140


@pytest.mark.parametrize("fit", [rankers.ctr_logistic, rankers.ctr_fm])
def test_rankers_score_after_observed_metrics(spark, sets, fit):
    """A session that has observed metrics cannot travel with tasks; what a ranker needs to score can (F26, F28)."""
    train, test = sets
    observed = Observation()
    train.observe(observed, F.count(F.lit(1)).alias("n")).count()
    assert observed.get["n"] > 0
    scored = rankers.score_batch(fit(train, iterations=2), test)
    assert scored.count() == test.count() and scored.filter("score is null or score < 0 or score > 1").isEmpty()


def test_models_are_fitted_on_as_many_partitions_as_there_are_cores(spark, monkeypatch):
    """Each partition sends a gradient of the model's size in every iteration, whatever the number of shuffle partitions."""
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(16 * cores))
    try:
        assert rankers._fit_parts(spark.range(1_000)) == cores
        monkeypatch.setattr(rankers, "FIT_ROWS", 100)
        assert rankers._fit_parts(spark.range(100 * cores + 201)) == cores + 3
        assert rankers._fit_parts(spark.range(10_000 * cores)) == 16 * cores
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_als_removes_the_shuffle_files_of_earlier_iterations(spark, ratings_of):
    rated = ratings_of([(u, m, float(1 + (u * m) % 5), u) for u in range(30) for m in range(20) if (u + m) % 3]).persist()
    rated.count()
    held = lambda: spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()
    before = held()
    model = factors.als_fit(rated, iterations=9)
    assert held() - before < 9  # each iteration has two
    assert model.itemFactors.count() == 20 and model.userFactors.count() == 30
    rated.unpersist()
