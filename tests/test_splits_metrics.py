import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tastegraph.operators import encode, metrics, split
from tastegraph.plans import tables


def test_splits_are_disjoint_and_complete(spark, folder):
    rated = tables.ratings(spark, folder)
    train, test = split.random_split(rated, ["userId", "movieId"])
    assert train.count() + test.count() == rated.count()
    assert train.count() / rated.count() == pytest.approx(0.8, abs=0.03)
    assert train.intersect(test).isEmpty()


def test_time_split_is_ordered(spark, folder):
    train, test = split.time_split(tables.ratings(spark, folder))
    assert train.agg(F.max("timestamp")).first()[0] < test.agg(F.min("timestamp")).first()[0]


def test_exact_quantile(spark):
    df = spark.range(1000).select(F.col("id").alias("timestamp"))
    assert split.quantile(df, "timestamp", 0.8).first()[0] == 799
    assert abs(split.quantile(df, "timestamp", 0.8, error=0.05).first()[0] - 799) <= 50


def test_auc_agrees_with_evaluator(spark):
    rnd = random.Random(5)
    rows = [(int(rnd.random() < 0.3 + 0.4 * (s := round(rnd.random(), 2))), s) for _ in range(3000)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = metrics.binary_metrics(df).first()
    raw = df.select(F.col("label").cast("double").alias("label"), F.col("score").alias("rawPrediction"))
    for name, value in (("areaUnderROC", got.roc_auc), ("areaUnderPR", got.pr_auc)):
        assert value == pytest.approx(BinaryClassificationEvaluator(metricName=name, numBins=0).evaluate(raw), abs=1e-9)
    assert got.n == 3000


def test_constant_column_scales_to_half(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "v double")
    assert [r.s for r in encode.min_max_scale(df, "v", "s").collect()] == [0.5, 0.5]


def test_one_hot_vector_agrees_with_index(spark, folder):
    row = encode.one_hot_ids(tables.movies(spark, folder)).filter("movieId = 17").first()
    assert row.movieIdVector.size == row.movieIdSize
    assert list(row.movieIdVector.indices) == [row.movieIdIndex] == [17]


def test_multi_hot_vector_agrees_with_codes(spark, folder):
    films = tables.movies(spark, folder)
    codes = {r.movieId: r.genreIndexes for r in encode.multi_hot_genres(films).collect()}
    for row in encode.multi_hot_vectors(films).collect():
        assert sorted(int(i) for i in row.vector.indices) == codes[row.movieId]
        assert set(row.vector.values) == {1.0}


def test_unknown_words_and_ids(spark):
    df = spark.createDataFrame([("Action", 5), ("Opera", 1001), (None, -1)], "g string, movieId int")
    got = df.select(encode.vocabulary_code("g"), encode.identity_bucket("movieId", 1001)).collect()
    assert [tuple(r) for r in got] == [(1, 5), (-1, None), (-1, None)]


def test_stddev_is_population(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "g string, v double")
    row = metrics.metric_summary(df, "g", "v").first()
    assert (row.runs, row["mean"], row.stdv) == (2, 2.0, 1.0)
