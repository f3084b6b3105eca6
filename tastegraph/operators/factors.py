"""Matrix factorisation with ALS."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.operators.products import largest_products
from tastegraph.session import shared_folder


def als_input(ratings: DataFrame) -> DataFrame:
    """Ids as int (larger ids fail the cast) and ratings as float."""
    return ratings.select(
        F.col("userId").cast("int").alias("userId"),
        F.col("movieId").cast("int").alias("movieId"),
        F.col("rating").cast("float").alias("rating"),
    )


def als(reg: float = 0.01, iterations: int = 5, rank: int = 10, seed: int = 42) -> ALS:
    """Every iteration checkpoints the item factors, after which the shuffle files of the iteration before are removed."""
    return ALS(
        rank=rank, regParam=reg, maxIter=iterations, userCol="userId", itemCol="movieId",
        ratingCol="rating", coldStartStrategy="drop", seed=seed, checkpointInterval=1,
    )


def als_fit(ratings: DataFrame, **options) -> ALSModel:
    shared_folder(ratings.sparkSession)  # the folder for checkpoints
    return als(**options).fit(als_input(ratings))


def als_predict(model: ALSModel, ratings: DataFrame) -> DataFrame:
    """Predictions for known users and movies; others are dropped."""
    return model.transform(als_input(ratings))


def als_factors(model: ALSModel) -> DataFrame:
    """Both factor tables in one: (kind, id, features)."""
    return (
        model.itemFactors.select(F.lit("item").alias("kind"), "id", "features")
        .unionByName(model.userFactors.select(F.lit("user").alias("kind"), "id", "features"))
    )


def _listed(best: DataFrame, own: str, other: str) -> DataFrame:
    """One row per ``own``: (own, recommendations array<struct<other, rating>>), best first."""
    entry = F.struct("rank", other, F.col("score").cast("float").alias("rating"))
    lists = best.groupBy(own).agg(F.sort_array(F.collect_list(entry)).alias("listed"))
    return lists.select(own, F.transform("listed", lambda e: e.dropFields("rank")).alias("recommendations"))


def recommend_items_for_all_users(model: ALSModel, k: int = 10) -> DataFrame:
    """Lists as ``ALSModel.recommendForAllUsers`` gives them, by bounded search instead of all products."""
    return _listed(best_items_for_users(model, k)[0], "userId", "movieId")


def recommend_users_for_all_items(model: ALSModel, k: int = 10) -> DataFrame:
    return _listed(best_users_for_items(model, k)[0], "movieId", "userId")


def best_items_for_users(model: ALSModel, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """Exact top lists with bounds instead of all products: (userId, rank, movieId, score) and (pairs, scored).

    The lists are those of ``ALSModel.recommendForAllUsers`` but for the order of items whose scores agree in single precision.
    """
    named = lambda df: df.select("id", F.col("features").alias("vector"))
    best, work = largest_products(named(model.userFactors), named(model.itemFactors), k)
    return best.withColumnsRenamed({"asker": "userId", "item": "movieId"}), work


def best_users_for_items(model: ALSModel, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """The same the other way round: (movieId, rank, userId, score) and (pairs, scored)."""
    named = lambda df: df.select("id", F.col("features").alias("vector"))
    best, work = largest_products(named(model.itemFactors), named(model.userFactors), k)
    return best.withColumnsRenamed({"asker": "movieId", "item": "userId"}), work


def first_ids(ratings: DataFrame, column: str, n: int = 3) -> DataFrame:
    """The ``n`` smallest distinct ids."""
    return ratings.select(F.col(column).cast("int").alias(column)).distinct().orderBy(column).limit(n)


def recommend_for_user_subset(model: ALSModel, users: DataFrame, k: int = 10) -> DataFrame:
    return model.recommendForUserSubset(users, k)


def recommend_for_item_subset(model: ALSModel, items: DataFrame, k: int = 10) -> DataFrame:
    return model.recommendForItemSubset(items, k)


def als_cross_validate(
    ratings: DataFrame,
    grid: dict[str, list] | None = None,
    folds: int = 10,
    parallelism: int = 4,
    seed: int = 42,
    **options,
) -> DataFrame:
    """Mean RMSE over the folds for each parameter combination: (params, rmse)."""
    shared_folder(ratings.sparkSession)
    estimator = als(seed=seed, **options)
    builder = ParamGridBuilder()
    for name, values in (grid or {"regParam": [0.01]}).items():
        builder.addGrid(estimator.getParam(name), values)
    maps = builder.build()
    evaluator = RegressionEvaluator(labelCol="rating", predictionCol="prediction", metricName="rmse")
    validator = CrossValidator(
        estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator,
        numFolds=folds, parallelism=parallelism, seed=seed,
    )
    data = als_input(ratings).persist()
    try:
        figures = validator.fit(data).avgMetrics
    finally:
        data.unpersist()
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in m.items()), float(figure)) for m, figure in zip(maps, figures)
    ]
    return ratings.sparkSession.createDataFrame(rows, "params string, rmse double")
