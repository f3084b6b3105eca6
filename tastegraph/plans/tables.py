"""Rating tables derived from the order tables.

A customer who ordered a part has rated a movie: the latest order line of each (customer, part) gives
the rating and its time. The rating table is written once per session and folder, as Parquet in the
shared folder, because nearly every job reads it more than once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.functions.columns import GENRES
from tastegraph.session import shared_folder
from tastegraph.sources import MOVIES, RATINGS, typed_user_item_records

_written: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _derive_ratings(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    last = F.max(F.struct(F.unix_timestamp("o_orderdate").alias("timestamp"), "l_quantity")).alias("last")
    return (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy(F.col("o_custkey").alias("userId"), F.col("l_partkey").alias("movieId"))
        .agg(last)
        .select(
            "userId",
            "movieId",
            (0.5 + 0.5 * (F.col("last.l_quantity").cast("int") % 10)).cast("double").alias("rating"),
            F.col("last.timestamp").alias("timestamp"),
        )
    )


def _written_once(spark: SparkSession, folder: str, name: str, derive, schema: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, folder.rstrip("/"), name)
    if key not in _written:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        derive(spark, folder).write.parquet(path)
        _written[key] = path
    return spark.read.schema(schema).parquet(_written[key])


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    return _written_once(spark, folder, "ratings", _derive_ratings, RATINGS)


def movies(spark: SparkSession, folder: str) -> DataFrame:
    """One movie per part; every 50th has no year in its title, movies have one to three genres."""
    part = table(spark, folder, "part")
    vocabulary = F.array(*[F.lit(g) for g in GENRES])
    pick = lambda number: F.get(vocabulary, (number % len(GENRES)).cast("int"))
    genres = F.array(pick(F.col("p_size")), pick(F.floor("p_retailprice")), pick(F.col("p_partkey")))
    year = (1960 + F.col("p_partkey") % 60).cast("string")
    return part.select(
        F.col("p_partkey").alias("movieId"),
        F.when(F.col("p_partkey") % 50 == 49, F.col("p_name"))
        .otherwise(F.concat("p_name", F.lit(" ("), year, F.lit(")"))).alias("title"),
        F.array_join(F.slice(genres, F.lit(1), (1 + F.col("p_partkey") % 3).cast("int")), "|").alias("genres"),
    )


def user_item_records(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings with invented demographics of the customer."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    rated = ratings(spark, folder)
    joined = rated.join(customer, F.col("userId") == F.col("c_custkey"))
    return typed_user_item_records(joined.select(
        F.col("movieId").alias("movie_id"),
        F.col("userId").alias("user_id"),
        F.col("rating").alias("user_rating"),
        (F.col("userId") % 2).alias("user_gender"),
        F.col("c_nationkey").alias("user_zip_code"),
        F.col("c_mktsegment").alias("user_occupation_text"),
        (10 * (F.col("userId") % 6)).alias("bucketized_user_age"),
    ))


__all__ = ["MOVIES", "table", "ratings", "movies", "user_item_records"]
