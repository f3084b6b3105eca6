"""Categorical and numeric encoders."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, QuantileDiscretizer, VectorAssembler
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.functions.columns import GENRES, draw
from tastegraph.operators.graph import explode_genres
from tastegraph.operators.ordering import HOT_ROWS, positions, running_total
from tastegraph.operators.samples import movie_rating_stats

# Sizes of the id and cross buckets of the rankers.
MOVIE_BUCKETS = 1001
USER_BUCKETS = 30001
CROSS_BUCKETS = 10000
# Numeric ranker features.
NUMERIC_FEATURES = [
    "releaseYear", "movieRatingCount", "movieAvgRating", "movieRatingStddev",
    "userRatingCount", "userAvgRating", "userRatingStddev",
]


def one_hot_ids(df: DataFrame, column: str = "movieId") -> DataFrame:
    """Sparse vector of length ``max id + 1`` with a one at the id, plus index and size as numbers."""
    indexed = df.withColumn(f"{column}Index", F.col(column).cast("int"))
    encoder = OneHotEncoder(inputCols=[f"{column}Index"], outputCols=[f"{column}Vector"], dropLast=False)
    model = encoder.fit(indexed)
    return model.transform(indexed).withColumn(f"{column}Size", F.lit(model.categorySizes[0]))


def string_index(df: DataFrame, column: str) -> DataFrame:
    """Codes from 0, most frequent value first, ties in value order: (value, n, code).

    The code table stays distributed, so the vocabulary may be large.
    """
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    )
    return running_total(counts, {"code": F.lit(1)}, [F.col("n").desc(), "value"])


def multi_hot_genres(movies: DataFrame) -> DataFrame:
    """Sorted genre codes per movie and the vocabulary size: (movieId, genreIndexes, indexSize)."""
    codes = string_index(explode_genres(movies), "genre").select(F.col("value").alias("genre"), "code")
    size = codes.agg(F.count(F.lit(1)).cast("int")).scalar()
    return (
        explode_genres(movies).join(codes, "genre")
        .groupBy("movieId")
        .agg(F.sort_array(F.collect_set(F.col("code").cast("int"))).alias("genreIndexes"))
        .withColumn("indexSize", size)
    )


def multi_hot_vectors(movies: DataFrame) -> DataFrame:
    """Movies with their ``multi_hot_genres`` as a sparse 0/1 vector; the vocabulary stays distributed."""
    sparse = F.udf(lambda indexes, size: Vectors.sparse(size, indexes or [], [1.0] * len(indexes or [])), VectorUDT())
    codes = multi_hot_genres(movies)
    size = codes.agg(F.max("indexSize")).scalar()
    known = codes.select("movieId", "genreIndexes")
    return movies.join(known, "movieId", "left").withColumn("vector", sparse("genreIndexes", F.coalesce(size, F.lit(0)))).drop("genreIndexes")


def quantile_bucket(df: DataFrame, column: str, output: str, buckets: int = 100) -> DataFrame:
    return QuantileDiscretizer(numBuckets=buckets, inputCol=column, outputCol=output).fit(df).transform(df)


def min_max_scale(df: DataFrame, column: str, output: str) -> DataFrame:
    """Scale to [0, 1]; a constant column becomes 0.5."""
    ends = df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("ends")).scalar()
    low, high = ends["lo"], ends["hi"]
    scaled = F.when(high == low, F.lit(0.5)).otherwise((F.col(column) - low) / (high - low))
    return df.withColumn(output, scaled)


def rating_feature_pipeline(ratings: DataFrame, buckets: int = 100) -> DataFrame:
    """Rating statistics per movie, the count in quantile buckets, the mean scaled to [0, 1]."""
    stats = movie_rating_stats(ratings)
    stages = [
        QuantileDiscretizer(numBuckets=buckets, inputCol="ratingCount", outputCol="ratingCountBucket"),
        VectorAssembler(inputCols=["avgRating"], outputCol="avgRatingVec"),
        MinMaxScaler(inputCol="avgRatingVec", outputCol="scaleAvgRating"),
    ]
    return Pipeline(stages=stages).fit(stats).transform(stats)


def identity_bucket(column: str, buckets: int) -> Column:
    """The id itself as category if it is in ``[0, buckets)``, else NULL."""
    return F.when((F.col(column) >= 0) & (F.col(column) < buckets), F.col(column).cast("int"))


def vocabulary_code(column: str, vocabulary: list[str] | None = None) -> Column:
    """Position in a fixed word list; -1 if missing or not listed."""
    words = GENRES if vocabulary is None else vocabulary
    listed = F.array_position(F.array(*[F.lit(w) for w in words]), F.col(column))
    return (F.coalesce(listed, F.lit(0)) - 1).cast("int")


def vocabulary(df: DataFrame, columns: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Sorted distinct values of each column as text: (feature, value, code), codes from 1.

    Code 0 is left for unknown values.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in columns])
    pairs = df.select(F.inline(entries)).filter(F.col("value").isNotNull()).distinct()
    placed = positions(pairs, ["feature"], ["value"], "code", hot_rows)
    return placed.withColumn("code", F.col("code") + 1)


def learned_vocabulary_lookup(df: DataFrame, columns: list[str], learned: DataFrame) -> DataFrame:
    """Codes of the columns from a ``vocabulary`` table; values it does not know get 0."""
    for c in columns:
        codes = learned.filter(F.col("feature") == c).select(
            F.col("value").alias(f"_{c}"), F.col("code").alias(f"{c}Code")
        )
        df = df.join(codes, F.col(c).cast("string") == F.col(f"_{c}"), "left").drop(f"_{c}")
        df = df.withColumn(f"{c}Code", F.coalesce(f"{c}Code", F.lit(0)))
    return df


def crossed_feature(columns: list[str], buckets: int = CROSS_BUCKETS) -> Column:
    """Bucket of a combination of columns."""
    return F.pmod(draw(*[F.col(c) for c in columns]), F.lit(buckets)).cast("int")


def numeric_vector(df: DataFrame, output: str = "numeric", columns: list[str] | None = None) -> DataFrame:
    columns = NUMERIC_FEATURES if columns is None else columns
    return VectorAssembler(inputCols=columns, outputCol=output, handleInvalid="error").transform(
        df.na.fill(0, columns)
    )
