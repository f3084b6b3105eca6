"""Batch sources. Schemas are fixed, so filters and column choices reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.session import durable

# Columns and types of the inputs and of the sample table.
RATINGS = "userId bigint, movieId bigint, rating double, timestamp bigint"
MOVIES = "movieId bigint, title string, genres string"
SAMPLES = (
    "movieId bigint, userId bigint, rating double, timestamp bigint, label int, "
    "movieRatingCount bigint, movieAvgRating double, movieRatingStddev double, releaseYear int, "
    "movieGenre1 string, movieGenre2 string, movieGenre3 string, "
    "userRatedMovie1 bigint, userRatedMovie2 bigint, userRatedMovie3 bigint, "
    "userRatedMovie4 bigint, userRatedMovie5 bigint, "
    "userRatingCount bigint, userAvgReleaseYear int, userReleaseYearStddev double, "
    "userAvgRating double, userRatingStddev double, "
    "userGenre1 string, userGenre2 string, userGenre3 string, userGenre4 string, userGenre5 string"
)
# Source column and type of the rating records with user demographics.
RECORD_FIELDS = {
    "movie_id": "string", "user_id": "string", "user_rating": "double", "user_gender": "int",
    "user_zip_code": "string", "user_occupation_text": "string", "bucketized_user_age": "int",
}


def _read(spark: SparkSession, path: str, schema: str, fmt: str, **options) -> DataFrame:
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.options(header=True, **options)
    return reader.format(fmt).load(path)


def read_ratings(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, RATINGS, fmt)


def read_movies(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return _read(spark, path, MOVIES, fmt)


def with_defaults(samples: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Missing values become a default: 0 for numbers and "" for text unless ``defaults`` says else."""
    defaults = defaults or {}
    fill = {
        name: defaults.get(name, "" if kind == "string" else 0) for name, kind in samples.dtypes
    }
    return samples.na.fill(fill)


def read_samples(
    spark: SparkSession, path: str, label: str = "label", defaults: dict | None = None, fmt: str = "csv"
) -> DataFrame:
    """Labelled samples: malformed rows and rows without a label are skipped, gaps get defaults."""
    samples = _read(spark, path, SAMPLES, fmt, mode="DROPMALFORMED")
    return with_defaults(samples.filter(F.col(label).isNotNull()), defaults)


def read_samples_with_rejects(
    spark: SparkSession, path: str, label: str = "label", defaults: dict | None = None
) -> tuple[DataFrame, DataFrame]:
    """Labelled samples of a CSV as ``read_samples`` gives them, and what it skips: (line, reason).

    ``reason`` is ``malformed`` for lines that do not fit the schema, and ``no label``. The file is read once: parsed rows are
    written with the text of malformed lines beside them, and both tables are read from there. Their rows add up to the lines.
    """
    reader = spark.read.schema(f"{SAMPLES}, _line string").options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_line")
    parsed = durable(reader.csv(path))
    reason = F.when(F.col("_line").isNotNull(), "malformed").when(F.col(label).isNull(), "no label")
    judged = parsed.withColumn("reason", reason)
    names = [c for c in parsed.columns if c != "_line"]
    rejects = judged.filter("reason is not null").select(F.coalesce("_line", F.to_csv(F.struct(*names))).alias("line"), "reason")
    return with_defaults(judged.filter("reason is null").select(*names), defaults), rejects


def typed_user_item_records(source: DataFrame) -> DataFrame:
    """The seven rating and demographic fields of a table, typed."""
    return source.select(*[F.col(name).cast(kind).alias(name) for name, kind in RECORD_FIELDS.items()])


def read_user_item_records(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Rating records with user demographics from a path, with their fixed schema; further columns are not read.

    A CSV may hold the columns in any order and has a header.
    """
    if fmt != "csv":
        return _read(spark, path, ", ".join(f"{name} {kind}" for name, kind in RECORD_FIELDS.items()), fmt)
    header = spark.read.options(header=True, inferSchema=False).csv(path).columns
    schema = ", ".join(f"`{name}` {RECORD_FIELDS.get(name, 'string')}" for name in header)
    return _read(spark, path, schema, fmt).select(*RECORD_FIELDS)
