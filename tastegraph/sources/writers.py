"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_samples(samples: DataFrame, path: str, fmt: str = "csv", single_file: bool = False) -> None:
    """Overwrite ``path``. ``single_file`` sends all rows through one task: only for small exports."""
    writer = (samples.coalesce(1) if single_file else samples).write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def embedding_lines(item, vector) -> Column:
    """One text line per embedding: ``id:v1 v2 ...``."""
    return F.concat_ws(":", F.col(item).cast("string"), F.array_join(F.col(vector).cast("array<string>"), " "))


def write_embeddings(
    embeddings: DataFrame, path: str, item: str = "id", vector: str = "vector", fmt: str = "parquet"
) -> None:
    """Write (id, array) rows, as Parquet or as text lines."""
    if fmt == "text":
        embeddings.select(embedding_lines(item, vector).alias("value")).write.mode("overwrite").text(path)
    else:
        embeddings.select(item, vector).write.mode("overwrite").format(fmt).save(path)
