"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.session import shared_folder

#: Python sees at most this many characters or bytes of a batch at once (one longer row still counts as one).
SLICE_SIZE = 3 << 20


def run_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet in the shared folder: no lineage, columns prunable, safe from lost executors."""
    path = run_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], column: int = 1, size: int = SLICE_SIZE) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about ``size`` characters in one column."""
    for batch in batches:
        start = held = 0
        for row, value in enumerate(batch.column(column)):
            held += len(value.as_buffer()) if value.is_valid else 0
            if held >= size:
                yield batch.slice(start, row + 1 - start)
                start, held = row + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


def letters(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def components(edges: DataFrame, low: str = "low", high: str = "high") -> DataFrame:
    """(node, component) for every node of an edge list; component is the smallest node reachable.

    Labels spread along edges and then jump to the label of the label, so rounds grow with the logarithm of
    the longest path. Each round is one pre-aggregated minimum per node, written to the shared folder.
    """
    both = written(
        edges.select(F.col(low).alias("a"), F.col(high).alias("b"))
        .unionAll(edges.select(F.col(high).alias("a"), F.col(low).alias("b"))).where("a <> b").distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("component")), "labels")
    while True:
        spread = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        )
        met = labels.join(spread, "node").select("node", "component", F.least("component", "near").alias("best"))
        jump = labels.select(F.col("node").alias("best"), F.col("component").alias("far"))
        after = written(
            met.join(jump, "best").select("node", F.least("best", "far").alias("component"),
                                          (F.least("best", "far") < F.col("component")).alias("moved")), "labels")
        if after.where("moved").isEmpty():
            return after.select("node", "component")
        labels = after.select("node", "component")
