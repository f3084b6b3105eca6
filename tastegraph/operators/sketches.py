"""Quantiles from sketches that are kept and merged.

Each part of a table, a day say, is read once and leaves one row: its number of values, their ends, and a KLL sketch. Any set
of parts gives quantiles by merging their rows, so a new part needs no rescan of the earlier ones. A sketch has a few
thousand numbers at most, whatever the rows behind it. Ranks are off by no more than ``rank_error`` of all rows (in 99 of 100
cases for a single quantile); sketches draw random numbers, so cuts may differ between runs within that error.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of a sketch; more is more exact.
K = 1_000


def rank_error(k: int = K) -> float:
    """Error of a rank as a share of all rows; the published estimate for this sketch."""
    return 2.296 / k ** 0.9723


def _kind(df: DataFrame, column: str) -> str:
    kind = dict(df.dtypes)[column]
    return "bigint" if kind in ("tinyint", "smallint", "int", "bigint") else "double"


def sketched(df: DataFrame, column: str, part: Column | None = None, k: int = K) -> DataFrame:
    """(part, rows, least, most, sketch) of the values of each part; NULLs do not count. Combined before the shuffle."""
    kind = _kind(df, column)
    value = F.col(column).cast(kind)
    agg = getattr(F, f"kll_sketch_agg_{kind}")
    return (
        df.filter(value.isNotNull()).groupBy((F.lit("all") if part is None else part).cast("string").alias("part"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min(value).alias("least"), F.max(value).alias("most"), agg(value, F.lit(k)).alias("sketch"))
    )


def add_parts(df: DataFrame, column: str, part: Column, path: str, k: int = K) -> None:
    """Sketches of the parts in ``df``, appended to a store. A part must come whole: it is not looked for in the store."""
    sketched(df, column, part, k).write.mode("append").parquet(path)


def cuts(sketches: DataFrame, shares: list[float]) -> list:
    """The values below which about the given shares of all rows lie, or equal them. Empty without rows.

    The ends are exact: they are kept beside the sketches.
    """
    kind = dict(sketches.dtypes)["least"]
    merged = sketches.agg(F.min("least").alias("least"), F.max("most").alias("most"), getattr(F, f"kll_merge_agg_{kind}")("sketch").alias("sketch"))
    inner = [s for s in shares if 0 < s < 1]
    get = getattr(F, f"kll_sketch_get_quantile_{kind}")
    found = merged.filter("least is not null").select("least", "most", *[get("sketch", F.lit(s)).alias(f"c{i}") for i, s in enumerate(inner)]).first()
    if found is None:
        return []
    inside = iter(found[2:])
    return [found["least"] if s <= 0 else found["most"] if s >= 1 else next(inside) for s in shares]


def bucketed(df: DataFrame, column: str, output: str, sketches: DataFrame, buckets: int = 100) -> DataFrame:
    """Adds the quantile bucket of a value as double, from the cuts of sketches; equal cuts count once, NULLs stay NULL."""
    inner = sorted({float(c) for c in cuts(sketches, [i / buckets for i in range(1, buckets)])})
    splits = [float("-inf"), *inner, float("inf")]
    return Bucketizer(splits=splits, inputCol=column, outputCol=output, handleInvalid="keep").transform(df)


def share_below(df: DataFrame, column: str, values: list) -> list[tuple[float, float]]:
    """For each value the exact shares of rows below it and up to it, in one pass."""
    kept = df.filter(F.col(column).isNotNull())
    figures = [f(F.col(column), v) for v in values for f in (lambda c, x: F.count_if(c < x), lambda c, x: F.count_if(c <= x))]
    row = kept.agg(F.count(F.lit(1)), *figures).first()
    return [(row[1 + 2 * i] / row[0], row[2 + 2 * i] / row[0]) for i in range(len(values))] if row[0] else []
