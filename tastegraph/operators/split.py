"""Seeded samples and train/test splits. All draws depend on row keys only, so they can be repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.functions.columns import unit_draw
from tastegraph.operators.ordering import running_total


def sample_fraction(df: DataFrame, fraction: float, keys: list[str], seed: int = 42) -> DataFrame:
    """About ``fraction`` of the rows."""
    return df.filter(unit_draw(str(seed), *[F.col(k) for k in keys]) < fraction)


def assign_split(
    df: DataFrame, weights: dict[str, float], keys: list[str], seed: int = 42, column: str = "split"
) -> DataFrame:
    """Name a split for each row, in proportion to ``weights``."""
    u = unit_draw(str(seed), *[F.col(k) for k in keys])
    total, upper, choice = sum(weights.values()), 0.0, F
    names = list(weights)
    for name in names[:-1]:
        upper += weights[name] / total
        choice = choice.when(u < upper, F.lit(name))
    choice = F.lit(names[-1]) if choice is F else choice.otherwise(F.lit(names[-1]))
    return df.withColumn(column, choice)


def random_split(
    df: DataFrame, keys: list[str], train: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Disjoint train and test rows; each side is a filter on the scan."""
    u = unit_draw(str(seed), *[F.col(k) for k in keys])
    return df.filter(u < train), df.filter(u >= train)


def quantile(df: DataFrame, column: str, q: float, error: float | None = None) -> DataFrame:
    """One row ``quantile``: the smallest value with at least ``q`` of the rows at or below it.

    Exact by default: values are counted first, then placed by range. With ``error`` a sketch of that
    relative rank error is used instead.
    """
    if error:
        return df.agg(F.percentile_approx(column, q, int(1 / error)).alias("quantile"))
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    below = running_total(counts, {"below": F.col("n")}, [column])
    total = counts.agg(F.sum("n")).scalar()
    wanted = F.greatest(F.ceil(F.lit(q) * total), F.lit(1))
    return below.filter((F.col("below") < wanted) & (F.col("below") + F.col("n") >= wanted)).select(
        F.col(column).alias("quantile")
    )


def time_split(
    df: DataFrame, q: float = 0.8, column: str = "timestamp", error: float | None = None
) -> tuple[DataFrame, DataFrame]:
    """Train up to and including the ``q`` quantile of time, test after it."""
    cut = quantile(df, column, q, error).first()[0]
    return df.filter(F.col(column) <= cut), df.filter(F.col(column) > cut)


def seeded_shuffle_split(
    df: DataFrame, keys: list[str], train: int = 80_000, test: int = 20_000, seed: int = 42
) -> DataFrame:
    """Shuffle by a seeded hash: ``split`` is train for the first ``train`` rows, test for the next ``test``, then rest.

    ``train`` and ``test`` bound what a model is fitted on and judged by; every row is returned.
    """
    shuffled = df.withColumn("_hash", F.md5(F.concat_ws(":", F.lit(str(seed)), *keys)))
    placed = running_total(shuffled, {"place": F.lit(1)}, ["_hash", *keys])
    split = F.when(F.col("place") < train, "train").when(F.col("place") < train + test, "test").otherwise("rest")
    return placed.withColumn("split", split).drop("_hash")
