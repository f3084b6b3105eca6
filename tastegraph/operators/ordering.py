"""Ordered work on groups of any size.

A window over ``partitionBy(key)`` sorts each key inside one task. That is right for most keys and
wrong for one that holds a third of the table. The helpers here keep the plain window for keys of up
to ``HOT_ROWS`` rows and place the rows of larger ones by range over (key, order), so that a large key
spreads over as many tasks as its size asks for. Results are the same either way.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tastegraph.session import durable

HOT_ROWS = 2_000_000
CHUNK_ROWS = 500_000
# Up to so many keys may be sent to every task, more are shuffled.
SENT_KEYS = 100_000


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _matching(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, or None if there are none.

    At most ``rows / hot_rows`` keys can qualify. The counts are combined before the shuffle.
    """
    hot = df.groupBy(*keys).count().filter(F.col("count") > hot_rows).select(*keys)
    if hot.isEmpty():
        return None
    hot = durable(hot)
    return hot.hint("merge") if hot.count() > SENT_KEYS else hot


def running_total(
    df: DataFrame, totals: dict[str, Column], order: Sequence, keys: Sequence[str] = ()
) -> DataFrame:
    """For each output name the sum of its value over the earlier rows of the same key, in ``order``.

    Rows are range-partitioned by (keys, order); the placement is written once, then the partition
    sums (at most one row per partition and key) are added to the sums inside the partition. ``order``
    should have few ties: rows that tie in it stay together.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = durable(
        df.withColumns({f"_{name}": value.cast("bigint") for name, value in totals.items()})
        .repartitionByRange(parts, *keys, *order)
        .withColumn("_part", F.spark_partition_id())
    )
    earlier_parts = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    earlier_rows = (
        Window.partitionBy(*keys, "_part")
        .orderBy(*[_column(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    zero = F.lit(0).cast("bigint")
    sums = placed.groupBy(*keys, "_part").agg(*[F.sum(f"_{name}").alias(name) for name in totals])
    offsets = sums.select(
        *keys, "_part", *[F.coalesce(F.sum(name).over(earlier_parts), zero).alias(f"_{name}_before") for name in totals]
    )
    inside = placed.withColumns(
        {f"_{name}": F.coalesce(F.sum(f"_{name}").over(earlier_rows), zero) for name in totals}
    )
    joined = inside.join(offsets, _matching(inside, offsets, [*keys, "_part"]))
    return joined.select(
        *[inside[c] for c in df.columns],
        *[(inside[f"_{name}"] + offsets[f"_{name}_before"]).alias(name) for name in totals],
    )


def positions(
    df: DataFrame, keys: Sequence[str], order: Sequence, name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """0-based position of each row among the rows of its key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    place = (F.row_number().over(window) - 1).cast("bigint").alias(name)
    hot = hot_keys(df, keys, hot_rows)
    if hot is None:
        return df.select("*", place)
    cold = df.join(hot, _matching(df, hot, keys), "left_anti")
    large = df.join(hot, _matching(df, hot, keys), "left_semi")
    return cold.select("*", place).unionByName(running_total(large, {name: F.lit(1)}, order, keys))


def in_chunks(
    df: DataFrame,
    key: str,
    order: Sequence,
    history: int,
    hot_rows: int = HOT_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> tuple[DataFrame, list[str]]:
    """Cut the timelines of hot keys into chunks of ``chunk_rows`` rows.

    Returns the rows and the columns to group by: ``[key]`` if no key is hot, else ``[key, "_chunk"]``.
    The last ``history`` rows of a chunk are repeated at the head of the next one with ``_lead`` set.
    """
    if chunk_rows < max(history, 1):
        raise ValueError("a chunk must hold the whole history")
    hot = hot_keys(df, [key], hot_rows)
    if hot is None:
        return df, [key]
    cold = df.join(hot, _matching(df, hot, [key]), "left_anti")
    large = df.join(hot, _matching(df, hot, [key]), "left_semi")
    placed = running_total(large, {"_place": F.lit(1)}, order, [key])
    own = F.floor(F.col("_place") / chunk_rows).cast("bigint")
    near_end = F.col("_place") % chunk_rows >= chunk_rows - history
    large = (
        placed.withColumn("_own", own)
        .withColumn("_chunk", F.explode(F.when(near_end, F.array("_own", F.col("_own") + 1)).otherwise(F.array("_own"))))
        .withColumn("_lead", F.col("_chunk") != F.col("_own"))
        .drop("_place", "_own")
    )
    cold = cold.withColumns({"_chunk": F.lit(0).cast("bigint"), "_lead": F.lit(False)})
    return cold.unionByName(large), [key, "_chunk"]


def over_history(
    df: DataFrame,
    key: str,
    order: Sequence,
    history: int,
    add: Callable[[DataFrame, WindowSpec], DataFrame],
    hot_rows: int = HOT_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Apply ``add(rows, window)`` per key, where ``add`` looks back at most ``history`` rows."""
    chunk_rows = max(min(chunk_rows, hot_rows), history, 1)
    rows, groups = in_chunks(df, key, order, history, hot_rows, chunk_rows)
    result = add(rows, Window.partitionBy(*groups).orderBy(*order))
    if len(groups) == 1:
        return result
    return result.filter(~F.col("_lead")).drop("_chunk", "_lead")


def add_past_stats(rows: DataFrame, window: WindowSpec, history: int, values: dict[str, str]) -> DataFrame:
    """Count of rows, mean and sample deviation of each value over the ``history`` rows before the current one.

    ``values`` maps a prefix to a column; the results are ``<prefix>Count``, ``<prefix>Mean`` and
    ``<prefix>Stddev``. The count is of rows, whatever their values; mean and deviation are of the values that are
    not NULL. A frame that holds NaN or an infinite value has neither; later frames are not touched by it.

    A sliding frame would add up to ``history`` rows again for every row; here each row costs one step of a
    running sum, and the frame is the difference of two of its earlier values. The sums are of finite values only.
    """
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {}
    for prefix, column in values.items():
        value = F.col(column).cast("double")
        finite = F.abs(value) < float("inf")
        kept = F.when(finite & ~F.isnan(value), value)
        sums[f"{prefix}Count"] = F.count(F.lit(1))
        sums[f"{prefix}Known"] = F.count(value)
        sums[f"{prefix}Finite"] = F.count(kept)
        sums[f"{prefix}Sum"] = F.sum(kept)
        sums[f"{prefix}Squares"] = F.sum(kept * kept)
    rows = rows.withColumns({name: total.over(running) for name, total in sums.items()})
    rows = rows.withColumns({
        name: F.coalesce(F.lag(name, 1).over(window), F.lit(0))
        - F.coalesce(F.lag(name, history + 1).over(window), F.lit(0))
        for name in sums
    })
    results = {}
    for prefix in values:
        n, known, total, squares = (F.col(f"{prefix}{part}") for part in ("Finite", "Known", "Sum", "Squares"))
        results[f"{prefix}Mean"] = F.when((n > 0) & (n == known), total / n)
        spread = F.greatest(squares - total * total / n, F.lit(0.0))
        results[f"{prefix}Stddev"] = F.when((n > 1) & (n == known), F.sqrt(spread / (n - 1)))
    return rows.withColumns(results).drop(*[f"{p}{part}" for p in values for part in ("Known", "Finite", "Sum", "Squares")])
