"""Mixing sources to target weights by weighted sampling without replacement.

Every document gets an exponential key divided by its quality weight (Efraimidis and Spirakis); in key order the
documents of a source form a weighted random sample of any length. A source whose target is at least its size is
taken whole as often as it fits (complete epochs); what is left of the target is filled with documents in key
order, as far as the running sum of sizes goes.

The running sum never needs a source in one task: keys fall into ranges of about 50,000 documents each over all
sources, whatever the weights; range sums are added up per source and only the documents of one source and range
are sorted together.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import written

#: Weights of the sources in code point order, repeated as often as needed.
WEIGHTS = (5, 2, 1)
#: The mix holds this share of all words, and no source or document more than ``MOST`` times its size.
SHARE, MOST = 1.5, 2
#: Documents per range of keys, about, over all sources.
RANGE_ROWS = 50_000
#: Different quality weights.
LEVELS = 16

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words between blanks; null counts as empty. Counted as starts of words, which needs no list of them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def quality(text: Column, size: Column) -> Column:
    """Weight between 0.25 and 1: the share of words that start with two ASCII or Latin letters."""
    wordy = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"(?<![^\x20\x09-\x0D])[A-Za-zÀ-ɏ]{2}"))
    return F.lit(0.25) + F.lit(0.75) * F.coalesce(wordy / F.when(size > 0, size), F.lit(0.0))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Targets share ``share`` times all sizes by weight; a target stops at ``most`` times the source's size and the
    excess goes to the others by weight until none is above. Only sums travel to the driver, one row a round.
    """
    sizes = written(sizes, "source-sizes")
    number = _position(sizes.select("source"))
    known = F.col("position") % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (known + 1).cast("int"))
    ranked = written(sizes.join(number, F.col("source").eqNullSafe(F.col("name"))).select(
        "source", "source_size", weight.alias("weight"), (F.lit(float(most)) * F.col("source_size")).alias("cap")), "source-ranks")
    total = sizes.agg(F.sum("source_size")).head()[0] or 0
    level, left = None, None
    while True:
        full = F.lit(False) if level is None else F.col("cap") <= level * F.col("weight")
        sums = ranked.agg(
            F.sum(F.when(full, F.col("cap")).otherwise(0.0)).alias("held"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.sum(F.when(full, 1).otherwise(0)).alias("n"),
        ).head()
        if not sums.open or sums.n == left:
            break
        level, left = (share * total - sums.held) / sums.open, sums.n
    target = F.least("cap", F.lit(float(level or 0.0)) * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def _position(sources: DataFrame) -> DataFrame:
    """(name, position): rank of each source by code point, null last.

    Sources are placed by range; a source's rank is its place in its partition after the sizes of those before.
    """
    placed = sources.distinct().repartitionByRange(F.col("source").isNull(), F.col("source"))
    inside = placed.sortWithinPartitions(F.col("source").isNull(), "source").select(
        F.col("source").alias("name"), F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("id"))
    inside = inside.select("name", "part", (F.col("id") - F.shiftleft(F.col("part").cast("long"), 33)).alias("place"))
    inside = written(inside, "source-places")
    counts = inside.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    return inside.join(before, "part").select("name", (F.col("place") + F.col("offset")).alias("position"))


def _mixture(weights: dict[float, int], key: Column) -> Column:
    """Share of all documents whose key is at most ``key``: each weight's keys are exponential."""
    rows = sum(weights.values()) or 1
    terms = [F.lit(n / rows) * (F.lit(1.0) - F.exp(-F.lit(w) * key)) for w, n in sorted(weights.items())]
    return functools.reduce(lambda a, b: a + b, terms, F.lit(0.0))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 42,
        id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", carry: bool = False) -> DataFrame:
    """(id, size, source_size, target, taken, copies): how many words of each document the mix takes.

    ``copies`` counts how often the document is in the mix and ``taken`` is that many times its size; documents
    without words have at most ``most`` copies and take nothing. A null text has size 0; null sources form one source, the last; rows
    with equal ids are different documents unless their texts are equal too, when either may come first. The document
    at the end of a budget is taken if at least half of it fits. Keys are hashes of seed, id and text, so reruns
    agree. With ``carry`` a struct column ``row`` holds all columns of the document, apart from the others, so that
    names cannot clash.
    """
    text, size = F.col(text_column), word_count(F.col(text_column))
    whole = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")]
    light = docs.select(
        F.col(id_column).alias("id"), F.col(source_column).alias("source"), size.alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_column), text).alias("draw"), text.alias("text"), *(whole if carry else []))
    light = light.withColumn("weight", F.ceil(quality(F.col("text"), F.col("size")) * LEVELS) / LEVELS).drop("text")
    if not carry:
        light = written(light, "mix")
    levels = {r.weight: r.n for r in light.groupBy("weight").agg(F.count(F.lit(1)).alias("n")).collect()}  # LEVELS rows at most
    ranges = 1 + sum(levels.values()) // RANGE_ROWS
    uniform = (F.shiftrightunsigned("draw", 11).cast("double") + 0.5) * F.lit(2.0 ** -53)
    keyed = light.withColumn("key", -F.log(uniform) / F.col("weight"))
    keyed = keyed.withColumn("range", F.least(F.floor(_mixture(levels, F.col("key")) * ranges), F.lit(ranges - 1)).cast("int")).drop("weight")

    sums = written(keyed.groupBy("source", "range").agg(F.sum("size").alias("words")), "mix-ranges")
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    order = Window.partitionBy("source").orderBy("range")
    before = sums.withColumn("before", F.sum("words").over(order) - F.col("words"))
    plan = before.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("source").alias("plan_source"), F.col("range").alias("plan_range"), "before", "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int").alias("epochs"))

    inside = Window.partitionBy("source", "range").orderBy("key", "draw", "id").rowsBetween(Window.unboundedPreceding, 0)
    met = keyed.join(plan, F.col("source").eqNullSafe(F.col("plan_source")) & (F.col("range") == F.col("plan_range")))
    reached = F.col("before") + F.sum("size").over(inside) - F.col("size") / 2
    picked = (F.col("epochs") < most) & (reached <= F.col("target") - F.col("epochs") * F.col("source_size"))
    copies = met.withColumn("copies", F.col("epochs") + picked.cast("int"))
    return copies.select(
        F.col("id").alias(id_column), "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies", *(["row"] if carry else []))
