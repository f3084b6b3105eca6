"""Co-consumption and typed graphs: sequences, edges, transition tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from tastegraph.functions.columns import genre_list, typed_node_id
from tastegraph.operators.ordering import HOT_ROWS, in_chunks, over_history
from tastegraph.operators.samples import USER_ORDER, positive_ratings

SEQUENCE_ROWS = 100_000


def user_sequences(
    ratings: DataFrame, min_rating: float = 3.5, part_rows: int = SEQUENCE_ROWS, overlap: int = 0
) -> DataFrame:
    """Movies a user liked, in time order: (userId, part, movieIds), one row per ``part_rows`` movies.

    A history of up to ``part_rows`` movies is part 0; longer ones continue in parts 1, 2, ... With ``overlap`` a part
    begins with as many movies of the part before, so that neighbours across a border are still seen together.
    """
    liked = positive_ratings(ratings, min_rating).select("userId", "movieId", "timestamp")
    rows, groups = in_chunks(liked, "userId", USER_ORDER, overlap, part_rows, part_rows)
    if len(groups) == 1:
        rows = rows.withColumns({"_chunk": F.lit(0).cast("bigint"), "_lead": F.lit(False)})
    ordered = F.sort_array(F.collect_list(F.struct("timestamp", "movieId")))
    return (
        rows.groupBy("userId", F.col("_chunk").alias("part"))
        .agg(ordered["movieId"].alias("movieIds"), F.bool_and("_lead").alias("_only_lead"))
        .filter(~F.col("_only_lead")).select("userId", "part", "movieIds")
    )


def sequence_text(sequences: DataFrame) -> DataFrame:
    return sequences.withColumn("movieIdStr", F.array_join(F.col("movieIds").cast("array<string>"), " "))


def consecutive_pairs(ratings: DataFrame, min_rating: float = 3.5, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each liked movie with the one the same user liked next: (userId, src, dst)."""

    def add(rows: DataFrame, window: WindowSpec) -> DataFrame:
        return rows.withColumn("src", F.lag("movieId").over(window))

    liked = positive_ratings(ratings, min_rating).select("userId", "movieId", "timestamp")
    paired = over_history(liked, "userId", USER_ORDER, 1, add, hot_rows)
    return paired.filter(F.col("src").isNotNull()).select("userId", "src", F.col("movieId").alias("dst"))


def edge_counts(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("cnt"))


def transition_probabilities(edges: DataFrame, per: tuple[str, ...] = ("src",)) -> DataFrame:
    """``p = cnt / sum of cnt`` over the edges of a source (or of a source and target type).

    Sums are combined before the shuffle and joined back, so a hub is not gathered in one task.
    """
    totals = edges.groupBy(*per).agg(F.sum("cnt").alias("_total"))
    return edges.join(totals, list(per)).withColumn("p", F.col("cnt") / F.col("_total")).drop("_total")


def node_distribution(edges: DataFrame) -> DataFrame:
    """Share of all pairs that start at a node: (node, share)."""
    counts = edges.groupBy(F.col("src").alias("node")).agg(F.sum("cnt").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.select("node", (F.col("_n") / total).alias("share"))


def user_distribution(ratings: DataFrame, min_rating: float = 3.5) -> DataFrame:
    """Share of all positive ratings per user: (userId, share)."""
    counts = positive_ratings(ratings, min_rating).groupBy("userId").agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.select("userId", (F.col("_n") / total).alias("share"))


def item_graph(ratings: DataFrame, min_rating: float = 3.5) -> DataFrame:
    """Item to next item with count and probability."""
    return transition_probabilities(edge_counts(consecutive_pairs(ratings, min_rating)))


def rated_items(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Movies with at least one rating of any height."""
    return movies.join(ratings.select("movieId").distinct(), "movieId", "left_semi")


def explode_genres(movies: DataFrame) -> DataFrame:
    """One row per movie and genre."""
    return movies.select("movieId", F.explode(genre_list(F.col("genres"))).alias("genre"))


def item_edges(ratings: DataFrame, min_rating: float = 3.5) -> DataFrame:
    """Item-to-item occurrences as typed edges; ``tie`` tells equal edges apart."""
    return consecutive_pairs(ratings, min_rating).select(
        typed_node_id("item", "src").alias("src"), F.lit("item").alias("src_type"),
        typed_node_id("item", "dst").alias("dst"), F.lit("item").alias("dst_type"),
        F.col("userId").alias("tie"),
    )


def meta_edge_rows(ratings: DataFrame, movies: DataFrame, min_rating: float = 3.5) -> DataFrame:
    """Typed edge occurrences: item-item, user-item and item-genre, the last two both ways."""
    user_item = positive_ratings(ratings, min_rating).select(
        typed_node_id("user", "userId").alias("src"), F.lit("user").alias("src_type"),
        typed_node_id("item", "movieId").alias("dst"), F.lit("item").alias("dst_type"),
        F.col("userId").alias("tie"),
    )
    item_genre = explode_genres(rated_items(ratings, movies)).select(
        typed_node_id("item", "movieId").alias("src"), F.lit("item").alias("src_type"),
        typed_node_id("genre", "genre").alias("dst"), F.lit("genre").alias("dst_type"),
        F.col("movieId").alias("tie"),
    )
    both_ways = [user_item, item_genre, reversed_edges(user_item), reversed_edges(item_genre)]
    edges = item_edges(ratings, min_rating)
    for more in both_ways:
        edges = edges.unionByName(more)
    return edges


def reversed_edges(edges: DataFrame) -> DataFrame:
    return edges.select(
        F.col("dst").alias("src"), F.col("dst_type").alias("src_type"),
        F.col("src").alias("dst"), F.col("src_type").alias("dst_type"), "tie",
    )


def meta_edges(ratings: DataFrame, movies: DataFrame, min_rating: float = 3.5) -> DataFrame:
    return (
        meta_edge_rows(ratings, movies, min_rating)
        .groupBy("src", "src_type", "dst", "dst_type").agg(F.count(F.lit(1)).alias("cnt"))
    )


def meta_transitions(edges: DataFrame) -> DataFrame:
    """Probability of an edge among the edges of its source to the same target type."""
    return transition_probabilities(edges, ("src", "dst_type"))
