"""Registered queries: one per operator, over the whole tables of a folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.operators import (
    embeddings, encode, factors, graph, item_cf, metrics, products, rankers, samples, sketches, split, walks,
)
from tastegraph.functions import columns as fn
from tastegraph.plans import tables
from tastegraph.session import shared_folder
from tastegraph.sources import (
    SAMPLES, read_movies, read_ratings, read_samples, read_samples_with_rejects, read_user_item_records, write_embeddings,
    write_samples,
)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

MIN_COS = 0.2
# Codes of each categorical field of the rating records, in every kind of crosses.
CROSS_FIELD_BUCKETS = 4_096
# Codes of the ids in the rankers; all ids are hashed into them.
ID_CODES = {"hashed": True, "movie_buckets": 8_192, "user_buckets": 30_001}
SEED = 42


def query(function: Query) -> Query:
    """Register under the function's name; a trailing underscore keeps it apart from an imported one."""
    REGISTRY[function.__name__.rstrip("_")] = function
    return function


def _run_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_once: dict[tuple, object] = {}


def _shared(spark: SparkSession, folder: str, name: str, make):
    """A table or model that several queries need, made once per session and folder."""
    key = (spark.sparkContext.applicationId, folder.rstrip("/"), name)
    if key not in _once:
        _once[key] = make()
    return _once[key]


def fer_table(spark: SparkSession, folder: str) -> DataFrame:
    """The sample table, written once for the queries that only consume it."""

    def make():
        path = _run_path(spark, "samples")
        write_samples(samples.rating_samples(tables.ratings(spark, folder), tables.movies(spark, folder)), path, "parquet")
        return path

    return spark.read.schema(SAMPLES).parquet(_shared(spark, folder, "samples", make))


# ---- sources and sinks -------------------------------------------------------------------------


@query
def read_ratings_(spark, folder):
    """Ratings written as CSV with header and read back with the fixed schema."""
    path = _run_path(spark, "ratings-csv")
    write_samples(tables.ratings(spark, folder), path)
    return read_ratings(spark, path)


@query
def read_movies_(spark, folder):
    path = _run_path(spark, "movies-csv")
    write_samples(tables.movies(spark, folder), path)
    return read_movies(spark, path)


@query
def read_samples_(spark, folder):
    """The sample table through CSV; gaps come back as defaults."""
    path = _run_path(spark, "samples-csv")
    write_samples(fer_table(spark, folder), path)
    return read_samples(spark, path)


@query
def read_user_item_records_(spark, folder):
    """Records written as CSV, among other columns and in another order, and read back from the path."""
    path = _run_path(spark, "records-csv")
    records = tables.user_item_records(spark, folder)
    write_samples(records.select(F.lit("x").alias("more"), *reversed(records.columns)), path)
    return read_user_item_records(spark, path)


@query
def read_samples_with_rejects_(spark, folder):
    """Samples and rejects per reason of a CSV in which some ids are no numbers and some labels are missing."""
    path = _run_path(spark, "samples-bad")
    spoilt = fer_table(spark, folder).withColumns({
        "movieId": F.concat(F.when(F.col("userId") % 50 == 0, "x").otherwise(""), F.col("movieId")),
        "label": F.when(F.col("userId") % 7 != 0, F.col("label"))})
    write_samples(spoilt, path)
    good, rejects = read_samples_with_rejects(spark, path)
    kinds = good.select(F.lit("kept").alias("kind")).unionByName(rejects.select(F.col("reason").alias("kind")))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query
def write_samples_(spark, folder):
    """Rows per label in a written and reread sample table."""
    path = _run_path(spark, "samples-out")
    write_samples(fer_table(spark, folder), path, "parquet")
    return spark.read.parquet(path).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query
def write_embeddings_(spark, folder):
    """Embedding lines as written to text."""
    path = _run_path(spark, "embeddings-text")
    whole = tables.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.transform("embedding", lambda v: F.floor(v.cast("double") * 1024) / 1024 + 2).alias("vector")
    )
    write_embeddings(whole, path, fmt="text")
    return spark.read.text(path).select(F.col("value").alias("line"))


# ---- samples -----------------------------------------------------------------------------------


@query
def fer_samples(spark, folder):
    return samples.rating_samples(tables.ratings(spark, folder), tables.movies(spark, folder))


def _with_gaps(spark, folder):
    """The ratings, every 17th of them without a value."""
    return tables.ratings(spark, folder).withColumn(
        "rating", F.when((F.col("userId") * 31 + F.col("movieId")) % 17 == 0, F.lit(None)).otherwise(F.col("rating")))


def _gap_features(spark, folder, **options):
    labelled = samples.add_label(_with_gaps(spark, folder))
    movie = samples.movie_rolling_features(labelled, 20, **options)
    user = samples.user_rolling_features(samples.attach_movie_features(movie, tables.movies(spark, folder)), 20, **options)
    return user.select("userId", "movieId", "movieRatingCount", "movieAvgRating", "movieRatingStddev", "userRatingCount", "userAvgRating", "userRatingStddev")


@query
def rolling_features_with_gaps(spark, folder):
    """Earlier ratings count with or without a value; means and deviations are of the values."""
    return _gap_features(spark, folder)


@query
def rolling_features_with_gaps_split_keys(spark, folder):
    """The same with users and movies of more than 30 ratings cut into chunks."""
    return _gap_features(spark, folder, hot_rows=30)


@query
def export_train_test(spark, folder):
    """A tenth of the samples, cut at the 0.8 quantile of time, both sides written and read back."""
    table = split.sample_fraction(fer_table(spark, folder), 0.1, ["userId", "movieId"], SEED)
    read = []
    for name, part in zip(("train", "test"), split.time_split(table, 0.8)):
        path = _run_path(spark, f"export-{name}")
        write_samples(part, path)
        read.append(read_samples(spark, path).withColumn("split", F.lit(name)))
    return read[0].unionByName(read[1]).select("userId", "movieId", "label", "timestamp", "userRatingCount", "split")


@query
def fer_samples_short_history(spark, folder):
    """The sample table with a history of 20, which most users exceed."""
    return samples.rating_samples(tables.ratings(spark, folder), tables.movies(spark, folder), history=20)


@query
def fer_samples_split_keys(spark, folder):
    """History of 20, with every key of more than 25 ratings treated as a hot one and cut into chunks."""
    return samples.rating_samples(tables.ratings(spark, folder), tables.movies(spark, folder), history=20, hot_rows=25)


@query
def fer_samples_printed(spark, folder):
    return samples.as_printed(fer_table(spark, folder))


@query
def positive_ratings(spark, folder):
    return samples.positive_ratings(tables.ratings(spark, folder))


@query
def add_label(spark, folder):
    return samples.add_label(tables.ratings(spark, folder))


@query
def rating_distribution(spark, folder):
    return samples.rating_distribution(tables.ratings(spark, folder))


@query
def movie_rating_stats(spark, folder):
    stats = samples.movie_rating_stats(tables.ratings(spark, folder))
    return stats.withColumns({c: fn.rounded(F.col(c), 6) for c in ("avgRating", "ratingVar", "ratingStddev")})


@query
def latest_ratings(spark, folder):
    """One rating per (user, part brand): the latest of many."""
    part = tables.table(spark, folder, "part").select(F.col("p_partkey").alias("movieId"), F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("bigint").alias("brand"))
    rated = tables.ratings(spark, folder).join(part, "movieId")
    return samples.latest_ratings(rated.select("userId", F.col("brand").alias("movieId"), "rating", "timestamp"))


@query
def movie_rolling_features(spark, folder):
    return samples.movie_rolling_features(samples.add_label(tables.ratings(spark, folder)))


@query
def user_rolling_features(spark, folder):
    labelled = samples.add_label(tables.ratings(spark, folder))
    return samples.user_rolling_features(samples.attach_movie_features(labelled, tables.movies(spark, folder)))


@query
def attach_movie_features(spark, folder):
    """Ratings with year and genres, the genre list as text."""
    joined = samples.attach_movie_features(tables.ratings(spark, folder), tables.movies(spark, folder))
    return joined.withColumn("genreList", F.array_join("genreList", "|"))


@query
def release_year(spark, folder):
    return tables.movies(spark, folder).select("movieId", "title", fn.release_year(F.col("title")).alias("releaseYear"))


@query
def split_genres(spark, folder):
    return tables.movies(spark, folder).select("movieId", *fn.first_genres(F.col("genres")))


@query
def min_history_filter(spark, folder):
    """Samples per number of earlier ratings, from 10 on."""
    labelled = samples.add_label(tables.ratings(spark, folder))
    joined = samples.attach_movie_features(labelled, tables.movies(spark, folder))
    kept = samples.user_rolling_features(joined, min_history=10)
    return kept.groupBy("userRatingCount").agg(F.count(F.lit(1)).alias("n"))


@query
def user_timeline(spark, folder):
    """Timeline of the user with the smallest id."""
    table = fer_table(spark, folder)
    first = table.agg(F.min("userId")).first()[0]
    return samples.user_timeline(table, first)


# ---- splits ------------------------------------------------------------------------------------


@query
def sample_fraction(spark, folder):
    return split.sample_fraction(tables.ratings(spark, folder), 0.1, ["userId", "movieId"], SEED)


@query
def random_split(spark, folder):
    train, test = split.random_split(tables.ratings(spark, folder), ["userId", "movieId"], 0.8, SEED)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query
def random_split_three_ways(spark, folder):
    return split.assign_split(
        tables.ratings(spark, folder), {"train": 0.7, "valid": 0.1, "test": 0.2}, ["userId", "movieId"], SEED
    )


@query
def time_quantile(spark, folder):
    return split.quantile(tables.ratings(spark, folder), "timestamp", 0.8)


@query
def time_quantile_approx(spark, folder):
    return split.quantile(tables.ratings(spark, folder), "timestamp", 0.8, error=0.05)


@query
def time_quantile_sketch(spark, folder):
    """Cuts of the rating times from a store of sketches per year: is each one's exact rank within a hundredth of its share?"""
    rated = tables.ratings(spark, folder)
    path = _run_path(spark, "time-sketches")
    year = F.year(F.timestamp_seconds("timestamp"))
    for part in (rated.where(year < 1999), rated.where(year >= 1999)):  # the later years are added to what is there
        sketches.add_parts(part, "timestamp", year, path)
    shares = [0.05, 0.2, 0.5, 0.8, 0.95]
    store = spark.read.parquet(path)
    exact = sketches.share_below(rated, "timestamp", sketches.cuts(store, shares))
    rows = [(share, below - 0.01 <= share <= upto + 0.01) for share, (below, upto) in zip(shares, exact, strict=True)]
    held = store.agg(F.sum("rows"), F.count("part")).first()
    return spark.createDataFrame([(*row, *held) for row in rows], "share double, within boolean, rows long, parts long")


@query
def quantile_bucket_sketch(spark, folder):
    """Quantile buckets of rating counts by sketch: does each bucket agree with the value's exact rank to a hundredth?"""
    stats = samples.movie_rating_stats(tables.ratings(spark, folder)).select("movieId", "ratingCount")
    held = sketches.sketched(stats, "ratingCount")
    cuts = sketches.cuts(held, [i / 100 for i in range(101)])
    exact = sketches.share_below(stats, "ratingCount", sorted(set(cuts)))
    bucket = sketches.bucketed(stats, "ratingCount", "bucket", held)
    inner = sorted(set(cuts[1:-1]))
    wanted = {c: ([s / 100 for s, x in enumerate(cuts) if x == c][0], [s / 100 for s, x in enumerate(cuts) if x == c][-1]) for c in cuts}
    good = [(float(i + 1), all(b - 0.01 <= s <= u + 0.01 for s in wanted[c]))
            for i, (c, (b, u)) in enumerate((c, e) for c, e in zip(sorted(set(cuts)), exact, strict=True) if c in inner)]
    edges = spark.createDataFrame([(0.0, True), *good], "bucket double, within boolean")
    return bucket.join(F.broadcast(edges), "bucket").select("movieId", "ratingCount", "within")


@query
def time_split(spark, folder):
    train, test = split.time_split(tables.ratings(spark, folder), 0.8)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query
def seeded_shuffle_split(spark, folder):
    return split.seeded_shuffle_split(tables.ratings(spark, folder), ["userId", "movieId"], 40_000, 10_000, SEED)


# ---- item CF -----------------------------------------------------------------------------------


@query
def cooccurring_pairs(spark, folder):
    """Product sums of the movie pairs that reach the similarity threshold."""
    return item_cf.pair_product_sums(tables.ratings(spark, folder), MIN_COS).select("movieIdHead", "movieIdTail", "product")


@query
def pair_product_sum(spark, folder):
    """Product sums next to their cosine."""
    pairs = item_cf.pair_product_sums(tables.ratings(spark, folder), MIN_COS)
    return pairs.withColumn("cos", fn.rounded(F.col("cos"), 6))


@query
def cosine(spark, folder):
    """The cosine formula on each movie's squared norm and the largest one."""
    norms = item_cf.item_norms(tables.ratings(spark, folder))
    largest = norms.agg(F.max("itemNorm")).scalar()
    value = fn.cosine(F.col("itemNorm"), F.col("itemNorm"), largest)
    return norms.select("movieId", fn.rounded(value, 6).alias("cos"))


@query
def item_norms(spark, folder):
    return item_cf.item_norms(tables.ratings(spark, folder))


@query
def attach_norms(spark, folder):
    """Consecutive movies with their norms."""
    edges = graph.edge_counts(graph.consecutive_pairs(tables.ratings(spark, folder)))
    pairs = edges.select(F.col("src").alias("movieIdHead"), F.col("dst").alias("movieIdTail"), "cnt")
    return item_cf.attach_norms(pairs, item_cf.item_norms(tables.ratings(spark, folder)))


@query
def min_similarity_filter(spark, folder):
    """Cosine from product sums and norms, kept from the threshold on."""
    rated = tables.ratings(spark, folder)
    cosines = item_cf.item_cosines(item_cf.pair_product_sums(rated, MIN_COS - 0.05), item_cf.item_norms(rated), MIN_COS)
    return cosines.withColumn("cos", fn.rounded(F.col("cos"), 6))


@query
def similar_items(spark, folder):
    """Similar items, one row per movie and similar movie."""
    pairs = item_cf.pair_product_sums(tables.ratings(spark, folder), MIN_COS)
    return item_cf.both_directions(pairs).withColumn("cos", fn.rounded(F.col("cos"), 6))


@query
def similar_items_heavy(spark, folder):
    """The same with users of more than 30 ratings treated as heavy."""
    pairs = item_cf.pair_product_sums(tables.ratings(spark, folder), MIN_COS, heavy_user=30)
    return item_cf.both_directions(pairs).withColumn("cos", fn.rounded(F.col("cos"), 6))


def _with_house_account(spark, folder):
    """The ratings, and a user who rated every movie and, as movies of their own, every line of every order."""
    films = tables.movies(spark, folder).select("movieId")
    lines = tables.table(spark, folder, "lineitem").select(
        (-(1 + F.col("l_orderkey") * 8 + F.col("l_linenumber"))).cast("long").alias("movieId")).distinct()
    house = films.unionByName(lines).select(
        F.lit(-1).cast("long").alias("userId"), "movieId", (0.5 + 0.5 * F.pmod("movieId", F.lit(10))).cast("double").alias("rating"),
        F.lit(0).cast("long").alias("timestamp"))
    return tables.ratings(spark, folder).unionByName(house)


@query
def movie_classes(spark, folder):
    """Movies with rating vectors of one direction, where one user rated more movies than all others know."""
    return item_cf.similar_classes(_with_house_account(spark, folder), MIN_COS)[0]


@query
def similar_classes(spark, folder):
    """Similar classes of movies beside a user whose own history has quadratically many similar pairs."""
    found = item_cf.similar_classes(_with_house_account(spark, folder), MIN_COS)[1]
    return found.select("classHead", "classTail", fn.rounded(F.col("cos"), 6).alias("cos"))


@query
def pair_product_sum_blocks(spark, folder):
    """The same pairs with histories cut into blocks of eight movies."""
    found = item_cf.pair_product_sums(tables.ratings(spark, folder), MIN_COS, block_rows=8)
    return found.withColumn("cos", fn.rounded(F.col("cos"), 6))


@query
def item_cf_(spark, folder):
    """Similar-item lists of the training split, as text."""
    train, _ = split.random_split(tables.ratings(spark, folder), ["userId", "movieId"], 0.8, SEED)
    lists = item_cf.item_cf(train, MIN_COS)
    text = F.transform("simList", lambda e: F.concat_ws(":", e["movieIdTail"], F.format_number(e["cos"], 5)))
    return lists.select("movieId", "page", F.array_join(F.sort_array(text), " ").alias("simList"))


@query
def similar_items_pages(spark, folder):
    """Similar-item lists in pages of three ranks, best first."""
    pages = item_cf.similar_items(item_cf.pair_product_sums(tables.ratings(spark, folder), MIN_COS), page_rows=3)
    return pages.select("movieId", "page", F.array_join("simList.movieIdTail", " ").alias("similar"))


# ---- graphs and walks --------------------------------------------------------------------------


@query
def user_sequences_parts(spark, folder):
    """Histories in parts of four movies."""
    sequences = graph.sequence_text(graph.user_sequences(tables.ratings(spark, folder), part_rows=4))
    return sequences.select("userId", "part", "movieIdStr")


@query
def user_sequences(spark, folder):
    sequences = graph.sequence_text(graph.user_sequences(tables.ratings(spark, folder)))
    return sequences.select("userId", "part", "movieIdStr")


@query
def consecutive_pairs(spark, folder):
    return graph.consecutive_pairs(tables.ratings(spark, folder))


@query
def edge_counts(spark, folder):
    return graph.edge_counts(graph.consecutive_pairs(tables.ratings(spark, folder)))


@query
def transition_probabilities(spark, folder):
    edges = graph.item_graph(tables.ratings(spark, folder))
    return edges.withColumn("p", F.round("p", 9))


@query
def item_graph(spark, folder):
    """Transition table of the item graph with the share of each source."""
    rated = tables.ratings(spark, folder)
    shares = graph.node_distribution(graph.edge_counts(graph.consecutive_pairs(rated)))
    joined = graph.item_graph(rated).join(shares, F.col("src") == F.col("node")).drop("node")
    return joined.withColumns({"p": F.round("p", 9), "share": F.round("share", 9)})


@query
def node_distribution(spark, folder):
    shares = graph.node_distribution(graph.edge_counts(graph.consecutive_pairs(tables.ratings(spark, folder))))
    return shares.withColumn("share", F.round("share", 9))


@query
def user_distribution(spark, folder):
    return graph.user_distribution(tables.ratings(spark, folder)).withColumn("share", F.round("share", 9))


@query
def rated_items(spark, folder):
    return graph.rated_items(tables.ratings(spark, folder), tables.movies(spark, folder))


@query
def explode_genres(spark, folder):
    return graph.explode_genres(tables.movies(spark, folder))


@query
def typed_node_id(spark, folder):
    return tables.movies(spark, folder).select("movieId", fn.typed_node_id("item", "movieId").alias("node"))


@query
def meta_edges(spark, folder):
    return graph.meta_edges(tables.ratings(spark, folder), tables.movies(spark, folder))


@query
def meta_transitions(spark, folder):
    edges = graph.meta_edges(tables.ratings(spark, folder), tables.movies(spark, folder))
    return graph.meta_transitions(edges).withColumn("p", F.round("p", 9))


@query
def random_walks(spark, folder):
    return walks.walk_steps(walks.random_walks(tables.ratings(spark, folder), seed=SEED))


@query
def metapath_walks(spark, folder):
    rated, movies = tables.ratings(spark, folder), tables.movies(spark, folder)
    return walks.walk_steps(walks.rating_metapath_walks(rated, movies, seed=SEED))


@query
def metapath_mix(spark, folder):
    """Walks and visited nodes per path of the standard mix."""
    rated, movies = tables.ratings(spark, folder), tables.movies(spark, folder)
    corpus = walks.rating_metapath_walks(rated, movies, seed=SEED)
    return corpus.groupBy("path").agg(F.count(F.lit(1)).alias("walks"), F.sum(F.size("nodes")).alias("visits"))


@query
def walk_corpus(spark, folder):
    corpus = walks.random_walks(tables.ratings(spark, folder), seed=SEED)
    return corpus.select("walk", F.array_join("nodes", " ").alias("tokens"))


# ---- encoders ----------------------------------------------------------------------------------


@query
def one_hot_ids(spark, folder):
    encoded = encode.one_hot_ids(tables.movies(spark, folder))
    return encoded.select("movieId", F.col("movieIdIndex").cast("bigint").alias("movieIdIndex"), F.col("movieIdSize").cast("bigint").alias("movieIdSize"))


@query
def string_index(spark, folder):
    return encode.string_index(graph.explode_genres(tables.movies(spark, folder)), "genre")


@query
def string_index_large(spark, folder):
    """Codes of a large vocabulary: users by number of ratings."""
    return encode.string_index(tables.ratings(spark, folder), "userId")


@query
def multi_hot_genres(spark, folder):
    codes = encode.multi_hot_genres(tables.movies(spark, folder))
    text = F.array_join(F.col("genreIndexes").cast("array<string>"), " ")
    return codes.select("movieId", text.alias("genreIndexes"), F.col("indexSize").cast("bigint").alias("indexSize"))


@query
def multi_hot_vectors(spark, folder):
    """Genre vectors, written out as text."""
    vectors = encode.multi_hot_vectors(tables.movies(spark, folder))
    numbers = F.transform(vector_to_array("vector"), lambda x: x.cast("int").cast("string"))
    return vectors.select("movieId", F.array_join(numbers, " ").alias("vector"))


@query
def quantile_bucket(spark, folder):
    stats = samples.movie_rating_stats(tables.ratings(spark, folder))
    return encode.quantile_bucket(stats, "ratingCount", "ratingCountBucket").select("movieId", "ratingCount", "ratingCountBucket")


@query
def min_max_scale(spark, folder):
    stats = samples.movie_rating_stats(tables.ratings(spark, folder))
    scaled = encode.min_max_scale(stats, "avgRating", "scaleAvgRating")
    return scaled.select("movieId", fn.rounded(F.col("scaleAvgRating"), 6).alias("scaleAvgRating"))


@query
def rating_feature_pipeline(spark, folder):
    result = encode.rating_feature_pipeline(tables.ratings(spark, folder))
    return result.select("movieId", "ratingCount", "ratingCountBucket", vector_to_array("scaleAvgRating")[0].alias("scaleAvgRating"))


@query
def identity_bucket(spark, folder):
    return tables.ratings(spark, folder).select(
        "userId", "movieId",
        encode.identity_bucket("movieId", encode.MOVIE_BUCKETS).alias("movieBucket"),
        encode.identity_bucket("userId", encode.USER_BUCKETS).alias("userBucket"),
    )


@query
def vocabulary_lookup(spark, folder):
    table = fer_table(spark, folder)
    names = rankers.GENRE_FEATURES
    return table.select("userId", "movieId", *[encode.vocabulary_code(c).alias(f"{c}Code") for c in names])


@query
def vocabulary(spark, folder):
    return encode.vocabulary(tables.user_item_records(spark, folder), rankers.RECORD_FEATURES)


@query
def learned_vocabulary_lookup(spark, folder):
    """Codes learned on the training split, looked up for all records."""
    records = tables.user_item_records(spark, folder)
    train, _ = split.random_split(records, ["user_id", "movie_id"], 0.8, SEED)
    learned = encode.vocabulary(train, ["movie_id", "user_zip_code"])
    coded = encode.learned_vocabulary_lookup(records, ["movie_id", "user_zip_code"], learned)
    return coded.select("user_id", "movie_id", "movie_idCode", "user_zip_codeCode")


@query
def crossed_feature(spark, folder):
    return fer_table(spark, folder).select(
        "userId", "movieId", "userRatedMovie1",
        encode.crossed_feature(["movieId", "userRatedMovie1"]).alias("crossed"),
    )


@query
def numeric_features(spark, folder):
    """The entries of the numeric vector under their names."""
    vector = encode.numeric_vector(fer_table(spark, folder))
    entries = vector_to_array("numeric")
    return vector.select("userId", "movieId", *[entries[i].alias(name) for i, name in enumerate(encode.NUMERIC_FEATURES)])


# ---- embeddings --------------------------------------------------------------------------------


@query
def item2vec(spark, folder):
    return embeddings.embedding_table(embeddings.item2vec(tables.ratings(spark, folder)))


@query
def embedding_table(spark, folder):
    """Length and squared norm of the item2vec vectors."""
    table = embeddings.embedding_table(embeddings.item2vec(tables.ratings(spark, folder)))
    square = F.aggregate("vector", F.lit(0.0), lambda total, v: total + v * v)
    return table.select("id", F.size("vector").alias("length"), square.alias("square"))


@query
def item2vec_synonyms(spark, folder):
    """Nearest movies of movie 158 in the item2vec space."""
    model = embeddings.item2vec(tables.ratings(spark, folder))
    return embeddings.synonyms(model, spark.createDataFrame([("158",)], "id string"))


@query
def window_pairs(spark, folder):
    """Counts of liked movies within five places of each other."""
    return embeddings.window_pairs(tables.ratings(spark, folder))


@query
def cooccurrence_vectors(spark, folder):
    """Item vectors from these counts, without a token table on the driver."""
    return embeddings.cooccurrence_vectors(embeddings.window_pairs(tables.ratings(spark, folder)))


@query
def embedding_mode_overlap(spark, folder):
    """Share of an item's 20 neighbours that both kinds of item vectors name."""
    rated = tables.ratings(spark, folder)
    walked = embeddings.embedding_table(embeddings.item2vec(rated))
    return embeddings.neighbour_overlap(walked, embeddings.cooccurrence_vectors(embeddings.window_pairs(rated)))


@query
def deepwalk_embeddings(spark, folder):
    return embeddings.embedding_table(embeddings.deepwalk_embeddings(tables.ratings(spark, folder)))


@query
def metapath_embeddings(spark, folder):
    rated, movies = tables.ratings(spark, folder), tables.movies(spark, folder)
    return embeddings.embedding_table(embeddings.metapath_embeddings(rated, movies))


@query
def embedding_cosine_topk(spark, folder):
    """The 20 vectors closest to the first vector of each label."""
    items = tables.table(spark, folder, "embeddings")
    first = items.groupBy("label").agg(F.min("vec_id").alias("vec_id"))
    queries = items.join(first, ["vec_id", "label"], "left_semi")
    found = embeddings.nearest_by_cosine(items, queries, 20, "vec_id", "embedding")
    return found.withColumn("cos", F.round("cos", 6))


@query
def lsh_buckets(spark, folder):
    return embeddings.lsh_buckets(tables.table(spark, folder, "embeddings"), "vec_id", vector="embedding")


@query
def lsh_neighbors(spark, folder):
    """About the 5 vectors nearest to the mean vector."""
    items = tables.table(spark, folder, "embeddings")
    mean = items.select(F.posexplode("embedding")).groupBy("pos").agg(F.avg("col").alias("m")).orderBy("pos")
    center = [row.m for row in mean.collect()]
    return embeddings.lsh_neighbors(items, center, 5, "vec_id", vector="embedding")


# ---- factors -----------------------------------------------------------------------------------


# Distance of two unit vectors whose cosine is 0.4.
NEAR = 1.0954


def _similar_vectors(spark, folder):
    """All embeddings at unit length, joined with each other."""
    def make():
        length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
        unit = tables.table(spark, folder, "embeddings").withColumn("length", length).where("length > 0").select(
            F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double") / F.col("length")).alias("vector"))
        return embeddings.similar_pairs(unit, NEAR, recall=0.9999, width=2)

    return _shared(spark, folder, "similar vectors", make)


@query
def lsh_similarity_join(spark, folder):
    """All pairs of embeddings near each other, found by shared hash buckets."""
    return _similar_vectors(spark, folder)[1].withColumn("distance", F.round("distance", 6))


@query
def lsh_join_audit(spark, folder):
    """What the join's audit counted, and whether the share of true pairs found is at least 0.9."""
    report = _similar_vectors(spark, folder)[2]
    return report.select("classes", "true_pairs", (F.col("found_pairs") >= 0.9 * F.col("true_pairs")).alias("enough"))


def _als(spark, folder):
    def make():
        train, test = split.random_split(tables.ratings(spark, folder), ["userId", "movieId"], 0.8, SEED)
        return factors.als_fit(train), test

    return _shared(spark, folder, "als", make)


@query
def als_fit(spark, folder):
    """Rank and table sizes of a fitted model."""
    model = _als(spark, folder)[0]
    counts = factors.als_factors(model).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("rank", F.lit(model.rank))


@query
def als_factors(spark, folder):
    return factors.als_factors(_als(spark, folder)[0])


@query
def als_predict(spark, folder):
    model, test = _als(spark, folder)
    return factors.als_predict(model, test)


@query
def als_rmse(spark, folder):
    model, test = _als(spark, folder)
    return metrics.rmse(factors.als_predict(model, test))


@query
def rmse(spark, folder):
    """Error of the movie's earlier mean rating as a prediction."""
    figure = metrics.rmse(fer_table(spark, folder), "rating", "movieAvgRating")
    return figure.withColumn("rmse", F.round("rmse", 6))


@query
def recommend_items_for_all_users(spark, folder):
    return factors.recommend_items_for_all_users(_als(spark, folder)[0])


@query
def recommend_users_for_all_items(spark, folder):
    return factors.recommend_users_for_all_items(_als(spark, folder)[0])


@query
def best_items_for_users(spark, folder):
    """Every user's ten best movies by bounded search."""
    return factors.best_items_for_users(_als(spark, folder)[0])[0]


@query
def best_users_for_items(spark, folder):
    return factors.best_users_for_items(_als(spark, folder)[0])[0]


@query
def scored_pairs(spark, folder):
    """How many of all pairs the two bounded searches multiply in full."""
    model = _als(spark, folder)[0]
    parts = [("user", factors.best_items_for_users), ("item", factors.best_users_for_items)]
    rows = [search(model)[1].select(F.lit(kind).alias("kind"), "pairs", "scored", (F.col("scored") / F.col("pairs")).alias("share"))
            for kind, search in parts]
    return rows[0].unionByName(rows[1])


@query
def largest_products(spark, folder):
    """The ten vectors of largest inner product with each vector."""
    vectors = tables.table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    best, _ = products.largest_products(vectors, vectors, 10)
    return best.withColumn("score", F.round("score", 5))


@query
def first_ids(spark, folder):
    return factors.first_ids(tables.ratings(spark, folder), "userId", 3)


@query
def recommend_for_user_subset(spark, folder):
    users = factors.first_ids(tables.ratings(spark, folder), "userId", 3)
    return factors.recommend_for_user_subset(_als(spark, folder)[0], users)


@query
def recommend_for_item_subset(spark, folder):
    items = factors.first_ids(tables.ratings(spark, folder), "movieId", 3)
    return factors.recommend_for_item_subset(_als(spark, folder)[0], items)


@query
def als_cross_validate(spark, folder):
    """Mean error over the folds of the training split."""
    train, _ = split.random_split(tables.ratings(spark, folder), ["userId", "movieId"], 0.8, SEED)
    return factors.als_cross_validate(train)


# ---- rankers -----------------------------------------------------------------------------------


def _ranker_sets(spark, folder):
    """Training and test features by time, planned once."""

    def make():
        train, test = split.time_split(fer_table(spark, folder), 0.8)
        return rankers.ranker_features(train, **ID_CODES), rankers.ranker_features(test, **ID_CODES)

    return _shared(spark, folder, "ranker-sets", make)


def _factor_sets(spark, folder):
    def make():
        train, test = _ranker_sets(spark, folder)
        model = factors.als_fit(train)
        return rankers.with_factors(train, model), rankers.with_factors(test, model)

    return _shared(spark, folder, "factor-sets", make)


def _fit_and_score(fit, sets):
    train, test = sets
    return rankers.score_batch(fit(train), test)


@query
def ctr_logistic(spark, folder):
    return _fit_and_score(rankers.ctr_logistic, _ranker_sets(spark, folder))


@query
def ctr_mlp(spark, folder):
    return _fit_and_score(rankers.ctr_mlp, _factor_sets(spark, folder))


@query
def ctr_wide_deep(spark, folder):
    return _fit_and_score(rankers.ctr_wide_deep, _factor_sets(spark, folder))


@query
def ctr_fm(spark, folder):
    return _fit_and_score(rankers.ctr_fm, _ranker_sets(spark, folder))


@query
def ctr_fm_full(spark, folder):
    return _fit_and_score(rankers.ctr_fm_full, _ranker_sets(spark, folder))


@query
def score_batch(spark, folder):
    """Scored test rows per predicted and actual label."""
    return ctr_logistic(spark, folder).groupBy("predicted", "label").agg(F.count(F.lit(1)).alias("n"))


@query
def ctr_logistic_metrics(spark, folder):
    """Metrics of the fitted logistic ranker on the test split."""
    return metrics.binary_metrics(ctr_logistic(spark, folder))


@query
def binary_metrics(spark, folder):
    """Metrics of the user's earlier mean rating, over 5, as a score."""
    scored = fer_table(spark, folder).select("label", (F.col("userAvgRating") / 5).alias("score"))
    figures = metrics.binary_metrics(scored)
    return figures.withColumns({c: F.round(c, 6) for c in ("log_loss", "accuracy", "roc_auc", "pr_auc")})


def _record_sets(spark, folder, buckets):
    records = tables.user_item_records(spark, folder)
    train, test = split.random_split(records, ["user_id", "movie_id"], 0.8, SEED)
    return rankers.record_features(train, buckets), rankers.record_features(test, buckets)


@query
def rating_cross_regression(spark, folder):
    """Test predictions with no, full and low-rank crosses of equal features."""
    result = None
    train, test = _record_sets(spark, folder, CROSS_FIELD_BUCKETS)
    for crosses in ("none", "full", "low_rank"):
        scored = rankers.rating_cross_regression(train, crosses).transform(test).select(
            F.lit(crosses).alias("crosses"), "user_id", "movie_id", "label", "prediction"
        )
        result = scored if result is None else result.unionByName(scored)
    return result


@query
def pair_interaction_strength(spark, folder):
    train, _ = _record_sets(spark, folder, 256)
    return rankers.pair_interaction_strength(rankers.rating_cross_regression(train, "low_rank"), 256)


@query
def repeated_runs(spark, folder):
    """Mean and deviation of the test RMSE over five seeds."""
    train, test = _record_sets(spark, folder, CROSS_FIELD_BUCKETS)
    runs = rankers.repeated_runs(train, test, ["none", "full", "low_rank"], 5)
    return metrics.metric_summary(runs, "crosses", "rmse")


@query
def metric_summary(spark, folder):
    """Mean and population deviation of the movie's earlier mean, per release year."""
    runs = fer_table(spark, folder).select("releaseYear", "movieAvgRating")
    summary = metrics.metric_summary(runs, "releaseYear", "movieAvgRating")
    return summary.withColumns({c: fn.rounded(F.col(c), 6) for c in ("mean", "stdv")})
