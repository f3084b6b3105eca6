"""Sequence and graph embeddings and neighbours among them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel, Word2Vec, Word2VecModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tastegraph.functions.columns import draw
from tastegraph.operators.blocks import BLOCK_ROWS as BUCKET_ROWS
from tastegraph.operators.blocks import block_pairs, dealt
from tastegraph.operators.graph import SEQUENCE_ROWS, user_sequences
from tastegraph.operators.ordering import HOT_ROWS, over_history
from tastegraph.operators.samples import USER_ORDER, positive_ratings
from tastegraph.operators.walks import random_walks, rating_metapath_walks
from tastegraph.session import durable

# Items and queries that meet in one task, about.
SHARD_ROWS, BLOCK_ROWS = 200_000, 1_000
# Blocks of queries that every item is sent to, unless there are more shards.
MOST_BLOCKS = 16
# Queries whose products with a shard are held at once.
ASKED_ROWS = 25
# Cosines of a row of which only the largest is looked at first.
RUN = 64
# Blocks that all items are dealt into when all are compared, unless they are so many that blocks get too large.
ALL_BLOCKS = 8


def fit_word2vec(
    corpus: DataFrame,
    column: str,
    size: int = 10,
    window: int = 5,
    iterations: int = 10,
    min_count: int = 5,
    partitions: int | None = None,
    seed: int = 42,
) -> Word2VecModel:
    """Skip-gram model of token arrays; each of ``partitions`` trains on its share of the sentences."""
    tokens = corpus.select(F.col(column).cast("array<string>").alias("tokens")).persist()
    partitions = partitions or corpus.sparkSession.sparkContext.defaultParallelism
    estimator = Word2Vec(
        vectorSize=size, windowSize=window, maxIter=iterations, minCount=min_count,
        numPartitions=partitions, seed=seed, inputCol="tokens", outputCol="mean",
    )
    try:
        return estimator.fit(tokens)
    finally:
        tokens.unpersist()


def item2vec(
    ratings: DataFrame, min_rating: float = 3.5, window: int = 5, part_rows: int = SEQUENCE_ROWS, **options
) -> Word2VecModel:
    """Parts of a long history overlap by the window, so every pair within it is trained on."""
    sequences = user_sequences(ratings, min_rating, part_rows, overlap=window)
    return fit_word2vec(sequences, "movieIds", window=window, **options)


def deepwalk_embeddings(ratings: DataFrame, walks: int = 20_000, length: int = 10, seed: int = 42, **options) -> Word2VecModel:
    return fit_word2vec(random_walks(ratings, walks, length, seed), "nodes", seed=seed, **options)


def metapath_embeddings(ratings: DataFrame, movies: DataFrame, paths=None, seed: int = 42, **options) -> Word2VecModel:
    """Items, users and genres in one space."""
    return fit_word2vec(rating_metapath_walks(ratings, movies, paths, seed), "nodes", seed=seed, **options)


def window_pairs(ratings: DataFrame, window: int = 5, min_rating: float = 3.5, hot_rows: int = HOT_ROWS) -> DataFrame:
    """How often two liked movies stand within ``window`` places of each other in a user's history: (src, dst, cnt), both ways.

    Each movie looks back at most ``window`` rows, so a long history is cut like any other (``over_history``).
    """

    def add(rows: DataFrame, order: WindowSpec) -> DataFrame:
        return rows.withColumn("_near", F.array(*[F.lag("movieId", k).over(order) for k in range(1, window + 1)]))

    liked = positive_ratings(ratings, min_rating).select("userId", "movieId", "timestamp")
    seen = over_history(liked, "userId", USER_ORDER, window, add, hot_rows)
    pairs = seen.select(F.col("movieId").alias("dst"), F.explode("_near").alias("src")).filter("src is not null and src <> dst")
    both = F.array(F.struct(F.col("src").alias("src"), F.col("dst").alias("dst")), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return pairs.select(F.inline(both)).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("cnt"))


def cooccurrence_vectors(
    pairs: DataFrame, size: int = 10, iterations: int = 10, min_count: int = 1, alpha: float = 4.0, reg: float = 0.05, seed: int = 42
) -> DataFrame:
    """(id, vector): item vectors from pair counts, by implicit ALS on their logarithms.

    Unlike ``fit_word2vec`` no vocabulary and no vectors reach the driver: the factor table stays distributed, whatever the
    number of items. Ids are 32-bit. Only pairs seen ``min_count`` times and more count.
    """
    kept = pairs.filter(F.col("cnt") >= min_count).select(
        F.col("src").cast("int").alias("src"), F.col("dst").cast("int").alias("dst"), F.log1p("cnt").cast("float").alias("weight"))
    model = ALS(
        rank=size, maxIter=iterations, regParam=reg, alpha=alpha, implicitPrefs=True, userCol="src", itemCol="dst", ratingCol="weight", seed=seed,
    ).fit(kept)
    return model.itemFactors.select(F.col("id").cast("string").alias("id"), F.col("features").alias("vector"))


def neighbour_overlap(first: DataFrame, second: DataFrame, k: int = 20) -> DataFrame:
    """(items, overlap): of the ``k`` nearest items in one table the mean share that the other one names too, over common items."""
    common = first.select("id").join(second.select("id"), "id")
    lists = [nearest_by_cosine(t, t, k).select("query", "id") for t in (durable(t.join(common, "id", "left_semi")) for t in (first, second))]
    shared = lists[0].join(lists[1], ["query", "id"]).agg(F.count(F.lit(1)).alias("both"))
    count = common.count()
    each = max(min(k, count - 1), 1)
    return shared.select(F.lit(count).cast("bigint").alias("items"), (F.col("both") / F.lit(max(count * each, 1))).alias("overlap"))


def embedding_table(model: Word2VecModel) -> DataFrame:
    """(id, vector) with the vector as ``array<float>``, written once: a model's own table would be sent from the driver at every use."""
    return durable(model.getVectors().select(F.col("word").alias("id"), vector_to_array("vector", "float32").alias("vector")))


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    rows = np.stack(vectors.to_numpy()).astype("float64")
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)


def _as_good(cos: np.ndarray, n: int) -> np.ndarray:
    """Where the ``n`` best are, and what is as good as the last of them, perhaps some more.

    In a long row the ``n``-th best of the largest of each run is a bound that ``n`` of all reach. A run is every so many entries.
    """
    if len(cos) >= 4 * n * RUN:
        tops = cos[:len(cos) // RUN * RUN].reshape(RUN, -1).max(axis=0)
        if not np.isnan(tops).any():
            return np.flatnonzero(~(cos < np.partition(tops, -n)[-n]))
    return np.flatnonzero(~(-cos > np.partition(-cos, n - 1)[n - 1]))


def _first(query, ids: np.ndarray, cos: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, id and cosine of the ``k`` best others, ties to the smaller id; only what is as good as the last one is sorted."""
    near = np.arange(len(ids))
    if len(ids) > k + 1:  # one more than asked for: the query is likely to be among them
        near = _as_good(cos, k + 1)
    near = near[ids[near] != query]
    if len(near) < k:  # several rows of the query
        near = np.flatnonzero(ids != query)
    order = near[np.lexsort((ids[near], -cos[near]))[:k]]
    return np.full(len(order), query, ids.dtype), ids[order], cos[order]


def nearest_by_cosine(
    items: DataFrame, queries: DataFrame, k: int = 20, item: str = "id", vector: str = "vector",
    shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` items closest to each query vector, other than itself: (query, id, cos, rank).

    ``queries`` has the columns of ``items`` and any number of rows. Items fall into shards and queries into blocks by
    a hash of their id; every task scores one shard against one block as one matrix product and passes on only the best
    ``k`` per query, of which the best are picked afterwards. Every item is sent to every block, so there are no more
    blocks than shards, or ``MOST_BLOCKS``, and blocks grow. Sizes change the work, not the result.
    """
    kind = dict(items.dtypes)[item]
    shards = -(-items.count() // shard_rows) or 1
    asked_rows = queries.count()
    blocks = max(min(-(-asked_rows // block_rows) or 1, max(shards, MOST_BLOCKS)), -(-asked_rows // max(shard_rows, block_rows)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    number = lambda n: F.pmod(F.xxhash64(item), F.lit(n)).cast("int")
    held = items.select(item, vector, number(shards).alias("_shard"), every(blocks).alias("_block"))
    asked = queries.select(F.col(item).alias("query"), F.col(vector).alias("_asked"), number(blocks).alias("_block"), every(shards).alias("_shard"))

    def best_of_shard(own: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(own) and len(wanted):
            ids, vectors, names = own[item].to_numpy(), _unit_rows(own[vector]).T, wanted["query"].to_numpy()
            asked = _unit_rows(wanted["_asked"])
            room = np.empty((min(ASKED_ROWS, len(asked)), len(ids)))
            for at in range(0, len(asked), ASKED_ROWS):
                part = asked[at:at + ASKED_ROWS]
                cos = np.matmul(part, vectors, out=room[:len(part)])
                found += [_first(query, ids, row, k) for query, row in zip(names[at:at + ASKED_ROWS], cos)]
        return pd.DataFrame({c: np.concatenate([f[i] for f in found]) if found else [] for i, c in enumerate(("query", "id", "cos"))})

    scored = held.groupBy("_shard", "_block").cogroup(asked.groupBy("_shard", "_block")).applyInPandas(
        best_of_shard, f"query {kind}, id {kind}, cos double")
    best = Window.partitionBy("query").orderBy(F.desc("cos"), "id")
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def synonyms(model: Word2VecModel, queries: DataFrame, k: int = 20) -> DataFrame:
    """Nearest tokens of each query token (column ``id``); unknown tokens give no rows."""
    table = embedding_table(model)
    known = table.join(queries.select(F.col("id").cast("string")).distinct(), "id", "left_semi")
    return nearest_by_cosine(table, known, k)


def fit_lsh(
    items: DataFrame, bucket_length: float = 0.1, tables: int = 3, seed: int = 42, vector: str = "vector"
) -> tuple[BucketedRandomProjectionLSHModel, DataFrame]:
    """Random-projection hash model and the items with their ``bucketId``."""
    dense = items.withColumn("emb", array_to_vector(F.col(vector).cast("array<double>")))
    model = BucketedRandomProjectionLSH(
        inputCol="emb", outputCol="bucketId", bucketLength=bucket_length, numHashTables=tables, seed=seed
    ).fit(dense)
    return model, model.transform(dense)


def lsh_buckets(items: DataFrame, item: str = "id", **options) -> DataFrame:
    """Bucket numbers per item: (item, buckets array<bigint>)."""
    _, hashed = fit_lsh(items, **options)
    return hashed.select(
        item, F.transform("bucketId", lambda v: vector_to_array(v)[0].cast("bigint")).alias("buckets")
    )


def lsh_neighbors(items: DataFrame, query: list[float], k: int = 5, item: str = "id", **options) -> DataFrame:
    """About the ``k`` items nearest to a vector by Euclidean distance: (item, distance)."""
    model, hashed = fit_lsh(items, **options)
    found = model.approxNearestNeighbors(hashed, DenseVector(query), k, distCol="distance")
    return found.select(item, "distance")


def vector_classes(items: DataFrame, item: str = "id", vector: str = "vector") -> DataFrame:
    """(item, classId, members): items with equal vectors, named by the smallest id. Items without a vector are left out."""
    known = items.select(item, vector).dropna()
    named = known.groupBy(vector).agg(F.min(item).alias("classId"), F.count(F.lit(1)).alias("members"))
    return known.join(named, vector).select(item, "classId", "members")


def _collision(distance: float, bucket_length: float) -> float:
    """Probability that one random projection puts two vectors at this distance into the same bucket."""
    c = bucket_length / distance
    return math.erf(c / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * c) * (1 - math.exp(-c * c / 2))


def _true_pairs(items: DataFrame, asked: DataFrame, max_distance: float, item: str, vector: str) -> DataFrame:
    """(low, high) of all pairs of an asked item and any other item within the distance; few items are asked."""
    sample = asked.select(item, vector).toPandas()
    names, rows = sample[item].to_numpy(), np.stack(sample[vector].to_numpy()).astype(float) if len(sample) else None

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own, mine = batch[item].to_numpy(), np.stack(batch[vector].to_numpy()).astype(float)
            for name, row in zip(names, rows, strict=True):
                hit = own[(np.sqrt(((mine - row) ** 2).sum(axis=1)) <= max_distance) & (own != name)]
                yield pd.DataFrame({"low": np.minimum(hit, name), "high": np.maximum(hit, name)})

    kind = dict(items.dtypes)[item]
    if rows is None:
        return items.sparkSession.createDataFrame([], f"low {kind}, high {kind}")
    return items.select(item, vector).mapInPandas(near, f"low {kind}, high {kind}").distinct()


def similar_pairs(
    items: DataFrame,
    max_distance: float,
    recall: float = 0.95,
    width: int = 4,
    bucket_length: float | None = None,
    audit: int = 200,
    block_rows: int = BUCKET_ROWS,
    item: str = "id",
    vector: str = "vector",
    seed: int = 42,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All items near each other by Euclidean distance: classes, pairs of classes, report.

    Items with equal vectors form a class (``vector_classes``) and only classes meet, so many copies make no pairs. Two classes
    meet if all ``width`` projections of one of the hash tables put them into the same bucket; large buckets are dealt into
    blocks. There are as many tables as give ``recall`` for pairs at the full distance. Distances of what met are exact. Pairs
    are (low, high, distance) of integral ids, each once.

    ``audit`` classes, chosen by a hash of their id, are compared with all others. While less of their true pairs than
    ``recall`` was found, the tables are doubled; when they would be more than 16 times the first number, all classes are
    compared block by block. The report has one row: (classes, tables, true_pairs, found_pairs), tables 0 for the last way.
    """
    classes = durable(vector_classes(items, item, vector))
    leaders = durable(items.join(classes.where(F.col(item) == F.col("classId")).select(item), item, "left_semi").select(item, vector).dropna())
    count, spark = leaders.count(), items.sparkSession
    length = bucket_length or 2 * max_distance
    chance = _collision(max_distance, length) ** width
    first = tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - chance))) if chance < 1 else 1
    asked = leaders.orderBy(draw("audit", F.col(item)), item).limit(audit)
    truth = durable(_true_pairs(leaders, asked, max_distance, item, vector))
    true_pairs = truth.count()
    while True:
        hashed = _hashed(leaders, length, tables, width, item, vector, seed) if count and tables <= 16 * first else None
        if hashed is None or _met_in_buckets(hashed) >= count * count:
            tables, pairs = 0, durable(_all_pairs(leaders, count, max_distance, block_rows, item, vector))
        else:
            pairs = durable(_met_pairs(durable(hashed), max_distance, block_rows, item, vector))
        found = truth.join(pairs, ["low", "high"], "left_semi").count()
        if not tables or found >= recall * true_pairs:
            break
        tables *= 2
    report = spark.createDataFrame([(count, tables, true_pairs, found)], "classes long, tables int, true_pairs long, found_pairs long")
    return classes, pairs, report


def _hashed(leaders: DataFrame, length: float, tables: int, width: int, item: str, vector: str, seed: int) -> DataFrame:
    """(item, vector, buckets): the bucket in each hash table, a hash of ``width`` projections."""
    _, hashed = fit_lsh(leaders, length, tables * width, seed, vector)
    parts = F.transform("bucketId", lambda v: vector_to_array(v)[0].cast("bigint"))
    keys = [F.xxhash64(F.slice("_parts", t * width + 1, width)) for t in range(tables)]
    return hashed.withColumn("_parts", parts).select(item, vector, F.array(*keys).alias("buckets"))


def _met_in_buckets(hashed: DataFrame) -> float:
    """How many ordered pairs of rows share a bucket, counted in each table."""
    sizes = hashed.select(F.posexplode("buckets").alias("table", "bucket")).groupBy("table", "bucket").count()
    return sizes.agg(F.sum(F.col("count").cast("double") * F.col("count"))).first()[0] or 0.0


def _all_pairs(leaders: DataFrame, count: int, max_distance: float, block_rows: int, item: str, vector: str) -> DataFrame:
    """(low, high, distance) of all rows near each other, each pair compared once.

    Rows are dealt into blocks, and each two blocks meet in one task as matrix products of ``ASKED_ROWS`` rows; what these
    cannot rule out gets its exact distance. A row is sent once per block, so blocks are few: ``ALL_BLOCKS``, or as many as
    hold them to ``SHARD_ROWS`` rows.
    """
    blocks = max(-(-count // SHARD_ROWS), min(ALL_BLOCKS, -(-count // block_rows)), 1)
    kind = leaders.schema[item].dataType.simpleString()

    def near(cell: pd.DataFrame) -> pd.DataFrame:
        rows = np.stack(cell["_v"].to_numpy()).astype(float)
        known = np.isfinite(rows).all(axis=1)
        rows, ids, block = rows[known], cell["_id"].to_numpy()[known], cell["_block"].to_numpy()[known]
        low, high = (np.flatnonzero(block == cell[side].iloc[0]) for side in ("low", "high"))
        square = (rows * rows).sum(axis=1)
        limit = max_distance * max_distance + 1e-9 * (1 + 2 * square.max(initial=0))
        own, found = rows[high].T, []
        for at in range(0, len(low), ASKED_ROWS):
            asked = low[at:at + ASKED_ROWS]
            i, j = np.nonzero(square[asked][:, None] + square[high] - 2 * (rows[asked] @ own) <= limit)
            i, j = asked[i], high[j]
            if cell["low"].iloc[0] == cell["high"].iloc[0]:
                i, j = i[ids[i] < ids[j]], j[ids[i] < ids[j]]
            total = np.zeros(len(i))
            for column in rows.T:  # in the order of the entries, as a sum over the arrays goes
                total += (column[i] - column[j]) ** 2
            distance = np.sqrt(total)
            hit = distance <= max_distance
            found.append((np.minimum(ids[i], ids[j])[hit], np.maximum(ids[i], ids[j])[hit], distance[hit]))
        return pd.DataFrame({c: np.concatenate([f[k] for f in found]) if found else [] for k, c in enumerate(("low", "high", "distance"))})

    dealt_out = leaders.select(
        F.col(item).alias("_id"), F.col(vector).cast("array<double>").alias("_v"), F.pmod(F.xxhash64(item), F.lit(blocks)).cast("int").alias("_block"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    cells = dealt_out.withColumn("_other", every).select(
        "_id", "_v", "_block", F.least("_block", "_other").alias("low"), F.greatest("_block", "_other").alias("high"))
    # the rows are few and their pairs many: keep all partitions
    parts = int(leaders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cells.repartition(parts, "low", "high").groupBy("low", "high").applyInPandas(near, f"low {kind}, high {kind}, distance double")


def _met_pairs(hashed: DataFrame, max_distance: float, block_rows: int, item: str, vector: str) -> DataFrame:
    """(low, high, distance) of the rows that share a bucket and are near enough; a pair counts in the first table it shares."""
    spread = hashed.select(
        F.col(item).alias("id"), F.col(vector).cast("array<double>").alias("v"), "buckets", F.posexplode("buckets").alias("table", "bucket"))
    left, right = block_pairs(dealt(spread, ["table", "bucket"], "id", block_rows))
    # the rows are few and their pairs many: keep all partitions
    parts = int(hashed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a, b = (side.repartition(parts, "table", "bucket", "low", "high").alias(name) for side, name in ((left, "a"), (right, "b")))
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("table", "bucket", "low", "high")]
    once = (F.col("a.low") < F.col("a.high")) | (F.col("a.id") < F.col("b.id"))
    shared = F.array_position(F.zip_with("a.buckets", "b.buckets", lambda x, y: x == y), F.lit(True)) == F.col("a.table") + 1
    distance = F.sqrt(F.aggregate(F.zip_with("a.v", "b.v", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    met = a.join(b, same[0] & same[1] & same[2] & same[3] & once & shared)
    near = met.select(F.least("a.id", "b.id").alias("low"), F.greatest("a.id", "b.id").alias("high"), distance.alias("distance"))
    return near.where(F.col("distance") <= max_distance)
