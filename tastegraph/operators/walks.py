"""Seeded random walks over typed graphs.

Edges are kept as occurrences and numbered within (source, target type); drawing a number below the
group's size picks a target with probability proportional to its count. Number and type make up a slot, and
a step is an equi-join on (source, slot): each walker meets one row, whatever the degree of its node, and
hubs are spread by the slot. Where far more walkers arrive than there are edges to leave by, the edges are
repeated under further slots, so that the walkers of one node never meet in one task.

The numbered edges are a table bucketed by (source, slot): they are shuffled once, when it is written. A step
moves the frontier alone, one row for each walker that still goes: it is sent to the edges while it is small,
else shuffled to their buckets. Every step writes the nodes it reached as rows, so no walk is carried along, and
a step begins only if some walker is left.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tastegraph.functions.columns import draw
from tastegraph.operators.graph import item_edges, meta_edge_rows
from tastegraph.operators.ordering import HOT_ROWS, positions, running_total
from tastegraph.session import durable, shared_folder

# Letters of a path and the node types they stand for.
NODE_TYPES = {"i": "item", "u": "user", "g": "genre"}
TYPE_CODES = {name: code for code, name in enumerate(NODE_TYPES.values())}
# The standard mix of paths and the number of walks on each.
METAPATHS = [
    ("uiiuiiuiiu", 20_000), ("igiuigiuigi", 10_000), ("iiuiigiiuii", 10_000),
    ("iiiiiiiiiii", 30_000), ("iiiuiiiuiii", 30_000),
]


# So many walkers, a node and four numbers each, are sent to the edges; more are shuffled to them.
SENT_WALKERS = 200_000


def _by_letter(letter: Column, values: dict[str, Column]) -> Column:
    return reduce(lambda chain, kv: chain.when(letter == kv[0], kv[1]), values.items(), F)


SIZES = [f"to_{name}" for name in TYPE_CODES]


def node_sizes(edges: DataFrame) -> DataFrame:
    """Per node the edges leaving to each type and ``came``, the edges arriving."""
    ends = F.array(
        F.struct(F.col("src").alias("node"), F.col("dst_type").alias("to"), F.lit(0).alias("came")),
        F.struct(F.col("dst").alias("node"), F.lit(None).cast("string").alias("to"), F.lit(1).alias("came")),
    )
    return edges.select(F.inline(ends)).groupBy("node").agg(
        *[F.count_if(F.col("to") == name).alias(f"to_{name}") for name in TYPE_CODES],
        F.sum("came").alias("came"),
    )


def _copies(came: Column, offered: Column, hot_rows: int) -> Column:
    """How often the edges of a group are repeated: about one copy per ``hot_rows`` arrivals per edge."""
    return F.greatest(F.ceil(came / (offered * F.lit(hot_rows))), F.lit(1)).cast("bigint")


def numbered_edges(edges: DataFrame, nodes: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Edges numbered within (src, dst_type), each with the sizes of its target."""
    numbered = positions(edges, ["src", "dst_type"], ["dst", "tie"], "pos", hot_rows)
    code = _by_letter(F.col("dst_type"), {name: F.lit(code) for name, code in TYPE_CODES.items()})
    offered = _by_letter(F.col("dst_type"), {name: F.col(f"to_{name}") for name in TYPE_CODES})
    crowded = nodes.filter(F.col("came") > hot_rows)
    if crowded.isEmpty():
        numbered = numbered.withColumns({"copies": F.lit(1).cast("bigint"), "copy": F.lit(0).cast("bigint")})
    else:
        numbered = (
            numbered.join(crowded.withColumnRenamed("node", "src"), "src", "left")
            .withColumn("copies", F.coalesce(_copies(F.col("came"), offered, hot_rows), F.lit(1)))
            .drop(*SIZES, "came")
            .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)))
        )
    return (
        numbered.join(nodes.withColumnRenamed("node", "dst"), "dst")
        .withColumn("slot", (F.col("pos") * F.col("copies") + F.col("copy")) * len(TYPE_CODES) + code)
        .select("src", "slot", "src_type", "dst_type", "pos", "copy", "dst", *SIZES, "came")
    )


def edge_store(numbered: DataFrame) -> str:
    """Writes numbered edges as a table of the session's catalog, its files in the shared folder; returns its name.

    There is one bucket, and one file, per shuffle partition: a join on (src, slot) finds the edges where they are.
    """
    spark = numbered.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"edges_{uuid.uuid4().hex}"
    (
        numbered.repartition(buckets, "src", "slot").write.format("parquet")
        .bucketBy(buckets, "src", "slot").sortBy("src", "slot")
        .option("path", f"{shared_folder(spark).rstrip('/')}/{name}").saveAsTable(name)
    )
    return name


def start_ranges(edges: DataFrame) -> DataFrame:
    """Per start type the nodes and the places they take: ``n`` of them from ``before`` on, one for each item that follows.

    Items stand in proportion to their outgoing item pairs, users to their positive ratings.
    """
    leaving = edges.filter(F.col("src_type").isin("item", "user") & (F.col("dst_type") == "item"))
    sizes = leaving.groupBy("src_type", F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("n"))
    return durable(running_total(sizes, {"before": F.col("n")}, ["node"], ["src_type"]))


def _starts(spark, ranges: DataFrame, nodes: DataFrame, paths: list[tuple[str, int]], seed: int) -> DataFrame | None:
    """(path_id, walk, node and its sizes) of all walks; None if there is nowhere to start.

    A place lies in one node's range. Ranges and places meet by bins about as wide as the average range.
    """
    totals = {r.src_type: (r.places, r.nodes) for r in ranges.groupBy("src_type").agg(
        F.sum("n").alias("places"), F.count(F.lit(1)).alias("nodes")).collect()}
    parts, widths = [], {kind: max(places // count, 1) for kind, (places, count) in totals.items()}
    for path_id, (path, count) in enumerate(paths):
        start = "item" if path[0] == "i" else "user"
        if start in totals:
            place = F.pmod(draw(str(seed), path_id, F.col("id"), 0), F.lit(totals[start][0]))
            parts.append(spark.range(count).select(
                F.lit(path_id).alias("path_id"), F.col("id").alias("walk"), F.lit(start).alias("src_type"), place.alias("place"),
                F.floor(place / widths[start]).alias("bin")))
    if not parts:
        return None
    width = _by_letter(F.col("src_type"), {kind: F.lit(w) for kind, w in widths.items()})
    bins = ranges.withColumn("bin", F.explode(F.sequence(F.floor(F.col("before") / width), F.floor((F.col("before") + F.col("n") - 1) / width))))
    met = reduce(DataFrame.unionByName, parts).join(bins, ["src_type", "bin"])
    inside = (F.col("place") >= F.col("before")) & (F.col("place") < F.col("before") + F.col("n"))
    return met.filter(inside).select("path_id", "walk", "node").join(nodes, "node").select("path_id", "walk", "node", *SIZES, "came")


def _next_slot(paths: list[tuple[str, int]], seed: int, step: int, hot_rows: int) -> Column:
    """Slot of the edge that a walker at its node takes in ``step``; null where the path or the graph ends."""
    letter = F.substring(F.get(F.array(*[F.lit(path) for path, _ in paths]), F.col("path_id")), step + 1, 1)
    offered = F.nullif(_by_letter(letter, {k: F.col(f"to_{v}") for k, v in NODE_TYPES.items()}), F.lit(0))
    code = _by_letter(letter, {k: F.lit(TYPE_CODES[v]) for k, v in NODE_TYPES.items()})
    number = F.pmod(draw(str(seed), F.col("path_id"), F.col("walk"), step), offered)
    copies = _copies(F.col("came"), offered, hot_rows)
    return (number * copies + F.pmod(F.col("walk"), copies)) * len(TYPE_CODES) + code


def _reached(rows: DataFrame, slot: Column, path: str) -> tuple[DataFrame, int]:
    """(path_id, walk, node, next), written, and how many of these walkers go on. The sizes of a node are left behind."""
    seen = Observation()
    rows = rows.select("path_id", "walk", "node", slot.alias("next"))
    rows.observe(seen, F.count("next").alias("left")).write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), seen.get["left"]


def walk_visits(
    edges: DataFrame,
    paths: list[tuple[str, int]] | None = None,
    seed: int = 42,
    hot_rows: int = HOT_ROWS,
    sent_walkers: int = SENT_WALKERS,
) -> DataFrame:
    """Walks along type patterns, a row per visited node: (path_id, path, walk, step, node).

    ``paths`` lists (pattern, number of walks). Patterns starting with ``i`` start at an item in
    proportion to its outgoing item pairs, others at a user in proportion to the user's positive ratings.
    A walk stops early where its node has no neighbour of the wanted type. Frontiers of up to ``sent_walkers``
    rows are sent to the edges.
    """
    paths = METAPATHS if paths is None else paths
    for path, _ in paths:
        if not path or set(path) - set(NODE_TYPES):
            raise ValueError(f"unknown node type in path {path!r}")
    spark = edges.sparkSession
    edges = durable(edges)
    nodes = durable(node_sizes(edges))
    starts = _starts(spark, start_ranges(edges), nodes, paths, seed)
    if starts is None:
        return spark.createDataFrame([], "path_id int, path string, walk bigint, step int, node string")
    folder = f"{shared_folder(spark).rstrip('/')}/walks-{uuid.uuid4().hex}"
    frontier, left = _reached(starts, _next_slot(paths, seed, 1, hot_rows), f"{folder}/0")
    visits = [frontier]
    store = None
    try:
        while left:
            store = store or edge_store(numbered_edges(edges, nodes, hot_rows))
            step = len(visits)
            moved = _step(spark.table(store), frontier, left <= sent_walkers)
            frontier, left = _reached(moved, _next_slot(paths, seed, step + 1, hot_rows), f"{folder}/{step}")
            visits.append(frontier)
    finally:
        if store:
            spark.sql(f"DROP TABLE {store}")  # its files stay in the shared folder
    names = F.array(*[F.lit(path) for path, _ in paths])
    return reduce(DataFrame.unionByName, [
        rows.select("path_id", F.get(names, F.col("path_id")).alias("path"), "walk", F.lit(step).alias("step"), "node")
        for step, rows in enumerate(visits)])


def _step(store: DataFrame, frontier: DataFrame, send: bool) -> DataFrame:
    """Each walker that goes on at the end of its edge. Edges stay in their buckets; only walkers move."""
    waiting = frontier.filter("next is not null").select("path_id", "walk", F.col("node").alias("_at"), "next")
    waiting = F.broadcast(waiting) if send else waiting.hint("shuffle_hash")
    met = store.select("src", "slot", F.col("dst").alias("node"), *SIZES, "came").join(
        waiting, (F.col("src") == F.col("_at")) & (F.col("slot") == F.col("next")))
    return met.select("path_id", "walk", "node", *SIZES, "came")


def metapath_walks(
    edges: DataFrame,
    paths: list[tuple[str, int]] | None = None,
    seed: int = 42,
    hot_rows: int = HOT_ROWS,
    sent_walkers: int = SENT_WALKERS,
) -> DataFrame:
    """Walks along type patterns, a row per walk: (path_id, path, walk, nodes); see ``walk_visits``."""
    visits = walk_visits(edges, paths, seed, hot_rows, sent_walkers)
    ordered = F.sort_array(F.collect_list(F.struct("step", "node")))
    return visits.groupBy("path_id", "path", "walk").agg(ordered["node"].alias("nodes"))


def random_walks(
    ratings: DataFrame, walks: int = 20_000, length: int = 10, seed: int = 42, min_rating: float = 3.5
) -> DataFrame:
    """Walks over the item graph: (walk, nodes)."""
    return metapath_walks(item_edges(ratings, min_rating), [("i" * length, walks)], seed).select("walk", "nodes")


def rating_metapath_walks(
    ratings: DataFrame,
    movies: DataFrame,
    paths: list[tuple[str, int]] | None = None,
    seed: int = 42,
    min_rating: float = 3.5,
) -> DataFrame:
    """Walks over the user-item-genre graph of a rating table."""
    return metapath_walks(meta_edge_rows(ratings, movies, min_rating), paths, seed)


def walk_steps(walks: DataFrame) -> DataFrame:
    """One row per visited node, ``step`` from 0."""
    others = [c for c in walks.columns if c != "nodes"]
    return walks.select(*others, F.posexplode("nodes").alias("step", "node"))
