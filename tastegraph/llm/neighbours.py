"""Near-duplicate vectors by NN-descent, with links at a cosine threshold.

1. Equal vectors are one class. Classes within half the threshold's angle of a leader form its ball: any two of them
   are within the whole angle, so they are linked without a comparison, however many they are. Balls are found by
   random projections: neighbours in projected order meet in leaves of bounded size, round after round, until none
   is absorbed any more.
2. Over the leaders NN-descent refines a neighbour graph: it starts from neighbours in the leaves of several
   projections, and in each round the neighbours of every node, in either direction, are compared with each other
   and better ones kept. A node whose list holds only neighbours that matter is saturated and gets a list twice as
   long; one whose list is as long as lists get is compared with all leaders instead. Rounds end when no neighbour that
   matters was found, no list is saturated, and a sample of nodes compared with all leaders shows the recall that is
   asked for. After the last round saturated nodes, and all if recall is too low, are compared with all leaders.
3. Pairs of balls are wholly linked, not at all, or decided member by member, as their angle and radii say.

Links follow from exact cosines in double precision. A pair can be missed only if the graph lacks an edge between
their balls, which is what the audit measures; a pair below the threshold is never linked.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.llm.common import components, written

#: Neighbours of a node at first, projections the graph starts from, and rows that meet in a leaf.
NEIGHBOURS, STARTS, LEAF = 10, 3, 512
#: Rounds that look for balls, at most; their number only changes the work, never the links.
BALL_ROUNDS = 8
#: Nodes that the audit compares with all leaders at first and at most, true neighbours it looks for, the recall below which the search goes on.
AUDIT_NODES, AUDIT_MOST, AUDIT_FOUND, AUDIT_RECALL = 200, 12_800, 300, 0.98
#: Rounds of the search, the longest list in it, and rows of a block when nodes are compared with all leaders.
ROUNDS, LONGEST, EXACT = 12, 320, 2048
#: Cosines that the audit holds at once.
AUDIT_CELLS = 4 << 20
#: Rows of a block when members of two balls are compared, and numbers that spread the rows of one vector.
BLOCK, SALTS = 256, 8
#: Angles this close to a limit are decided by comparing members.
MARGIN = 1e-7


def usable(vector: Column) -> Column:
    """Not null, all components finite, and not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: pa.Array) -> np.ndarray:
    """Rows of length one in double precision; shorter vectors are filled with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = pa.concat_arrays(vectors.chunks) if vectors.num_chunks else pa.array([], vectors.type)
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), int(lengths.max(initial=1))))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    out /= np.abs(out).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return np.pad(a, ((0, 0), (0, width - a.shape[1]))), np.pad(b, ((0, 0), (0, width - b.shape[1])))


def angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


def projected(nodes: DataFrame, seed: int) -> DataFrame:
    """The nodes in the order of a random projection: sign bits of 16 directions, then the place along another."""
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = unit(batch.column(1))
            directions = np.random.default_rng(seed).standard_normal((17, v.shape[1])).T
            on = v @ directions
            code = ((on[:, :16] > 0) * (1 << np.arange(16))).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(code.astype(np.int32)), pa.array(on[:, 16])], names=[*batch.schema.names, "code", "along"])

    kind = nodes.schema["vector"].dataType.simpleString()
    keyed = nodes.select("node", "vector", "radius").mapInArrow(project, f"node long, vector {kind}, radius double, code int, along double")
    return keyed.repartitionByRange("code", "along", "node").sortWithinPartitions("code", "along", "node")


def leaves(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Consecutive rows of a partition, ``size`` at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - rows)
            batch = batch.slice(part.num_rows)
            held.append(part)
            rows += part.num_rows
            if rows == size:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def absorbed(nodes: DataFrame, reach: float, seed: int) -> DataFrame:
    """(node, vector, parent, radius): in each leaf a node takes in those whose balls fit within ``reach`` of it."""
    def absorb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for leaf in leaves(batches, LEAF):
            v = unit(leaf["vector"])
            node, radius = leaf["node"].to_numpy(), leaf["radius"].to_numpy().copy()
            apart = angle(v @ v.T)
            parent, free = np.arange(len(node)), np.ones(len(node), bool)
            for i in range(len(node)):
                if not free[i]:
                    continue
                free[i] = False
                taken = np.flatnonzero(free & (apart[i] + radius <= reach))
                if len(taken):
                    parent[taken], free[taken] = i, False
                    radius[i] = max(radius[i], (apart[i, taken] + radius[taken]).max())
            yield pa.RecordBatch.from_arrays(
                [leaf["node"].combine_chunks(), leaf["vector"].combine_chunks(), pa.array(node[parent]), pa.array(radius)],
                names=["node", "vector", "parent", "radius"])

    kind = nodes.schema["vector"].dataType.simpleString()
    return projected(nodes, seed).mapInArrow(absorb, f"node long, vector {kind}, parent long, radius double")


def balls(nodes: DataFrame, reach: float) -> tuple[DataFrame, DataFrame]:
    """(node, vector, radius) of the leaders, and (node, leader) of all nodes."""
    leaders = nodes.select("node", "vector", F.lit(0.0).alias("radius"))
    owner = nodes.select("node", F.col("node").alias("leader"))
    for k in range(BALL_ROUNDS):
        step = written(absorbed(leaders, reach, 1000 + k), "balls")
        leaders = step.where("node = parent").select("node", "vector", "radius")
        if step.where("node <> parent").isEmpty():
            break
        up = step.where("node <> parent").select(F.col("node").alias("leader"), "parent")
        owner = written(owner.join(up, "leader", "left").select("node", F.coalesce("parent", "leader").alias("leader")), "owners")
    return leaders, owner


def first_graph(leaders: DataFrame, seed: int, k: int) -> DataFrame:
    """(u, v, cosine): the best ``k`` of each node in its leaf of one projection."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for leaf in leaves(batches, LEAF):
            v, node = unit(leaf["vector"]), leaf["node"].to_numpy()
            cosine = v @ v.T
            np.fill_diagonal(cosine, -2)
            keep = min(k, len(node) - 1)
            best = np.argpartition(-cosine, keep - 1, axis=1)[:, :keep] if keep > 0 else np.zeros((len(node), 0), int)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(node, keep)), pa.array(node[best.ravel()]), pa.array(np.take_along_axis(cosine, best, 1).ravel())],
                names=["u", "v", "cosine"])

    return projected(leaders, seed).mapInArrow(meet, "u long, v long, cosine double")


def best_of(edges: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """The best neighbours of each node, as many as its list is long: ``k``, or what ``wanted`` (u, k) says."""
    once = edges.groupBy("u", "v").agg(F.max("cosine").alias("cosine"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("cosine"), "v")))
    return ranked.join(wanted, "u", "left").where(F.col("rank") <= F.coalesce("k", F.lit(k))).select("u", "v", "cosine")


def local_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (centre, node, vector, worst, known) in order of the centre: pairs of one centre's nodes that improve a list."""
    def compared(rows: pa.Table) -> pa.RecordBatch:
        v, node, worst = unit(rows["vector"]), rows["node"].to_numpy(), rows["worst"].to_numpy()
        known, centre = rows["known"].to_pylist(), rows["centre"].to_numpy()
        bounds = np.flatnonzero(np.concatenate(([True], centre[1:] != centre[:-1], [True])))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            cosine = v[lo:hi] @ v[lo:hi].T
            np.fill_diagonal(cosine, -2)
            a, b = np.nonzero(cosine > worst[lo:hi, None])
            if len(a):
                new = [x for x in range(len(a)) if node[lo + b[x]] not in known_sets(known, lo + a[x])]
                a, b = a[new], b[new]
                out.append((node[lo + a], node[lo + b], cosine[a, b]))
        parts = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.RecordBatch.from_arrays([pa.array(p) for p in parts], names=["u", "v", "cosine"])

    def known_sets(known: list, row: int) -> set:
        if not isinstance(known[row], set):
            known[row] = set(known[row])
        return known[row]

    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        centre = held["centre"].to_numpy()
        cut = int(np.searchsorted(centre, centre[-1]))
        if cut and held.num_rows > 4096:
            yield compared(held.slice(0, cut))
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield compared(held)


def descended(graph: DataFrame, leaders: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """One round: neighbours of neighbours meet at the node between them; the better ones enter the lists."""
    lists = graph.groupBy("u").agg(F.min("cosine").alias("worst"), F.collect_list("v").alias("known"), F.count(F.lit(1)).alias("n"))
    held = leaders.select(F.col("node").alias("u"), "vector").join(lists, "u", "left").join(wanted, "u", "left").select(
        F.col("u").alias("node"), "vector", F.coalesce("known", F.array().cast("array<long>")).alias("known"),
        F.when(F.col("n") >= F.coalesce("k", F.lit(k)), F.col("worst")).otherwise(F.lit(-2.0)).alias("worst"))
    either = graph.select(F.col("u").alias("centre"), F.col("v").alias("node"), "cosine").unionAll(
        graph.select(F.col("v").alias("centre"), F.col("u").alias("node"), "cosine"))
    around = best_of(either.select(F.col("centre").alias("u"), F.col("node").alias("v"), "cosine"), wanted.select("u", (F.col("k") * 2).alias("k")), 2 * k)
    met = around.select(F.col("u").alias("centre"), F.col("v").alias("node")).join(held, "node").select("centre", "node", "vector", "worst", "known")
    found = met.repartition("centre").sortWithinPartitions("centre").mapInArrow(local_join, "u long, v long, cosine double")
    back = graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "cosine")
    return best_of(graph.unionAll(back).unionAll(found), wanted, k)


def exact(some: DataFrame, leaders: DataFrame, matters: float) -> DataFrame:
    """(u, v, cosine): all neighbours that matter of the nodes ``some``, in both directions. Blocks of both meet in groups."""
    def blocked(nodes: DataFrame, seed: int) -> tuple[DataFrame, int]:
        count = max(1, -(-nodes.count() // EXACT))
        return nodes.select("node", "vector", F.pmod(F.xxhash64(F.lit(seed), "node"), F.lit(count)).alias("block")), count

    (left, across), (right, down) = blocked(some, 21), blocked(leaders, 22)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    grid = left.select("node", "vector", F.lit(0).alias("side"), F.col("block").cast("int").alias("a"), every(down).alias("b")).unionByName(
        right.select("node", "vector", F.lit(1).alias("side"), every(across).alias("a"), F.col("block").cast("int").alias("b")))

    def compare(group: pa.Table) -> pa.Table:
        side = group["side"].to_numpy()
        a, b = group.filter(pa.array(side == 0)), group.filter(pa.array(side == 1))
        va, vb = same_width(unit(a["vector"]), unit(b["vector"]))
        cosine, u, v = va @ vb.T, a["node"].to_numpy(), b["node"].to_numpy()
        i, j = np.nonzero((cosine >= matters) & (u[:, None] != v[None, :]))
        found = cosine[i, j]
        return pa.Table.from_arrays(
            [pa.array(np.concatenate([u[i], v[j]])), pa.array(np.concatenate([v[j], u[i]])), pa.array(np.concatenate([found, found]))],
            names=["u", "v", "cosine"])

    return grid.groupBy("a", "b").applyInArrow(compare, "u long, v long, cosine double")


def audit(graph: DataFrame, leaders: DataFrame, matters: float) -> float:
    """Share of the neighbours that matter in the lists of a sample of nodes, by comparing these with all leaders.

    The sample is drawn without a look at the graph and grows until it has ``AUDIT_FOUND`` true neighbours, or is
    ``AUDIT_MOST`` nodes or all.
    """
    draw = F.xxhash64(F.lit(5), F.col("node"))
    size = AUDIT_NODES
    while True:
        sample = leaders.orderBy(draw).limit(size).select("node", "vector").toArrow()  # AUDIT_MOST rows at most
        if not sample.num_rows:
            return 1.0
        shared = leaders.sparkSession.sparkContext.broadcast((unit(sample["vector"]), sample["node"].to_numpy()))

        def compare(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked, names = shared.value
            step = max(1, AUDIT_CELLS // len(names))
            for batch in (b.slice(k, step) for b in batches for k in range(0, b.num_rows, step)):
                mine, theirs = same_width(unit(batch.column(1)), asked)
                node = batch.column(0).to_numpy()
                a, b = np.nonzero(mine @ theirs.T >= matters)
                other = node[a] != names[b]
                yield pa.RecordBatch.from_arrays([pa.array(names[b[other]]), pa.array(node[a[other]])], names=["u", "v"])

        true = leaders.select("node", "vector").mapInArrow(compare, "u long, v long").distinct()
        hits = graph.select("u", "v", F.lit(1).alias("hit")).distinct()
        got = true.join(hits, ["u", "v"], "left").agg(F.count(F.lit(1)), F.count("hit")).head()
        shared.unpersist()
        if got[0] >= AUDIT_FOUND or sample.num_rows < size or size >= AUDIT_MOST:
            return got[1] / got[0] if got[0] else 1.0
        size = min(4 * size, AUDIT_MOST)


def neighbour_graph(leaders: DataFrame, matters: float, k: int = NEIGHBOURS) -> tuple[DataFrame, float]:
    """(u, v, cosine) with all neighbours that matter, and the audited recall, which is ``AUDIT_RECALL`` at least."""
    spark = leaders.sparkSession
    wanted = spark.createDataFrame([], "u long, k int")
    starts = first_graph(leaders, 1, k)
    for s in range(2, STARTS + 1):
        starts = starts.unionAll(first_graph(leaders, s, k))
    graph = written(best_of(starts, wanted, k), "graph")
    before = graph.where(F.col("cosine") >= matters).count()
    done, sure = spark.createDataFrame([], "u long"), spark.createDataFrame([], "u long, v long, cosine double")

    def completed(full: DataFrame) -> None:
        """Compare saturated nodes with all leaders, each once."""
        nonlocal done, sure
        new = full.select("u").join(done, "u", "left_anti")
        if not new.isEmpty():
            done = written(done.unionAll(new), "compared")
            some = leaders.join(new.withColumnRenamed("u", "node"), "node", "left_semi")
            sure = written(sure.unionAll(exact(some, leaders, matters)), "exact")

    length = F.coalesce("k", F.lit(k))
    for turn in range(ROUNDS):
        graph = written(descended(graph, leaders, wanted, k), "graph")
        after = graph.where(F.col("cosine") >= matters).count()
        full = written(graph.groupBy("u").agg(F.min("cosine").alias("worst"), F.count(F.lit(1)).alias("n")).join(wanted, "u", "left").where(
            (F.col("worst") >= matters) & (F.col("n") >= length)).select("u", length.alias("k")), "saturated")
        more = full.where(F.col("k") < LONGEST).select("u", F.least(2 * F.col("k"), F.lit(LONGEST)).cast("int").alias("k"))
        if not more.isEmpty():
            wanted = written(wanted.join(more, "u", "left_anti").unionByName(more), "lists")
        elif after == before:
            completed(full)
            recall = audit(graph.unionAll(sure), leaders, matters)
            if recall >= AUDIT_RECALL:
                return graph.unionAll(sure), recall
            # fresh projections bring nodes together that no round has reached
            fresh = graph
            for s in range(STARTS):
                fresh = fresh.unionAll(first_graph(leaders, 100 + turn * STARTS + s, k))
            graph = written(best_of(fresh, wanted, k), "graph")
        before = after
    completed(full)
    recall = audit(graph.unionAll(sure), leaders, matters)
    if recall >= AUDIT_RECALL:
        return graph.unionAll(sure), recall
    return written(exact(leaders, leaders, matters), "exact"), 1.0


def compare_members(pairs: DataFrame, members: DataFrame, cosine: float) -> DataFrame:
    """(leader, other, node, weight): for members of ambiguous pairs of balls, the rows linked with them in the other ball.

    Members are cut into blocks of ``BLOCK``; every group has two blocks.
    """
    place = F.row_number().over(Window.partitionBy("leader", "chunk").orderBy("node"))
    chunked = members.withColumn("chunk", F.pmod(F.xxhash64("node"), F.ceil(F.col("ball") / BLOCK).cast("long")))
    blocks = written(chunked.withColumn("block", F.concat_ws("-", "chunk", F.floor((place - 1) / BLOCK))).select("leader", "block", "node", "size", "vector"), "members")
    names = blocks.select("leader", "block").distinct()
    grid = written(
        pairs.select("low", "high").join(names.select(F.col("leader").alias("low"), F.col("block").alias("low_block")), "low")
        .join(names.select(F.col("leader").alias("high"), F.col("block").alias("high_block")), "high")
        .withColumn("pair", F.xxhash64("low", "low_block", "high", "high_block")), "member-pairs")
    left = grid.join(blocks, (F.col("low") == F.col("leader")) & (F.col("low_block") == F.col("block"))).select(
        "pair", F.lit(0).alias("side"), "low", "high", "node", "size", "vector")
    right = grid.join(blocks, (F.col("high") == F.col("leader")) & (F.col("high_block") == F.col("block"))).select(
        "pair", F.lit(1).alias("side"), "low", "high", "node", "size", "vector")

    def compare(group: pa.Table) -> pa.Table:
        side = group["side"].to_numpy()
        a, b = group.filter(pa.array(side == 0)), group.filter(pa.array(side == 1))
        va, vb = same_width(unit(a["vector"]), unit(b["vector"]))
        near = va @ vb.T >= cosine
        low, high = a["low"][0].as_py(), a["high"][0].as_py()
        wa, wb = near @ b["size"].to_numpy(), a["size"].to_numpy() @ near
        return pa.Table.from_arrays([
            pa.array([low] * len(wa) + [high] * len(wb)), pa.array([high] * len(wa) + [low] * len(wb)),
            pa.concat_arrays([a["node"].combine_chunks(), b["node"].combine_chunks()]), pa.array(np.concatenate([wa, wb]).astype(np.int64))],
            names=["leader", "other", "node", "weight"])

    both = left.unionByName(right).groupBy("pair").applyInArrow(compare, "leader long, other long, node long, weight long")
    return both.where("weight > 0")


def linked(vectors: DataFrame, cosine: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding",
           report: Callable[[float], None] | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row.

    Vectors that are null, zero or hold null or non-finite components link with nothing, and so do rows with a null id,
    whose component is null. Rows with equal ids are different vectors. Shorter vectors count as filled with zeros. Other
    columns are not carried. ``report`` gets the audited recall.
    """
    theta = math.acos(cosine)
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(vector_column).alias("vector"))
    ok = F.col("vec_id").isNotNull() & usable(F.col("vector"))
    nodes = written(
        rows.where(ok).groupBy("vector").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("size"))
        .withColumn("node", F.xxhash64("first", "vector")), "vectors")
    leaders, owner = balls(nodes, theta / 2 - MARGIN)
    leaders = written(leaders, "leaders")
    matters = math.cos(min(math.pi, 2 * theta))
    graph, recall = neighbour_graph(leaders, matters)
    if recall < AUDIT_RECALL:
        raise RuntimeError(f"recall of the neighbour graph is {recall}")
    if report:
        report(recall)

    pair = graph.where((F.col("cosine") >= matters)).select(F.least("u", "v").alias("low"), F.greatest("u", "v").alias("high"), "cosine")
    pair = pair.groupBy("low", "high").agg(F.max("cosine").alias("cosine"))
    radius = leaders.select("node", "radius")
    pair = pair.join(radius.select(F.col("node").alias("low"), F.col("radius").alias("low_radius")), "low").join(
        radius.select(F.col("node").alias("high"), F.col("radius").alias("high_radius")), "high")
    apart, both = F.acos(F.least("cosine", F.lit(1.0))), F.col("low_radius") + F.col("high_radius")
    state = F.when(both == 0, F.when(F.col("cosine") >= cosine, "all")).when(apart + both <= theta - MARGIN, "all").when(apart - both <= theta + MARGIN, "some")
    pair = written(pair.withColumn("state", state).where("state is not null").select("low", "high", "state"), "ball-pairs")

    sized = nodes.join(owner, "node")
    weight = written(sized.groupBy("leader").agg(F.sum("size").alias("ball"), F.count(F.lit(1)).alias("classes"), F.min("first").alias("least")), "ball-sizes")
    whole = pair.where("state = 'all'")
    some = pair.where("state = 'some'")
    members = sized.join(weight.select("leader", F.col("classes").alias("ball")), "leader").join(
        some.select(F.explode(F.array("low", "high")).alias("leader")).distinct(), "leader", "left_semi").select("leader", "ball", "node", "size", "vector")
    partial = written(compare_members(some, members, cosine), "member-links")

    toward = whole.select(F.col("low").alias("leader"), F.col("high").alias("other")).unionAll(whole.select(F.col("high").alias("leader"), F.col("low").alias("other")))
    by_ball = toward.join(weight.select(F.col("leader").alias("other"), "ball"), "other").groupBy("leader").agg(F.sum("ball").alias("beyond"))
    by_node = partial.groupBy("node").agg(F.sum("weight").alias("partly"))
    edges = whole.select("low", "high").unionAll(partial.select(F.least("leader", "other").alias("low"), F.greatest("leader", "other").alias("high"))).distinct()
    joined = weight.join(components(edges).withColumnRenamed("node", "leader"), "leader", "left").withColumn("component", F.coalesce("component", "leader"))
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    per_ball = joined.join(least, "component").join(by_ball, "leader", "left").select(
        "leader", "component_id", (F.col("ball") - 1 + F.coalesce("beyond", F.lit(0))).alias("links"))
    per_class = sized.join(per_ball, "leader").join(by_node, "node", "left").select(
        F.col("vector").alias("of"), "component_id", (F.col("links") + F.coalesce("partly", F.lit(0))).cast("long").alias("n_links"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt"))
    placed = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int"))
    met = placed.join(per_class, ok & (F.col("vector") == F.col("of")) & (F.col("salt") == F.col("of_salt")), "left")
    component = F.coalesce("component_id", "vec_id")
    return met.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
