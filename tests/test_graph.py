import pytest
from pyspark.sql import functions as F

from tastegraph.operators import graph, walks
from tastegraph.plans import tables
from tastegraph.sources import MOVIES


@pytest.fixture
def rated(spark, folder):
    return tables.ratings(spark, folder)


@pytest.fixture
def films(spark, folder):
    return tables.movies(spark, folder)


def test_sequence_and_pairs(spark, ratings_of):
    rows = [(1, 858, 5.0, 1), (1, 50, 4.0, 2), (1, 593, 4.0, 3), (1, 457, 4.0, 4), (1, 9, 1.0, 2), (2, 5, 4.0, 1)]
    sequences = {r.userId: r.movieIds for r in graph.user_sequences(ratings_of(rows)).collect()}
    assert sequences == {1: [858, 50, 593, 457], 2: [5]}
    pairs = {(r.src, r.dst) for r in graph.consecutive_pairs(ratings_of(rows)).collect()}
    assert pairs == {(858, 50), (50, 593), (593, 457)}


def test_long_sequences_continue_in_parts(spark, ratings_of):
    rows = [(1, m, 4.0, m) for m in range(25)] + [(2, m, 4.0, m) for m in range(5)]
    parts = graph.user_sequences(ratings_of(rows), part_rows=10).orderBy("userId", "part").collect()
    assert [(r.userId, r.part, len(r.movieIds)) for r in parts] == [(1, 0, 10), (1, 1, 10), (1, 2, 5), (2, 0, 5)]
    assert [m for r in parts if r.userId == 1 for m in r.movieIds] == list(range(25))


def test_pairs_same_for_hot_users(spark, rated):
    plain = graph.consecutive_pairs(rated)
    split = graph.consecutive_pairs(rated, hot_rows=10)
    assert plain.exceptAll(split).isEmpty() and split.exceptAll(plain).isEmpty()


def test_probabilities_sum_to_one(spark, rated, films):
    transitions = graph.meta_transitions(graph.meta_edges(rated, films))
    worst = transitions.groupBy("src", "dst_type").agg(F.abs(F.sum("p") - 1).alias("d")).agg(F.max("d")).first()[0]
    assert worst < 1e-9
    shares = graph.node_distribution(graph.edge_counts(graph.consecutive_pairs(rated)))
    assert shares.agg(F.sum("share")).first()[0] == pytest.approx(1)


def test_every_step_follows_an_edge(spark, rated, films):
    edges = graph.meta_edge_rows(rated, films)
    paths = [("uiiu", 300), ("igi", 200)]
    corpus = walks.metapath_walks(edges, paths, seed=7).persist()
    assert corpus.count() == 500
    known = {(r.src, r.dst) for r in edges.select("src", "dst").distinct().collect()}
    prefix = {"i": "movieId:", "u": "userId:", "g": "genre:"}
    for row in corpus.collect():
        assert len(row.nodes) <= len(row.path)
        assert all(node.startswith(prefix[letter]) for letter, node in zip(row.path, row.nodes))
        assert all(step in known for step in zip(row.nodes, row.nodes[1:]))


def test_walks_do_not_depend_on_hot_keys_or_partitions(spark, rated, films):
    edges = graph.meta_edge_rows(rated, films)
    plain = walks.metapath_walks(edges, [("uigi", 200)], seed=3)
    split = walks.metapath_walks(edges.repartition(7), [("uigi", 200)], seed=3, hot_rows=15)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


def test_crowded_node_with_one_way_out(spark):
    rows = [(f"s{i}", "item", "hub", "item", i) for i in range(60)] + [("hub", "item", "end", "item", 0)]
    edges = spark.createDataFrame(rows, "src string, src_type string, dst string, dst_type string, tie bigint")
    plain = walks.metapath_walks(edges, [("iii", 500)], seed=5)
    split = walks.metapath_walks(edges, [("iii", 500)], seed=5, hot_rows=7)
    numbered = walks.numbered_edges(edges, walks.node_sizes(edges), 7)
    assert numbered.filter("src = 'hub'").count() == 9
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


def test_walk_stops_at_dead_end_and_missing_type(spark, ratings_of):
    rows = [(1, 1, 5.0, 1), (1, 2, 5.0, 2)]
    films = spark.createDataFrame([(1, "A", "Action")], MOVIES)
    corpus = walks.rating_metapath_walks(ratings_of(rows), films, [("iii", 3), ("iig", 2), ("igi", 2)])
    nodes = {(r.path, tuple(r.nodes)) for r in corpus.collect()}
    assert nodes == {
        ("iii", ("movieId:1", "movieId:2")),
        ("iig", ("movieId:1", "movieId:2")),
        ("igi", ("movieId:1", "genre:Action", "movieId:1")),
    }


def test_walk_frequencies_follow_counts(spark):
    rows = [("a", "item", "b", "item", i) for i in range(30)] + [("a", "item", "c", "item", i) for i in range(10)]
    edges = spark.createDataFrame(rows, "src string, src_type string, dst string, dst_type string, tie bigint")
    last = walks.metapath_walks(edges, [("ii", 4000)]).groupBy(F.col("nodes")[1].alias("n")).count().collect()
    share = {r.n: r["count"] / 4000 for r in last}
    assert share["b"] == pytest.approx(0.75, abs=0.03)


def test_unknown_letters_and_empty_graph(spark):
    empty = spark.createDataFrame([], "src string, src_type string, dst string, dst_type string, tie bigint")
    with pytest.raises(ValueError):
        walks.metapath_walks(empty, [("ix", 1)])
    assert walks.metapath_walks(empty, [("iu", 5)]).count() == 0


def test_a_step_leaves_the_edges_in_their_buckets(spark, rated, films):
    edges = graph.meta_edge_rows(rated, films)
    numbered = walks.numbered_edges(edges, walks.node_sizes(edges))
    store = walks.edge_store(numbered)
    paths = [("uiu", 50), ("ig", 30)]
    starts = walks._starts(spark, walks.start_ranges(edges), walks.node_sizes(edges), paths, 1)
    frontier, left = walks._reached(starts, walks._next_slot(paths, 1, 1, 1000), walks.shared_folder(spark) + "/step-test-" + store)
    assert left <= frontier.count() == 80
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = walks._step(spark.table(store), frontier, send=False)
        plan = moved._jdf.queryExecution().executedPlan().toString()
        assert "ShuffledHashJoin" in plan and plan.count("Exchange") == 1 and "Bucketed: true" in plan
        before_scan = plan[:plan.index("Bucketed: true")]
        assert "Exchange" not in before_scan.split("ShuffledHashJoin")[1]
        assert moved.count() == left > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql(f"DROP TABLE {store}")


def test_sent_and_shuffled_frontiers_walk_alike(spark, rated, films):
    edges = graph.meta_edge_rows(rated, films)
    rows = [walks.walk_visits(edges, [("uiig", 150), ("igi", 100)], 9, sent_walkers=n).collect() for n in (0, 1000)]
    assert sorted(map(str, rows[0])) == sorted(map(str, rows[1])) and len(rows[0]) > 500


def test_no_step_after_the_last_walker(spark, monkeypatch):
    edges = spark.createDataFrame([("a", "item", "b", "item", 0)], "src string, src_type string, dst string, dst_type string, tie bigint")
    steps = []
    taken = walks._step
    monkeypatch.setattr(walks, "_step", lambda *args: steps.append(1) or taken(*args))
    visits = walks.walk_visits(edges, [("iiiiiiii", 5)])
    assert {(r.walk, r.step, r.node) for r in visits.collect()} == {(w, k, "ab"[k]) for w in range(5) for k in range(2)}
    assert len(steps) == 1
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("edges_")]


def test_starts_are_in_proportion(spark):
    rows = [(f"n{k:02d}", "item", "z", "item", i) for k in range(20) for i in range(1 + 50 * (k == 7))]
    edges = spark.createDataFrame(rows, "src string, src_type string, dst string, dst_type string, tie bigint")
    first = walks.walk_visits(edges, [("i", 3000)]).groupBy("node").count().collect()
    share = {r.node: r["count"] / 3000 for r in first}
    assert sum(share.values()) == pytest.approx(1) and share["n07"] == pytest.approx(51 / 70, abs=0.04) and len(share) == 20
