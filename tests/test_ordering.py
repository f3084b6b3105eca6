import random

from pyspark.sql import functions as F

from tastegraph.operators import ordering
from tastegraph.operators.ordering import hot_keys, in_chunks, over_history, positions, running_total


def rows(n=600, seed=1):
    rnd = random.Random(seed)
    return [("hot" if i % 3 == 0 else f"k{rnd.randrange(40)}", rnd.randrange(50), i, rnd.randrange(5)) for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "k string, t int, id int, v bigint").repartition(5)


def test_running_total_matches_plain_loop(spark):
    data = rows()
    got = {r.id: (r.before, r.place) for r in running_total(
        frame(spark, data), {"before": F.col("v"), "place": F.lit(1)}, ["t", "id"], ["k"]).collect()}
    sums, counts = {}, {}
    for k, t, i, v in sorted(data, key=lambda r: (r[1], r[2])):
        assert got[i] == (sums.get(k, 0), counts.get(k, 0))
        sums[k], counts[k] = sums.get(k, 0) + v, counts.get(k, 0) + 1


def test_running_total_over_all_rows_descending(spark):
    data = rows()
    got = {r.id: r.before for r in running_total(
        frame(spark, data), {"before": F.col("v")}, [F.col("t").desc(), "id"]).collect()}
    total = 0
    for k, t, i, v in sorted(data, key=lambda r: (-r[1], r[2])):
        assert got[i] == total
        total += v


def test_positions_same_for_hot_keys(spark):
    df = frame(spark, rows())
    plain = {tuple(r) for r in positions(df, ["k"], ["t", "id"], "p").collect()}
    split = {tuple(r) for r in positions(df, ["k"], ["t", "id"], "p", hot_rows=20).collect()}
    assert hot_keys(df, ["k"], 20).count() >= 1
    assert plain == split


def test_history_same_for_chunked_keys(spark):
    df = frame(spark, rows())

    def add(part, window):
        return part.withColumn("past", F.collect_list("id").over(window.rowsBetween(-7, -1)))

    plain = {(r.id, tuple(r.past)) for r in over_history(df, "k", ["t", "id"], 7, add).collect()}
    for chunk in (7, 13, 50):
        split = {(r.id, tuple(r.past)) for r in over_history(df, "k", ["t", "id"], 7, add, 10, chunk).collect()}
        assert split == plain


def test_chunks_bound_group_size(spark):
    chunked, groups = in_chunks(frame(spark, rows()), "k", ["t", "id"], 5, hot_rows=30, chunk_rows=20)
    assert groups == ["k", "_chunk"]
    assert chunked.groupBy(*groups).count().agg(F.max("count")).first()[0] <= 30
    assert chunked.filter(~F.col("_lead")).count() == 600


def test_many_hot_keys_are_shuffled(spark, monkeypatch):
    """Hot keys beyond a number are not sent to every task; rows and positions stay the same (F3)."""
    rows = spark.createDataFrame([(k % 7 if k % 7 else None, k) for k in range(70)], "key long, at long")
    want = sorted(map(str, ordering.positions(rows, ["key"], ["at"], "place").collect()))
    for most, sent in ((100, True), (3, False)):
        monkeypatch.setattr(ordering, "SENT_KEYS", most)
        placed = ordering.positions(rows, ["key"], ["at"], "place", hot_rows=5)
        assert sorted(map(str, placed.collect())) == want
        joined = rows.join(ordering.hot_keys(rows, ["key"], 5), "key", "left_semi")
        assert ("Broadcast" in joined._jdf.queryExecution().executedPlan().toString()) == sent
