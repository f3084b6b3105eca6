"""Cuts of merged sketches against exact ranks."""

import random

import pytest
from pyspark.sql import functions as F

from tastegraph.operators import sketches


@pytest.fixture
def rows(spark):
    rnd = random.Random(5)
    data = [(d, int(rnd.gauss(0, 1e6)) if d % 2 else rnd.randrange(50), rnd.random() ** 3) for d in range(6) for _ in range(3000)]
    return spark.createDataFrame([*data, (7, None, None)], "day int, n long, x double")


@pytest.mark.parametrize("column", ["n", "x"])
def test_rank_error(rows, column):
    shares = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
    found = sketches.cuts(sketches.sketched(rows, column, F.col("day")), shares)
    for share, (below, upto) in zip(shares, sketches.share_below(rows, column, found), strict=True):
        assert below - 0.01 <= share <= upto + 0.01
    ends = sketches.cuts(sketches.sketched(rows, column), [0, 1])
    assert ends == list(rows.agg(F.min(column), F.max(column)).first())


def test_new_parts_need_no_rescan(spark, rows, tmp_path):
    path = str(tmp_path / "store")
    sketches.add_parts(rows.where("day < 3"), "n", F.col("day"), path)
    sketches.add_parts(rows.where("day >= 3"), "n", F.col("day"), path)
    store = spark.read.parquet(path)
    assert sorted((r.part, r.rows) for r in store.collect()) == [(str(d), 3000) for d in range(6)]
    (middle,) = sketches.cuts(store, [0.5])
    below, upto = sketches.share_below(rows, "n", [middle])[0]
    assert below - 0.01 <= 0.5 <= upto + 0.01
    (early,) = sketches.cuts(store.where("part < '3'"), [0.5])
    below, upto = sketches.share_below(rows.where("day < 3"), "n", [early])[0]
    assert below - 0.01 <= 0.5 <= upto + 0.01


def test_buckets(rows):
    got = sketches.bucketed(rows, "x", "bucket", sketches.sketched(rows, "x"), 10)
    sizes = {r.bucket: r["count"] for r in got.groupBy("bucket").count().collect()}
    assert sizes.pop(None) == 1 and len(sizes) == 10 and all(abs(n - 1800) < 2 * 0.01 * 18_000 for n in sizes.values())


def test_no_rows_and_one_value(spark):
    none = spark.createDataFrame([(None,)], "n int")
    assert sketches.cuts(sketches.sketched(none, "n"), [0.5]) == [] and sketches.share_below(none, "n", [1]) == []
    one = spark.createDataFrame([(4,)] * 30, "n int")
    assert sketches.cuts(sketches.sketched(one, "n"), [0, 0.3, 1]) == [4, 4, 4]
