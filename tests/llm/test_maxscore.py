"""MaxScore against scoring everything."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegraph.llm import maxscore

SCHEMA = "vec_id long, vector array<long>, rank int, score string"


def plain(rows, queries, k):
    out = set()
    for q, a in queries:
        scored = sorted(((-sum(x * y for x, y in zip(a, v, strict=False)), i) for i, v in rows if i != q))[:k]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)}
    return out


@pytest.mark.parametrize(("shard", "block", "kind"), [(16_384, 2_048, "dense"), (30, 7, "dense"), (50, 5, "sparse"), (40, 9, "negative")])
def test_against_all_scores(spark, monkeypatch, shard, block, kind):
    monkeypatch.setattr(maxscore, "SHARD", shard)
    monkeypatch.setattr(maxscore, "BLOCK", block)
    draw = np.random.default_rng(3)
    m = draw.integers(-9, 10, (200, 12))
    if kind == "sparse":
        m[draw.random(m.shape) < 0.85] = 0
    if kind == "negative":
        m = -abs(m)
        m[::2] *= -1
    m[50:90] = m[50]  # many equal vectors, so ties
    rows = [(int(i) * 3, [int(x) for x in v]) for i, v in enumerate(m)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    got = maxscore.top_k(df, df.where("vec_id % 5 = 0"), 7).collect()
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == plain(rows, [r for r in rows if r[0] % 5 == 0], 7)


def test_edges(spark):
    big = [2 ** 30, -(2 ** 30)]
    rows = [(1, [1, 2], 1, "x"), (1, [1, 2], 1, "x"), (2, [3], 1, "x"), (3, None, 1, "x"), (None, [1, 1], 1, "x"), (4, big, 1, "x"), (5, [], 1, "x"), (6, [0, 0], 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = maxscore.top_k(df, df, 3).collect()
    want = {1: [2, 5, 6], 2: [4, 1, 5], 4: [2, 5, 6], 5: [1, 2, 4], 6: [1, 2, 4]}
    assert {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in want} == want
    assert {r.score for r in got if r.query_id == 4 and r.vec_id == 2} == {3 * 2 ** 30}
    assert maxscore.top_k(df.where("false"), df.where("false"), 3).count() == 0
    assert maxscore.top_k(df, df.where("false"), 3).count() == 0
    odd = spark.createDataFrame([([0.5, -0.01],), ([float("nan"), 1.0],), ([float("inf")],), ([1.0, None],), (None,)], "v array<float>")
    assert [r.s for r in odd.select(maxscore.scaled(F.col("v"), 64.0).alias("s")).collect()] == [[32, -1], None, None, None, None]
