"""The mix against a plain implementation, and what it promises."""

import re
from collections import defaultdict

import pytest

from tastegraph.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, taken string"


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted([s for s in sizes if s is not None]) + [s for s in sizes if s is None]
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    left, goal, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if most * sizes[s] <= unit * weight[s]}
        if not full:
            return goal | {s: unit * weight[s] for s in open_}
        goal |= {s: float(most * sizes[s]) for s in full}
        left -= sum(goal[s] for s in full)
        open_ -= full
    return goal


def count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("range_rows", [50_000, 7])
def test_against_plain(spark, monkeypatch, range_rows):
    monkeypatch.setattr(mixing, "RANGE_ROWS", range_rows)
    names = ["b", "a", "Z", "é", None, "", "hot"]
    rows = [(i, " ".join(["word"] * (i * 7 % 23)) if i % 11 else None, names[i % 7] if i % 3 else "hot", 1, "x") for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    source, sizes, taken = {r[0]: r[2] for r in rows}, defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r[2]] += count(r[1])
    want = targets(sizes)
    for r in got:
        assert r.size == count(rows[r.doc_id][1]) and r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(want[source[r.doc_id]])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source[r.doc_id]] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 12
    assert len(got) == len(rows)


def test_no_epoch_is_left_out(spark):
    docs = spark.createDataFrame([(i, "a b c", "s" if i else "t", 1, "x") for i in range(50)], SCHEMA)
    got = mixing.mix(docs).collect()
    assert all(r.taken >= r.size for r in got if r.target >= r.source_size)


def test_no_document_is_taken_more_often_than_the_cap(spark):
    rows = [(i, "" if i < 6 else "a b c", "small", 1, "x") for i in range(9)] + [(100 + i, "w " * 50, "large", 1, "x") for i in range(9)]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert max(r.copies for r in got) == 2 and all(r.copies <= 2 for r in got if r.size == 0)


def test_edges(spark):
    docs = spark.createDataFrame([(None, None, None, 1, "x"), (1, "", None, 1, "x"), (1, "", None, 1, "x")], SCHEMA)
    assert sorted(r.taken for r in mixing.mix(docs).collect()) == [0, 0, 0]
    assert mixing.mix(docs.where("false")).count() == 0
    long = spark.createDataFrame([(1, "word " * 300_000, "a", 1, "x"), (2, "w", "b", 1, "x")], SCHEMA)
    assert {r.doc_id: r.size for r in mixing.mix(long).collect()} == {1: 300_000, 2: 1}
    row = mixing.mix(long, carry=True).select("row.*").columns
    assert row == ["doc_id", "text", "source", "size", "taken"]


def test_heavier_documents_come_earlier(spark):
    rows = [(i, "!! ?? -- ++" if i % 2 else "some good plain words", "big", 1, "x") for i in range(2000)] + [(9999, "w " * 9000, "small", 1, "x")]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), share=0.5, weights=(1, 1)).where("doc_id < 9999").collect()
    good, odd = (sum(r.taken for r in got if r.doc_id % 2 == k) for k in (0, 1))
    assert good > 1.5 * odd
