"""The join against comparing all pairs, and its edge cases."""

import random
import re

import numpy as np
import pytest

from tastegraph.llm import jaccard

SCHEMA = "doc_id long, text string, component_id string, `set` int"


def grams(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k:k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def plain(rows, n, per_cent):
    sets = [grams(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= per_cent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(i, least.get(root(k), i))
    return {(i, len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(rows)}


def corpus(seed):
    """Chains of near copies, exact copies, a passage that many share, and short texts."""
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = draw.choices(vocabulary, k=30)
    rows, next_id = [], 0
    for family in range(12):
        words = draw.choices(vocabulary, k=draw.choice([8, 25, 60, 150]))
        for _ in range(draw.choice([1, 2, 8])):
            words = list(words)
            for _ in range(draw.choice([0, 1, 1, 2])):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            extra = passage if family % 3 == 0 else []
            rows.append((next_id * 7 % 1009, draw.choice([" ", "\t", "\n "]).join(extra + words).upper()))
            next_id += 1
    return rows + [(5000, ""), (5001, "  "), (5002, "A b"), (5003, "a B"), (5004, "é"), (5005, "É")]


@pytest.mark.parametrize(("n", "per_cent", "seed"), [(3, 90, 1), (5, 80, 2), (3, 90, 3), (2, 50, 4)])
def test_against_all_pairs(spark, monkeypatch, n, per_cent, seed):
    monkeypatch.setattr(jaccard, "FRAGMENTS", 5)
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    got = jaccard.classes(docs, n, per_cent).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == plain(rows, n, per_cent)
    assert len(got) == len(rows)


@pytest.mark.parametrize("few", [0, 8])
def test_edited_copies_around_the_threshold(spark, monkeypatch, few):
    monkeypatch.setattr(jaccard, "FEW", few)
    draw = random.Random(7)
    base = [f"b{k}" for k in range(150)]
    rows, pairs = [], []
    for k in range(160):
        own = list(base)
        for _ in range(draw.choice([1, 1, 2, 3, 4, 5])):
            own[draw.randrange(150)] = draw.choice([f"x{k}", f"x{draw.randrange(1000)}", "shared"])
        rows.append((k, " ".join(own)))
    real = jaccard.linked
    monkeypatch.setattr(jaccard, "linked", lambda p, *a: (pairs.append(p.count()), real(p, *a))[1])
    got = jaccard.classes(spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA), 3, 90).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == plain(rows, 3, 90)
    assert sum(pairs) < 160 * 159 / 2 / 5


def test_a_large_group_needs_few_comparisons(spark, monkeypatch):
    draw = random.Random(1)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(300):
        own = list(words)
        own[draw.randrange(300)] = f"x{k}"
        rows.append((k, " ".join(own), "x", 1))
    seen = []
    real = jaccard.linked
    monkeypatch.setattr(jaccard, "linked", lambda pairs, *a: (seen.append(pairs.count()), real(pairs, *a))[1])
    got = jaccard.classes(spark.createDataFrame(rows, SCHEMA), 3, 90).collect()
    assert {r.component_id for r in got} == {0} and sum(seen) < 3000


def test_edges(spark):
    rows = [(None, "a b c d", "x", 1), (None, None, "x", 1), (3, "A B C D", "x", 1), (3, "a b c d", "x", 1), (4, "", "x", 1), (9, "w " * 200_000, "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.classes(docs, 3, 90).collect()), key=str)
    assert got == sorted([(0, 2, 3), (0, 0, None), (3, 2, 3), (3, 2, 3), (4, 0, 4), (9, 1, 9)], key=str)
    assert jaccard.classes(docs.where("false"), 3, 90).count() == 0
    kept = jaccard.one_of_each(docs, 3, 90)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 4, 9]
    empty = spark.createDataFrame([(None, None, "a", 1), (None, "", "b", 2), (None, None, "a", 1), (7, " ", "c", 3), (7, " ", "c", 3)], SCHEMA)
    assert sorted(r.set for r in jaccard.one_of_each(docs.unionAll(empty), 3, 90).collect()) == [1, 1, 1, 1, 1, 1, 2, 3, 3]


def test_hash_of_long_and_odd_words():
    known = jaccard.Words()
    assert len(jaccard.ngrams("a\x0bb\x0cc d", 3, known)) == 2
    assert (jaccard.ngrams("x y", 3, known) == jaccard.ngrams("X\ty", 3, known)).all()
    assert len(jaccard.ngrams(" ".join(map(str, range(1000))), 3, known)) == 998
    assert not np.array_equal(jaccard.ngrams("x", 3, known), jaccard.ngrams("x x", 3, known))
