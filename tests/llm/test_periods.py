"""Runs against all stretches of all periods; the grammar against what it was made of; the query against plain code."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastegraph.llm import periods
from tastegraph.llm.common import read_table


def plain_runs(words, least=12):
    out = {}
    for q in range(1, len(words) // 2 + 1):
        k = 0
        while k + q < len(words):
            if words[k] != words[k + q]:
                k += 1
                continue
            start = k
            while k + q < len(words) and words[k] == words[k + q]:
                k += 1
            if k + q - start >= max(least, 2 * q):
                out.setdefault((start, k + q - start), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def random_texts(seed, n=60):
    rng = random.Random(seed)
    for _ in range(n):
        kind, size = rng.randrange(5), rng.randrange(0, 160)
        text = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(size)]
        if kind == 1:
            text = (text[:rng.randrange(1, 20)] or [0]) * rng.randrange(1, 12)
        elif kind == 2:
            a = text[:rng.randrange(1, 9)] or [1]
            text = text + a * rng.randrange(2, 9) + text[::-1] + a * 3
        elif kind == 3:  # Fibonacci words are full of runs
            a, b = [0], [0, 1]
            for _ in range(rng.randrange(2, 10)):
                a, b = b, b + a
            text = b
        yield text


@pytest.mark.parametrize("least", [2, 4, 12])
def test_runs_against_all_stretches(least):
    for seed in range(6):
        texts = list(random_texts(seed))
        got = periods.runs_of([np.array(t, np.int64) for t in texts], least)
        for text, runs in zip(texts, got, strict=True):
            assert [tuple(r) for r in runs.tolist()] == plain_runs(text, least), text


def test_no_texts_and_empty_texts():
    assert periods.runs_of([]) == []
    assert [len(r) for r in periods.runs_of([np.zeros(0, np.int64), np.zeros(0, np.int64), np.array([1])])] == [0, 0, 0]


def test_queries_in_small_parts(monkeypatch):
    texts = [np.array(t, np.int64) for t in random_texts(11)]
    whole = [r.tolist() for r in periods.runs_of(texts, 3)]
    monkeypatch.setattr(periods, "QUERIES", 7)
    assert [r.tolist() for r in periods.runs_of(texts, 3)] == whole


def test_grammar():
    rng = random.Random(3)
    x = [1000] + [rng.randrange(3) for _ in range(400)] + [7] * 90 + [0, 1] * 60 + [1001]
    grammar = periods.Grammar(np.array(x), (1, len(x) - 1))
    assert len(grammar.symbols[-1]) <= 6 and any(right < 0 for _, right in grammar.rules.values())
    for symbols in grammar.symbols:
        assert [w for s in symbols.tolist() for w in grammar.expansion(s)] == x
    a, b = (np.array(v) for v in zip(*[sorted(rng.sample(range(1, len(x) - 1), 2)) for _ in range(3000)], strict=True))
    ahead = [next(k for k in range(len(x)) if x[i + k] != x[j + k]) for i, j in zip(a, b, strict=True)]
    back = [next(k for k in range(len(x)) if x[i - k] != x[j - k]) for i, j in zip(a, b, strict=True)]
    assert grammar.common(a, b).tolist() == ahead and grammar.common(a, b, backward=True).tolist() == back


def plain_row(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return (
        doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_rows(spark, folder):
    from tastegraph.llm.queries import REGISTRY

    docs = [r for r in read_table(spark, folder, "documents").collect() if len(r.text or "") < 6000]
    got = {r.doc_id: r for r in REGISTRY["op11_periods"](spark, folder).collect()}
    assert len(got) == read_table(spark, folder, "documents").count()
    for r in docs:
        assert tuple(got[r.doc_id][c] for c in NAMES) == plain_row(r.doc_id, r.text), r.doc_id


def test_odd_rows(spark):
    texts = [None, "", " \n", "a", "a " * 11, "a " * 12, "a b " * 3 + "x", "é\xa0ß é\xa0ß " * 6, "\x1ca " * 20, "x" * 100_000, "w " * 50_000]
    rows = [(k, t, "x", 5) for k, t in enumerate(texts)] + [(5, "a " * 12, "x", 5), (None, "b c " * 9, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, n_runs int")
    got = periods.digests(docs).collect()
    want = sorted(str(plain_row(r[0], r[1])) for r in rows if r[0] != 10)
    assert sorted(str(tuple(r)) for r in got if r.doc_id != 10) == want
    long = next(r for r in got if r.doc_id == 10)
    assert long.n_runs == 1 and long.period in range(1, 30_000)
    kept = periods.runs(docs, F.col("text")).select("row.row", "row.n_runs", "collapsed", "runs").collect()
    assert {(r.row, r.n_runs) for r in kept} == {("x", 5), (None, None)} and len(kept) == len(rows)
    assert periods.digests(spark.createDataFrame([], "doc_id long, text string")).collect() == []
