"""Repeated strings against a plain search; suffix order, factors and anchors against their definitions."""

import hashlib
import random

import numpy as np
import pytest

from tastegraph.llm import suffixes


def plain(rows, length, first_stays):
    texts = [(t or "").encode() for _, t in rows]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    seen, count = {}, {}
    for k in order:
        for i in range(len(texts[k]) - length + 1):
            s = texts[k][i:i + length]
            seen.setdefault(s, (k, i))
            count[s] = count.get(s, 0) + 1
    out = []
    for k, t in enumerate(texts):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            s = t[i:i + length]
            if (seen[s] != (k, i)) if first_stays else count[s] > 1:
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(t) else 0
        out.append((rows[k][0], len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    draw = random.Random(seed)
    word = lambda n: "".join(draw.choice("abcdé ") for _ in range(n))
    passage, base = word(70), word(300)
    rows = []
    for k in range(40):
        kind = k % 8
        t = [word(120), word(60) + passage + word(50), base, base[:100] + "X" + base[101:], "ab" * 90, "line of text\n" * 12, word(5), passage[:45] + word(9) + passage[20:]][kind]
        rows.append((draw.randrange(10_000), t + (word(draw.randrange(40)) if kind in (3, 5) else "")))
    return [*rows, (20_000, None), (20_001, ""), (20_002, "z" * 200)]


@pytest.mark.parametrize("first_stays", [False, True])
@pytest.mark.parametrize(("bucket", "piece"), [(4_000, 1 << 20), (3, 64)])
def test_against_plain_search(spark, monkeypatch, first_stays, bucket, piece):
    monkeypatch.setattr(suffixes, "BUCKET", bucket)
    monkeypatch.setattr(suffixes, "PIECE", piece)
    rows = corpus(bucket)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n_bytes int, raw string")
    got = sorted(map(tuple, suffixes.without_repeats(docs, 40, first_stays).collect()), key=str)
    assert got == plain(rows, 40, first_stays)


def test_edges(spark):
    docs = spark.createDataFrame([(None, "abc" * 200, 1), (None, "abc" * 200, 1), (1, "é" * 200, 1), (2, None, 1), (3, "q" * 100_000, 1)], "doc_id long, text string, h1 int")
    got = {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.without_repeats(docs, 400, False).collect()}
    assert got == {(None, 600, 600, 1), (1, 400, 0, 0), (2, 0, 0, 0), (3, 100_000, 100_000, 1)}
    assert suffixes.without_repeats(docs.where("false"), 400, False).count() == 0


def test_suffix_order_and_factors():
    draw = random.Random(4)
    for _ in range(30):
        texts = ["".join(draw.choice("ab") for _ in range(draw.randrange(1, 40))).encode() for _ in range(draw.randrange(1, 5))]
        data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
        order = suffixes.SuffixOrder(data, ends, 16)
        where = [(t, i) for t in range(len(texts)) for i in range(len(texts[t]))]

        def match(a, b):
            (s, i), (t, j) = where[a], where[b]
            n = 0
            while i + n < len(texts[s]) and j + n < len(texts[t]) and texts[s][i + n] == texts[t][j + n]:
                n += 1
            return n

        for later in (False, True):
            got = order.factors(later)
            for k in range(len(where)):
                others = range(k + 1, len(where)) if later else range(k)
                want = max((match(k, o) for o in others), default=0)
                assert (got[k] >= 8) == (want >= 8) and (want < 8 or min(got[k], 16) // 8 == min(want, 16) // 8)


def test_nearest_smaller():
    draw = np.random.default_rng(5)
    for n in (1, 2, 9, 200):
        for p in (draw.permutation(n), np.arange(n), np.arange(n)[::-1]):
            before, after = suffixes._nearest(p)
            for k in range(n):
                assert before[k] == max((j for j in range(k) if p[j] < p[k]), default=-1)
                assert after[k] == min((j for j in range(k + 1, n) if p[j] < p[k]), default=n)


def test_every_string_holds_an_anchor():
    draw = random.Random(6)
    for text in ("".join(draw.choice("abc") for _ in range(500)), "a" * 500, "abcdefg " * 60, "ab" * 40 + "c" * 300 + "ab" * 60):
        data = np.frombuffer(text.encode(), np.uint8)
        at, value = suffixes.anchors(data, 60, 16)
        x = suffixes.hashes(data, 16)
        for s in range(len(data) - 59):
            inside = at[(at >= s) & (at <= s + 44)]
            assert len(inside) and (x[inside] >> np.uint64(32)).min() == (x[s:s + 45] >> np.uint64(32)).min()
    assert len(suffixes.anchors(np.zeros(100_000, np.uint8), 400, 64)[0]) < 700


def test_matches_end_with_their_text():
    """The last bytes of a text and the first of the next one make no string, whatever the length left (F1)."""
    for seed in range(300):
        draw = random.Random(seed)
        tail, head = ("".join(draw.choice("abcdefgh") for _ in range(n)) for n in (60, 70))
        texts = []
        for _ in range(draw.randrange(2, 8)):
            (a, b), (c, d) = sorted(draw.sample(range(60), 2)), sorted(draw.sample(range(70), 2))
            more = "".join(draw.choice("xyz") for _ in range(draw.randrange(10)))
            texts.append(draw.choice([more + tail[a:], more + head[:d], head[:d] + more, tail[a:] + more, head[c:] + tail[:b], tail, head]).encode())
        count = {}
        for t in texts:
            for i in range(len(t) - 39):
                count[t[i:i + 40]] = count.get(t[i:i + 40], 0) + 1
        want = [[i for i in range(len(t) - 39) if count[t[i:i + 40]] > 1] for t in texts]
        assert [sorted(x.tolist()) for x in suffixes.repeated_starts(texts, 40, False)] == want
