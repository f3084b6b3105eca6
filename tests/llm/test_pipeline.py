"""Each stage against plain code on what its predecessor kept."""

import hashlib
import math
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tastegraph.llm import langid, mixing, secrets
from tastegraph.llm.common import read_table, written

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, clean int, `a.b` int"


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs = read_table(spark, folder, "documents")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), "test")
        out.append(docs.collect())
    return out


def grams(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k:k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def test_columns(spark, stages, folder):
    want = set(read_table(spark, folder, "documents").columns)
    assert all(set(rows[0].asDict()) == want for rows in stages[:-1])
    assert set(stages[-1][0].asDict()) == {"doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"}


def test_language(spark, folder, stages):
    model = langid.fit(read_table(spark, folder, "documents"))
    assert {r.doc_id for r in stages[1]} == {r.doc_id for r in stages[0] if not langid.predict(model, r.text)[2]}


def test_one_of_near_copies(stages):
    rows = sorted(stages[1], key=lambda r: r.doc_id)
    sets, label = [grams(r.text, 5) for r in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    assert sorted(r.doc_id for r in stages[2]) == [r.doc_id for k, r in enumerate(rows) if label[k] == k]


def test_secrets_are_gone(stages):
    before = {r.doc_id: r for r in stages[2]}
    for r in stages[3]:
        assert not secrets.base_spans(r.text)
        old = before[r.doc_id]
        out, at = "", 0
        for _, s, e in secrets.base_spans(old.text):
            out += (old.text[at:s] + "[SECRET]") if s >= at else ""
            at = max(at, e)
        assert r.text == out + old.text[at:] and (r.n_chars == len(r.text) or r.text == old.text)
    assert len(stages[3]) == len(before)


def test_mix(spark, stages):
    taken = {}
    for r in stages[4]:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + 1
    keys = spark.createDataFrame([(r.doc_id, r.text) for r in stages[3]], "doc_id long, text string").select(
        "doc_id", F.xxhash64(F.lit(42), "doc_id", "text").alias("draw"),
        (F.ceil(mixing.quality(F.col("text"), mixing.word_count(F.col("text"))) * mixing.LEVELS) / mixing.LEVELS).alias("w")).collect()
    key = {r.doc_id: -math.log(((r.draw % 2 ** 64 >> 11) + 0.5) * 2.0 ** -53) / r.w for r in keys}
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in stages[3]}
    total = sum(size.values())
    names = sorted({r.source for r in stages[3]})
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    sums = {s: sum(size[r.doc_id] for r in stages[3] if r.source == s) for s in names}
    left, open_, goal = 1.5 * total, set(names), {}
    while full := {s for s in open_ if 2 * sums[s] <= left / sum(weight[x] for x in open_) * weight[s]}:
        goal |= {s: 2.0 * sums[s] for s in full}
        left, open_ = left - sum(goal[s] for s in full), open_ - full
    goal |= {s: left / sum(weight[x] for x in open_) * weight[s] for s in open_}
    for s in names:
        epochs = int(goal[s] // sums[s])
        rest, run = goal[s] - epochs * sums[s], 0
        for r in sorted((r for r in stages[3] if r.source == s), key=lambda r: key[r.doc_id]):
            run += size[r.doc_id]
            assert taken.get(r.doc_id, 0) == epochs + (run - size[r.doc_id] / 2 <= rest)


def test_tokens(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = {r.doc_id: r.text for r in stages[4]}
    assert sorted(r.doc_id for r in stages[5]) == sorted(r.doc_id for r in stages[4])
    for r in stages[5]:
        ids = np.array(library.encode(text[r.doc_id], add_special_tokens=False).ids, "<u4").tobytes()
        assert (bytes(r.ids), r.n_tokens, r.ids_sha256) == (ids, len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark, folder):
    rows = [(None, "the house is by the river", "en", None, 1, "r", 1, 1), (1, None, None, "s", None, "r", 1, 1), (2, "", "en", "s", 0, "r", 1, 1),
            (3, "token=abcdefgh1 is in the text of the house", "en", "s", 10, "r", 1, 1), (3, "token=abcdefgh1 is in the text of the house", "en", "s", 10, "r", 1, 1),
            (4, "word " * 60_000, "en", "t", 1, "r", 1, 1)]
    rows += [(i, f"the {i} and the house of the river is in the town", "en", "u", 1, "r", 1, 1) for i in range(10, 30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for empty in (False, True):
        step = docs.where("false") if empty else docs
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            columns = step.columns
            step = written(stage(spark, step, folder), "test")
            assert k == 4 or step.columns == columns
        assert (step.count() == 0) == empty


def test_run(spark, folder, stages):
    got = entry.queries()["pipeline"](spark, folder)
    assert sorted((r.doc_id, r.ids_sha256) for r in got.collect()) == sorted((r.doc_id, r.ids_sha256) for r in stages[-1])
