"""Line rules against a plain version, and the query against its SQL."""

import random
import re

import pytest

from tastegraph.llm import linerules, oracle
from tastegraph.llm.common import read_table

WORD = r"[^\x20\x09-\x0D]+"
PROSE = "Rain fell on the harbour all day long. Nobody went out to sea before the evening."
TEXTS = {
    "null": None, "empty": "", "blank": " \n\t\n", "short": "One two.", "prose": f"{PROSE}\n{PROSE}\n",
    "menu": f"Home | News | Sport | Contact | About\n{PROSE}", "tags": "rain* sea$ port% crew& home# boat* deck* mast* sail& keel#\n" * 4,
    "shouting": "RAIN!! FELL!! ON!! THE!! HARBOUR!! ALL!! DAY!! LONG!! AGAIN!! AND!! AGAIN!!", "licence": f"{PROSE}\nLicensed under the Apache License, Version 2.0.",
    "no marks": " ".join(f"w{i}" for i in range(200)), "quoted": f'He said: "{PROSE}"  \nand left', "repeats": "a b c d e f a b c d e g h i j a b c d e",
    "overlaps": "x x x x x x x x", "twice": " ".join(["one two three four five six seven"] * 2), "separate": "a b c d e a b c d f", "spaces": "\x0b a\x0cb \r\n c\xa0d e",
    "long": " ".join(random.Random(5).choice("abcdefgh") for _ in range(3000)) + ".", "kelvin": f"{PROSE}\nCooKie policy", "wide": "你好。" * 30,
    "duplicates": "Same line.\nSame line.\n\nOther.\nSame line.",
}


def plain(text):
    text = text or ""
    words = re.findall(WORD, text)
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)} if len(windows) < 4000 else None
    keep, fallen = [], {"punctuation": 0, "navigation": 0, "boilerplate": 0}
    for line in lines:
        n = len(re.findall(WORD, line))
        marks, separators = sum(line.count(c) for c in ".!?…。"), sum(line.count(c) for c in "#*$%&|<>»›•·→")
        if separators >= 2 and separators * 4 >= n:
            fallen["navigation"] += 1
        elif marks * 60 < n and not re.search("[.!?…。][\"')\\]»”’]*[\\x20\\x09-\\x0D]*\\Z", line) or (n >= 8 and marks * 2 > n):
            fallen["punctuation"] += 1
        elif n <= 30 and re.search("|".join(linerules.PHRASES), line, re.IGNORECASE):
            fallen["boilerplate"] += 1
        else:
            keep.append(line)
    chars, kept = sum(map(len, words)), sum(len(w) for x in keep for w in re.findall(WORD, x))
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return dict(
        n_words=len(words), word_chars=chars, n_symbols=sum(text.count(c) for c in "#*$%&|<>"), n_dup_lines=len(lines) - len(set(lines)),
        n_repeat_words=len(repeated), n_lines=len(lines), kept_chars=kept, clean_text="\n".join(keep), base_failed=failed,
        kept=not failed and 100 * kept >= 50 * chars, **{f"n_{k}": v for k, v in fallen.items()})


def test_against_plain(spark):
    rows = [(name, text, 7) for name, text in TEXTS.items()] + [("prose", TEXTS["prose"], 7), (None, PROSE, 7)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, n_words int")
    got = linerules.judged(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain(r.row.text)
        wrong = [(k, str(r[k])[:80], str(want[k])[:80]) for k in want if r[k] != want[k]]
        assert not wrong, r.row.doc_id
        assert r.row.n_words == 7


def test_verdicts(spark):
    docs = spark.createDataFrame([(k, v) for k, v in TEXTS.items()], "doc_id string, text string")
    kept = {r.doc_id: r.text for r in linerules.cleaned(docs).collect()}
    assert kept["menu"] == PROSE and kept["licence"] == PROSE
    assert not {"null", "empty", "short", "tags", "shouting", "no marks", "repeats", "twice"} & set(kept)
    assert linerules.cleaned(docs).columns == docs.columns


def test_limits_are_parameters(spark):
    docs = spark.createDataFrame([(1, TEXTS["menu"])], "doc_id long, text string")
    assert linerules.cleaned(docs, linerules.Rules(most_lost=5)).count() == 0
    assert linerules.cleaned(docs, linerules.Rules(most_lost=90)).count() == 1


def test_empty_table_and_plan(spark, folder):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert linerules.digests(docs).collect() == []
    plan = linerules.digests(read_table(spark, folder, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("name", ["op13_linerules"])
def test_query_equals_sql(spark, folder, name):
    from compare import differences, duck

    from tastegraph.llm.queries import REGISTRY

    assert differences(REGISTRY[name](spark, folder).toPandas(), duck(folder).execute(oracle.oracle_sql()[name]).df()) is None


def test_junk_goes_and_clean_documents_stay(spark, folder):
    found = linerules.digests(read_table(spark, folder, "documents")).join(read_table(spark, folder, "labels"), "doc_id").collect()
    good, bad = [r.kept for r in found if r.quality == 1 and not r.base_failed], [r.kept for r in found if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)
