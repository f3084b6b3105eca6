"""Runs of repeating words in texts, found by recompression.

A run is a stretch of words with smallest period q (words q apart are the same) that is at least twice q and at least
``LEAST`` words long and that no neighbouring word extends.

The words of a batch of texts, each text behind a mark of its own, become one sequence of numbers. Recompression turns it
into a run-length grammar: block compression replaces every stretch of one symbol by a new symbol, pair compression
parts the symbols in two halves and replaces every pair of a left and a right one by a new symbol; the two alternate
until no text is longer than a symbol or two. Both are the same wherever the same words stand, but for the ends, so the
longest common extension of two positions takes a few steps on each level: up while whole symbols agree, and down from
the first that differ.

Candidates are on the harmonic grid: a run of period q holds two neighbouring multiples of q, so for each q only
positions a multiple of q apart are compared. Where the words at two such places agree, the grammar gives the exact
extensions to both sides, and with them the run. All queries of a batch are answered together. No suffix arrays.

Everything stays inside a row of the table; the memory of a task grows with its longest text, about 300 bytes a word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tastegraph.llm.common import slices

#: Words in the shortest run.
LEAST = 12
#: Extension queries that are answered together.
QUERIES = 1 << 18


class Grammar:
    """Levels of a recompression: symbols, the symbol above each, and the first child of each symbol above."""

    def __init__(self, symbols: np.ndarray, longest: tuple[int, int]):
        """``longest``: begin and end of the longest text; levels above the one where it is a symbol or two are not built."""
        self.symbols, self.up, self.first = [symbols.astype(np.int64)], [], []
        self._new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        fresh, quiet, (low, high) = int(symbols.max(initial=-1)) + 1, 0, longest
        while quiet < 6 and high - low > 2:
            below, blocks = self.symbols[-1], self.joins_blocks(len(self.up))
            starts = self._blocks(below) if blocks else self._pairs(below, len(self.up))
            above = below[starts].copy()
            sizes = np.diff(np.append(starts, len(below)))
            joined = np.flatnonzero(sizes > 1)
            quiet = 0 if len(joined) else quiet + 1
            if len(joined):
                # a pair and a block are told apart by the sign of the second part
                right = -sizes[joined] if blocks else below[starts[joined] + 1]
                names, kinds = pd.factorize(_both(above[joined], right))
                self._new.append((fresh + np.arange(len(kinds)), *_first_of(names, above[joined], right)))
                above[joined] = fresh + names
                fresh += len(kinds)
            self._push(below, starts, above)
            low, high = int(self.up[-1][low]), int(self.up[-1][high])

    @staticmethod
    def joins_blocks(level: int) -> bool:
        return level % 2 == 0

    @cached_property
    def rules(self) -> dict[int, tuple[int, int]]:
        """New symbols: (left, right) of a pair, (symbol, -count) of a block."""
        out: dict[int, tuple[int, int]] = {}
        for new, left, right in self._new:
            out.update(zip(new.tolist(), zip(left.tolist(), right.tolist(), strict=True), strict=True))
        return out

    def _push(self, below: np.ndarray, starts: np.ndarray, above: np.ndarray) -> None:
        up = np.zeros(len(below), np.int32)
        up[starts[1:]] = 1
        self.up.append(np.cumsum(up, dtype=np.int32))
        self.first.append(np.append(starts, len(below)).astype(np.int32))
        self.symbols.append(above)

    @staticmethod
    def _blocks(symbols: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))

    @staticmethod
    def _pairs(symbols: np.ndarray, level: int) -> np.ndarray:
        """Starts of symbols after pair compression; of a few partings of the alphabet the one that joins most."""
        best = None
        for salt in range(3):
            mixed = (symbols + np.int64(1 + 3 * level + salt)) * np.int64(-7046029254386353131)
            left = ((mixed ^ (mixed >> 29)) * np.int64(-4658895280553007687) >> 61) & 1 == 1
            ends = np.append(False, left[:-1] & ~left[1:])  # the right symbol of a pair
            if best is None or ends.sum() > best.sum():
                best = ends
        return np.flatnonzero(~best)

    def expansion(self, symbol: int) -> list[int]:
        """The words behind a symbol."""
        out, todo = [], [symbol]
        while todo:
            top = todo.pop()
            if top not in self.rules:
                out.append(top)
            else:
                left, right = self.rules[top]
                todo.extend([left] * -right if right < 0 else [right, left])
        return out

    def common(self, a: np.ndarray, b: np.ndarray, backward: bool = False) -> np.ndarray:
        """How many words agree from positions a and b on (a < b), or from them on backward, themselves included.

        The sequence must end and begin with a symbol that occurs once, so that no extension runs out of it.
        """
        if backward:
            return _common([_Mirror(self, k) for k in range(len(self.symbols))], len(self.symbols[0]) - 1 - a, len(self.symbols[0]) - 1 - b)
        return _common([_Level(self, k) for k in range(len(self.symbols))], a, b)


def _both(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One number for two; symbols and counts of a batch stay below 2^31."""
    return (left << 32) | (right & 0xFFFFFFFF)


def _first_of(names: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.zeros(names.max(initial=-1) + 1, np.int64)
    at[names[::-1]] = np.arange(len(names))[::-1]
    return left[at], right[at]


class _Level:
    """One level, read forward."""

    def __init__(self, grammar: Grammar, k: int):
        self.symbols, self.blocks = grammar.symbols[k], grammar.joins_blocks(k)
        self._up = grammar.up[k] if k < len(grammar.up) else None
        self._first = grammar.first[k] if k < len(grammar.up) else None

    def symbol(self, at: np.ndarray) -> np.ndarray:
        return self.symbols[at]

    def above(self, at: np.ndarray) -> np.ndarray:
        return self._up[at]

    def begin(self, above: np.ndarray) -> np.ndarray:
        return self._first[above]


class _Mirror(_Level):
    """One level, read backward: place p is the p-th from the end."""

    def symbol(self, at: np.ndarray) -> np.ndarray:
        return self.symbols[len(self.symbols) - 1 - at]

    def above(self, at: np.ndarray) -> np.ndarray:
        return len(self._first) - 2 - self._up[len(self._up) - 1 - at]

    def begin(self, above: np.ndarray) -> np.ndarray:
        return len(self._up) - self._first[len(self._first) - 1 - above]


def _common(levels: list[_Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    start = a
    a, b = a.astype(np.int64), b.astype(np.int64)
    top = np.zeros(len(a), np.int64)  # the level at which each query stopped to agree
    live = np.arange(len(a))
    for k, level in enumerate(levels[:-1]):
        if not len(live):
            break
        p, q = a[live], b[live]
        same = level.symbol(p) == level.symbol(q)
        live, p, q = live[same], p[same], q[same]
        top[live] = k
        above_p, above_q = level.above(p), level.above(q)
        inside = (level.begin(above_p) != p) | (level.begin(above_q) != q)
        # to the end of the shorter rest; where the rests differ, the symbols after it do too
        rest_p, rest_q = level.begin(above_p + 1) - p, level.begin(above_q + 1) - q
        step = np.where(inside, np.minimum(rest_p, rest_q), 0)
        a[live], b[live] = p + step, q + step
        goes = ~inside | (rest_p == rest_q)
        live, p, q = live[goes], a[live[goes]], b[live[goes]]
        a[live], b[live] = level.above(p), level.above(q)
        top[live] = k + 1
    while len(live):  # symbol by symbol on the highest level
        live = live[levels[-1].symbol(a[live]) == levels[-1].symbol(b[live])]
        a[live], b[live] = a[live] + 1, b[live] + 1
    # down again: blocks that differ agree in the shorter one, pairs that differ in their first symbol at most
    for k in range(len(levels) - 2, -1, -1):
        level = levels[k]
        live = np.flatnonzero(top > k)
        if not len(live):
            continue
        above_p, above_q = a[live], b[live]
        p, q = level.begin(above_p), level.begin(above_q)
        rest = np.minimum(level.begin(above_p + 1) - p, level.begin(above_q + 1) - q) if level.blocks else 1
        step = np.where(level.symbol(p) == level.symbol(q), rest, 0)
        a[live], b[live] = p + step, q + step
    return a - start


def _candidates(x: np.ndarray, begins: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of grid places whose word, and a neighbouring word, come again a period later.

    Texts lie in falling order of size, so those that can hold a period are a prefix.
    """
    places, periods = [], []
    for q in range(1, int(sizes.max(initial=0)) // 2 + 1):
        holds = int(np.searchsorted(-sizes, -2 * q, side="right"))
        end = int(begins[holds - 1] + sizes[holds - 1])
        at = np.arange(q, end - q, q)
        at = at[x[q:end - q:q] == x[2 * q:end:q]]
        if len(at):
            if least > 2:  # a run then has two such places in a row
                at = at[(x[at - 1] == x[at + q - 1]) | (x[at + 1] == x[at + q + 1])]
            places.append(at)
            periods.append(np.full(len(at), q))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def runs_of(texts: list[np.ndarray], least: int = LEAST) -> list[np.ndarray]:
    """For each text, given as numbers of its words, its runs as rows (start, length, period) by start, then period."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    sizes = np.array([len(texts[k]) for k in order], np.int64)
    # each text between two marks that occur once
    begins = np.cumsum(np.append(0, sizes[:-1] + 1)) + 1 if len(sizes) else np.zeros(0, np.int64)
    x = np.full(int(sizes.sum()) + len(sizes) + 1, -1, np.int64)
    for k, begin in zip(order, begins, strict=True):
        x[begin:begin + len(texts[k])] = texts[k]
    marks = np.flatnonzero(x < 0)
    x[marks] = int(x.max(initial=0)) + 1 + np.arange(len(marks))
    x = pd.factorize(x)[0].astype(np.int64)

    places, periods = _candidates(x, begins, sizes, least)
    found = [np.zeros((0, 3), np.int64)]
    if len(places):
        grammar = Grammar(x, (int(begins[0]), int(begins[0] + sizes[0])))
        for at in range(0, len(places), QUERIES):
            a, q = places[at:at + QUERIES], periods[at:at + QUERIES]
            ahead, back = grammar.common(a, a + q), grammar.common(a, a + q, backward=True)
            start, length = a - back + 1, ahead + back - 1 + q
            whole = length >= np.maximum(2 * q, least)
            found.append(np.unique(np.stack([start[whole], length[whole], q[whole]], axis=1), axis=0))
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # multiples of the smallest period give the same stretch again
    first = np.append(True, (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1]))[:len(rows)]
    rows = rows[first]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    text = np.searchsorted(begins, rows[:, 0], side="right") - 1
    bounds = np.searchsorted(text, np.arange(len(sizes) + 1))
    out: list[np.ndarray] = [np.zeros((0, 3), np.int64)] * len(texts)
    for j, k in enumerate(order):
        mine = rows[bounds[j]:bounds[j + 1]].copy()
        mine[:, 0] -= begins[j]
        out[k] = mine
    return out


SCHEMA = pa.schema([
    ("n_runs", pa.int64()), ("runs", pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))),
    ("runs_sha256", pa.string()), ("collapsed", pa.string()), ("collapsed_sha256", pa.string()),
])


def _judge(texts: pa.Array, least: int, keep_text: bool, keep_runs: bool) -> list[pa.Array]:
    words = [value.as_buffer().to_pybytes().split() if value.is_valid else [] for value in texts]
    flat = pa.array([w for ws in words for w in ws], pa.large_binary()).dictionary_encode().indices.to_numpy() if any(words) else np.zeros(0, np.int64)
    bounds = np.cumsum([0, *map(len, words)])
    parts = [flat[bounds[k]:bounds[k + 1]] for k in range(len(words))]
    lists, counts, shas, collapsed, collapsed_shas = [], [], [], [], []
    for ws, runs in zip(words, runs_of(parts, least), strict=True):
        dropped = np.zeros(len(ws) + 1, np.int64)
        np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
        np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
        left = b" ".join(w for w, d in zip(ws, np.cumsum(dropped).tolist(), strict=False) if not d) if len(runs) else b" ".join(ws)
        counts.append(len(runs))
        lists.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()] if keep_runs else None)
        shas.append(hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist()).encode()).hexdigest())
        collapsed.append(left.decode() if keep_text else None)
        collapsed_shas.append(hashlib.sha256(left).hexdigest())
    return [pa.array(column, field.type) for column, field in zip([counts, lists, shas, collapsed, collapsed_shas], SCHEMA, strict=True)]


def runs(docs: DataFrame, text: Column, least: int = LEAST, keep_text: bool = True) -> DataFrame:
    """(row, n_runs, runs, runs_sha256, collapsed, collapsed_sha256): ``row`` is the whole input row as a struct.

    ``runs`` lists every run as (start, length, period) by start, then period; words are numbered from 0. ``collapsed`` is
    the text without the words that lie behind the first period of a run, joined by one space (null unless ``keep_text``).
    A null or empty text, and one without words, has no runs and collapses to the empty text. Each input row gives one row,
    repeated rows too.
    """
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.cast("string").alias("text"))
    added = "n_runs long, runs array<struct<start: long, length: long, period: long>>, runs_sha256 string, collapsed string, collapsed_sha256 string"
    schema = StructType([given.schema["row"], *StructType.fromDDL(added)])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = _judge(batch.column(1), least, keep_text, True)
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["row", *SCHEMA.names])

    return given.mapInArrow(judge, schema)


def planted(text: Column, key: Column) -> Column:
    """The words of the text; where crc32(key) is a multiple of ten, they repeat themselves from some word on."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeating(ws: Column) -> Column:
        n = F.size(ws)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        tail = F.transform(F.sequence(a, (n - 1).cast("long")), lambda i: F.get(ws, (a + (i - a) % p).cast("int")))
        return F.array_join(F.concat(F.slice(ws, 1, a.cast("int")), tail), " ")

    bound = F.get(F.transform(F.array(words), lambda ws: F.when(F.size(ws) > 0, repeating(ws)).otherwise(F.lit(""))), F.lit(0))
    return F.when(h % 10 == 0, bound).otherwise(text)


def digests(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_runs, the longest run, digests) of each row of (doc_id, text), with the planted repeats."""
    given = docs.select("doc_id", "text")
    found = runs(given.select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text")), F.col("text"), least, keep_text=False)
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    found = found.select("row.doc_id", "n_runs", longest.alias("longest"), "runs_sha256", "collapsed_sha256")
    length = -F.col("longest.less")
    return found.select(
        "doc_id", "n_runs", F.col("longest.start").alias("start"), length.alias("length"), F.col("longest.period").alias("period"),
        F.floor(1000 * length / F.col("longest.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
