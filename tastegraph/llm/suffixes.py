"""Removal of long byte strings that occur more than once, by longest-previous-factor arrays.

A suffix array of a whole corpus fits in no task, so suffixes are first brought together where they can match:

1. Texts that are equal as a whole are one class.
2. Every string of ``length`` bytes holds an anchor: the k-gram of least hash in it. Equal strings hold equal
   anchors, so only anchors that occur more than once matter, about one in 200 bytes of repeated text.
3. The surroundings of equal anchors (all strings of ``length`` bytes that hold the anchor) meet in buckets of bounded
   size. There a suffix array is built by prefix doubling. In suffix order, the nearest suffix before and the nearest
   after that start at a smaller position give the longest earlier match of each position (its longest previous
   factor); with larger positions, the longest later one.
4. Positions with a match of at least ``length`` bytes go back to their texts, where the strings are united and cut.

An anchor with more surroundings than a bucket holds takes another exact way: hashes of its strings are counted
with partial aggregation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import slices, written

#: Bytes of the k-gram whose hash makes an anchor.
GRAM = 64
#: Surroundings in a bucket, about, and of one anchor at most; anchors in a part, about; bytes taken at once.
BUCKET, PART, PIECE = 4_000, 1_000_000, 1 << 20
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes that start at each position, for as many positions as have that many."""
    level, width, out, done = data.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1, None, 0
    level ^= level >> np.uint64(29)
    count = len(data) - size + 1
    while done < size and count > 0:
        if size & width:
            part = level[done:done + count]
            out = part.copy() if out is None else _mix(out, part)
            done += width
        if done < size:
            level = _mix(level[:-width], level[width:]) if len(level) > width else level[:0]
            width *= 2
    return out if count > 0 else np.zeros(0, np.uint64)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0xBF58476D1CE4E5B9) + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def window_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``."""
    n = len(x)
    if n < width:
        return x[:0]
    padded = np.concatenate([x, np.full(-n % width, TOP)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, 1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes): in every string of ``length`` bytes one position whose k-gram has the least hash of it.

    Of equal k-grams near each other, as in a text that repeats a line, only as many are kept as that needs.
    """
    width = length - gram + 1
    x = hashes(data, gram)
    if len(x) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low = np.uint64(0xFFFFFFFF)
    tagged = (x & ~low) | np.arange(len(x), dtype=np.uint64)
    at = np.unique((window_least(tagged, width) & low).astype(np.int64))
    value = x[at]
    tie = np.flatnonzero((value[1:] == value[:-1]) & (at[1:] - at[:-1] < width))
    if len(tie):
        keep, last, held = np.ones(len(at), bool), -2, 0
        for k in tie.tolist():  # k and k + 1 are equal: k goes if the one kept before it still reaches k + 1
            if last == k - 1 and at[k + 1] - held < width:
                keep[k] = False
            else:
                held = at[k]
            last = k
        at, value = at[keep], value[keep]
    return at, value


def _nearest(position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of an order: the nearest places before and after it that hold a smaller position (-1 and n: none).

    Pointers skip to the pointer of the place they point to until it holds a smaller position.
    """
    n = len(position)
    out = []
    for values in (position, position[::-1]):
        low = np.append(values, -1)  # the place -1 ends every search
        link = np.arange(-1, n - 1)
        open_ = np.flatnonzero(low[link] > values)
        while len(open_):
            link[open_] = link[link[open_]]
            open_ = open_[low[link[open_]] > values[open_]]
        out.append(link)
    back = out[1][::-1]
    return out[0], np.where(back < 0, n, n - 1 - back)


class SuffixOrder:
    """Suffix order of several texts laid end to end; no match runs across the end of a text."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, reach: int):
        """``reach``: suffixes are told apart by at least so many bytes."""
        n = len(data)
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        word = np.zeros(n, np.uint64)
        for k in range(8):
            word = (word << np.uint64(8)) | padded[k:n + k]
        crossing = (ends[:, None] - np.arange(1, 8)).ravel()
        crossing = np.unique(crossing[crossing >= np.repeat(np.concatenate(([0], ends[:-1])), 7)])
        order = np.argsort(word, kind="stable")
        self.data, self.size = data, n
        self.end = np.repeat(ends, np.diff(ends, prepend=0))  # where the text of each position ends
        rank = self._ranked(order, word[order])
        rank[crossing] = n + crossing  # each its own: what holds it matches nothing
        self.levels = [(8, rank)]
        width = 8
        while width < reach:
            rank = self._doubled(rank, width)
            width *= 2
            self.levels.append((width, rank))
        self.order = np.argsort(rank, kind="stable")

    @staticmethod
    def _ranked(order: np.ndarray, key: np.ndarray) -> np.ndarray:
        first = np.concatenate(([True], key[1:] != key[:-1]))
        start = np.flatnonzero(first)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.repeat(start, np.diff(np.append(start, len(order))))
        return rank

    def _doubled(self, rank: np.ndarray, width: int) -> np.ndarray:
        """Ranks by twice the width; only suffixes that still share a rank are sorted again."""
        counts = np.bincount(rank, minlength=1)
        active = np.flatnonzero(counts[rank] > 1)
        # what a text has no more bytes for matches nothing, even if the words of the next text would
        ahead = np.where(active + width < self.end[active], rank[np.minimum(active + width, self.size - 1)], -1 - active)
        by = np.lexsort((ahead, rank[active]))
        a, old, new = active[by], rank[active][by], ahead[by]
        out = rank.copy()
        if len(a):
            place = np.arange(len(a))
            group = np.concatenate(([True], old[1:] != old[:-1]))
            sub = group | np.concatenate(([True], new[1:] != new[:-1]))
            group_start = np.maximum.accumulate(np.where(group, place, 0))
            out[a] = old + np.maximum.accumulate(np.where(sub, place, 0)) - group_start
        return out

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes, up to less than twice the reach."""
        long = np.zeros(len(a), np.int64)
        a_end, b_end = self.end[a], self.end[b]
        for width, rank in reversed(self.levels):
            i, j = a + long, b + long
            inside = (i < a_end) & (j < b_end)
            same = inside & (rank[np.minimum(i, self.size - 1)] == rank[np.minimum(j, self.size - 1)])
            long += width * same
        for _ in range(7):  # single bytes
            i, j = a + long, b + long
            inside = (i < a_end) & (j < b_end)
            same = inside & (self.data[np.minimum(i, self.size - 1)] == self.data[np.minimum(j, self.size - 1)])
            long += same & (long % 8 == _)
        return long

    def _links(self, later: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(suffix, nearest suffix before or after it in order that starts earlier, or later)."""
        before, after = _nearest(self.size - 1 - self.order if later else self.order)
        for link, none in ((before, -1), (after, self.size)):
            there = np.flatnonzero(link != none)
            yield self.order[there], self.order[link[there]]

    def factors(self, later: bool = False) -> np.ndarray:
        """Longest previous factor of each position, or the longest match that starts later."""
        best = np.zeros(self.size, np.int64)
        for own, other in self._links(later):
            best[own] = np.maximum(best[own], self.common(own, other))
        return best

    def matched(self, length: int, later: bool = False) -> np.ndarray:
        """Whether the longest previous factor (or longest later match) of each position has ``length`` bytes.

        Two ranks of the largest width within ``length`` cover it, so the factor itself need not be measured.
        """
        out = np.zeros(self.size, bool)
        width, rank = max((level for level in self.levels if level[0] <= length), key=lambda level: level[0])
        for own, other in self._links(later):
            inside = (own + length <= self.end[own]) & (other + length <= self.end[other])
            own, other = own[inside], other[inside]
            for shift in [*range(0, length - width, width), length - width]:
                same = rank[own + shift] == rank[other + shift]
                own, other = own[same], other[same]
            out[own] = True
        return out


def repeated_starts(texts: list[bytes], length: int, first_stays: bool) -> list[np.ndarray]:
    """In each text the starts of strings of ``length`` bytes that start anywhere else too (or: anywhere before).

    What is in no string whose hash occurs twice is left out first, and equal pieces are sorted once; the first of
    them stands for all.
    """
    found = [hashes(np.frombuffer(t, np.uint8), length) for t in texts]
    sizes = np.array([len(f) for f in found])
    flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
    order = np.argsort(flat)
    ranked = flat[order]
    same = np.zeros(len(flat), bool)
    if len(flat) > 1:
        equal = ranked[1:] == ranked[:-1]
        same[order[1:][equal]] = same[order[:-1][equal]] = True
    pieces: dict[bytes, int] = {}
    places: list[tuple[int, int, int]] = []  # text, start, piece
    at = 0
    for k, (text, size) in enumerate(zip(texts, sizes.tolist(), strict=True)):
        for start, end in united(np.flatnonzero(same[at:at + size]), length).tolist():
            places.append((k, start, pieces.setdefault(text[start:end], len(pieces))))
        at += size
    times = np.bincount([p for _, _, p in places], minlength=len(pieces))
    widths, starts = [len(p) for p in pieces], _matched_starts(list(pieces), length, first_stays)
    out: list[list[np.ndarray]] = [[] for _ in texts]
    seen: set[int] = set()
    for k, start, piece in places:
        own = starts[piece]
        if times[piece] > 1 and (piece in seen or not first_stays):
            own = np.arange(widths[piece] - length + 1)
        seen.add(piece)
        out[k].append(own + start)
    return [np.concatenate(o) if o else np.zeros(0, np.int64) for o in out]


def _matched_starts(texts: list[bytes], length: int, first_stays: bool) -> list[np.ndarray]:
    """The same for distinct texts, by suffix order."""
    lengths = np.array([len(t) for t in texts], np.int64)
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(lengths)
    if not len(data):
        return [np.zeros(0, np.int64)] * len(texts)
    order = SuffixOrder(data, ends[lengths > 0], length)
    there = order.matched(length)
    if not first_stays:
        there |= order.matched(length, later=True)
    return [np.flatnonzero(there[e - n:e]) for e, n in zip(ends, lengths, strict=True)]


def united(starts: np.ndarray, length: int) -> np.ndarray:
    """(start, end) of the maximal runs that strings of ``length`` bytes at sorted starts cover."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    new = np.concatenate(([True], starts[1:] > starts[:-1] + length))
    last = np.flatnonzero(np.append(new[1:], True))
    return np.stack([starts[new], starts[last] + length], 1)


def text_key(text: Column) -> list[Column]:
    """Two hashes that stand for a text."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("second"), text).alias("h2")]


def anchor_parts(texts: DataFrame, parts: int, length: int, gram: int) -> DataFrame:
    """Bundles (part, h1, h2, position, hash) of all anchors of (h1, h2, raw), by hash."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, PIECE):
            found, seen = [], set()
            for h1, h2, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (h1, h2) in seen:
                    continue
                seen.add((h1, h2))
                data = np.frombuffer(raw, np.uint8)
                for start in range(0, max(len(data) - length + 1, 0), PIECE):
                    at, value = anchors(data[start:start + PIECE + length - 1], length, gram)
                    found.append((np.full(len(at), h1), np.full(len(at), h2), at + start, value.view(np.int64)))
            if not found:
                continue
            columns = [np.concatenate(c) for c in zip(*found, strict=True)]
            part = ((columns[3].view(np.uint64) >> np.uint64(11)) % np.uint64(parts)).astype(np.int64)
            by = np.argsort(part, kind="stable")
            bounds = np.searchsorted(part[by], np.arange(parts + 1))
            rows = [(k, *(c[by[bounds[k]:bounds[k + 1]]].astype("<i8").tobytes() for c in columns)) for k in range(parts) if bounds[k] < bounds[k + 1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 5))],
                names=["part", "h1", "h2", "position", "hash"])

    return texts.mapInArrow(cut, "part int, h1 binary, h2 binary, position binary, hash binary")


def repeated_anchors(bundles: DataFrame) -> DataFrame:
    """(h1, h2, position, hash, n) of the anchors that occur n > 1 times."""
    kinds = pa.schema([(c, pa.int64()) for c in ("h1", "h2", "position", "hash", "n")])

    def counted(table: pa.Table) -> pa.Table:
        columns = [np.concatenate([np.frombuffer(b.as_buffer(), "<i8") for b in table[c]]) for c in ("h1", "h2", "position", "hash")]
        by = np.lexsort(columns)
        h1, h2, position, value = (c[by] for c in columns)
        new = np.concatenate(([True], (value[1:] != value[:-1]) | (position[1:] != position[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
        h1, h2, position, value = (c[new] for c in (h1, h2, position, value))
        start = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
        n = np.diff(np.append(start, len(value)))
        n = np.repeat(n, n)
        return pa.Table.from_arrays([pa.array(c[n > 1]) for c in (h1, h2, position, value, n)], schema=kinds)

    return bundles.groupBy("part").applyInArrow(counted, "h1 long, h2 long, position long, hash long, n long")


def surroundings(flagged: DataFrame, length: int, gram: int) -> DataFrame:
    """(hash, n, h1, h2, start, around) from (h1, h2, raw, found): the bytes of all strings that hold an anchor."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, PIECE):
            for h1, h2, raw, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for k in range(0, len(found), 2_000):
                    some = found[k:k + 2_000]
                    starts = [max(0, f["position"] - length + gram) for f in some]
                    around = [raw[s:f["position"] + length] for s, f in zip(starts, some, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([f["hash"] for f in some], pa.int64()), pa.array([f["n"] for f in some], pa.int64()), pa.array([h1] * len(some), pa.int64()),
                         pa.array([h2] * len(some), pa.int64()), pa.array(starts, pa.int64()), pa.array(around, pa.binary())],
                        names=["hash", "n", "h1", "h2", "start", "around"])

    return flagged.mapInArrow(cut, "hash long, n long, h1 long, h2 long, start long, around binary")


def bucket_matches(around: DataFrame, buckets: int, length: int, first_stays: bool) -> DataFrame:
    """(h1, h2, runs): covered runs found in the buckets, as little-endian 64-bit pairs of start and end."""
    kinds = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("runs", pa.binary())])

    def matched(table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("h1", "ascending"), ("h2", "ascending"), ("start", "ascending")])
        # surroundings of one text that overlap become one, so that a place is not its own match
        around, start, h1, h2 = [], [], [], []
        for a, s, x, y in zip(*(table[c].to_pylist() for c in ("around", "start", "h1", "h2")), strict=True):
            if around and (x, y) == (h1[-1], h2[-1]) and s <= start[-1] + len(around[-1]):
                around[-1] += a[start[-1] + len(around[-1]) - s:]
            else:
                around.append(a), start.append(s), h1.append(x), h2.append(y)
        out = []
        for k, own in enumerate(repeated_starts(around, length, first_stays)):
            if len(own):
                out.append((h1[k], h2[k], (united(own, length) + start[k]).astype("<i8").tobytes()))
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds.types, strict=True)], schema=kinds)

    keyed = around.withColumn("bucket", F.pmod(F.xxhash64("hash"), F.lit(buckets)))
    return keyed.groupBy("bucket").applyInArrow(matched, "h1 long, h2 long, runs binary")


def counted_matches(around: DataFrame, length: int, first_stays: bool) -> DataFrame:
    """The same for anchors with too many surroundings: their strings are counted by hash."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4, PIECE):
            values = [hashes(np.frombuffer(a, np.uint8), length).view(np.int64) for a in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(values, pa.list_(pa.int64()))], names=["h1", "h2", "order", "start", "strings"])

    rows = around.select("h1", "h2", "order", "start", "around").mapInArrow(cut, "h1 long, h2 long, `order` struct<a: boolean, b: long>, start long, strings array<long>")
    strings = rows.select("h1", "h2", "order", "start", F.posexplode("strings").alias("k", "string")).select(
        "string", F.struct("order", "h1", (F.col("start") + F.col("k")).alias("at"), "h2").alias("place"))
    ends = strings.groupBy("string").agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first <> last")
    met = strings.join(ends, "string")
    met = met.where("place <> first") if first_stays else met
    runs = met.select("place.h1", "place.h2", "place.at").distinct()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy()
            pairs = np.stack([at, at + length], 1).astype("<i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([p.tobytes() for p in pairs], pa.binary())], names=["h1", "h2", "runs"])

    return runs.mapInArrow(pack, "h1 long, h2 long, runs binary")


def cut_texts(flagged: DataFrame) -> DataFrame:
    """(h1, h2, n_removed, n_spans, kept, kept_sha256) from (h1, h2, raw, runs): the runs united and taken out."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2, PIECE):
            out = []
            for raw, packed in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                runs = np.concatenate([np.frombuffer(p, "<i8").reshape(-1, 2) for p in packed])
                runs = runs[np.argsort(runs[:, 0], kind="stable")]
                reach = np.maximum.accumulate(runs[:, 1])
                new = np.concatenate(([True], runs[1:, 0] > reach[:-1]))
                starts, ends = runs[new, 0], reach[np.flatnonzero(np.append(new[1:], True))]
                kept = b"".join(raw[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(raw)], strict=True))
                out.append((int((ends - starts).sum()), len(starts), kept, hashlib.sha256(kept).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True))],
                names=["h1", "h2", "n_removed", "n_spans", "kept", "kept_sha256"])

    return flagged.mapInArrow(cut, "h1 long, h2 long, n_removed long, n_spans long, kept binary, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = 400, first_stays: bool = True, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else in the corpus, the same text
    included; with ``first_stays`` only if it starts anywhere before, in the order of ids (null last) and positions.
    Strings are judged on the input and never cross texts. Null counts as empty. Rows with equal ids and equal texts
    are copies: with ``first_stays`` all of them keep what the first keeps. Other columns are not carried.
    """
    gram = min(GRAM, max(1, length // 4))
    text = F.coalesce(F.col(text_column), F.lit(""))
    plain = docs.select(F.col(id_column).alias("doc_id"), text.alias("text"))
    rows = written(plain.select("doc_id", *text_key(F.col("text")), F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "suffix-rows")
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").cast("long").alias("b"))
    classes = rows.groupBy("h1", "h2").agg(F.min(order).alias("order"), F.count(F.lit(1)).alias("copies"), F.max("n_bytes").alias("n_bytes"), F.max("sha").alias("sha"))
    total = rows.agg(F.sum("n_bytes")).head()[0] or 0
    parts = max(32, total // (PART * (length - gram + 1) // 2))

    raw = plain.select(*text_key(F.col("text")), F.encode("text", "UTF-8").alias("raw"), "doc_id")
    found = written(repeated_anchors(anchor_parts(raw.where(F.octet_length("raw") >= length).select("h1", "h2", "raw"), parts, length, gram)), "suffix-anchors")
    by_text = found.groupBy("h1", "h2").agg(F.collect_list(F.struct("position", "hash", "n")).alias("found"))
    first = by_text.join(classes.select("h1", "h2", "order"), ["h1", "h2"])
    flagged = written(
        raw.join(first, ["h1", "h2"]).where(F.col("order.b").eqNullSafe(F.col("doc_id").cast("long"))).select("h1", "h2", "raw", "found", "order"), "suffix-texts")
    around = surroundings(flagged.select("h1", "h2", "raw", "found"), length, gram).join(first.select("h1", "h2", "order"), ["h1", "h2"])
    around = written(around, "suffix-surroundings")
    count = around.count()
    matches = bucket_matches(around.where(F.col("n") <= BUCKET), max(1, count // BUCKET), length, first_stays).unionAll(
        counted_matches(around.where(F.col("n") > BUCKET), length, first_stays))
    runs = matches.groupBy("h1", "h2").agg(F.collect_list("runs").alias("runs"))
    cut = written(cut_texts(flagged.join(runs, ["h1", "h2"]).select("h1", "h2", "raw", "runs")).drop("kept").distinct(), "suffix-cut")

    empty = hashlib.sha256(b"").hexdigest()
    judged = classes.join(cut, ["h1", "h2"], "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    keep = lambda gone, name, none: F.when(whole, gone).otherwise(F.coalesce(F.col(name), none)) if not first_stays else F.coalesce(F.col(name), none)
    judged = judged.select(
        F.col("h1"), F.col("h2"), "order", "copies", keep(F.col("n_bytes"), "n_removed", F.lit(0)).alias("n_removed"),
        keep(F.lit(1), "n_spans", F.lit(0)).alias("n_spans"), keep(F.lit(empty), "kept_sha256", F.col("sha")).alias("kept_sha256"))
    met = rows.join(judged, ["h1", "h2"])
    if first_stays:
        later = (order != F.col("order")) & (F.col("n_bytes") >= length)
        met = met.withColumns({
            "n_removed": F.when(later, F.col("n_bytes")).otherwise(F.col("n_removed")), "n_spans": F.when(later, F.lit(1)).otherwise(F.col("n_spans")),
            "kept_sha256": F.when(later, F.lit(empty)).otherwise(F.col("kept_sha256"))})
    return met.select(F.col("doc_id").alias(id_column), "n_bytes", F.col("n_removed").cast("long").alias("n_removed"), F.col("n_spans").cast("long").alias("n_spans"), "kept_sha256")
