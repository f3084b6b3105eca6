"""Byte-pair encoding by speculation and verification, and decoding.

A word is first cut greedily into the longest vocabulary entries. A cut is the true encoding exactly when no
merge could have crossed any of its boundaries, which depends on the two tokens of a boundary alone: so all
distinct adjacent pairs of a batch are tested at once in numpy, and only words with a failing pair go through
the merges one by one.

A merge crosses the boundary between ``a`` and ``b`` if some token ``x`` on the right edge of ``a``'s merge tree
and some ``y`` on the left edge of ``b``'s can merge before either is used up by its own tree. Of equal merges the
left one comes first, so ``x`` is used up first on a tie with its own tree and ``y`` is not.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastegraph.llm.common import slices

# The published pre-tokenisation pattern of byte-level BPE.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Letters and numbers below U+0250, for texts that stay below it.
LATIN_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
LATIN_NUMBERS = "0-9²³¹¼-¾"

#: New words a Python worker remembers before it starts afresh; the set before is kept until then.
KNOWN_WORDS = 150_000
#: Longer words are merged with a heap.
SHORT_WORD = 64
NEVER = np.iinfo(np.int64).max


def byte_characters() -> dict[str, int]:
    """The character that stands for each byte in vocabulary files: printable ones for themselves, others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Token bytes, merges in order and special tokens of a byte-level BPE file."""

    def __init__(self, tokens: list[bytes], merges: list[tuple[int, int, int]], special: dict[str, int]):
        """``merges`` holds (left id, right id, merged id), the first merge first."""
        self.tokens, self.merges, self.special = tokens, merges, special

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        letter, ids = byte_characters(), whole["model"]["vocab"]
        special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        tokens = [b""] * (1 + max([*ids.values(), *special.values()]))
        for text, i in ids.items():
            tokens[i] = bytes(letter[c] for c in text)
        for text, i in special.items():
            tokens[i] = text.encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in whole["model"]["merges"]]
        return cls(tokens, [(ids[a], ids[b], ids[a + b]) for a, b in pairs], special)


class Encoder:
    """Encodes texts; keeps tables and remembered words, so make one for each Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        special = set(v.special.values())
        self.tokens, self.special = v.tokens, v.special
        self.by_bytes = {t: i for i, t in enumerate(v.tokens) if t and i not in special}
        self.byte_ids = [self.by_bytes[bytes([b])] for b in range(256)]
        self.rank = {(a, b): (r, z) for r, (a, b, z) in enumerate(v.merges)}
        self.lengths: dict[bytes, tuple[int, ...]] = {}
        for t in self.by_bytes:
            if len(t) > 2:
                self.lengths[t[:3]] = (*self.lengths.get(t[:3], ()), len(t))
        self.lengths = {start: tuple(sorted(set(n), reverse=True)) for start, n in self.lengths.items()}
        n = len(v.tokens)
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.made = np.full(n, NEVER, np.int64)
        for r, (a, b, z) in enumerate(v.merges):
            if self.made[z] == NEVER:
                self.left[z], self.right[z], self.made[z] = a, b, r
        codes = np.array([a * n + b for a, b, _ in v.merges], np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes, self.ranks, self.size = codes[order], order, n
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(v.special, key=len, reverse=True))) + ")") if v.special else None
        self.words = regex.compile(WORDS)
        self.latin_words = re.compile(
            rf"'(?:[sdmt]|ll|ve|re)| ?[{LATIN_LETTERS}]+| ?[{LATIN_NUMBERS}]+| ?[^\s{LATIN_LETTERS}{LATIN_NUMBERS}]+|\s+(?!\S)|\s+")
        self.not_latin = re.compile("[\x1c-\x1fɐ-\U0010ffff]")

    def greedy(self, word: bytes) -> list[int]:
        """Longest vocabulary entries from the left; only lengths that exist for the next three bytes are tried."""
        out, at, find, lengths = [], 0, self.by_bytes.get, self.lengths.get
        while at < len(word):
            for length in lengths(word[at:at + 3], ()):
                part = word[at:at + length]
                token = find(part)
                if token is not None and len(part) == length:
                    break
            else:
                part = word[at:at + 2]
                token = find(part)
                if token is None:
                    part = word[at:at + 1]
                    token = find(part)
            out.append(token)
            at += len(part)
        return out

    def merged(self, word: bytes) -> list[int]:
        """Merges one by one: the earliest merge first, the leftmost of equal ones; a heap keeps long words cheap."""
        if len(word) <= SHORT_WORD:
            return self._merged_short(word)
        ids = [self.byte_ids[b] for b in word]
        after, before, rank = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1)), self.rank
        heap = [(rank[p][0], i, *p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in rank]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else len(ids)
            if j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = rank[a, b][1], -1
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
                if (p := (ids[i], ids[after[i]])) in rank:
                    heapq.heappush(heap, (rank[p][0], i, *p))
            if before[i] >= 0 and (p := (ids[before[i]], ids[i])) in rank:
                heapq.heappush(heap, (rank[p][0], before[i], *p))
        return [i for i in ids if i >= 0]

    def _merged_short(self, word: bytes) -> list[int]:
        ids, find, last = [self.byte_ids[b] for b in word], self.rank.get, (NEVER, -1)
        next_merge = [find(p, last) for p in zip(ids, ids[1:], strict=False)]
        while next_merge:
            best = min(next_merge)
            if best is last:
                break
            i = next_merge.index(best)
            ids[i:i + 2] = [best[1]]
            del next_merge[i]
            if i < len(next_merge):
                next_merge[i] = find((best[1], ids[i + 1]), last)
            if i:
                next_merge[i - 1] = find((ids[i - 1], best[1]), last)
        return ids

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens: no merge crosses their boundary."""
        good = np.ones(len(a), bool)
        x, x_used = a.copy(), np.full(len(a), NEVER)
        while (live := x >= 0).any():
            y, y_used = b.copy(), np.full(len(a), NEVER)
            while (rows := np.flatnonzero(live & good & (y >= 0))).size:
                code = x[rows] * self.size + y[rows]
                at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
                rank = np.where(self.codes[at] == code, self.ranks[at], NEVER)
                good[rows] = ~((rank < x_used[rows]) & (rank <= y_used[rows]) & (rank < NEVER))
                y_used[rows] = self.made[y[rows]]
                y[rows] = self.left[y[rows]]
            x_used = np.where(live, self.made[x], x_used)
            x = np.where(live, self.right[x], -1)
        return good

    def learn(self, words: list[str]) -> None:
        """Find and remember the ids of distinct new words."""
        raw = [w.encode() for w in words]
        cuts = [self.greedy(w) for w in raw]
        flat = np.array([i for c in cuts for i in c], np.int64)
        ends = np.cumsum([len(c) for c in cuts])
        inside = np.ones(max(len(flat) - 1, 0), bool)
        inside[ends[:-1] - 1] = False
        where = np.flatnonzero(inside)
        codes, back = np.unique(flat[where] * self.size + flat[where + 1], return_inverse=True)
        new = [c for c in codes.tolist() if c not in self.pairs]
        if new:
            fresh = np.array(new, np.int64)
            if len(self.pairs) + len(new) > KNOWN_WORDS:
                self.pairs.clear()
                new, fresh = codes.tolist(), codes
            self.pairs.update(zip(new, self.compatible(fresh // self.size, fresh % self.size).tolist(), strict=True))
        good = np.array([self.pairs[c] for c in codes.tolist()], bool)
        failing = set(np.searchsorted(ends, where[~good[back]], side="right").tolist()) if len(codes) else set()
        for k, word in enumerate(words):
            ids = self.merged(raw[k]) if k in failing else cuts[k]
            self.known[word] = np.array(ids, "<u4").tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self._pieces(t) for t in texts]
        new = {w for words in split for w in words if w not in self.known}
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.older, self.known = self.known, {}
            new = {w for words in split for w in words}
        self.known |= {w: self.older[w] for w in new if w in self.older}
        new -= self.known.keys() | self.special.keys()
        if new:
            self.learn(list(new))
        self.known |= {t: np.array([i], "<u4").tobytes() for t, i in self.special.items()}
        find = self.known.__getitem__
        out = [b"".join(map(find, words)) for words in split]
        return out

    def _pieces(self, text: str) -> list[str]:
        """Words of a text; special tokens stand alone."""
        words = (self.words if self.not_latin.search(text) else self.latin_words).findall
        if not self.cut or not any(s in text for s in self.special):
            return words(text)
        out: list[str] = []
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                out.append(part)
            else:
                out += words(part)
        return out


def decoded(ids: bytes | None, tokens: list[bytes]) -> str:
    """The text of ids; bytes that are no UTF-8 become U+FFFD."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids or b"", "<u4").tolist())).decode("utf-8", "replace")


def there_and_back(docs: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids, decoded): ``encode_documents`` and ``decode_documents`` in one pass, so that each core needs one Python worker."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema[id_column].dataType

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in slices(batches):
            ids = encoder.encode_batch([t or "" for t in batch.column(1).to_pylist()])
            texts = [decoded(i, encoder.tokens) for i in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary()), pa.array(texts, pa.string())], names=["key", "ids", "decoded"])

    schema = T.StructType([T.StructField("key", kind), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])
    coded = docs.select(F.col(id_column).alias("key"), F.col(text_column).alias("text")).mapInArrow(both, schema)
    return coded.select(F.col("key").alias(id_column), "ids", "decoded")


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids): the ids of each whole text as a binary of little-endian unsigned 32-bit integers.

    A null or empty text has no ids (an empty binary); rows keep their multiplicity and null ids of rows stay null.
    Special tokens written in a text count as such. Other columns are not carried.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # bounded: one vocabulary file
    kind = docs.schema[id_column].dataType

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in slices(batches):
            ids = encoder.encode_batch([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["key", "ids"])

    schema = T.StructType([T.StructField("key", kind), T.StructField("ids", T.BinaryType())])
    coded = docs.select(F.col(id_column).alias("key"), F.col(text_column).alias("text")).mapInArrow(encode, schema)
    return coded.select(F.col("key").alias(id_column), "ids")


def decode_documents(coded: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(id, ids, decoded): the text of each sequence of ids; bytes that are no UTF-8 become U+FFFD. Null ids count as none."""
    shared = coded.sparkSession.sparkContext.broadcast(vocabulary)
    kind = coded.schema[id_column].dataType

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [decoded(ids, shared.value.tokens) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["key", "ids", "decoded"])

    schema = T.StructType([T.StructField("key", kind), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())])
    plain = coded.select(F.col(id_column).alias("key"), F.coalesce(ids_column, F.lit(b"")).alias("ids")).mapInArrow(decode, schema)
    return plain.select(F.col("key").alias(id_column), "ids", "decoded")


def digests(docs: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: number of ids, hash of the ids and hash of the text that they decode to."""
    return there_and_back(docs, vocabulary, id_column, text_column).select(
        id_column,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
