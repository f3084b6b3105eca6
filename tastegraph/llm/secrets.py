"""Secrets in texts: fixed patterns, and a linear-chain conditional random field that adds to them.

Tokens are runs of letters and digits, single marks and line ends, all of them. Each is tagged as the begin or inside of
a secret or as outside, from its shape and that of its word (a run without blanks), its neighbours, the words that
announce secrets before it, and features of the whole text. Transitions depend on how two tokens meet: glued, with
a blank between them, or at a line end. So a password with punctuation or a phrase of several words is one chain.

Viterbi is exact for the whole text, but runs only where it must. A word whose best secret tag loses more than any
transitions can give back is plain; a secret may reach into plain words only until their losses exceed what leaving
or entering a secret can gain (``Bounds``). Beyond that all is proved outside and never looked at.

The field is trained in numpy by gradient ascent (AdaGrad) on windows of a bounded sample of the documents, where the
patterns' matches are the truth, and on made-up lines that show secrets no pattern covers and harmless look-alikes.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
import operator
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns in their order and the length from which a match counts.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 8, 16
#: Some of these is in every text with an assignment.
KEYWORDS = ("password", "passwd", "secret", "token", "api")
#: The kind of the spans that the field adds.
ADDED = "field"

CHUNK = re.compile(r"\n|\S+")
TOKEN = re.compile(r"[^\W_]+|\n|_|[^\w\s]")
DIGIT = re.compile(r"[0-9]")
#: Words that announce a secret, by strength: a phrase of words, a secret, perhaps a secret.
ANNOUNCE = {3: re.compile(r"passphrase|mnemonic", re.I), 2: re.compile(r".*(?:passw|pwd|secret|token|bearer|credential).*|pass|private", re.I | re.S),
            1: re.compile(r"api|.{0,6}key|auth|authorization|access|login|signature|sig", re.I | re.S)}
#: Each of those words holds one of these.
HINT_PARTS = tuple("pass pwd secret token api key auth bearer cred private access login sig mnemonic".split())
HINTS = re.compile("|".join(HINT_PARTS), re.I)
HARMLESS = re.compile(
    r"(?P<number>[-+$€£(]*[0-9][0-9.,+/:%()_-]*)|(?P<uuid>[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})|(?P<mail>[^@\s/]+@[^@\s/]+\.[a-z]+)"
    r"|(?P<address>(?:https?://|www\.).*|[\w./-]*\.(?:com|org|net|html?|php|png|jpe?g|pdf|css|js|txt|py|md)(?:/.*)?)", re.S)
PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "sk_", "pk_", "xox", "AIza", "eyJ", "glpat-", "SG.")
#: Shapes of words of letters alone, and such words between marks.
LETTERS = ("lower", "upper", "title", "single")
SIMPLE = re.compile(r"([\"'(\[]*)([^\W\d_]{1,40})([.,;!?\"')\]]*)")
EDGE_MARKS = "\"'()[]{}<>,.;:!?`*"

OUT, BEGIN, INSIDE = 0, 1, 2
#: How two neighbouring tokens meet; the last kind lies behind the end of a training window and has no weights.
GLUED, SPACED, LINE, BEYOND = 0, 1, 2, 3
NEVER = -1e9
#: Tokens after an announcing word that know of it.
REACH = 8
#: Documents in the sample that trains the field, the most characters of each, windows of each sort, tokens of a window, rounds.
FIT_DOCS, FIT_CHARS, FIT_WINDOWS, WINDOW, ROUNDS = 2_000, 20_000, 1_200, 40, 8
#: Words whose bounds a worker remembers, and the longest of them.
KNOWN_WORDS, KNOWN_LENGTH = 150_000, 48
#: Words whose tokens a worker remembers.
KNOWN_PARTS = 20_000

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost, non-overlapping matches of each pattern as (kind, start, end)."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def kind_of(token: str) -> str:
    """What a token is made of; marks and line ends are their own kind."""
    if len(token) == 1 and not token.isalnum():
        return token
    if token.isdigit():
        return "digits"
    if token.isalpha():
        return "lower" if token.islower() else "upper" if token.isupper() else "title" if token[1:].islower() else "mixed"
    return "hex" if re.fullmatch(r"[0-9a-f]+", token) else "digits+lower" if token.islower() else "digits+upper" if token.isupper() else "digits+mixed"


def shape(word: str) -> str:
    """What a word without its outer marks is made of."""
    if known := HARMLESS.fullmatch(word):
        return known.lastgroup
    inner = "".join(c for c in word if c.isalnum())
    kind = kind_of(inner) if len(inner) > 1 else "single" if inner else "marks"
    marks = {c for c in word if not c.isalnum()}
    sorts = ("-" if marks & set("-_'’") else "") + ("." if marks & set("./+=") else "") + ("!" if marks - set("-_'’./+=") else "")
    return kind + sorts


def announces(token: str) -> int:
    if len(token) > 24 or not token.isalpha():
        return 0
    return next((k for k, words in ANNOUNCE.items() if words.fullmatch(token)), 0)


@dataclass
class Part:
    """A token of a word: its place, kind, the word's shape, and the names of what holds whatever stands around the word."""

    start: int
    end: int
    token: str
    kind: str
    shape: str
    names: list[str]
    hint: int
    #: The field that weighed the names last, and their sums.
    weighed: tuple[object, tuple[float, float, float]] | None = None


class Sorts(dict[str, tuple[bool, bool, bool]]):
    """What sort of character each one is."""

    def __missing__(self, c: str) -> tuple[bool, bool, bool]:
        self[c] = value = (c.isdigit(), c.isupper(), c.isalnum())
        return value


SORTS = Sorts()


def parts(word: str) -> list[Part]:
    """The tokens of a word with features that depend on the word alone."""
    return known_parts(word) if len(word) <= KNOWN_LENGTH else parts_anew(word)


def parts_anew(word: str) -> list[Part]:
    core = word.strip(EDGE_MARKS)
    form, size = shape(core), min(len(core) // 4, 10)
    entropy = 0.0
    if core and form not in LETTERS:
        shares = [core.count(c) / len(core) for c in dict.fromkeys(core)] if len(core) <= KNOWN_LENGTH else [n / len(core) for n in Counter(core).values()]
        entropy = -sum([p * math.log2(p) for p in shares])
    sorts = list(map(SORTS.__getitem__, core))
    changes = sum(map(operator.ne, sorts, sorts[1:]))
    whole = ["any=", f"shape={form}", f"size={form},{size}", f"entropy={size},{int(2 * entropy)}", f"changes={size},{min(changes, 8)}"]
    whole += [f"prefix={p}" for p in PREFIXES if core.startswith(p)][:1]
    found = list(TOKEN.finditer(word))
    kinds = ["", *[kind_of(m[0]) for m in found], ""]
    out = []
    for k, m in enumerate(found):
        token, kind = m[0], kinds[k + 1]
        names = [*whole, f"kind={kind}", f"length={kind},{min(len(token) // 3, 8)}", f"glued={kinds[k]}", f"next={kinds[k + 2]}",
                 f"edge={kind if k in (0, len(found) - 1) else ''}"]
        out.append(Part(m.start(), m.end(), token, kind, form, names, announces(token)))
    return out


#: A word is met when its bound is sought, and again in a stretch.
known_parts = functools.lru_cache(KNOWN_PARTS)(parts_anew)


def around(part: Part, hint: str, since: int) -> list[str]:
    """What the words before a token announce."""
    return [f"hint={hint}", f"hint-shape={hint},{part.shape}", f"hint-kind={hint},{part.kind}", f"hint-since={hint},{since}"]


NO_HINT = ("", 0)


def file_features(text: str) -> list[str]:
    return [f"file-size={min(len(text).bit_length() // 3, 6)}", f"file-hint={bool(HINTS.search(text))}"]


def side(word: str | None) -> str:
    return "line" if word is None or word == "\n" else "sep" if word[-1] in ":=" else "word"


@dataclass
class Row:
    """A token in its place: word and offsets in it, names of features of the place, and how it meets the token before."""

    word: int
    start: int
    end: int
    part: Part
    placed: list[str]
    meets: int

    @property
    def names(self) -> list[str]:
        return [*self.part.names, *self.placed]


def rows_of(words: list[str], lo: int, hi: int, whole: list[str]) -> list[Row]:
    """The tokens of words ``lo`` to ``hi`` with all their features. No word before ``lo`` may announce a secret in them."""
    out: list[Row] = []
    since, strength, told = REACH + 1, 0, False
    for k in range(lo, hi):
        word = words[k]
        inside = parts(word)
        before, after = side(words[k - 1] if k else None), side(words[k + 1] if k + 1 < len(words) else None)
        for at, part in enumerate(inside):
            since += 1
            near = (f"{strength}{'told' if told else ''}", since) if since <= REACH else NO_HINT
            names = [*around(part, *near), *whole]
            if at == 0:
                names.append(f"before={before}")
            if at == len(inside) - 1:
                names.append(f"after={'line' if after == 'line' else 'word'}")
            meets = GLUED if at else LINE if before == "line" or word == "\n" else SPACED
            out.append(Row(k, part.start, part.end, part, names, meets))
            if part.kind == "\n":
                since = REACH + 1
            elif part.hint:
                strength = max(part.hint, strength) if since <= REACH else part.hint
                since, told = 0, False
            elif part.token in (":", "=", "is"):
                told = True
    return out


ZERO = (0.0, 0.0, 0.0)
ALLOWED = np.array([[0, 0, NEVER], [0, 0, 0], [0, 0, 0]], float)


@dataclass
class Field:
    """Weights of the field: feature names by tag, and transitions between tags by how tokens meet."""

    weights: dict[str, tuple[float, float, float]]
    step: np.ndarray

    @functools.cached_property
    def bounds(self) -> Bounds:
        """Kept with the field, so that a worker's tasks share what they know of words."""
        return Bounds(self)

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "step": self.step}

    def scores(self, rows: list[Row]) -> list[tuple[float, float, float]]:
        return [self.weigh(r.part, r.placed) for r in rows]

    def weigh(self, part: Part, placed: list[str]) -> tuple[float, float, float]:
        """Sums of the weights of a token's own features, which are kept with it, and of its place's."""
        get = self.weights.get
        if part.weighed is None or part.weighed[0] is not self:
            part.weighed = self, tuple(map(sum, zip(*[get(n, ZERO) for n in part.names], strict=True)))
        return tuple(map(sum, zip(part.weighed[1], *[get(n, ZERO) for n in placed], strict=True)))


def viterbi(scores, meets: list[int], end: int, step: np.ndarray) -> list[int]:
    """Best tags of a stretch with outside before and after it; a tie goes to outside, then begin."""
    moves = (step + ALLOWED).tolist()
    into = [list(zip(*move)) for move in moves]
    best, back = [0.0, NEVER, NEVER], []
    for row, kind in zip(scores, meets, strict=True):
        after, pointers = [], []
        for (out, begin, inside), own in zip(into[kind], row):
            out, begin, inside = out + best[OUT], begin + best[BEGIN], inside + best[INSIDE]
            if out >= begin and out >= inside:
                after.append(out + own)
                pointers.append(OUT)
            elif begin >= inside:
                after.append(begin + own)
                pointers.append(BEGIN)
            else:
                after.append(inside + own)
                pointers.append(INSIDE)
        best = after
        back.append(pointers)
    last = [best[a] + moves[end][a][OUT] for a in (OUT, BEGIN, INSIDE)]
    tags, tag = [], last.index(max(last))
    for pointers in reversed(back):
        tags.append(tag)
        tag = pointers[tag]
    return tags[::-1]


class Bounds(dict[str, float]):
    """For each word, what it surely loses as part of a secret, as a number below zero; 1, 2 and 3 for words that must be
    looked at: such a loss is not sure, the word announces secrets, or it ends in a mark that does.

    Relative to outside, a token in a secret gains at most its own best tag and the best transition into it. Where the sum
    is at most ``-least`` it is plain. Let a stretch of plain tokens in a secret become outside: that wins all their
    losses and changes the transitions out of the secret before and the begin of the one after by at most ``change``. So no
    best tagging has a secret reach into plain tokens beyond losses of ``change``; and as ``least`` exceeds
    the gain of leaving a secret, none consists of plain tokens only.
    """

    def __init__(self, field: Field):
        super().__init__()
        self.field = field
        self.simple: dict[tuple, float] = {}
        self.hints: tuple[str, ...] = HINT_PARTS  # those that the text at hand may hold
        moves = field.step[:BEYOND] - field.step[:BEYOND, OUT, OUT][:, None, None]
        into = [*moves[:, OUT, BEGIN], *moves[:, 1:, 1:].ravel()]
        leave = moves[:, 1:, OUT].ravel()
        self.into = float(max(0, *into))
        self.least = 0.5 + float(max(0, leave.max()))
        best: dict[str, float] = {}
        begin: dict[str, float] = {}
        self.file = dict.fromkeys(("file-size", "file-hint"), 0.0)
        for name, (o, b, i) in field.weights.items():
            sort = name.split("=", 1)[0]
            best[name] = max(b, i) - o
            begin[sort] = max(begin.get(sort, 0.0), i - b)
            if sort in self.file:
                self.file[sort] = max(self.file[sort], best[name])
        self.best = best
        self.ends = {e: max(0.0, *(best.get(f"{e}={v}", 0.0) for v in ("line", "word"))) for e in ("before", "after")}
        start = sum(begin.values()) + float(moves[:, 1:, INSIDE].max() - moves[:, OUT, BEGIN].min())
        self.change = 0.5 + max(0.0, float(leave.max() - leave.min()), max(0.0, start) + max(0.0, -float(leave.min())))

    def __missing__(self, word: str) -> float:
        simple = SIMPLE.fullmatch(word)
        if simple and not self.hinted(word) and not simple[2].startswith(PREFIXES) and (kind := kind_of(simple[2])) in LETTERS:
            # all that such words' features depend on; a word that announces a secret holds a hint
            key = (simple[1], kind, len(simple[2]), simple[3])
            value = self.simple.get(key)
            if value is None:
                value = self.loss(word)
                if len(word) <= KNOWN_LENGTH:
                    self.simple[key] = value
        else:
            value = self.loss(word)
        if len(word) <= KNOWN_LENGTH:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = value
        return value

    def hinted(self, word: str) -> bool:
        if not self.hints:
            return False
        low = word.casefold()
        return "ı" in low or any([h in low for h in self.hints])

    def loss(self, word: str) -> float:
        inside = parts(word)
        if any(p.hint for p in inside):
            return 2.0
        if word[-1] in ":=":
            return 3.0
        worst = -math.inf
        for k, part in enumerate(inside):
            o, b, i = self.field.weigh(part, around(part, *NO_HINT))
            gain = max(b, i) - o + self.into + sum(self.file.values())
            gain += self.ends["before"] * (k == 0) + self.ends["after"] * (k == len(inside) - 1)
            worst = max(worst, gain)
        return worst if worst <= -self.least else 1.0

    def stretches(self, words: list[str], text: str | None = None) -> list[tuple[int, int]]:
        """Ranges of words outside which every token is proved outside. A ``text`` without hints needs no search for them in its words."""
        low = None if text is None else text.casefold()
        self.hints = tuple(h for h in HINT_PARTS if low is None or h in low or "ı" in low)
        loss = np.fromiter(map(self.__getitem__, words), float, len(words))
        live = loss > 0
        for k in np.flatnonzero(loss == 2).tolist():
            live[k:k + REACH + 1] = True
        follow = np.flatnonzero(loss == 3) + 1
        live[follow[follow < len(words)]] = True
        out: list[tuple[int, int]] = []
        for k in np.flatnonzero(live).tolist():
            if out and k < out[-1][1]:
                continue  # in reach of the last one, whose end is at least as far
            lo, lost = k, 0.0
            while lo > 0 and not live[lo - 1] and lost <= self.change:
                lo -= 1
                lost -= loss[lo]
            hi, lost = k + 1, 0.0
            while hi < len(words) and (live[hi] or lost <= self.change):
                lost = 0.0 if live[hi] else lost - loss[hi]
                hi += 1
            if out and lo <= out[-1][1]:
                out[-1] = (out[-1][0], hi)
            else:
                out.append((lo, hi))
        return out


def tagged(field: Field, words: list[str], lo: int, hi: int, whole: list[str]) -> Iterator[tuple[Row, int]]:
    """Each token of a stretch with its best tag."""
    rows = rows_of(words, lo, hi, whole)
    end = LINE if hi == len(words) or words[hi] == "\n" or words[hi - 1] == "\n" else SPACED
    for row, tag in zip(rows, viterbi(field.scores(rows), [r.meets for r in rows], end, field.step), strict=True):
        yield row, tag


def field_spans(field: Field, text: str, skip: bool = True) -> list[tuple[int, int]]:
    """(start, end) of the best tagging's secrets; without ``skip`` every token goes through Viterbi."""
    words = CHUNK.findall(text)
    stretches = field.bounds.stretches(words, text) if skip else [(0, len(words))] if words else []
    if not stretches:
        return []
    places = [m.start() for m in CHUNK.finditer(text)]
    whole, out = file_features(text), []
    for lo, hi in stretches:
        for row, tag in tagged(field, words, lo, hi, whole):
            at = places[row.word]
            if tag == BEGIN:
                out.append((at + row.start, at + row.end))
            elif tag == INSIDE:
                out[-1] = (out[-1][0], at + row.end)
    return out


def made_up(seed: int = 5, lines: int = 900) -> list[tuple[str, list[tuple[int, int]]]]:
    """Lines with secrets that no base pattern covers, and lines with harmless strings of the same look."""
    draw = random.Random(seed)
    pick = lambda alphabet, n: "".join(draw.choice(alphabet) for _ in range(n))
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    upper = lower.upper()
    mixed = lower + upper + digits
    syllables = [c + v for c in "bdfghklmnprstvwz" for v in "aeiou"] + ["an", "er", "in", "sch", "ung", "ent", "ó", "é", "ü"]
    common = "the of and to in is it for on that with as was are see and more not by der die und le la les de el que en los una".split()
    word = lambda: draw.choice(common) if draw.random() < 0.4 else "".join(draw.choice(syllables) for _ in range(draw.randint(2, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))

    def leet() -> str:
        text = "".join(draw.choice(syllables[:80]) for _ in range(draw.randint(2, 4))).title().replace("o", "0").replace("e", draw.choice("3e")).replace("a", draw.choice("4@a"))
        at = draw.randint(1, len(text) - 1)
        return text[:at] + draw.choice("!@#$%&*?^") + text[at:] + draw.choice("!&#%$") + pick(mixed, 3)

    def token() -> str:
        return draw.choice([
            lambda: pick(mixed, draw.randint(20, 44)), lambda: pick(lower + upper, draw.randint(20, 40)), lambda: pick(mixed + "+/", 38) + draw.choice(["==", "=", "Q"]),
            lambda: "ghp_" + pick(mixed, 36), lambda: "sk-" + pick(mixed, 46), lambda: draw.choice(["sk_live_", "pk_test_", "sk_test_"]) + pick(lower + upper if draw.random() < 0.5 else mixed, 28),
            lambda: "AIza" + pick(mixed + "_-", 34) + "5", lambda: f"eyJ{pick(mixed, 17)}.{pick(mixed, 40)}.{pick(mixed + '_-', 42)}8",
            lambda: "xoxb-" + pick(digits, 11) + "-" + pick(mixed, 24), lambda: pick(mixed, 6) + "".join("-" + pick(mixed, 6) for _ in range(4))])()

    def secret() -> tuple[str, str]:
        sort = draw.random()
        if sort < 0.35:
            return draw.choice(["aws_key = ", "Authorization: Bearer ", "authorization: bearer ", "private key: ", "auth: ", "credential is ", "see ", "set ", "Bearer ", "signature=", ""]), token()
        if sort < 0.6:
            return draw.choice(["pwd: ", "pwd=", "the pwd is ", "my pass is ", "pass: ", "login: admin / pwd: ", "credentials: "]), leet()
        if sort < 0.8:
            return draw.choice(["key = ", "key: ", "auth = ", "pwd = ", "credential: ", "access key: "]), pick(upper, 1) + pick(lower, 1) + pick(digits, 1) + pick(mixed, draw.randint(5, 9)) + pick(lower, 1)
        return draw.choice(["passphrase: ", "Passphrase = ", "wallet mnemonic: ", "passphrase is "]), " ".join(draw.choice([
            "".join(draw.choice(syllables[:80]) for _ in range(draw.randint(2, 3))), draw.choice("correct horse battery staple river stone window apple".split())]) for _ in range(draw.randint(3, 6)))

    def harmless() -> tuple[str, str]:
        lead = draw.choice(["at ", "key ", "see ", "number: ", "on ", "id = ", "key: ", "the login is ", "", "", ""])
        if draw.random() < 0.3:
            return draw.choice(["the key to ", "a token of ", "password: ", "secret: ", "pwd is ", "the secret is ", "access to ", "private ", "key: ", "auth: ", "login: ", "the passphrase was "]), prose(draw.randint(1, 4))
        return lead, draw.choice([
            lambda: f"20{pick(digits, 2)}-01-{pick(digits, 2)}T10:22", lambda: "+1-555-" + pick(digits, 7), lambda: pick(digits, draw.randint(1, 16)),
            lambda: f"www.{pick(lower, 6)}.com/page{pick(digits, 3)}", lambda: f"https://{pick(lower, 6)}.org/{word()}?{word()}={pick(digits, 3)}",
            lambda: f"{pick('0123456789abcdef', 8)}-{pick('0123456789abcdef', 4)}-4a1b-9c2d-{pick('0123456789abcdef', 12)}",
            lambda: f"v{pick(digits, 1)}.{pick(digits, 2)}.{pick(digits, 3)}-beta2", lambda: f"chapter{pick(digits, 3)}", lambda: f"user.name{pick(digits, 4)}", lambda: f"{word()}.{word()}@{word()}.com",
            lambda: f"DE{pick(digits, 20)}", lambda: f"img_{pick(digits, 4)}_{pick('abc', 3)}.jpg", lambda: f"192.168.{pick('12', 2)}.{pick('12', 2)}", lambda: f"Mozilla/5.0/{pick(digits, 4)}",
            lambda: word().title() + word().title() + word().title(), lambda: f"{word()}_{word()}_{word()}", lambda: word().upper() + " " + word().upper(), lambda: f"{word()}({word()}, {word()})",
            lambda: f"${pick(digits, 3)}.{pick(digits, 2)}!", lambda: f"#{word()} @{word()}", lambda: f"{word()}-{word()}-{word()}", lambda: f"\"{word().title()} {prose(2)}!\"",
            lambda: f"{word()}'s {pick(digits, 2)}%", lambda: f"<{word()}>{word()}</{word()}>", lambda: f"{word().title()}, {prose(3)}.", lambda: prose(6)])()

    out = []
    for k in range(2 * lines):
        lead, value = harmless() if k % 2 else secret()
        quote = draw.choice(["", "", "", '"', "'"])
        start = draw.choice(["", f"{prose(2)} ", f"{prose(4)}, ", f"{prose(3).title()}. ", f"{prose(3)}\n"]) + lead + quote
        tail = draw.choice(["", "", f"\n{prose(3)}"])
        if " " not in value:
            tail = draw.choice([tail, f" {prose(3)}", f", {prose(3)}", ".", f" {word().title()} {prose(2)}."])
        out.append((f"{start}{value}{quote}{tail}", [] if k % 2 else [(len(start), len(start) + len(value))]))
    return out


def true_spans(text: str) -> list[tuple[int, int]]:
    """What the base patterns say about secrets: values of assignments, access keys and long hex strings."""
    low = text.lower()
    values = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH] if any(k in low for k in KEYWORDS) else []
    return values + [s[1:] for s in base_spans(text) if s[0] != "assign"]


def examples(text: str, truth: list[tuple[int, int]], words: int = WINDOW // 2) -> Iterator[tuple]:
    """Windows of a text as (sort, words, lo, hi, file features, places, true spans): sort 2 holds a secret, 1 something like one, 0 neither."""
    chunks = list(CHUNK.finditer(text))
    whole, plain = file_features(text), [m[0] for m in chunks]
    for lo in range(0, len(chunks), words):
        hi = min(lo + words, len(chunks))
        first, last = chunks[lo].start(), chunks[hi - 1].end()
        mine = [s for s in truth if s[0] < last and first < s[1]]
        sort = 2 if mine else 1 if re.search(r"[0-9]|[a-z][A-Z]", text[first:last]) or HINTS.search(text, first, last) else 0
        yield sort, plain, lo, hi, whole, [m.start() for m in chunks[lo:hi]], mine


def labelled(window) -> tuple[list[Row], list[int], int]:
    _, words, lo, hi, whole, places, truth = window
    rows, tags, last = rows_of(words, lo, hi, whole)[:WINDOW], [], None
    for r in rows:
        at = places[r.word - lo]
        owner = next((s for s in truth if s[0] < at + r.end and at + r.start < s[1]), None)
        tags.append(OUT if owner is None else INSIDE if owner == last else BEGIN)
        last = owner
    return rows, tags, LINE if hi == len(words) else SPACED


def marginals(scores: np.ndarray, meets: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the tags of each token, (windows, tokens, 3), and expected transitions by kind, for windows at once.

    Windows end with tokens that can only be outside; the tag before the first token is outside.
    """
    n, size, _ = scores.shape
    moves = (step + ALLOWED)[meets]
    top = lambda a, axis: (m := a.max(axis=axis, keepdims=True), (np.log(np.exp(a - m).sum(axis=axis, keepdims=True)) + m).squeeze(axis))[1]
    ahead, behind = np.empty((n, size, 3)), np.zeros((n, size, 3))
    ahead[:, 0] = scores[:, 0] + moves[:, 0, OUT]
    for k in range(1, size):
        ahead[:, k] = top(ahead[:, k - 1, :, None] + moves[:, k], 1) + scores[:, k]
    for k in range(size - 2, -1, -1):
        behind[:, k] = top(moves[:, k + 1] + (scores[:, k + 1] + behind[:, k + 1])[:, None, :], 2)
    total = top(ahead[:, -1] + behind[:, -1], 1)
    tags = np.exp(ahead + behind - total[:, None, None])
    expected = np.zeros_like(step)
    np.add.at(expected[:, OUT], meets[:, 0], tags[:, 0])
    pairs = np.exp(ahead[:, :-1, :, None] + moves[:, 1:] + (scores[:, 1:] + behind[:, 1:])[:, :, None, :] - total[:, None, None, None])
    np.add.at(expected, meets[:, 1:], pairs)
    return tags, expected


def train(texts: list[str], rounds: int = ROUNDS, rate: float = 0.25, decay: float = 2e-4, seed: int = 3, batch: int = 64) -> Field:
    """AdaGrad on the likelihood of the tags over windows of the texts and made-up lines; order and seed are fixed."""
    windows = [w for t in texts for w in examples(t, true_spans(t))]
    draw = random.Random(seed)
    chosen = [w for sort in (2, 1, 0) for mine in [[w for w in windows if w[0] == sort]] for w in draw.sample(mine, min(len(mine), FIT_WINDOWS))]
    data = [labelled(w) for w in chosen] + [labelled(w) for t, truth in made_up() for w in examples(t, truth)]
    index: dict[str, int] = {}
    for rows, _, _ in data:
        for name in (n for r in rows for n in r.names):
            index.setdefault(name, len(index) + 1)
    most = max(len(r.names) for rows, _, _ in data for r in rows)
    size = WINDOW + 1
    names, meets = np.zeros((len(data), size, most), np.int32), np.full((len(data), size), BEYOND)
    truth, real = np.zeros((len(data), size), int), np.zeros((len(data), size), bool)
    for k, (rows, tags, end) in enumerate(data):
        for j, r in enumerate(rows):
            names[k, j, :len(r.names)] = [index[n] for n in r.names]
        meets[k, :len(rows) + 1] = [*(r.meets for r in rows), end]
        truth[k, :len(rows)], real[k, :len(rows)] = tags, True
    state, step = np.zeros((len(index) + 1, 3)), np.zeros((4, 3, 3))
    state_past, step_past = np.full_like(state, 1e-2), np.full_like(step, 1e-2)
    eye = np.eye(3)
    for _ in range(rounds):
        for at in itertools.batched(draw.sample(range(len(data)), len(data)), batch):
            x, g, y, here = (a[list(at)] for a in (names, meets, truth, real))
            scores = state[x].sum(axis=2)
            scores[~here] = [0, NEVER, NEVER]
            tags, expected = marginals(scores, g, step)
            push = (eye[y] - tags) * here[..., None]
            up = np.stack([np.bincount(x.ravel(), np.repeat(push[..., t].ravel(), most), len(state)) for t in range(3)], 1)
            up = up / batch - decay * state
            up[0] = 0
            seen = np.zeros_like(step)
            chain = np.concatenate([np.zeros((len(at), 1), int), y], 1)
            np.add.at(seen, (g, chain[:, :-1], chain[:, 1:]), 1)
            turn = (seen - expected) / batch - decay * step
            turn[BEYOND] = 0
            state_past += up * up
            step_past += turn * turn
            state += rate * up / np.sqrt(state_past)
            step += rate * turn / np.sqrt(step_past)
    return Field({n: tuple(state[k].tolist()) for n, k in index.items()}, step)


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", sample: int = FIT_DOCS, chars: int = FIT_CHARS) -> Field:
    """Train on about ``sample`` documents of at most ``chars`` characters, chosen by a hash of the id. That
    bounded sample is all that comes to the driver."""
    rows = docs.count()
    place = F.pmod(F.xxhash64(F.lit(17), F.col(id_column)), F.lit(1 << 30)) / float(1 << 30)
    picked = docs.where((F.char_length(text_column) <= chars) & (place < min(1.0, sample / max(rows, 1)))).select(F.col(text_column).alias("t"))
    texts = sorted({r.t for r in picked.limit(2 * sample).collect()}, key=lambda t: (hashlib.sha1(t.encode()).digest(), t))
    return train(texts)


def spans(field: Field, text: str) -> list[Span]:
    """All spans by start: the base ones, and the parts of the field's that no base span covers, unless they are marks only."""
    base = base_spans(text)
    added = [(ADDED, *s) for s in field_spans(field, text)]
    kept, first = [], 0
    reach = list(itertools.accumulate((s[2] for s in base), max))
    for kind, start, end in added:  # both lists are in order of their starts
        while first < len(base) and reach[first] <= start:
            first += 1
        at = start
        for _, lo, hi in itertools.takewhile(lambda s: s[1] < end, itertools.islice(base, first, None)):
            if at < lo:
                kept.append((kind, at, lo))
            at = max(at, hi)
        if at < end:
            kept.append((kind, at, end))
    kept = [s for s in kept if any(map(str.isalnum, text[s[1]:s[2]]))]
    order = {k: i for i, k in enumerate((*KINDS, ADDED))}
    return sorted([*base, *kept], key=lambda s: (s[1], order[s[0]]))


def found(docs: DataFrame, field: Field, text: Column) -> Column:
    """array of struct(kind, start, end) of a text; null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(field)  # bounded: features of the bounded sample

    @F.pandas_udf("array<struct<kind: string, start: int, end: int>>")
    def scan(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            yield pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in spans(shared.value, t or "")] for t in texts], dtype=object)

    return scan(text)


def redacted(docs: DataFrame, field: Field, text: Column, mark: str = "[SECRET]") -> Column:
    """The text with each union of overlapping spans replaced by ``mark``; null stays null, others stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def clean(value: str | None) -> str | None:
        if value is None:
            return None
        out, at = [], 0
        for _, start, end in spans(shared.value, value):
            if start >= at:
                out += [value[at:start], mark]
            at = max(at, end)
        return "".join([*out, value[at:]])

    @F.pandas_udf("string")
    def rewrite(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in series:
            yield pd.Series([clean(t) for t in texts], dtype=object)

    return rewrite(text)


def scanned(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_field, base_sha256, spans) for each row."""
    field = fit(docs, id_column, text_column)
    all_spans = docs.select(F.col(id_column).alias("id"), found(docs, field, F.col(text_column)).alias("all"))
    base = F.filter("all", lambda s: s.kind != ADDED)
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    of_kind = lambda k: F.size(F.filter("all", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    counts = [of_kind(k) for k in (*KINDS, ADDED)]
    return all_spans.select(F.col("id").alias(id_column), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("all").alias("spans"))
