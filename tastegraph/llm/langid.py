"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is lower-cased and cut into all runs of two, three and four UTF-8 bytes; each run is hashed to a row of an
embedding table, the rows are averaged, and a linear layer with softmax gives the languages. Both are trained by
stochastic gradient descent in numpy on a bounded sample of labelled rows. Since average and layer are linear, a
prediction only sums one score per run and language. A held-back part of the sample, whole and in short cuts, sets the
softmax temperature.

A text is rejected for either of two reasons, both calibrated on the held-back part: its best language has too low a
probability, or its runs are too rare in the learned languages. The second is the mean log frequency of its runs, one
more score per run. It is held against that of the rarest held-back texts, with room for chance that shrinks with the
square root of the text's length, since a softmax alone is sure of texts in languages it has never seen.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
RUNS = (2, 3, 4)
BUCKETS, WIDTH = 1 << 16, 16
#: The fit sees about this many labelled rows of each language, and only texts of at most so many characters.
FIT_ROWS, FIT_CHARS = 500, 20_000
#: Share of held-back labelled rows that may be rejected, and the highest threshold.
REJECT_SHARE, REJECT_MOST = 0.001, 0.5
#: Room below the rarest held-back texts, as a share of their distance from the median, and in deviations of the mean of a text's runs.
ROOM, DEVIATIONS = 0.25, 4.0
#: Words in the cuts of held-back texts that set the temperature.
CUTS = (1, 2, 4)
#: Bytes whose runs are hashed at once.
PIECE = 1 << 20


@dataclass
class Model:
    """``scores``: (buckets, languages); a text's logits are the mean score of its runs plus ``bias``, over ``temperature``.

    ``common``: log frequency of each bucket in the learned texts; a text is known if the mean over its runs is at least
    ``usual`` less ``spread`` over the square root of their number.
    """

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    common: np.ndarray | None = None
    usual: float = -np.inf
    spread: float = 0.0

    @functools.cached_property
    def table(self) -> np.ndarray:
        common = np.zeros(len(self.scores), np.float32) if self.common is None else self.common
        return np.column_stack([self.scores, common])


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def hashed(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each run length: the bucket of the run that starts at each byte."""
    code = data.astype(np.uint32)
    for n in range(2, max(RUNS) + 1):
        if len(data) < n:
            return
        code = (code[:-1] << np.uint32(8)) ^ data[n - 1:]
        if n in RUNS:
            yield n, (code * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(16)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and the share of its runs that fall into each."""
    data = np.frombuffer(f" {text.lower()} ".encode(), np.uint8)
    rows, counts = np.unique(np.concatenate([h for _, h in hashed(data)]), return_counts=True)
    return rows, (counts / counts.sum()).astype(np.float32)


def measured(table: np.ndarray, text: str) -> tuple[np.ndarray, int]:
    """Mean row of ``table`` over the runs of the whole text, and their number; piece by piece so that memory does not grow."""
    data = np.frombuffer(f" {text.lower()} ".encode(), np.uint8)
    total, runs = np.zeros(table.shape[1]), 0
    for start in range(0, len(data), PIECE):
        for n, rows in hashed(data[start:start + PIECE + max(RUNS) - 1]):
            rows = rows[:min(PIECE, len(data) - start - n + 1)]
            total += table[rows].sum(axis=0, dtype=np.float64)
            runs += len(rows)
    return total / max(runs, 1), runs


def logits(model: Model, text: str) -> np.ndarray:
    return measured(model.scores, text)[0] + model.bias


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: list[str], labels: list[str], epochs: int = 6, rate: float = 8.0, seed: int = 7) -> Model:
    """Fit on texts and random cuts of them, so that short texts are known too; every fifth text sets the threshold."""
    languages = sorted(set(labels))
    draw = np.random.default_rng(seed)
    kept = [k for k in range(len(texts)) if k % 5]
    held = [k for k in range(len(texts)) if k % 5 == 0] if len(texts) >= 50 else kept
    samples = []
    for k in kept or range(len(texts)):
        words = texts[k].split(" ")
        samples.append((bag(texts[k]), languages.index(labels[k])))
        for length in (4, 12, 40):
            start = int(draw.integers(0, max(1, len(words) - length)))
            if has_letter(part := " ".join(words[start:start + length])):
                samples.append((bag(part), languages.index(labels[k])))
    table = draw.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    layer = np.zeros((WIDTH, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    steps, step = epochs * len(samples), 0
    for _ in range(epochs):
        for k in draw.permutation(len(samples)):
            (rows, shares), label = samples[k]
            pace = rate * (1 - step / steps)
            own = table[rows]
            hidden = shares @ own
            wrong = softmax(hidden @ layer + bias)
            wrong[label] -= 1
            back = layer @ wrong
            layer -= pace * 0.1 * np.outer(hidden, wrong)
            bias -= pace * 0.01 * wrong
            table[rows] = own - pace * np.outer(shares, back)
            step += 1
    seen = np.zeros(BUCKETS)
    for k in kept or range(len(texts)):
        rows, shares = bag(texts[k])
        seen[rows] += shares * len(texts[k])
    common = np.log((seen + 0.5) / (seen.sum() + 0.5 * BUCKETS)).astype(np.float32)
    model = Model(languages, table @ layer, bias, common=common)
    return calibrated(model, [texts[k] for k in held], [labels[k] for k in held])


def calibrated(model: Model, texts: list[str], labels: list[str]) -> Model:
    """Set the temperature of least loss over these rows and short cuts of them, and both bounds of rejection, from the least
    sure and the rarest of ``REJECT_SHARE`` of these rows."""
    if not texts:
        return model
    found = [measured(model.table, t) for t in texts]
    z, known = np.array([m[:-1] + model.bias for m, _ in found]), np.sort([m[-1] for m, _ in found])
    cuts = [(c, x) for t, x in zip(texts, labels, strict=True) for n in CUTS if has_letter(c := " ".join(t.split()[n:2 * n]))]
    short = np.array([logits(model, c) for c, _ in cuts]).reshape(len(cuts), len(model.languages))
    y = np.array([model.languages.index(x) for x in (*labels, *(x for _, x in cuts))])
    loss = lambda t: -np.log(softmax(np.concatenate([z, short]) / t)[np.arange(len(y)), y] + 1e-12).mean()
    model.temperature = float(min((0.001 * 1.2 ** k for k in range(60)), key=loss))
    sure = np.sort(softmax(z / model.temperature).max(axis=1))
    last = int(REJECT_SHARE * len(sure))
    model.threshold = float(min(REJECT_MOST, 0.9 * sure[last]))
    weight = np.exp(model.common.astype(float))
    weight /= weight.sum()
    deviation = np.sqrt(weight @ model.common.astype(float) ** 2 - (weight @ model.common.astype(float)) ** 2)
    model.usual = float(known[last] - ROOM * (np.median(known) - known[last]))
    model.spread = float(DEVIATIONS * deviation)
    return model


def learnable(id_column: Column) -> Column:
    """Rows that may be learned from; the others are held out. A null id is never learned from."""
    return F.crc32(id_column.cast("string").cast("binary")) % 3 != 1


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
        rows: int = FIT_ROWS, chars: int = FIT_CHARS) -> Model:
    """Train on a sample of the labelled rows that are not held out: about ``rows`` of each language, by a hash of the id.

    Only texts with a letter and of at most ``chars`` characters are learned from; the sample is all that comes to the
    driver. Without any such row the model knows no language.
    """
    usable = docs.where(F.col(lang_column).isNotNull() & learnable(F.col(id_column)) & F.col(text_column).isNotNull()
                        & (F.char_length(text_column) <= chars))
    counts = {r[0]: r[1] for r in usable.groupBy(lang_column).agg(F.count(F.lit(1))).collect()}  # one row a language
    if not counts:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, rows / n))])
    place = F.pmod(F.xxhash64(F.lit(11), F.col(id_column)), F.lit(1 << 30)) / float(1 << 30)
    sample = usable.where(place < share[F.col(lang_column)]).select(F.col(lang_column).alias("l"), F.col(text_column).alias("t"), place.alias("p"))
    bound = 2 * rows * len(counts)  # twice what the hash gives: stops only at rows that repeat one id again and again
    found = sorted({(r.p, r.l, r.t) for r in sample.limit(bound).collect() if has_letter(r.t)})
    return train([t for _, _, t in found], [lang for _, lang, _ in found]) if found else Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))


def predict(model: Model, text: str | None) -> tuple[str, float, bool]:
    """(language, probability, rejected); a model that knows no language rejects only what has no letter."""
    if not has_letter(text) or not model.languages:
        return UNKNOWN, 0.0, not has_letter(text)
    mean, runs = measured(model.table, text)
    p = softmax((mean[:-1] + model.bias) / model.temperature)
    best = int(p.argmax())
    rare = mean[-1] < model.usual - model.spread / np.sqrt(max(runs, 1))
    return model.languages[best], float(p[best]), bool(p[best] < model.threshold or rare)


def language(docs: DataFrame, model: Model, text: Column) -> Column:
    """struct(lang, score, rejected) of a text: null, empty or letterless is ``und``, 0 and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: buckets times languages

    @F.pandas_udf("lang string, score double, rejected boolean")
    def known(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in series:
            yield pd.DataFrame([predict(shared.value, t) for t in texts], columns=["lang", "score", "rejected"])

    return known(text)


def predicted(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """(id, held_out, lang_pred, score, rejected) for each row, by a model fitted on the rows that are not held out."""
    model = fit(docs, id_column, text_column, lang_column)
    plain = docs.select(F.col(id_column).alias("id"), language(docs, model, F.col(text_column)).alias("found"))
    return plain.select(
        F.col("id").alias(id_column), F.coalesce(~learnable(F.col("id")), F.lit(False)).alias("held_out"),
        F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"), F.col("found.rejected").alias("rejected"))
