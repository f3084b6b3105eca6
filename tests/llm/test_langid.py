"""Held-out accuracy on the small documents, rejection, and edge cases."""

import zlib

import numpy as np

from tastegraph.llm import langid
from tastegraph.llm.common import read_table


def test_held_out_accuracy(spark, folder):
    docs = read_table(spark, folder.replace("sf0.001", "sf0.01"), "documents")
    got = langid.predicted(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert sum(r.rejected for r in got) <= 0.01 * len(got)


def test_held_out_labels_are_not_learned(spark):
    held = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 3 == 1][:60]
    open_ = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 3 != 1][:60]
    rows = [(i, "das ist ein kleiner text", "xx", "s") for i in held] + [(i, f"this is text number {i}", "en", "s") for i in open_]
    got = langid.predicted(spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")).collect()
    assert {r.lang_pred for r in got} == {"en"}


def test_edges(spark):
    rows = [(None, "some words", None, "s"), (1, None, "en", "s"), (2, "", "en", "s"), (3, "12 % ²", "en", "s"), (4, "plain english words here", "en", "s"),
            (4, "plain english words here", "en", "s"), (6, "mots " * 300_000, "fr", "s"), (7, "日本", "ja", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = {(r.doc_id, r.lang_pred) for r in langid.predicted(docs).collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= got and len(got) == 7
    assert langid.predicted(docs.where("false")).count() == 0
    nothing = langid.predicted(docs.withColumn("lang", docs.lang.substr(9, 1)).where("doc_id is null")).head()
    assert (nothing.lang_pred, nothing.score, nothing.rejected, nothing.held_out) == ("und", 0.0, False, False)


def test_pieces_do_not_change_the_sum(monkeypatch):
    draw = np.random.default_rng(1)
    model = langid.Model(["a", "b"], draw.normal(size=(langid.BUCKETS, 2)), np.zeros(2))
    text = "Größe und Länge, deux mots " * 50
    whole = langid.logits(model, text)
    rows, shares = langid.bag(text)
    assert np.allclose(whole, shares @ model.scores[rows], atol=1e-4)
    monkeypatch.setattr(langid, "PIECE", 37)
    assert np.allclose(whole, langid.logits(model, text))


def test_unsure_texts_are_rejected():
    german, english = "der die das und ist nicht ein eine", "the of and to in that is was for it"
    model = langid.train([german] * 40 + [english] * 40, ["de"] * 40 + ["en"] * 40)
    assert langid.predict(model, german)[0] == "de" and not langid.predict(model, english)[2]
    model.threshold = 0.99
    assert langid.predict(model, "zzz qqq")[2]


#: Rejected share of documents of 20 words and more in languages that the model has not learned.
LEFT_OUT = 0.9
FOREIGN = [
    "Kissa istui matolla ja oli iloinen, koska talossa oli ruokaa kaikille, jotka tulivat sinne illalla", "Кошка сидела на коврике и была рада, что все пришли",
    "Kot siedział na macie i był szczęśliwy, że wszyscy przyszli wieczorem po jedzenie", "Macska ült a szőnyegen és boldog volt, hogy eljöttek az ételért",
]


def test_languages_never_seen_are_rejected(spark, folder):
    """A softmax is sure of them; the frequency of their runs is not. The temperature lies inside its grid."""
    docs = read_table(spark, folder.replace("sf0.001", "sf0.01"), "documents")
    model = langid.fit(docs)
    assert 0.001 < model.temperature < 0.001 * 1.2 ** 59
    assert all(langid.predict(model, t)[2] for t in FOREIGN)
    for text in ("The cat sat on the mat and was glad that they had come", "Die Katze saß auf der Matte und war froh", "ok", "Le chat"):
        assert not langid.predict(model, text)[2]
    held = [r.text for r in docs.where("lang is not null").where(~langid.learnable(docs.doc_id)).collect()]
    assert sum(langid.predict(model, t)[2] for t in held) <= 0.01 * len(held)


def test_rejection_of_languages_left_out(spark, folder):
    """Trained on two of the four languages, documents of the others mostly go and those of the two stay."""
    rows = [r for r in read_table(spark, folder.replace("sf0.001", "sf0.01"), "documents").orderBy("doc_id").collect() if r.lang and langid.has_letter(r.text) and len(r.text) < 20_000]
    learned = [r for r in rows if r.lang in ("de", "en")]
    model = langid.train([r.text for r in learned[::2]], [r.lang for r in learned[::2]])
    share = lambda some: sum(langid.predict(model, r.text)[2] for r in some) / len(some)
    assert share(learned[1::2]) <= 0.02
    assert share([r for r in rows if r.lang in ("es", "fr") and len(r.text.split()) >= 20]) >= LEFT_OUT
