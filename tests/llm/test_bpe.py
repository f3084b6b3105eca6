"""Ids equal those of the tokenizers library; decoding gives the text back."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tastegraph.llm import bpe
from tastegraph.llm.queries import byte_vocabulary

PIECES = ["a", "b", "'s", "'LL", "  ", "\t", "\n", "é", "中", "文", "​", "\x85", "\xa0", "\x1c", "1", "²", "Ⅷ", "٣",
          "!", "<|endoftext|>", "<|end", "😀", "̈", "the", "ing", "aaaa", "　", "_", "-", "ª", "ǅ", " "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def texts():
    draw = random.Random(1)
    mixed = ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 30))) for _ in range(500)]
    return [*mixed, "", "a" * 20000, "ab" * 5000, " " * 300 + "x", "\x00\x01"]


def test_ids_equal_the_library(library):
    encoder = bpe.Encoder(byte_vocabulary())
    want = [np.array(x.ids, "<u4").tobytes() for x in library.encode_batch(texts(), add_special_tokens=False)]
    assert encoder.encode_batch(texts()) == want


def test_remembered_words_may_be_forgotten(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 20)
    encoder = bpe.Encoder(byte_vocabulary())
    for text in texts():
        assert encoder.encode_batch([text]) == [np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]


def test_every_token_encodes_to_itself_or_by_merges():
    vocabulary = byte_vocabulary()
    encoder = bpe.Encoder(vocabulary)
    draw = random.Random(2)
    for token in draw.sample([t for t in vocabulary.tokens if t], 2000):
        short, encoder_long = encoder.merged(token), encoder._merged_short(token)
        assert short == encoder_long


def test_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "hello world", None), (3, "hello world", "x"), (3, "hello world", "x"), (4, "né " * 40000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = bpe.digests(docs, byte_vocabulary()).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got)[:5] == [(0, 2), (1, 0), (2, 0), (3, 2), (3, 2)]
    back = bpe.decode_documents(bpe.encode_documents(docs, byte_vocabulary()), byte_vocabulary()).collect()
    assert sorted(r.decoded for r in back) == sorted(t or "" for _, t, _ in rows)
    assert bpe.digests(docs.where("false"), byte_vocabulary()).count() == 0


def test_bytes_that_are_no_text(spark, library):
    odd = [library.encode("é", add_special_tokens=False).ids, [0xA0 % 256, 5, 130, 131], [200, 201]]
    coded = spark.createDataFrame([(i, bytearray(np.array(x, "<u4").tobytes())) for i, x in enumerate(odd)], "doc_id long, ids binary")
    got = {r.doc_id: r.decoded for r in bpe.decode_documents(coded, byte_vocabulary()).collect()}
    assert got == {i: library.decode(x, skip_special_tokens=False) for i, x in enumerate(odd)}
