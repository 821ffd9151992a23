"""Merge rounds against the library that the ids must equal."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest

from tallymark.llm import symbols

PATH = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = "abcdetnioThe ,.\n\t▁é日本́\x00<>0xA1' "


def _texts():
    rng = random.Random(4)
    texts = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["a" * n for n in (1, 5, 255, 256, 257, 300, 2000)] + [" " * n for n in (1, 2, 3, 16, 17, 40, 255, 257, 1000)]
    texts += ["ab" * 400 + " " + "x y" * 200, "the" * 200, "\U0001f600 x", "<s> </s> <unk> <0x0A>", "\r\n \n"]
    texts += ["".join(chr(rng.randint(1, 0x2FFF)) for _ in range(3000)), "word " * 30000, None, ""]
    return texts


TEXTS = _texts()


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=PATH)


@pytest.mark.parametrize(("keep", "long"), [(200_000, 256), (50, 256), (200_000, 8), (200_000, 10**6)])
def test_ids_equal_the_library(library, monkeypatch, keep, long):
    """With a full and a small memory; long segments early by the heap, and never."""
    monkeypatch.setattr(symbols, "LONG", long)
    encoder = symbols.SymbolEncoder(PATH, keep=keep)
    texts = TEXTS if long < 10**6 else [t for t in TEXTS if t and len(t) < 500]
    for begin in range(0, len(texts), 100):
        part = texts[begin : begin + 100]
        assert [np.frombuffer(p, "<u4").tolist() for p in encoder(part)] == [library.encode(t or "") for t in part]


def test_texts_equal_the_library(library):
    rng = random.Random(5)
    decoder = symbols.SymbolDecoder(PATH)
    lists = [library.encode(t or "") for t in TEXTS]
    lists += [[rng.choice([rng.randint(0, 300), rng.randint(0, 31999)]) for _ in range(rng.randint(0, 12))] for _ in range(4000)]
    assert [decoder(ids) for ids in lists] == [library.decode(ids) for ids in lists]
    with pytest.raises(ValueError, match="outside"):
        decoder([32000])


def test_tables(spark, library):
    rows = [(i % 7 if i % 5 else None, t, "n", 3) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, __id int").repartition(3)
    out = symbols.decode(symbols.encode(docs, PATH), PATH)
    assert out.columns == ["doc_id", "ids", "decoded"]
    expected = [(i, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t, *_ in rows]
    assert sorted(map(repr, ((r.doc_id, list(r.ids), r.decoded) for r in out.collect()))) == sorted(map(repr, expected))
    assert symbols.decode(symbols.encode(docs.limit(0), PATH), PATH).count() == 0


def test_merges_from_the_left_do_not_overlap():
    hit = np.array([True, True, True, False, True, True, False, True])
    assert symbols._from_the_left(hit).tolist() == [True, False, True, False, True, False, False, True]
