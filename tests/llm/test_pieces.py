from __future__ import annotations

import os

import numpy as np
import pytest
from corpora import corpus, edge_rows, edge_table, table
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import pieces

sentencepiece = pytest.importorskip("sentencepiece")
PATH = os.path.join(pieces.TOKENIZERS, "piece_bpe_32k.model")
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary here")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.PieceModel.load(PATH))


def ids_of(encoder, texts):
    flat, bounds = encoder.encode(texts)
    return [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


TRICKY = ["", " ", "  ", "a  b ", " x", "\n\n", "tab\tq", "é é", "ﬁ①", "<s></s><0x0A>", "　z", "a\r\nb", "aaaaaaaaaaaaaaaa",
          "😀 😀😀", "    code    indent", "antidisestablishmentarianism 3.14159", "x" * 700, "Das übergroße Straßenschild."]


def test_ids_of_the_library(encoder, library):
    assert ids_of(encoder, [*TRICKY, None]) == [*(library.encode(text) for text in TRICKY), []]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abehinorst .,ÉéßA1\n 漢😀'"), max_size=40), max_size=6))
def test_random_texts(encoder, library, texts):
    assert ids_of(encoder, texts) == [library.encode(text) for text in texts]


def test_round_trip(encoder):
    decoder = pieces.Decoder(encoder.model)
    flat, bounds = encoder.encode(TRICKY)
    assert [decoder.decode(flat[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == TRICKY


def test_forgetting_changes_nothing(encoder, monkeypatch, library):
    monkeypatch.setattr(pieces, "KNOWN_BYTES", 2000)
    small = pieces.Encoder(encoder.model)
    texts = [text for _, text, *_ in corpus()]
    assert [ids_of(small, [text])[0] for text in texts] == library.encode(texts)


def test_unigram_scores(library):
    """The same pieces as a unigram model: the sum of scores is the library's."""
    from sentencepiece import sentencepiece_model_pb2

    with open(PATH, "rb") as file:
        proto = sentencepiece_model_pb2.ModelProto.FromString(file.read())
    for rank, piece in enumerate(proto.pieces):
        if piece.type == piece.NORMAL:
            piece.score = -float(np.log(rank + 2.0))
    proto.trainer_spec.model_type = sentencepiece_model_pb2.TrainerSpec.UNIGRAM
    other = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    kinds = np.array([1 if other.is_byte(i) else 0 if p.type == p.NORMAL else 2 for i, p in enumerate(proto.pieces)])
    scores = np.array([p.score for p in proto.pieces])
    model = pieces.PieceModel([p.piece for p in proto.pieces], scores, False, np.full(256, 0, dtype=np.int32), kinds)
    texts = ["the river is wide", "antidisestablishmentarianism", "Straßenschild und Apfel"]
    for mine, theirs in zip(ids_of(pieces.Encoder(model), texts), other.encode(texts), strict=True):
        assert scores[mine].sum() == pytest.approx(scores[theirs].sum(), abs=1e-3)


def test_a_very_long_text_in_parts(encoder, library, monkeypatch):
    monkeypatch.setattr(pieces, "PART_CHARS", 200)
    text = "The river  is wide, and  the stone is old. " * 60
    flat, _ = pieces._encode_all(encoder, [text, "short"])
    assert flat.tolist() == library.encode(text) + library.encode("short")


def test_tables(spark, library):
    rows = edge_rows()
    got = pieces.encode_pieces(edge_table(spark), PATH, round_trip="same")
    assert [c for c in got.columns if c not in ("piece_ids", "same")] == [c for c in edge_table(spark).columns if c != "text"]
    found = sorted((str(row.doc_id), list(row.piece_ids), row.same) for row in got.collect())
    assert found == sorted((str(i), library.encode(text or ""), True) for i, text, *_ in rows)
    back = pieces.decode_pieces(pieces.encode_pieces(table(spark, rows), PATH), PATH)
    assert sorted(row.text for row in back.collect()) == sorted(text or "" for _, text, *_ in rows)
    assert pieces.encode_pieces(edge_table(spark, []), PATH).collect() == []
