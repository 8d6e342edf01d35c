"""Piece ids against the model's library."""

from __future__ import annotations

import hashlib
import random

import pytest
import sentencepiece
from helpers import AWKWARD, docs, words
from public_tokenizers import path

from candlemill.llm import piece_encoding
from candlemill.llm.piece_encoding import MODEL, PieceEncoder, piece_digests, segment_pattern, with_pieces

PARTS = [" ", "  ", "\n", "\t", "▁", "a", "b", "the", "ing", "ation", "<s>", "<0x41>", "é", "é", "漢", "字", "😀", "\x00",
         "​", "ﬁ", "Ａ", "_", "1", "23", "....", "     ", "zz", "İ", "ß", "\r\n", "�", "###", "&&&", "don't", "e.g."]


@pytest.fixture(scope="module")
def own():
    return PieceEncoder()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=path(MODEL))


def test_ids_of_random_texts(own, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(30))) for _ in range(6000)]
    texts += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(32, 1500), rng.randrange(0x3000, 0x9000)]))
                      for _ in range(rng.randrange(150))) for _ in range(1500)]
    for text in texts:
        assert own.encode(text) == library.encode(text, add_bos=True, add_eos=True)


def test_very_long_texts(own, library):
    for text in ("a" * 60_000, " " * 40_000, "ab" * 30_000, "x " * 30_000, "\n" * 5000, "漢" * 5000, "tion" * 20_000):
        assert own.encode(text) == library.encode(text, add_bos=True, add_eos=True)


def test_neighbours_of_borders_tell_what_merging_tells(own):
    rng = random.Random(2)
    steady = sorted(own.steady)
    for _ in range(8000):
        a, b = rng.choice(steady), rng.choice(steady)
        merged = own.merge(own.text_of[a] + own.text_of[b])
        assert own._stay_apart(a, b) == (merged == [own.text_of[a], own.text_of[b]])


def test_backtracking_goes_back():
    """A vocabulary in which the longest piece first leads nowhere."""
    own = PieceEncoder.__new__(PieceEncoder)
    own.ids = {"a": 0, "b": 1, "c": 2, "ab": 3, "bc": 4, "abc": 5}
    own.score = {"bc": -1.0, "ab": -2.0, "abc": -3.0, "a": -9.0, "b": -9.5, "c": -9.7}
    assert own.merge("abcab") == ["abc", "ab"] and own.merge("abbc") == ["ab", "bc"]


def test_segments_keep_all_characters(own):
    rng = random.Random(3)
    for _ in range(2000):
        text = "▁" + "".join(rng.choice(PARTS) for _ in range(20)).replace(" ", "▁")
        assert "".join(own.segments.findall(text)) == text
    assert segment_pattern(["a▁b"]) == "(?s:.+)"


def test_forgetting_changes_nothing(own, library, monkeypatch):
    monkeypatch.setattr(piece_encoding, "MAX_SEGMENTS", 5)
    monkeypatch.setattr(piece_encoding, "MAX_PAIRS", 3)
    rng = random.Random(4)
    for _ in range(40):
        text = words(rng, 30)
        assert own.encode(text) == library.encode(text, add_bos=True, add_eos=True)


def test_rows(spark, library):
    rng = random.Random(5)
    rows = [(k, words(rng, 50)) for k in range(30)] + AWKWARD + [(3, "again"), (3, "again"), (40, "x" * 30_000)]
    frame = docs(spark, rows)
    got = sorted(map(tuple, piece_digests(frame).collect()), key=repr)

    def want(k, text):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        return k, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()

    assert got == sorted((want(*r) for r in rows), key=repr)
    whole = {r.doc_id: r for r in with_pieces(frame).collect()}
    assert whole[9001].ids == whole[9002].ids == [1, 2] and whole[9001].decoded == ""
    assert whole[9007].decoded == dict(AWKWARD)[9007]
    assert piece_digests(frame.limit(0)).count() == 0
