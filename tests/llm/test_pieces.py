"""Encoding and decoding against the library, and the merges step by step."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from cases import frame, odd_rows

from marketlens.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "ab  ▁▁\n\t\x00eé日本​𝔘ñ<s>0x́'.,- �"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return pieces.Encoder(PATH)


def texts():
    rng = random.Random(3)
    yield from ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    yield from [r[1] or "" for r in odd_rows()]
    yield from ["a" * 9000, " " * 9000, "x1" * 4000, "日本" * 3000, "".join(rng.choice("abcdefghij0123=/") for _ in range(9000))]


def test_ids_and_text_are_the_librarys(own, library):
    for text in texts():
        ids = library.encode(text)
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids)


def test_any_ids_decode_as_in_the_library(own, library):
    rng = random.Random(4)
    for _ in range(3000):
        ids = [rng.randrange(262) if rng.random() < 0.6 else rng.randrange(32_000) for _ in range(rng.randint(0, 12))]
        assert own.decode(ids) == library.decode(ids), ids


def test_backtracking_gives_what_the_merges_give(own):
    """Without the cuts and the memory of parts; failed places are met on the way."""
    rng = random.Random(5)
    failures = 0
    for _ in range(3000):
        part = "".join(rng.choice(["▁", "t", "h", "e", "r", "in", "s", "an"]) for _ in range(rng.randint(1, 14)))
        numbers = own.pieces.encode(part)
        assert [own.pieces.text[k] for k in numbers] == own.pieces.merged(part)
        greedy = [-1] * len(part)
        own.pieces.longest(part, 0, greedy)
        failures += [k for k in greedy if k >= 0] != numbers
    assert failures > 100


def test_the_longest_piece_at_a_place(own):
    rng = random.Random(6)
    for _ in range(300):
        part = "".join(rng.choice("▁these 1,.").replace(" ", "▁") for _ in range(20))
        out = [-1] * len(part)
        own.pieces.longest(part, 0, out)
        for at, k in enumerate(out):
            if k >= 0:
                longest = max((part[at:end] for end in range(at + 1, len(part) + 1) if part[at:end] in own.pieces.number), key=len)
                assert own.pieces.text[k] == longest


def test_two_pieces_fit_if_merging_gives_them_back(own):
    rng = random.Random(7)
    table = own.pieces
    common = range(3000)
    fits = 0
    for _ in range(4000):
        a, b = rng.choice(common), rng.choice(common)
        fits += table.fit(a, b)
        assert table.fit(a, b) == (table.merged(table.text[a] + table.text[b]) == [table.text[a], table.text[b]])
    assert 0 < fits < 4000


def test_a_small_memory_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(pieces, "REMEMBERED", 20)
    small = pieces.Encoder(PATH)
    for text in list(texts())[:400]:
        assert small.encode(text) == library.encode(text)


def test_digests_of_odd_rows(spark, library):
    rows = odd_rows()
    got = sorted(map(repr, map(tuple, pieces.digests(frame(spark, rows), PATH).collect())))

    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    expected = []
    for doc_id, text in rows:
        ids = library.encode(text or "")
        expected.append(repr((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))))
    assert got == sorted(expected)
    assert pieces.digests(frame(spark, []), PATH).count() == 0


def test_columns_of_ids_and_of_texts(spark, library):
    docs = frame(spark, odd_rows())
    rows = pieces.detokenize(pieces.tokenize(docs, PATH), PATH, out="again")
    assert rows.columns == [*docs.columns, "ids", "again"]
    for r in rows.select("text", "ids", "again").collect():
        assert r.ids == library.encode(r.text or "") and r.again == library.decode(r.ids)
    with pytest.raises(ValueError):
        pieces.tokenize(docs, "piece_bpe_32k.model")
