import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from cases import frame, odd_rows, words
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlens.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def known():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(PATH, P.PATTERN)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text("abcde thing\n'  12", max_size=80))
def test_same_ids_as_the_library(text):
    own, library = bpe.encoder(PATH, P.PATTERN), _library()
    ids = own.encode(text)
    assert ids == library.encode_ordinary(text) and own.decode(ids) == text.encode()


_CACHE = []


def _library():
    if not _CACHE:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
        _CACHE.append(tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    return _CACHE[0]


def test_every_kind_of_character_is_split_alike(own, known):
    for i in [*range(0x3000), *range(0x3000, 0x11_0000, 61)]:
        if not 0xD800 <= i < 0xE000:
            text = f"a {chr(i)}b {chr(i)}{chr(i)} 1{chr(i)}.{chr(i)}"
            assert own.encode(text) == known.encode_ordinary(text), hex(i)


def test_long_pieces(own, known):
    text = "ab" * 20_000 + " " * 5_000 + "x" * 30_000 + "é" * 4_000
    assert own.encode(text) == known.encode_ordinary(text)


def test_appends_and_edits_are_those_of_the_whole(own):
    rng, vocabulary = random.Random(1), own.vocabulary
    table = bpe.Prefixes(vocabulary)
    for _ in range(200):
        if rng.random() < 0.5:
            table.append(words(rng, 2).replace(" ", "").encode())
        else:
            a = rng.randrange(len(table.data) + 1)
            table.edit(a, min(len(table.data), a + rng.randrange(4)), b"edit"[: rng.randrange(5)])
        assert table.last == bpe.Prefixes(vocabulary, table.data).last


def test_digests_of_odd_documents(spark, known):
    rows = odd_rows()
    got = sorted(map(repr, map(tuple, bpe.digests(frame(spark, rows), PATH, P.PATTERN).collect())))
    want = []
    for doc, text in rows:
        ids = known.encode_ordinary(text or "")
        joined = " ".join(map(str, ids)).encode()
        want.append(repr((doc, len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())))
    assert got == sorted(want)
    assert bpe.digests(frame(spark, rows).limit(0), PATH, P.PATTERN).collect() == []


def test_round_trip_of_columns(spark):
    docs = frame(spark, odd_rows())
    back = bpe.detokenize(bpe.tokenize(docs, PATH, P.PATTERN, out="ids"), PATH, P.PATTERN)
    assert all(bytes(r.bytes).decode() == (r.text or "") for r in back.collect())


def test_memory_of_pieces_is_bounded(monkeypatch, known):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    own, text = bpe.Encoder(PATH, P.PATTERN), words(random.Random(3), 500) + " ".join(f"w{i}" for i in range(500))
    assert own.encode(text) == known.encode_ordinary(text) and len(own._known) <= 50


def test_an_edit_renews_only_what_is_near_it():
    """A long piece: entries behind the edit are kept once they agree, and are those of a fresh table."""
    rng = random.Random(11)
    ranks = {bytes([b]): i for i, b in enumerate(b"abc")}
    for i, token in enumerate([b"ab", b"abc", b"ca", b"bb", b"bbab", b"caca"]):
        ranks[token] = 3 + i
    small = bpe.Vocabulary(ranks)
    filled = []

    class Counted(bpe.Prefixes):
        def _fill(self, upto=None):
            before = len(self.last)
            super()._fill(upto)
            filled.append(len(self.last) - before)

    for _ in range(200):
        data = bytes(rng.choice(b"abc") for _ in range(400))
        table = Counted(small, data)
        start = rng.randrange(400)
        end = min(400, start + rng.randrange(4))
        new = bytes(rng.choice(b"abc") for _ in range(rng.randrange(4)))
        filled.clear()
        table.edit(start, end, new)
        assert table.last == bpe.Prefixes(small, data[:start] + new + data[end:]).last
        assert sum(filled) < 100
