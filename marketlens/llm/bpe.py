"""Byte-level BPE by dynamic programming over prefixes, and back.

A sequence of tokens is what the merges make of its bytes if and only if every two neighbours are
what the merges make of theirs. So each prefix of a piece has exactly one valid last token: the
one that fits the last token of the prefix before it. `Prefixes` stores that token for every
prefix. Following them from the end gives the encoding; appending bytes only adds entries, and
an edit only renews the entries behind it up to where as many of them in a row as the longest token
has bytes are the old ones: from there on all are.

A text is split by the vocabulary's pattern and every piece is encoded on its own. Workers
remember the pieces they have met, up to a bound, so most pieces cost a look-up.

Cases: null and empty texts have no tokens. Bytes of any kind round-trip. A piece of any length
costs time in proportion to it. Repeated rows are all encoded. No rows give none.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import narrow, small_batches, texts

#: Pieces that a worker remembers, and pairs of tokens.
REMEMBERED = 1_000_000
#: Bytes at the start of a piece whose entries are kept for other pieces that start alike.
STEM = 6
#: Longer pieces are encoded anew each time.
LONGEST_REMEMBERED = 64


class Vocabulary:
    """Tokens by rank, and which two of them stay apart when merged."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks), default=1)
        self.tokens = {i: token for token, i in ranks.items()}
        #: Of three last bytes, the length of the longest token that ends in them.
        self.reach: dict[bytes, int] = {}
        for token in ranks:
            if len(token) > 2:
                self.reach[token[-3:]] = max(len(token), self.reach.get(token[-3:], 2))
        self._apart: dict[int, bool] = {}
        self._edges: tuple[dict, dict] = ({}, {})

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """From a file of base64 tokens and ranks, a line each."""
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())})

    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens that the last merge of a token joins; None for a single byte."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            _, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 62), i) for i in range(len(parts) - 1))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def edge(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """What stands at one end of a token while it is merged, last first: its bytes, the rank
        that made it and the rank that used it up. side: 1 is the right end, 0 the left."""
        known = self._edges[side].get(token)
        if known is None:
            data, used, known = self.tokens[token], 1 << 62, []
            while data:
                made = self.ranks[data] if len(data) > 1 else -1
                known.append((data, made, used))
                used, halves = made, self.halves(data)
                data = halves[side] if halves else b""
            self._edges[side][token] = known
        return known

    def apart(self, left: int, right: int) -> bool:
        """Whether the merges of the two tokens' bytes give the two tokens: no merge across the
        border comes before both of its sides are used up. Of equal ranks the left one is first."""
        known = self._apart.get(left << 32 | right)
        if known is None:
            if len(self._apart) >= REMEMBERED:
                self._apart.clear()
            known, ranks = True, self.ranks
            for a, made_a, used_a in self.edge(left, 1):
                for b, made_b, used_b in self.edge(right, 0):
                    rank = ranks.get(a + b)
                    if rank is not None and made_a < rank < used_a and made_b < rank <= used_b:
                        known = False
            self._apart[left << 32 | right] = known
        return known


class Prefixes:
    """The valid last token of every prefix of a piece."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b"", last: list[int] | None = None):
        """`last` are entries known of the first bytes."""
        self.vocabulary, self.data, self.last = vocabulary, data, last or [-1]
        self._fill()

    def _fill(self, upto: int | None = None) -> None:
        ranks, apart, known = self.vocabulary.ranks, self.vocabulary.apart, self.vocabulary._apart
        data, last, reach = self.data, self.last, self.vocabulary.reach.get
        for end in range(len(last), (len(data) if upto is None else upto) + 1):
            for start in range(max(0, end - reach(data[end - 3 : end], 2)) if end > 2 else 0, end):
                part = data[start:end]
                if part in ranks:
                    token = ranks[part]
                    if not start:
                        break
                    fits = known.get(last[start] << 32 | token)
                    if fits or fits is None and apart(last[start], token):
                        break
            else:
                raise ValueError(f"the vocabulary has no token for byte {data[end - 1]}")
            last.append(token)

    def append(self, more: bytes) -> Prefixes:
        """Add bytes at the end; what is there keeps its entries."""
        self.data += more
        self._fill()
        return self

    def edit(self, start: int, end: int, new: bytes) -> Prefixes:
        """Replace the bytes from start to end; entries are renewed behind start, up to where they
        agree with the old ones over the bytes of the longest token."""
        old = self.last[end + 1 :]
        self.data = self.data[:start] + new + self.data[end:]
        del self.last[start + 1 :]
        behind, agree = start + len(new), 0
        self._fill(behind)
        for k, token in enumerate(old, 1):
            self._fill(behind + k)
            agree = agree + 1 if self.last[-1] == token else 0
            if agree == self.vocabulary.longest:
                self.last += old[k:]
                break
        return self

    def ids(self) -> list[int]:
        out, end, tokens = [], len(self.data), self.vocabulary.tokens
        while end:
            out.append(self.last[end])
            end -= len(tokens[out[-1]])
        return out[::-1]


def _latin(kind: str) -> str:
    """The characters below 256 of a class of the `regex` module, for a character set."""
    return "".join(f"\\x{i:02x}" for i in range(256) if regex.match(kind, chr(i)))


def splitter(pattern: str):
    """The function that splits a text by `pattern`. Texts in Latin-1 go through `re`, which is
    faster, with the classes spelt out for these characters."""
    every = regex.compile(pattern).findall
    classes = {kind: _latin(kind) for kind in (r"\p{L}", r"\p{N}", r"\s", r"\S")}
    latin = re.sub(r"\[[^\]]*\]|\\p\{[LN]\}|\\[sS]", lambda m: _spelt(m[0], classes), pattern)
    fast = re.compile(latin).findall

    def split(text: str) -> list[str]:
        return (fast if text.isascii() or max(text) < "\u0100" else every)(text)

    return split


def _spelt(part: str, classes: dict[str, str]) -> str:
    if part[0] != "[":
        return f"[{classes[part]}]"
    for kind, own in classes.items():
        part = part.replace(kind, own)
    return part


class Encoder:
    """Texts to ids and back, with the vocabulary at `path` and the pattern that splits texts."""

    def __init__(self, path: str, pattern: str):
        self.vocabulary = Vocabulary.read(path)
        self.split = splitter(pattern)
        self._known: dict[str, str] = {}
        self._older: dict[str, str] = {}
        self._stems: dict[bytes, list[int]] = {}

    def piece(self, piece: str) -> str:
        """The ids of a piece, joined by spaces."""
        joined = self._older.get(piece)
        if joined is None:
            data = piece.encode()
            whole = self.vocabulary.ranks.get(data)
            joined = str(whole) if whole is not None else " ".join(map(str, self.prefixes(data).ids()))
        if len(piece) <= LONGEST_REMEMBERED:
            if len(self._known) >= REMEMBERED // 2:  # what isn't met again goes
                self._older, self._known = self._known, {}
            self._known[piece] = joined
        return joined

    def prefixes(self, data: bytes) -> Prefixes:
        """The table of a piece, from that of its stem where another piece had it."""
        stem = data[:STEM]
        known = self._stems.get(stem)
        table = Prefixes(self.vocabulary, data, known and known.copy())
        if known is None:
            if len(self._stems) >= REMEMBERED // 5:
                self._stems.clear()
            self._stems[stem] = table.last[: STEM + 1]
        return table

    def joined(self, text: str) -> str:
        """The ids of a text, joined by spaces."""
        known, piece = self._known, self.piece
        return " ".join([known.get(p) or piece(p) for p in self.split(text)])

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in self.joined(text).split()]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, ids))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """A worker's encoder; read once in a process."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def _ids(path: str, pattern: str):
    @F.arrow_udf("array<int>")
    def ids(column: pa.Array) -> pa.Array:
        encode = encoder(path, pattern).encode
        return pa.array([encode(x.decode()) for x in texts(column)], pa.list_(pa.int32()))

    return ids


def tokenize(docs: DataFrame, path: str, pattern: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """`docs` with the ids of the texts as a further column."""
    small_batches(docs.sparkSession)
    return docs.withColumn(out, _ids(path, pattern)(docs[text_col]))


def detokenize(tokens: DataFrame, path: str, pattern: str, ids_col: str = "ids", out: str = "bytes") -> DataFrame:
    """`tokens` with the decoded bytes as a further column."""

    @F.arrow_udf("binary")
    def decoded(column: pa.Array) -> pa.Array:
        decode = encoder(path, pattern).decode
        return pa.array([None if ids is None else decode(ids) for ids in column.to_pylist()], pa.binary())

    return tokens.withColumn(out, decoded(tokens[ids_col]))


def _digests(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = encoder(path, pattern)
            tokens = {str(i): token for i, token in own.vocabulary.tokens.items()}
            counts, ids, decoded = [], [], []
            for data in texts(batch.column(1)):
                joined = own.joined(data.decode())
                split = joined.split(" ") if joined else []
                counts.append(len(split))
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join(map(tokens.__getitem__, split))).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, n_tokens, and digests of the ids and of the bytes decoded from them."""
    if not os.path.isabs(path):
        raise ValueError("executors need an absolute path of the vocabulary")
    small_batches(docs.sparkSession)
    rows = narrow(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_digests(path, pattern), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
