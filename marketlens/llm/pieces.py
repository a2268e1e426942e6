"""SentencePiece BPE by backtracking over longest matches, and back.

The merges join, of all neighbours that make a piece, those of the best score, the leftmost first.
A sequence of pieces is what they make of its characters if and only if every two neighbours are what
the merges make of theirs, so the encoding is the only sequence all of whose neighbours fit. It is
found by backtracking: an Aho-Corasick automaton gives the longest piece that starts at a place; of it
and its prefixes the first is taken that fits the piece before it and does not end where no encoding
goes on. If none does, the place is marked in a bitfield of
failed places and the piece before it is shortened. What fits is found by merging the characters of
the two pieces again, and remembered. What stands before a place is the same on every way there, so
every place fails once at most.

No merge joins two characters that are neighbours in no piece, so texts are cut there. Where no piece
has the space mark behind another character, they are first cut before every run of marks, and at
characters that are in no piece, which become bytes (or the unknown piece). Workers remember the parts
they have met.

Models: BPE without user-defined or unused pieces; normalising is left to the library.

Cases: null and empty texts have no pieces. Parts of any length cost time in proportion to it.
Repeated rows are all encoded. No rows give none.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from marketlens.llm.common import narrow, small_batches, texts

#: Parts of texts that a worker remembers, and pairs of pieces.
REMEMBERED = 1_000_000
#: Longer parts are encoded anew each time.
LONGEST_REMEMBERED = 64
SPACE = "▁"
#: Stands for a control piece among decoded bytes; in no UTF-8.
CONTROL = b"\xff"


class Pieces:
    """The pieces of a model, which of them fit side by side, and the longest at each place."""

    def __init__(self, path: str):
        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) for i in range(size)]
        if any(map(model.is_unused, range(size))):
            raise ValueError("unused pieces are not handled")
        self.normalize = model.normalize
        self.unknown = model.unk_id()
        self.bytes_ = [i for i in range(size) if model.is_byte(i)]
        self.text: list[str] = []
        #: Ids of a piece, joined by commas; a character that is no piece has several.
        self.joined: list[str] = []
        #: What ids stand for when decoded.
        self.surface: dict[str, bytes] = {}
        scores = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if i in self.bytes_:
                self.surface[str(i)] = bytes([int(piece[1:-1], 16)])
            elif special[i]:
                self.surface[str(i)] = CONTROL if model.is_control(i) else model.decode([i]).encode()
            else:
                self.surface[str(i)] = piece.replace(SPACE, " ").encode()
                self.text.append(piece)
                self.joined.append(str(i))
                scores[piece] = model.get_score(i)
        self.normal = {x for x in self.surface if not special[int(x)]}.difference(map(str, self.bytes_))
        self.scores = {piece: score for piece, score in scores.items() if len(piece) > 1}
        self.characters = set().union(*scores) if scores else set()
        for c in sorted(self.characters - set(scores)):
            self.text.append(c)
            self.joined.append(self.foreign(c))
        self.number = {piece: k for k, piece in enumerate(self.text)}
        self.prefixed = self.normalize("a") == f"{SPACE}a"
        self.squeezed = SPACE * 2 not in self.normalize("a  b")
        self.cut = not any(SPACE in piece.lstrip(SPACE) for piece in self.text)
        #: Characters that are neighbours in some piece.
        self.pairs = {pair for piece in scores for pair in zip(piece, piece[1:])}
        self.length = [len(piece) for piece in self.text]
        self._shorter = [self._prefix(piece) for piece in self.text]
        self._fits: dict[int, bool] = {}
        self._starts = ahocorasick.Automaton()
        for piece, k in self.number.items():
            self._starts.add_word(piece, k)
        self._starts.make_automaton()

    def foreign(self, characters: str) -> str:
        """Ids of characters that are in no piece."""
        if len(self.bytes_) == 256:
            return ",".join(str(self.bytes_[b]) for b in characters.encode())
        return str(self.unknown)

    def _prefix(self, piece: str) -> int:
        """The longest piece that is a shorter prefix of a piece; -1 for none."""
        for end in range(len(piece) - 1, 0, -1):
            if piece[:end] in self.number:
                return self.number[piece[:end]]
        return -1

    def merged(self, text: str) -> list[str]:
        """What the merges make of a text, step by step."""
        parts, scores = list(text), self.scores
        while True:
            best, at = None, 0
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fit(self, left: int, right: int) -> bool:
        """Whether the merges make two pieces of their characters; left is -1 for the right one alone."""
        known = self._fits.get(left << 32 | right)
        if known is None:
            if len(self._fits) >= REMEMBERED:
                self._fits.clear()
            parts = [self.text[k] for k in (left, right) if k >= 0]
            if left >= 0 and not self._meet(*parts):  # nothing joins them, so each is merged by itself
                known = self.fit(-1, left) and self.fit(-1, right)
            else:
                known = self.merged("".join(parts)) == parts
            self._fits[left << 32 | right] = known
        return known

    def _meet(self, left: str, right: str) -> bool:
        """Whether an end of the left piece and a beginning of the right one make a piece."""
        starts = [right[:k] for k in range(1, len(right) + 1)]
        return not self.scores.keys().isdisjoint([left[k:] + start for k in range(len(left)) for start in starts])

    def longest(self, part: str, at: int, out: list[int]) -> None:
        """Put down the longest piece that starts at a place, the longest one that starts at its end,
        and so on, up to a place where it is known."""
        for end, piece in self._starts.iter_long(part, at):
            if out[at] >= 0:
                return
            out[at] = piece
            at = end + 1

    def encode(self, part: str) -> list[int]:
        """Numbers of the pieces that the merges make of a part."""
        length, shorter, known = self.length, self._shorter, self._fits.get
        size, failures = len(part), False
        failed = bytearray(size // 8 + 1)
        taken: list[int] = []
        longest = [-1] * size
        self.longest(part, 0, longest)
        at, piece, last = 0, longest[0], -1
        while at < size:
            while piece >= 0:
                end = at + length[piece]
                if not failures or not failed[end >> 3] >> (end & 7) & 1:
                    fits = known(last << 32 | piece)
                    if fits or fits is None and self.fit(last, piece):
                        break
                piece = shorter[piece]
            if piece >= 0:
                taken.append(piece)
                at, last = end, piece
                if at < size:
                    piece = longest[at]
                    if piece < 0:
                        self.longest(part, at, longest)
                        piece = longest[at]
            else:
                if not taken:
                    raise ValueError("the model has no piece for a character")
                failures = True
                failed[at >> 3] |= 1 << (at & 7)
                piece = taken.pop()
                last = taken[-1] if taken else -1
                at -= length[piece]
                piece = shorter[piece]
        return taken


class Encoder:
    """Texts to ids and back, with the model at `path`."""

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        known = "".join(map(re.escape, sorted(self.pieces.characters - {SPACE})))
        # a run of marks and what follows it, a run of marks alone, characters that are in no piece
        pattern = rf"{SPACE}*[{known}]+|{SPACE}+|[^{known}{SPACE}]+" if self.pieces.cut else rf"[{known}{SPACE}]+|[^{known}{SPACE}]+"
        self.split = re.compile(pattern).findall
        self._known: dict[str, str] = {}
        self._older: dict[str, str] = {}

    def part(self, part: str) -> str:
        """The ids of a part, joined by commas."""
        joined = self._older.get(part)
        if joined is None:
            joined = self._new(part)
        if len(part) <= LONGEST_REMEMBERED:
            if len(self._known) >= REMEMBERED // 2:  # what isn't met again goes
                self._older, self._known = self._known, {}
            self._known[part] = joined
        return joined

    def _new(self, part: str) -> str:
        pieces = self.pieces
        whole = pieces.number.get(part, -1)
        if whole >= 0 and pieces.fit(-1, whole):
            return pieces.joined[whole]
        if part[0] not in pieces.characters:
            return pieces.foreign(part)
        pairs = pieces.pairs
        if not pairs.issuperset(zip(part, part[1:])):  # no merge joins characters that are neighbours in no piece
            cuts = [0, *[k for k, pair in enumerate(zip(part, part[1:]), 1) if pair not in pairs], len(part)]
            known = self._known
            return ",".join([known.get(x) or self.part(x) for x in [part[a:b] for a, b in zip(cuts, cuts[1:])]])
        joined = pieces.joined
        return ",".join([joined[k] for k in pieces.encode(part)])

    def joined(self, text: str) -> str:
        """The ids of a text, joined by commas."""
        if not text:
            return ""
        known, part = self._known, self.part
        return ",".join([known.get(p) or part(p) for p in self.split(self.pieces.normalize(text))])

    def encode(self, text: str) -> list[int]:
        joined = self.joined(text)
        return [int(x) for x in joined.split(",")] if joined else []

    def surface(self, ids: list[str]) -> str:
        """The text of ids, given as decimal strings. Bytes that are no UTF-8 become U+FFFD each."""
        pieces = self.pieces
        out = list(map(pieces.surface.__getitem__, ids))
        if pieces.prefixed or pieces.squeezed:
            for k, x in enumerate(ids):
                if out[k] is CONTROL:
                    continue
                if x in pieces.normal and out[k].startswith(b" "):
                    out[k] = out[k][1:]
                    if pieces.squeezed and not out[k]:
                        continue
                break
        try:
            return b"".join(out).decode()
        except UnicodeDecodeError:
            return "".join(map(_decoded, _runs(out, ids, set(map(str, pieces.bytes_)))))

    def decode(self, ids: Iterable[int]) -> str:
        return self.surface([str(i) for i in ids])


def _runs(parts: list[bytes], ids: list[str], single: set[str]) -> Iterator[bytes]:
    """Runs of bytes from byte pieces, and the other pieces one by one."""
    open_ = b""
    for part, x in zip(parts, ids):
        if x in single:
            open_ += part
            continue
        if open_:
            yield open_
        open_ = b""
        if part is not CONTROL:
            yield part
    yield open_


def _decoded(run: bytes) -> str:
    out, at = [], 0
    while at < len(run):
        for n in (1, 2, 3, 4):
            try:
                out.append(run[at : at + n].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("\ufffd")
            n = 1
        at += n
    return "".join(out)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """A worker's encoder; read once in a process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _absolute(path: str) -> str:
    if not os.path.isabs(path):
        raise ValueError("executors need an absolute path of the model")
    return path


def tokenize(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """`docs` with the ids of the texts as a further column."""
    _absolute(path)

    @F.arrow_udf("array<int>")
    def ids(column: pa.Array) -> pa.Array:
        encode = encoder(path).encode
        return pa.array([encode(x.decode()) for x in texts(column)], pa.list_(pa.int32()))

    small_batches(docs.sparkSession)
    return docs.withColumn(out, ids(docs[text_col]))


def detokenize(tokens: DataFrame, path: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """`tokens` with the decoded text as a further column; null ids give null."""
    _absolute(path)

    @F.arrow_udf("string")
    def decoded(column: pa.Array) -> pa.Array:
        decode = encoder(path).decode
        return pa.array([None if ids is None else decode(ids) for ids in column.to_pylist()], pa.string())

    return tokens.withColumn(out, decoded(tokens[ids_col]))


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = encoder(path)
            counts, ids, decoded = [], [], []
            for data in texts(batch.column(1)):
                joined = own.joined(data.decode())
                split = joined.split(",") if joined else []
                counts.append(len(split))
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded.append(hashlib.sha256(own.surface(split).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: doc_id, n_tokens, and digests of the ids and of the text decoded from them."""
    _absolute(path)
    small_batches(docs.sparkSession)
    rows = narrow(docs, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_digests(path), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
