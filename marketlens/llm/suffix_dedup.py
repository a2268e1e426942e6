"""Removal of repeated passages by a sampled suffix array.

A byte goes if it lies in a LENGTH-byte string that also starts earlier: in a document of smaller
doc_id, or in the same one. Strings are bytes of UTF-8 and never cross documents.

Not all suffixes are sorted. Every string of LENGTH bytes (a window) has an anchor: of its
LEAD-byte pieces, the one of the least hash, the first of these. Equal windows have equal anchors,
so only windows whose anchors have the same bytes need comparing. Neighbouring windows with one
anchor hash form a stretch; a text has about one for every 35 bytes.

1. Stretches are grouped by their anchor's bytes. A stretch whose whole text occurs earlier is
   repeated, all of it; each task settles its own copies before the shuffle. A stretch that is
   alone in its group, and can't repeat itself, is new. What is left is a small part. Anchors that
   a sample of SAMPLE documents finds common are dealt by the stretch's whole text besides, and
   every different text of such a group is compared; the sample decides on the dealing alone.
2. The texts of these are range-partitioned by their lead with sampled splitters; equal leads never
   straddle a border, and groups whose windows exceed WINDOWS are compared across all buckets
   instead: there the whole window is the key, aggregated before it is shuffled.
3. In a bucket the windows are ordered by multikey quicksort, eight bytes at a time, refining only
   what is still equal; windows equal in all bytes that are not the first of them are repeated.
4. A document's repeated windows are joined to spans, which are cut out.

Cases: null and empty texts, and those shorter than LENGTH, lose nothing. Rows that repeat an id
and text are one document, each losing the same bytes. Different texts under one id are documents
of their own, in the order of their hashes. A null id comes before all others. No rows give none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import LEAST, narrow, runs, small_batches, starts_of_runs, stored, texts
from marketlens.session import durable

LENGTH = 100
LEAD = 32
#: Windows of a group up to which one task compares them.
WINDOWS = 1 << 18
#: Windows of a stretch; longer ones are cut.
STRETCH = 1 << 12
#: Documents, on average, of the sample that finds common anchors, and their least number of stretches.
SAMPLE, COMMON = 4_096, 16
#: Bytes of text that are hashed at once.
SLAB = 1 << 18
_FACTOR = 0x01000193


def _piece_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of each `width` bytes; width is a power of two."""
    sums, have = data.astype(np.uint32) + np.uint32(1), 1
    while have < width:
        sums = sums[:-have] * np.uint32(pow(_FACTOR, have, 1 << 32)) + sums[have:]
        have *= 2
    sums ^= sums >> np.uint32(16)
    sums *= np.uint32(0x7FEB352D)
    sums ^= sums >> np.uint32(15)
    sums *= np.uint32(0x846CA68B)
    return sums ^ (sums >> np.uint32(16))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbouring values."""
    have = 1
    out = values
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(values) - width + 1], out[width - have : len(values) - have + 1])
    return out


def stretches(data: np.ndarray, length: int = LENGTH, lead: int = LEAD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a text's bytes: first window, number of windows, anchor, and whether it can repeat itself,
    for each stretch."""
    if len(data) < length:
        return (np.zeros(0, dtype=np.int64),) * 4
    hashes = _piece_hashes(data, lead).astype(np.uint64)
    keyed = _least((hashes << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64), length - lead + 1)
    values, places = keyed >> np.uint64(32), (keyed & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.append(True, values[1:] != values[:-1])
    moved = np.flatnonzero(~new[1:] & (places[1:] != places[:-1]))
    if len(moved):  # equal hashes, but are they of equal bytes?
        piece = np.lib.stride_tricks.sliding_window_view(data, lead)
        new[moved + 1] = (piece[places[moved]] != piece[places[moved + 1]]).any(axis=1)
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(values)))
    if count.max() > STRETCH:
        first = np.concatenate([np.arange(a, a + n, STRETCH) for a, n in zip(first.tolist(), count.tolist())])
        count = np.diff(np.append(first, len(values)))
    return first, count, places[first], places[first] != places[first + count - 1]


def _signed(hashes: list[int]) -> pa.Array:
    return pa.array(np.array(hashes, dtype=np.uint64).view(np.int64))


_STRETCH_DDL = "lead long, whole long, doc_id long, nth long, start int, n int, anchor int, inner boolean, known boolean, common boolean"


def _stretch_rows(length: int, lead: int, common: frozenset[int] = frozenset()):
    """The stretches of every text; `common` are the signed hashes of anchors to be dealt by whole text."""
    crowded = np.array(sorted(common), dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            ids, nths, data_of = batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2))
            leads, wholes, known, parts, seen = [], [], [], [], {}
            for row in sorted(range(len(ids)), key=lambda i: (ids[i], nths[i])):  # earlier ones first
                data, own_id, own_nth = data_of[row], ids[row], nths[row]
                for at in range(0, max(1, len(data) - length + 1), SLAB):
                    slab = data[at : at + SLAB + length - 1]  # slabs share no window
                    first, count, anchor, inner = stretches(np.frombuffer(slab, dtype=np.uint8), length, lead)
                    parts.append((np.full(len(first), own_id), np.full(len(first), own_nth), first + at, count, anchor - first, inner))
                    for a, n, p in zip(first.tolist(), count.tolist(), anchor.tolist()):
                        key = (digest(slab[p : p + lead]), digest(slab[a : a + n + length - 1]))
                        leads.append(key[0])
                        wholes.append(key[1])
                        place = (own_id, own_nth, a + at)
                        known.append(seen.setdefault(key, place) != place)
            if not leads:
                continue
            doc, nth, start, n, anchor, inner = (np.concatenate(x) for x in zip(*parts))
            signed = np.array(leads, dtype=np.uint64).view(np.int64)
            hot = np.isin(signed, crowded)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed), _signed(wholes), pa.array(doc.astype(np.int64)), pa.array(nth.astype(np.int64)),
                    *[pa.array(x.astype(np.int32)) for x in (start, n, anchor)],
                    pa.array(inner.astype(bool) | hot), pa.array(known, pa.bool_()), pa.array(hot),
                ],
                names=["lead", "whole", "doc_id", "nth", "start", "n", "anchor", "inner", "known", "common"],
            )

    return run


_JUDGED = ["lead", "doc_id", "nth", "start", "n", "anchor"]
_JUDGED_DDL = "lead long, doc_id long, nth long, start int, n int, anchor int, open boolean"


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by lead, whole text and place: the repeated stretches (open false), and those
    whose windows have to be compared (open true). Holds a batch and one row."""
    last = None  # lead, whole text and place of the row before
    texts_so_far = 0  # different whole texts of its lead
    held: list[np.ndarray] | None = None  # the only text of its lead so far

    for batch in batches:
        column = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names}
        known = column["known"]
        ready = [column[c][known] for c in _JUDGED]
        column = {c: x[~known] for c, x in column.items()}
        lead, whole = column["lead"], column["whole"]
        opened = np.zeros(0, dtype=bool)
        if len(lead):
            place = [lead, whole, column["doc_id"], column["nth"], column["start"]]
            same = [np.append(last is not None and x[0] == last[i], x[1:] == x[:-1]) for i, x in enumerate(place)]
            new_lead = ~same[0]
            new_whole = new_lead | ~same[1]
            twin = np.logical_and.reduce(same)  # of a repeated row: the same place once more
            begin = np.flatnonzero(new_lead)
            if not new_lead[0]:
                begin = np.append(0, begin)
            sizes = np.diff(np.append(begin, len(lead)))
            before = np.zeros(len(begin), dtype=np.int64)
            before[0] = 0 if new_lead[0] else texts_so_far
            count = np.cumsum(new_whole)
            nth_text = count + np.repeat(before - count[begin] + new_whole[begin], sizes)
            most = nth_text[begin + sizes - 1]
            opened = new_whole & (column["inner"] | np.repeat(most > 1, sizes))
            if held is not None:
                if not new_lead[0] and most[0] > 1:
                    ready = [np.append(h, x).astype(x.dtype) for h, x in zip(held, ready)]
                    ready_open = np.append(True, np.zeros(len(ready[0]) - 1, dtype=bool))
                else:
                    ready_open = np.zeros(len(ready[0]), dtype=bool)
                if new_lead[0] or most[0] > 1 or len(begin) > 1:
                    held = None
            else:
                ready_open = np.zeros(len(ready[0]), dtype=bool)
            at = int(begin[-1])
            if most[-1] == 1 and new_lead[at] and not column["inner"][at]:
                held = [column[c][at : at + 1] for c in _JUDGED]
            rows = opened | (~new_whole & ~twin)
            columns = [np.append(a, column[c][rows]) for a, c in zip(ready, _JUDGED)]
            opened = np.append(ready_open, opened[rows])
            last, texts_so_far = [x[-1] for x in place], int(most[-1])
        else:
            columns, opened = ready, np.zeros(len(ready[0]), dtype=bool)
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(opened)], names=[*_JUDGED, "open"])


_PART_DDL = "lead binary, doc_id long, nth long, start int, n int, data binary"


def _parts(length: int, lead: int):
    """The texts of a document's open stretches, with the bytes of their anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            rows = zip(*[batch.column(c).to_pylist() for c in ("doc_id", "nth", "open")], texts(batch.column("text")))
            for doc, nth, opened, data in rows:
                for x in opened:
                    a, n, p = x["start"], x["n"], x["start"] + x["anchor"]
                    out.append((data[p : p + lead], doc, nth, a, n, data[a : a + n + length - 1]))
            types = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 6, types)], names=["lead", "doc_id", "nth", "start", "n", "data"]
            )

    return run


def equal_windows(group: np.ndarray, data: bytes, at: np.ndarray, length: int) -> np.ndarray:
    """Which of the windows at `at`, ordered by place, equal an earlier one of the same group.

    Multikey quicksort: what is equal so far is ordered by the next eight bytes."""
    width = min(8, length)
    words = np.lib.stride_tricks.as_strided(
        np.frombuffer(data, dtype=np.uint8), shape=(max(0, len(data) - width + 1), width), strides=(1, 1), writeable=False
    )
    rows, classes = np.arange(len(at)), group
    for offset in [*range(0, length - width, width), length - width]:
        piece = words[at[rows] + offset]
        key = np.ascontiguousarray(np.pad(piece, ((0, 0), (0, 8 - width)))).view(np.uint64).ravel()
        order = np.lexsort((key, classes))
        rows, key, classes = rows[order], key[order], classes[order]
        new = np.ones(len(rows) + 1, dtype=bool)
        new[1:-1] = (classes[1:] != classes[:-1]) | (key[1:] != key[:-1])
        shared = ~(new[:-1] & new[1:])
        classes, rows = np.cumsum(new[:-1])[shared], rows[shared]
        if not len(rows):
            break
    repeated = np.zeros(len(at), dtype=bool)
    if len(rows):
        repeated[rows[np.append(False, classes[1:] == classes[:-1])]] = True
    return repeated


def _compare(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["lead"]):
            parts = table.column("data").to_pylist()
            lead = table.column("lead").to_pylist()
            doc, nth, start, n = (table.column(c).to_numpy() for c in ("doc_id", "nth", "start", "n"))
            group = np.cumsum([False] + [a != b for a, b in zip(lead[1:], lead[:-1])])
            offsets = np.cumsum([0, *map(len, parts[:-1])])
            row = np.repeat(np.arange(len(n)), n)
            window = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            repeated = equal_windows(group[row], b"".join(parts), offsets[row] + window, length)
            hit = np.flatnonzero(repeated)
            new = np.append(True, (np.diff(hit) != 1) | (row[hit][1:] != row[hit][:-1])) if len(hit) else np.zeros(0, dtype=bool)
            begin = hit[new]
            count = np.diff(np.append(np.flatnonzero(new), len(hit)))
            own = row[begin]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[own]), pa.array(nth[own]), pa.array((start[own] + window[begin]).astype(np.int32)), pa.array(count.astype(np.int32))],
                names=["doc_id", "nth", "start", "n"],
            )

    return run


def _compare_hot(parts: DataFrame, length: int) -> DataFrame:
    """The same for groups too large for a task: windows are keys, their first places aggregated."""
    windows = parts.select("doc_id", "nth", "start", "data", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    windows = windows.select("doc_id", "nth", (F.col("start") + F.col("i")).alias("start"), F.expr(f"substring(data, i + 1, {length})").alias("window"))
    place = F.struct("doc_id", "nth", "start")
    firsts = durable(windows.groupBy("window").agg(F.min(place).alias("first"), F.count("*").alias("m")).where("m > 1").select("window", "first"))
    return windows.join(firsts, "window").where(place > F.col("first")).select("doc_id", "nth", "start", F.lit(1).alias("n"))


def common_anchors(rows: DataFrame, length: int, lead: int, sample: int = SAMPLE) -> frozenset[int]:
    """Hashes of anchors with over a quarter of a task's even share of the stretches, judged by a sample
    of about `sample` documents: at most four a shuffle partition."""
    total = rows.count()
    part = rows.select("doc_id", "nth", "text")
    part = part.sample(sample / total, seed=3) if total > sample else part
    found = part.mapInArrow(_stretch_rows(length, lead), _STRETCH_DDL).where("not known")
    counts = durable(found.groupBy("lead").agg(F.count("*").alias("m")))
    share = (counts.agg(F.sum("m")).first()[0] or 0) / (4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return frozenset(r["lead"] for r in counts.where(F.col("m") > max(COMMON, share)).select("lead").collect())


def _cut(data: bytes, repeated: list[dict], length: int) -> tuple[int, int, bytes]:
    """Bytes removed, spans removed and what is left."""
    out, done, removed, spans, reach = [], 0, 0, 0, -1
    for a, b in sorted((x["start"], x["start"] + x["n"] + length - 1) for x in repeated):
        spans += a > reach
        reach = max(reach, b)
        if a > done:
            out.append(data[done:a])
        if b > done:
            removed += b - max(a, done)
            done = b
    out.append(data[done:])
    return removed, spans, b"".join(out)


_KEPT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _keep(length: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, given, repeated, data in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "no_id", "repeated")], texts(batch.column("text"))):
                removed, spans, kept = _cut(data, repeated or [], length)
                out.append((None if given else doc, len(data), removed, spans, hashlib.sha256(kept).hexdigest() if digest else kept))
            types = [pa.int64()] * 4 + [pa.string() if digest else pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 5, types)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256" if digest else "kept"],
            )

    return run


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, lead: int = LEAD, most: int = WINDOWS, digest: bool = True
) -> DataFrame:
    """A row per document: doc_id, n_bytes, n_removed, n_spans, and kept_sha256 (or `kept`, the bytes)."""
    small_batches(docs.sparkSession)
    rows = narrow(docs, doc_id=id_col, text=text_col)
    rows = rows.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "text")
    sig = F.xxhash64("text").alias("sig")
    again, several = stored(rows.select("doc_id", sig).groupBy("doc_id").agg(F.count("*").alias("m"), F.min("sig").alias("a"), F.max("sig").alias("b")).where("m > 1"))
    repeats = not again.isEmpty()
    if repeats:
        # texts of one id are told apart and ordered by their hashes, a row each, however many they are
        rows = rows.join(several.select("doc_id", (F.col("a") != F.col("b")).alias("differ")), "doc_id", "left")
        rows = rows.withColumn("nth", F.when(F.col("differ"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))).drop("differ")
    else:
        rows = rows.withColumn("nth", F.lit(0).cast("long"))
    common = common_anchors(rows, length, lead)
    deal = F.when(F.col("known"), F.xxhash64("doc_id", "start")).when(F.col("common"), F.xxhash64("lead", "whole")).otherwise(F.col("lead"))
    found = rows.select("doc_id", "nth", "text").mapInArrow(_stretch_rows(length, lead, common), _STRETCH_DDL)
    found = found.repartition(deal).sortWithinPartitions("lead", "whole", "doc_id", "nth", "start")
    judged = durable(found.mapInArrow(_judge, _JUDGED_DDL))
    lists = judged.where("open").groupBy("doc_id", "nth").agg(F.collect_list(F.struct("start", "n", "anchor")).alias("open"))
    parts = rows.select("doc_id", "nth", "text").join(lists, ["doc_id", "nth"]).mapInArrow(_parts(length, lead), _PART_DDL)
    parts = durable(parts.dropDuplicates(["doc_id", "nth", "start"]) if repeats else parts)
    sizes = parts.groupBy("lead").agg(F.sum("n").alias("windows"))
    hot, few = stored(sizes.where(F.col("windows") > most).select("lead"))
    crowded = not hot.isEmpty()
    apart = parts.join(few, "lead", "left_anti") if crowded else parts
    apart = apart.repartitionByRange(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "lead")
    compared = apart.sortWithinPartitions("lead", "doc_id", "nth", "start").mapInArrow(_compare(length), "doc_id long, nth long, start int, n int")
    if crowded:
        compared = compared.unionByName(_compare_hot(parts.join(few, "lead", "left_semi"), length))
    gone = judged.where("not open").select("doc_id", "nth", "start", "n").unionByName(compared)
    gone = gone.groupBy("doc_id", "nth").agg(F.collect_list(F.struct("start", "n")).alias("repeated"))
    whole = rows.join(gone, ["doc_id", "nth"], "left").select("doc_id", "no_id", "repeated", "text")
    return whole.mapInArrow(_keep(length, digest), _KEPT_DDL.replace("kept binary", "kept_sha256 string") if digest else _KEPT_DDL)
