"""Separated text with quoted line breaks, read by many tasks per file.

Whether a byte of such a file lies in a quoted cell depends on everything before it. Each split is
therefore read from every state that a parser can be in at its start (`scan`): where do the states
lead, and where does the first record begin. Runs that meet at a record's end are one from there on,
which mostly happens within a record or two. Folding these maps over the splits of a file, a row per
split, gives each split's state, hence ranges of whole records, which are parsed apart.

Malformed quotes mean what they mean to Python's csv module, also to one that reads the whole file:
a quote opens a cell at its start only, text behind a closing quote belongs to the cell. Records
without any character are left out, and so is a byte order mark."""

from __future__ import annotations

import codecs
import csv
import io
import re
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.schemas import RAW_ENCODING, RAW_SEPARATOR
from marketlens.session import durable
from marketlens.sources.files import open_file

SPLIT_BYTES = 32 << 20
_BATCH_ROWS = 10_000
_CELLS = pa.schema([("path", pa.string()), ("start", pa.int64()), ("cells", pa.list_(pa.string()))])
_STATES = "path string, start long, size long, ends array<int>, firsts array<long>"

# What brings a parser into each state: at a record's start, at a cell's start, in a bare cell, in a
# quoted cell, behind a quote in a quoted cell.
RECORD, CELL, BARE, QUOTED, CLOSING = range(5)
_COMPRESSED = (".gz", ".bz2", ".zst", ".deflate", ".snappy", ".lz4")
_QUOTED_CELL = re.compile('"[^"]*(?:""[^"]*)*')


def splittable(path: str, encoding: str) -> bool:
    """Whether a file is plain text in which separators, quotes and line ends are bytes of their own."""
    single = ("iso8859", "cp125", "utf-8", "ascii")
    return codecs.lookup(encoding).name.startswith(single) and not path.lower().endswith(_COMPRESSED)


def _prefixes(sep: str) -> tuple[str, ...]:
    return "", sep, "x", '"', '"x"'


def _ends(data: bytes, prefix: str, sep: str) -> Iterator[int]:
    """Where records end in a split that begins in the state `prefix` leads to; not the last one
    if it goes on."""
    taken, spent = 0, False

    def lines() -> Iterator[str]:
        nonlocal taken, spent
        text = io.TextIOWrapper(io.BytesIO(data), "latin-1", newline="")
        for number, line in enumerate(text):
            if line[-1] not in "\r\n":
                break
            taken += len(line)
            yield line if number else prefix + line
        spent = True

    for _ in csv.reader(lines(), delimiter=sep):
        if spent:
            return
        yield taken


def _state(text: str, sep: str) -> int:
    """The state at the end of a text within one record, from its start."""
    at, size = 0, len(text)
    while at < size:
        if text[at] == '"':
            at = _QUOTED_CELL.match(text, at).end()
            if at == size:
                return QUOTED
            if at + 1 == size:
                return CLOSING
            at += 1
        at = text.find(sep, at)
        if at < 0:
            return BARE
        at += 1
    return CELL if size else RECORD


def scan(data: bytes, sep: str) -> tuple[list[int], list[int | None]]:
    """For each state at the start of a split: the state at its end, and where in it the first
    record begins."""
    prefixes = _prefixes(sep)
    ends: list[int] = [RECORD] * len(prefixes)
    firsts: list[int | None] = [None] * len(prefixes)
    open_runs: dict[int, tuple[Iterator[int], list[int]]] = {}

    def place(at: int | None, before: int, run: Iterator[int], states: list[int], prefix: str) -> None:
        if at is None:
            state = _state(prefix + data[before:].decode("latin-1"), sep)
            for s in states:
                ends[s] = state
        elif at in open_runs:
            open_runs[at][1].extend(states)
        else:
            open_runs[at] = (run, states)

    for state, prefix in enumerate(prefixes):
        run = _ends(data, prefix, sep)
        at = 0 if state == RECORD else next(run, None)
        if at is not None and at < len(data):
            firsts[state] = at
        place(at, 0, run, [state], prefix)
    while open_runs:
        at = min(open_runs)
        run, states = open_runs.pop(at)
        last = at
        if open_runs:
            following = next(run, None)
        else:
            for last in run:
                pass
            following = None
        place(following, last, run, states, "")
    return ends, firsts


def _ranges(files: pd.DataFrame) -> pd.DataFrame:
    """The splits of one file in order: from the first record that begins in each to that of the next."""
    state, starts = RECORD, []
    files = files.sort_values("start")
    for start, ends, firsts in zip(files["start"], files["ends"], files["firsts"]):
        first = firsts[state]
        if first is not None and first == first:
            starts.append(int(start + first))
        state = ends[state]
    size = files["size"].iloc[0]
    return pd.DataFrame({"path": files["path"].iloc[0], "start": starts, "stop": [*starts[1:], size][: len(starts)]})


def _spread(rows: DataFrame, number: int) -> DataFrame:
    """A task for each row, in the order of the file."""
    return rows.repartitionByRange(number, "path", "start").sortWithinPartitions("path", "start")


def read_records(
    files: DataFrame, sep: str = RAW_SEPARATOR, encoding: str = RAW_ENCODING, split_bytes: int = SPLIT_BYTES, header: bool = False
) -> DataFrame:
    """`path` and `cells` of all records of the files (`path`, `size`), in the order of each file;
    with `header` without each file's first record. Tasks hold a split, or a record if that is
    longer. The text is read twice; the states of splits are kept (`durable`) in between."""

    def scans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(row["path"]) as handle:
                    handle.seek(row["start"])
                    data = handle.read(split_bytes)
                mark = len(codecs.BOM_UTF8) if row["start"] == 0 and data.startswith(codecs.BOM_UTF8) else 0
                ends, firsts = scan(data[mark:], sep)
                firsts = [first + mark if first else first for first in firsts]
                found = [{"path": row["path"], "start": row["start"], "size": row["size"], "ends": ends, "firsts": firsts}]
                yield pa.RecordBatch.from_pylist(found, schema=scanned)

    scanned = pa.schema(
        [("path", pa.string()), ("start", pa.int64()), ("size", pa.int64()), ("ends", pa.list_(pa.int32())), ("firsts", pa.list_(pa.int64()))]
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(row["path"]) as handle:
                    handle.seek(row["start"])
                    data = handle.read(row["stop"] - row["start"])
                if row["start"] == 0:
                    data = data.removeprefix(codecs.BOM_UTF8)
                text = io.TextIOWrapper(io.BytesIO(data), encoding, errors="replace", newline="")
                parsed = filter(None, csv.reader(text, delimiter=sep))
                if header and row["start"] == 0:
                    next(parsed, None)
                yield from _cell_batches(row, parsed)

    sized = files.filter("size > 0").select("path", F.col("size").cast("long").alias("size"))
    splits = sized.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))))
    number = max(1, splits.count())
    states = durable(_spread(splits, number).mapInArrow(scans, _STATES))
    ranges = states.groupBy("path").applyInPandas(_ranges, "path string, start long, stop long")
    return _spread(ranges, number).mapInArrow(records, "path string, start long, cells array<string>").select("path", "cells")


def _cell_batches(row: dict, parsed: Iterator[Sequence[str]]) -> Iterator[pa.RecordBatch]:
    rows: list[Sequence[str]] = []

    def batch() -> pa.RecordBatch:
        size = len(rows)
        columns = [pa.array([row["path"]] * size, pa.string()), pa.array([row["start"]] * size, pa.int64()), pa.array(rows, pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays(columns, schema=_CELLS)

    for cells in parsed:
        rows.append(cells)
        if len(rows) == _BATCH_ROWS:
            yield batch()
            rows = []
    if rows:
        yield batch()
