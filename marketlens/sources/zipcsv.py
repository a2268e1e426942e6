"""Spark data source for headerless separated records inside (nested) zip archives.

    spark.dataSource.register(ZipCsvDataSource)
    spark.read.format("zipcsv").load("/data/raw")

One partition per source, as the catalogue names it: a plain file of an archive, or an inner archive
with all its files. Partitions are found from the directories of the outer archives alone; an inner
archive is inflated by the task that reads it, once, into a file of the task's own, and its files are
streamed from there. A deflated file cannot be split."""

from __future__ import annotations

import csv
import io
import json
import shutil
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from typing import IO

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from marketlens.schemas import RAW_ENCODING, RAW_SEPARATOR
from marketlens.sources.files import is_zip, open_file, walk

SCHEMA = "source string, cells array<string>"
_ARROW = pa.schema([("source", pa.string()), ("cells", pa.list_(pa.string()))])
_BATCH_ROWS = 10_000
#: Bytes of an inflated inner archive that a task keeps in memory.
SPOOL = 64 << 20


def _is_zip(name: str) -> bool:
    return name.lower().endswith(".zip")


def _files(archive: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    return [i for i in archive.infolist() if not i.is_dir()]


@contextmanager
def _spooled(stream: IO[bytes]) -> Iterator[IO[bytes]]:
    """What a stream holds, read through once, to seek in: in memory, or in a temporary file of this
    task beyond SPOOL bytes."""
    with tempfile.SpooledTemporaryFile(SPOOL) as copy:
        shutil.copyfileobj(stream, copy, 1 << 20)
        copy.seek(0)
        yield copy


def _plain(archive: zipfile.ZipFile, infos: list[zipfile.ZipInfo]) -> Iterator[IO[bytes]]:
    """The plain files among the members of an archive, also in the archives in it, one after the other."""
    for info in infos:
        with archive.open(info) as stream:
            if not _is_zip(info.filename):
                yield stream
                continue
            with _spooled(stream) as copy, zipfile.ZipFile(copy) as inner:
                yield from _plain(inner, _files(inner))


@dataclass
class Source(InputPartition):
    """A member of an archive; all its plain files where there is no member."""

    uri: str
    member: str | None

    @property
    def label(self) -> str:
        return self.uri if self.member is None else f"{self.uri}::{self.member}"


class ZipCsvReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        """From the option `sources` (JSON pairs of archive and member) or by looking at the
        directories of the archives under `path`."""
        if "sources" in self.options:
            return [Source(uri, member) for uri, member in json.loads(self.options["sources"])]
        found = []
        for uri in sorted(path for path, _ in walk(self.options["path"]) if _is_zip(path) or is_zip(path)):
            with open_file(uri) as handle, zipfile.ZipFile(handle) as archive:
                found += [Source(uri, info.filename) for info in _files(archive)]
        return found

    def read(self, partition: Source) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(2**31 - 1)
        rows: list[list[str]] = []
        with open_file(partition.uri) as handle, zipfile.ZipFile(handle) as archive:
            if partition.member is None:
                infos = [i for i in _files(archive) if not _is_zip(i.filename)]
            else:
                infos = [archive.getinfo(partition.member)]
            for stream in _plain(archive, infos):
                for cells in self._records(stream):
                    rows.append(cells)
                    if len(rows) == _BATCH_ROWS:
                        yield self._batch(partition.label, rows)
                        rows = []
        if rows:
            yield self._batch(partition.label, rows)

    def _records(self, stream: IO[bytes]) -> Iterator[list[str]]:
        text = io.TextIOWrapper(stream, encoding=self.options.get("encoding", RAW_ENCODING), errors="replace", newline="")
        yield from filter(None, csv.reader(text, delimiter=self.options.get("sep", RAW_SEPARATOR), quotechar='"'))
        text.detach()

    @staticmethod
    def _batch(source: str, rows: list[list[str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([source] * len(rows), pa.string()), pa.array(rows, pa.list_(pa.string()))], schema=_ARROW
        )


class ZipCsvDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zipcsv"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ZipCsvReader:
        return ZipCsvReader(dict(self.options))
