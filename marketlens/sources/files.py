"""Listing and random-access reading of files inside tasks, on any file system Arrow knows."""

from __future__ import annotations

import io
from collections.abc import Iterator

from pyarrow import fs

# Arrow's names of schemes that Hadoop calls otherwise.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def resolve(uri: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path on it, and the prefix that makes its paths URIs again."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:") :].lstrip("/"), ""
    if "://" not in uri:
        return fs.LocalFileSystem(), uri, ""
    scheme, rest = uri.split("://", 1)
    system, path = fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}://{rest}")
    return system, path, f"{scheme}://" + rest.removesuffix(path)


class _Raw(io.RawIOBase):
    """An Arrow file as a Python one: seeking before its start is an OSError."""

    def __init__(self, native):
        self.native = native

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        data = self.native.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)

    def tell(self) -> int:
        return self.native.tell()

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        start = {io.SEEK_SET: 0, io.SEEK_CUR: self.native.tell(), io.SEEK_END: self.native.size()}[whence]
        if start + offset < 0:
            raise OSError("seek before the start of the file")
        self.native.seek(start + offset)
        return start + offset

    def close(self) -> None:
        if not self.closed:
            self.native.close()
        super().close()


def open_file(uri: str) -> io.BufferedReader:
    """A seekable binary handle."""
    system, path, _ = resolve(uri)
    return io.BufferedReader(_Raw(system.open_input_file(path)), 1 << 20)


def is_zip(uri: str) -> bool:
    """Whether a file is a zip archive, by its content: archives start with their first record or,
    if empty, with the end record."""
    with open_file(uri) as handle:
        return handle.read(4) in (b"PK\x03\x04", b"PK\x05\x06", b"PK\x07\x08")


def walk(root: str) -> Iterator[tuple[str, int]]:
    """Path and size of a file, or of every file under a folder; nothing for a missing path."""
    system, path, prefix = resolve(root)
    info = system.get_file_info(path)
    if info.type == fs.FileType.File:
        yield prefix + info.path, info.size
    elif info.type == fs.FileType.Directory:
        for found in system.get_file_info(fs.FileSelector(path, recursive=True)):
            if found.type == fs.FileType.File:
                yield prefix + found.path, found.size


def children(path: str) -> Iterator[tuple[str, int, bool]]:
    """Path, size and whether it is a folder, of a file itself or of what lies right in a folder;
    nothing for a missing path."""
    system, place, prefix = resolve(path)
    info = system.get_file_info(place)
    found = system.get_file_info(fs.FileSelector(place)) if info.type == fs.FileType.Directory else [info]
    for entry in found:
        if entry.type in (fs.FileType.File, fs.FileType.Directory):
            yield prefix + entry.path, entry.size or 0, entry.type == fs.FileType.Directory
