"""Files that tasks write and read themselves, on any storage ``pyarrow.fs`` knows.

A task writes under a name of its own, so a repeated or speculative attempt harms nothing; a file counts
once the table that lists it has been committed by Spark.
"""

from __future__ import annotations

import re
import uuid

import pyarrow.fs as pafs


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or an absolute local path."""
    if re.match("file:/", uri):
        return pafs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", uri))


def own_name(folder: str, task: int, number: int, suffix: str) -> str:
    return f"{folder}/part-{task:05d}-{number:04d}-{uuid.uuid4().hex}{suffix}"


class Ranges:
    """Reads byte ranges of one file."""

    def __init__(self, uri: str):
        fs, path = open_fs(uri)
        self.size = fs.get_file_info(path).size
        self._file = fs.open_input_file(path)

    def read(self, start: int, length: int) -> bytes:
        self._file.seek(start)
        data = self._file.read(length)
        if len(data) != length:
            raise EOFError(f"{length} bytes wanted at {start}, {len(data)} found")
        return data

    def __enter__(self) -> Ranges:
        return self

    def __exit__(self, *_) -> None:
        self._file.close()
