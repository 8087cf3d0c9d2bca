"""Files in the shared folder, read and written on executors by any URI that pyarrow knows."""

from __future__ import annotations

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:"):
            return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def make_parent(uri: str) -> None:
    system, path = opened(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)


def read_range(source, start: int, length: int) -> bytes:
    source.seek(start)
    return source.read(length)
