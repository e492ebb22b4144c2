"""Files that tasks write and read beside Spark's tables: any file system that Arrow knows, by URI."""

from __future__ import annotations

import pyarrow.fs as pafs


def located(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path; a bare path is a local one."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def write(uri: str, content: bytes) -> None:
    system, path = located(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(path) as file:
        file.write(content)


def read(uri: str) -> bytes:
    system, path = located(uri)
    with system.open_input_file(path) as file:
        return file.read()
