"""Files that tasks write and read themselves, on any store pyarrow can open.

A file is written under a name of its own attempt and then renamed, so a task
that runs again (a lost executor, speculation) never leaves half a file under
the final name.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" not in uri and uri.startswith("file:/"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


@contextmanager
def new_file(uri: str) -> Iterator[pa.NativeFile]:
    """A stream whose content appears under ``uri`` once it is complete."""
    store, path = located(uri)
    store.create_dir(posixpath.dirname(path), recursive=True)
    own = f"{path}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        yield out
    store.move(own, path)


@contextmanager
def random_access(uri: str) -> Iterator[pa.NativeFile]:
    store, path = located(uri)
    with store.open_input_file(path) as f:
        yield f


def read_range(f: pa.NativeFile, start: int, size: int) -> bytes:
    """Exactly ``size`` bytes from ``start``."""
    data = f.read_at(size, start)
    if len(data) != size:
        raise ValueError(f"file ends at {start + len(data)}, {start + size} expected")
    return data
