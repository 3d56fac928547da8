"""Files that tasks write to and read from the shared folder, through pyarrow's filesystems."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyarrow import NativeFile
from pyarrow import fs as pafs


def _located(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


@contextmanager
def written(uri: str) -> Iterator[NativeFile]:
    """A file that appears under its name only when complete: a failed or repeated attempt of a task leaves no half of one."""
    system, path = _located(uri)
    folder, _, name = path.rpartition("/")
    system.create_dir(folder, recursive=True)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    try:
        with system.open_output_stream(draft) as out:
            yield out
    except BaseException:
        system.delete_file(draft)
        raise
    system.move(draft, path)


def opened(uri: str) -> NativeFile:
    """The file, with random access."""
    system, path = _located(uri)
    return system.open_input_file(path)
