"""Binary files in the shared folder, written and read inside tasks.

The folder is a plain path or a URI of a store that pyarrow knows (file, hdfs, s3, gs). A file
appears under its name only when it is complete; a task that runs again writes the same bytes
under the same name."""

from __future__ import annotations

import uuid

from pyarrow import fs


def _open(uri: str):
    return fs.FileSystem.from_uri(uri)


def write_bytes(uri: str, data: bytes) -> None:
    system, path = _open(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(part) as out:
        out.write(data)
    try:
        system.move(part, path)
    except OSError:  # stores that never move onto a name: the same bytes are there already
        if system.get_file_info(path).type != fs.FileType.File:
            raise
        system.delete_file(part)


def read_ranges(uri: str, ranges: list[tuple[int, int]]):
    """Yield the bytes of each (offset, length)."""
    system, path = _open(uri)
    with system.open_input_file(path) as source:
        for offset, length in ranges:
            yield source.read_at(length, offset)
