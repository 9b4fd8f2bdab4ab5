"""Files that tasks write to and read from the shared folder."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager
from urllib.parse import unquote, urlparse

import pyarrow.fs as pafs


def _place(uri: str):
    """File system and path of a URI; a path without a scheme, or with ``file``, is a folder all machines share."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return pafs.LocalFileSystem(), unquote(parsed.path) if parsed.scheme else uri
    return pafs.FileSystem.from_uri(uri)


@contextmanager
def writing(uri: str):
    """Write under a name of this attempt, then take the final name: a repeated or lost task leaves no partial file."""
    system, path = _place(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    attempt = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(attempt, compression=None, buffer_size=1 << 20) as out:
        yield out
    system.move(attempt, path)


def reading(uri: str):
    system, path = _place(uri)
    return system.open_input_file(path)


def remove(uri: str) -> None:
    """Remove a file if it is still there."""
    system, path = _place(uri)
    if system.get_file_info(path).type != pafs.FileType.NotFound:
        system.delete_file(path)
