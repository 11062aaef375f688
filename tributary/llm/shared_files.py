"""Plain files in the folder that driver and executors share, from inside tasks.

A writing task gives each file a name of its own and returns it; only the names that Spark commits (a
table of a finished job) are read later. So a task that runs twice, or is lost, harms nothing: the
files of its other attempts are never listed.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or a plain path."""
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def new_file(folder: str, suffix: str) -> str:
    """A name below the folder that no other attempt uses."""
    system, path = opened(folder)
    system.create_dir(path, recursive=True)
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def output(uri: str):
    system, path = opened(uri)
    return system.open_output_stream(path, compression=None)


def input_stream(uri: str):
    system, path = opened(uri)
    return system.open_input_stream(path, compression=None)
