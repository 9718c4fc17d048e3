"""Files that tasks write to and read from the cluster's shared folder by URI."""

from __future__ import annotations

import uuid

from pyarrow import fs


def _place(uri: str):
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def create(folder: str, name: str):
    """(URI, output stream) of a new file whose name no other attempt of the task uses.

    What a lost or repeated attempt wrote is left aside: readers only open the
    files that the finished tasks' manifest names.
    """
    uri = f"{folder}/{name}-{uuid.uuid4().hex}"
    where, path = _place(uri)
    where.create_dir(path.rpartition("/")[0], recursive=True)
    return uri, where.open_output_stream(path)


def open_input(uri: str):
    """A seekable file."""
    where, path = _place(uri)
    return where.open_input_file(path)


def open_stream(uri: str):
    where, path = _place(uri)
    return where.open_input_stream(path, compression=None)
