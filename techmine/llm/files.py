"""Files in the shared folder, opened inside tasks."""

from __future__ import annotations

import os


def local_path(uri: str) -> str | None:
    """The path of a ``file:`` URI or plain path; None for other stores."""
    if uri.startswith("file:"):
        return "/" + uri[len("file:"):].lstrip("/")
    return None if ":" in uri.split("/", 1)[0] else uri


def open_write(uri: str):
    path = local_path(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    from pyarrow import fs
    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    return store.open_output_stream(path)


def open_read(uri: str):
    path = local_path(uri)
    if path is not None:
        return open(path, "rb")
    from pyarrow import fs
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)
