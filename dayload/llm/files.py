"""Whole files in the shared folder, written and read by tasks.

Plain and ``file:`` paths use the operating system (reads are memory-mapped);
other schemes go through pyarrow's file systems.
"""

from __future__ import annotations

import mmap
import os
import uuid
from collections.abc import Iterable
from urllib.parse import urlparse


def local_path(path: str) -> str | None:
    """The operating system's path of a plain or ``file:`` path, else None."""
    url = urlparse(path)
    return url.path if url.scheme in ("", "file") else None


def replace_file(path: str, chunks: Iterable[bytes]) -> None:
    """Write a file under a temporary name beside it and move it into place."""
    local = local_path(path)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        part = f"{local}.{uuid.uuid4().hex[:8]}"
        with open(part, "wb") as out:
            for c in chunks:
                out.write(c)
        os.replace(part, local)
        return
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    part = f"{inner}.{uuid.uuid4().hex[:8]}"
    store.create_dir(os.path.dirname(inner), recursive=True)
    with store.open_output_stream(part) as out:
        for c in chunks:
            out.write(c)
    store.move(part, inner)


def read_bytes(path: str):
    """The file's bytes: a memory map where the store allows, else a copy."""
    local = local_path(path)
    if local is not None:
        with open(local, "rb") as f:
            return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ) if os.fstat(f.fileno()).st_size else b""
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    with store.open_input_stream(inner) as f:
        return f.read()
