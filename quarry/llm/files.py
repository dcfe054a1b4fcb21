"""Binary files in the shared folder, written whole by tasks and mapped or read by workers."""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np


def local_path(uri: str) -> str | None:
    """Path of a folder that is mounted on every worker; None for other stores."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return None if "://" in uri else uri


def write_bytes(folder: str, name: str, data: bytes) -> None:
    """Write under another name, then rename: a retried or doubled task leaves one whole file."""
    path = local_path(folder)
    if path is None:
        from pyarrow import fs
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        part = f"{root}/.{name}.{uuid.uuid4().hex}"
        with store.open_output_stream(part) as f:
            f.write(data)
        store.move(part, f"{root}/{name}")
        return
    os.makedirs(path, exist_ok=True)
    part = os.path.join(path, f".{name}.{uuid.uuid4().hex}")
    with open(part, "wb") as f:
        f.write(data)
    os.replace(part, os.path.join(path, name))


def write_array(folder: str, name: str, a: np.ndarray) -> None:
    import io
    buf = io.BytesIO()
    np.save(buf, np.ascontiguousarray(a), allow_pickle=False)
    write_bytes(folder, name, buf.getvalue())


def map_array(folder: str, name: str) -> np.ndarray:
    """The array, memory-mapped. From a store without a mount it is copied once into a file that
    has no name any more when it is mapped, so nothing stays behind."""
    path = local_path(folder)
    if path is not None:
        return np.load(os.path.join(path, name), mmap_mode="r")
    from pyarrow import fs
    store, root = fs.FileSystem.from_uri(folder)
    with tempfile.NamedTemporaryFile() as tmp:
        with store.open_input_stream(f"{root}/{name}") as f:
            while chunk := f.read(1 << 24):
                tmp.write(chunk)
        tmp.flush()
        return np.load(tmp.name, mmap_mode="r")
