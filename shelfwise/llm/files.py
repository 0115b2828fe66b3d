"""Files of arrays in the shared folder, written whole by tasks and memory-mapped by others."""

from __future__ import annotations

import json
import mmap
import os
from collections import OrderedDict

import numpy as np

#: Bytes of files held in memory by a worker where the store cannot be memory-mapped.
HELD_BYTES = 256 << 20
#: Files mapped at once.
MAPPED_FILES = 4000


def _filesystem(uri: str):
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def save_arrays(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """One file: length of a JSON table of contents, the table, the arrays.  A task that runs again replaces it whole."""
    system, path = _filesystem(uri)
    contents, at, parts = {}, 0, []
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a)
        contents[name] = [str(raw.dtype), len(raw), at]
        parts.append(raw)
        at += -(-raw.nbytes // 64) * 64
    head = json.dumps(contents).encode()
    start = -(-(8 + len(head)) // 64) * 64
    system.create_dir(os.path.dirname(path), recursive=True)
    temp = f"{path}.{os.getpid()}.{os.urandom(4).hex()}"
    with system.open_output_stream(temp) as out:
        out.write(len(head).to_bytes(8, "little") + head + bytes(start - 8 - len(head)))
        for raw in parts:
            out.write(memoryview(raw).cast("B") if raw.nbytes else b"")
            out.write(bytes(-raw.nbytes % 64))
    system.move(temp, path)


def map_arrays(uri: str) -> tuple[dict[str, np.ndarray], int]:
    """The arrays of a file, memory-mapped where the store is a file system; and the bytes that they take of this process."""
    from pyarrow import fs

    system, path = _filesystem(uri)
    if isinstance(system, fs.LocalFileSystem):
        with open(path, "rb") as file:
            raw = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        taken = 0
    else:
        with system.open_input_stream(path) as src:
            raw = src.read()
        taken = len(raw)
    head = int.from_bytes(raw[:8], "little")
    start = -(-(8 + head) // 64) * 64
    return {k: np.frombuffer(raw, d, n, start + at) if n else np.empty(0, d) for k, (d, n, at) in json.loads(raw[8 : 8 + head]).items()}, taken


_mapped: OrderedDict[str, tuple[dict[str, np.ndarray], int]] = OrderedDict()


def mapped(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file; those used last stay open, within bounds of number and memory."""
    if uri not in _mapped:
        _mapped[uri] = map_arrays(uri)
        while len(_mapped) > 1 and (len(_mapped) > MAPPED_FILES or sum(n for _, n in _mapped.values()) > HELD_BYTES):
            _mapped.popitem(last=False)
    _mapped.move_to_end(uri)
    return _mapped[uri][0]
