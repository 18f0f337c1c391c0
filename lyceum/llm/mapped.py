"""Arrays in files of the shared folder, opened by memory mapping."""

from __future__ import annotations

import json
import mmap
import os
import tempfile
import uuid
from typing import BinaryIO
from urllib.parse import unquote, urlparse

import numpy as np


def local_path(uri: str) -> str | None:
    """The path if the folder is mounted, as file: or a plain path."""
    parts = urlparse(uri)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def mapped(file: BinaryIO) -> np.ndarray:
    """A plain array over the map of a file: its views cost less than those of numpy's own kind of map."""
    return np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ), np.uint8)


class Store:
    """A folder of files, each a set of named arrays.  A file is written whole under another name and then
    renamed, so that a task that is run again, or twice at a time, leaves the same file."""

    def __init__(self, uri: str):
        self.uri = uri

    def write(self, name: str, arrays: dict[str, np.ndarray]) -> None:
        head, at = {}, 0
        for key, value in arrays.items():
            head[key] = (value.dtype.str, at, len(value))
            at += -(-value.nbytes // 8) * 8
        text = json.dumps(head).encode()
        text += b" " * (-len(text) % 8)
        parts = [len(text).to_bytes(8, "little"), text]
        for value in arrays.values():
            parts += [np.ascontiguousarray(value).tobytes(), b"\0" * (-value.nbytes % 8)]
        folder = local_path(self.uri)
        if folder:
            os.makedirs(folder, exist_ok=True)
            part = f"{folder}/.{name}-{uuid.uuid4().hex}"
            with open(part, "wb") as out:
                out.writelines(parts)
            os.replace(part, f"{folder}/{name}")
        else:
            from pyarrow.fs import FileSystem

            system, path = FileSystem.from_uri(self.uri)
            system.create_dir(path, recursive=True)
            part = f"{path}/.{name}-{uuid.uuid4().hex}"
            with system.open_output_stream(part) as out:
                for piece in parts:
                    out.write(piece)
            system.move(part, f"{path}/{name}")

    def read(self, name: str) -> dict[str, np.ndarray]:
        """Maps of a file.  From a store that is not mounted it is fetched into a file without a name,
        which is gone as soon as the task lets go of the maps."""
        folder = local_path(self.uri)
        if folder:
            with open(f"{folder}/{name}", "rb") as source:
                raw = mapped(source)
        else:
            from pyarrow.fs import FileSystem

            system, path = FileSystem.from_uri(self.uri)
            with tempfile.TemporaryFile() as own, system.open_input_stream(f"{path}/{name}") as source:
                while piece := source.read(1 << 22):
                    own.write(piece)
                own.flush()
                raw = mapped(own)
        size = int(raw[:8].view("<u8")[0])
        head = json.loads(raw[8:8 + size].tobytes())
        return {k: raw[8 + size + at: 8 + size + at + n * np.dtype(kind).itemsize].view(kind) for k, (kind, at, n) in head.items()}
