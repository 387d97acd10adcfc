"""Files that tasks write below the shared folder.

Every attempt of a task writes files of its own name. Only the names that a finished task returns are
ever read, so what a lost executor or a repeated attempt leaves behind is never seen.
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def open_new(folder: str, suffix: str):
    """(address, open stream) of a new file below ``folder``, which any executor can reach."""
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    return f"{folder}/{name}", system.open_output_stream(f"{root}/{name}", compression=None)


def open_old(address: str):
    """A file to read at any position."""
    system, path = fs.FileSystem.from_uri(address)
    return system.open_input_file(path)
