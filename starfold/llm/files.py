"""Binary files in the shared store, written and read by tasks."""

from __future__ import annotations

import pyarrow.fs


def filesystem(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path in the shared store, and the path within it."""
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return pyarrow.fs.FileSystem.from_uri(path)
    return pyarrow.fs.LocalFileSystem(), path


def beside(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"
