"""Files that tasks and driver share, by path or URI: what Python writes beside Spark's own writers goes through here."""

from __future__ import annotations


def store(path: str):
    """The filesystem of a path or URI, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if path.startswith("file:") or "://" in path else (fs.LocalFileSystem(), path)
