"""Plain files in folders that all executors share, opened from Python tasks."""

from __future__ import annotations

from pyarrow import fs


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; a path without a scheme is local."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)
