"""Files as tasks open them: ``pyarrow.fs`` under the paths that Spark lists."""

from __future__ import annotations

import re
from urllib.parse import quote


def located(path: str):
    """(file system, path in it) of a path as Spark writes it: not percent-encoded, local ones with or without ``file:``."""
    from pyarrow import fs

    if local := re.fullmatch(r"(?:file:(?://)?)?(/.*)", path, re.S):
        return fs.LocalFileSystem(), local[1]
    return fs.FileSystem.from_uri(quote(path, safe="/:@"))
