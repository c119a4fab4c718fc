"""Range reads of files where they lie, from a task."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager


def ranged(path: str) -> bool:
    """Whether tasks can read ranges of files there; other stores are read through Spark, as whole files."""
    scheme = path.partition(":")[0] if ":" in path else ""
    return scheme in ("", "file", "hdfs", "s3", "gs")


@contextmanager
def opened(path: str) -> Iterator[Callable[[int, int], bytes]]:
    """A function that reads n bytes from a place of the file. The path is one that Spark's file sources give."""
    import pyarrow.fs as pafs

    uri = "file://" + path[5:] if path.startswith("file:") and "://" not in path else path
    fs, name = pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)
    with fs.open_input_file(name) as f:

        def read(at: int, n: int) -> bytes:
            f.seek(at)
            return f.read(n)

        yield read
