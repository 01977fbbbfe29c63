"""Reading and writing plain files from inside tasks, on any store that pyarrow knows."""

from __future__ import annotations

from pyarrow import fs


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or absolute path, and the path inside it."""
    return fs.FileSystem.from_uri(uri)


class AtomicFile:
    """A file that appears under its name only when it is complete.

    Tasks may run twice: each attempt writes a file of its own and the last one to finish takes the name.
    The content depends on the task's rows alone, so it does not matter which one that is.
    """

    def __init__(self, uri: str, attempt: int):
        self.fs, self.path = store(uri)
        self.own = f"{self.path}.{attempt}.tmp"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.sink = self.fs.open_output_stream(self.own, compression=None)

    def close(self) -> None:
        self.sink.close()
        self.fs.move(self.own, self.path)

    def abandon(self) -> None:
        self.sink.close()
        self.fs.delete_file(self.own)
