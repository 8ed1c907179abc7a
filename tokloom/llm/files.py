"""Files in folders that all executors share, by URI; used inside tasks."""

from __future__ import annotations

import posixpath


class Folder:
    """A shared folder (``file:``, ``hdfs:``, ``s3:`` ... or a plain path)."""

    def __init__(self, uri: str):
        from pyarrow import fs

        self.files, self.root = (fs.FileSystem.from_uri(uri) if ":" in uri
                                 else (fs.LocalFileSystem(), uri))

    def make(self) -> None:
        self.files.create_dir(self.root, recursive=True)

    def at(self, name: str) -> str:
        return posixpath.join(self.root, name)

    def read(self, name: str):
        """Open for streaming or seeking."""
        return self.files.open_input_file(self.at(name))

    def write(self, name: str, attempt: int) -> "Output":
        return Output(self, name, f".{name}-{attempt}.part")


class Output:
    """A file that takes its name only when it is complete, so a task run again replaces it whole."""

    def __init__(self, folder: Folder, name: str, temporary: str):
        self.folder, self.name, self.temporary, self.offset = folder, name, temporary, 0
        self.stream = folder.files.open_output_stream(folder.at(temporary), buffer_size=1 << 20)

    def put(self, data: bytes) -> None:
        self.stream.write(data)
        self.offset += len(data)

    def done(self) -> None:
        self.stream.close()
        self.folder.files.move(self.folder.at(self.temporary), self.folder.at(self.name))
