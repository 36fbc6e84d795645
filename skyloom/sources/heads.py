"""Headers of image files without their images: a data source that reads 2880-byte blocks up to the END card.

The driver lists the files and deals them into partitions; a task opens each of its files and reads no further than the header. A card with a byte
that no header may hold (they are printable ASCII) ends the search, so a file that isn't an image costs one block or a few, and has
a null header. In a stream, files are taken in the order of their modification times; the offset is the last one's time and path, so a file that is moved
in with an older time than one that was read is not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

BLOCK, CARD = 2880, 80
SCHEMA = "path string, length long, modified long, header string, head_bytes long"
ENDINGS = (".fits", ".fit")


def read_head(file) -> tuple[str | None, int]:
    """The header's text up to its END card, null where there is none, and how many bytes were read."""
    held, size = [], 0
    while block := file.read(BLOCK):
        size += len(block)
        for at in range(0, len(block), CARD):
            card = block[at : at + CARD]
            if any(b < 32 or b > 126 for b in card):
                return None, size
            held.append(card.decode("ascii"))
            if held[-1].rstrip() == "END":
                return "".join(held), size
    return None, size


@dataclass
class Files(InputPartition):
    names: list[tuple[str, int, int]]  # path, length, modification time in nanoseconds


def listed(path: str) -> list[tuple[str, int, int]]:
    """All image files below a folder by modification time and path."""
    system, at = pafs.FileSystem.from_uri(path)
    infos = system.get_file_info(pafs.FileSelector(at, recursive=True, allow_not_found=True))
    return sorted(((i.path, i.size, i.mtime_ns or 0) for i in infos if i.type == pafs.FileType.File and i.path.lower().endswith(ENDINGS)), key=lambda f: (f[2], f[0]))


def dealt(files: list[tuple[str, int, int]], each: int) -> list[Files]:
    return [Files(files[a : a + each]) for a in range(0, len(files), each)] or [Files([])]


class _Reading:
    def __init__(self, options: dict) -> None:
        self.path, self.each = options["path"], int(options.get("filesperpartition", options.get("filesPerPartition", 500)))

    def read(self, partition: Files) -> Iterator[tuple]:
        system, _ = pafs.FileSystem.from_uri(self.path)
        for name, length, modified in partition.names:
            with system.open_input_file(name) as file:
                header, size = read_head(file)
            yield name, length, modified // 1000, header, size


class _Batch(_Reading, DataSourceReader):
    def partitions(self) -> list[Files]:
        return dealt(listed(self.path), self.each)


class _Stream(_Reading, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"modified": -1, "path": ""}

    def latestOffset(self) -> dict:
        files = listed(self.path)
        return {"modified": files[-1][2], "path": files[-1][0]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Files]:
        after, until = ((o["modified"], o["path"]) for o in (start, end))
        return dealt([f for f in listed(self.path) if after < (f[2], f[0]) <= until], self.each)

    def commit(self, end: dict) -> None:
        pass


class HeadSource(DataSource):
    """Format `image_heads`: option path, and filesPerPartition (500)."""

    @classmethod
    def name(cls) -> str:
        return "image_heads"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options)
