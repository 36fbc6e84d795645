"""Many small numeric rows packed into one binary per destination, so a shuffle moves few Spark rows.

A packed row is (pid, kind, rows): `pid` names the destination group, `kind` the layout, `rows` the columns one after the
other. Columns are stored by byte planes, so a shuffle's codec finds the zero bytes of small numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import input_partitions

KIND = "pid int, kind int, rows binary"


def groups(df: DataFrame) -> int:
    """A group is what one task unpacks: as many as the session's shuffle partitions, which whoever runs the job sizes."""
    return input_partitions(df.sparkSession)


def _planes(column: np.ndarray) -> bytes:
    return np.ascontiguousarray(column).view(np.uint8).reshape(len(column), column.itemsize).T.tobytes()


def pack(pid: np.ndarray, columns: list[np.ndarray], kind: int = 0, lists: tuple[np.ndarray, np.ndarray] | None = None) -> pa.RecordBatch:
    """One packed row per distinct pid. lists: lengths and values of a list column, which comes last."""
    order = np.argsort(pid.astype(np.uint16) if len(pid) and pid.max() < 1 << 16 else pid, kind="stable")
    columns = [c[order] for c in columns]
    cuts = np.append(np.flatnonzero(np.diff(pid[order], prepend=-1)), len(order))
    if lists:
        length, values = lists
        begin = (np.cumsum(length) - length)[order]
        length = length[order]
        until = np.append(0, np.cumsum(length))
        values = values[np.repeat(begin - until[:-1], length) + np.arange(until[-1])]
    made = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        parts = [np.uint32(b - a).tobytes(), *(_planes(c[a:b]) for c in columns)]
        if lists:
            parts += [_planes(length[a:b].astype(np.uint32)), _planes(values[until[a] : until[b]])]
        made.append(b"".join(parts))
    return pa.RecordBatch.from_arrays([pa.array(pid[order][cuts[:-1]].astype(np.int32)), pa.array(np.full(len(made), kind, np.int32)), pa.array(made, pa.binary())], names=["pid", "kind", "rows"])


def unpack(blobs: list[bytes], types: list[str], values: str | None = None) -> list[np.ndarray]:
    """The columns of packed rows, then lengths and values of the list column where it has one."""
    found = []
    for blob in blobs:
        n, at = int(np.frombuffer(blob, np.uint32, 1)[0]), 4
        columns = []
        for t in [*types, "u4"] if values else types:
            size = np.dtype(t).itemsize
            columns.append(np.frombuffer(blob, np.uint8, n * size, at).reshape(size, n).T.copy().view(t).ravel())
            at += n * size
        if values:
            size = np.dtype(values).itemsize
            m = (len(blob) - at) // size
            columns.append(np.frombuffer(blob, np.uint8, m * size, at).reshape(size, m).T.copy().view(values).ravel())
        found.append(columns)
    return [np.concatenate(c) for c in zip(*found, strict=True)]


def dealt(packed: DataFrame) -> DataFrame:
    """Brings the rows of each pid together in one partition, without a sort."""
    return packed.repartitionById(groups(packed), F.col("pid"))


def gathered(batches: Iterator[pa.RecordBatch]) -> dict[int, list[bytes]]:
    """A partition's binaries by kind."""
    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for k, kind in enumerate(batch.column(1).to_pylist()):
            held.setdefault(kind, []).append(batch.column(2)[k].as_py())
    return held


class Sender:
    """Collects columns and packs them when there are many rows, so that packed rows aren't small."""

    def __init__(self, at_once: int, kind: int = 0) -> None:
        self.at_once, self.kind, self.held, self.size = at_once, kind, [], 0

    def take(self, pid: np.ndarray, columns: list[np.ndarray], lists: tuple[np.ndarray, np.ndarray] | None = None) -> Iterator[pa.RecordBatch]:
        if len(pid):
            self.held.append((pid, columns, lists))
            self.size += len(pid) + (len(lists[1]) if lists else 0)
            if self.size >= self.at_once:
                yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            columns = [np.concatenate(c) for c in zip(*(h[1] for h in self.held), strict=True)]
            lists = tuple(np.concatenate([h[2][k] for h in self.held]) for k in (0, 1)) if self.held[0][2] else None
            pid = np.concatenate([h[0] for h in self.held])
            self.held, self.size = [], 0
            yield from self.made(pid, columns, lists)

    def made(self, pid: np.ndarray, columns: list[np.ndarray], lists: tuple[np.ndarray, np.ndarray] | None) -> Iterator[pa.RecordBatch]:
        yield pack(pid, columns, self.kind, lists)
