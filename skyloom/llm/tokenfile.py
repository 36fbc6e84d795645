"""Token-ID output: documents as ids in range-coded, checksummed blocks, and the way back.

File format (a table of segments in Parquet, so any store that Spark writes to will do): `part` numbers ranges of
ascending doc_id, `segment` counts within a part, `first` is the number of ids before the segment in its part, and
`payload` holds

    magic "SKLM2\\n", CRC-32 of the index, sizes; index: doc_id and id count of each document; lengths and CRC-32s of
    the blocks; the blocks, each coded by itself (rangecoder.py)

A document is never split over segments; a segment takes documents until it has LANES * BLOCK ids, so memory is
bounded by that or by the longest document. A damaged block or index raises an error that names it.

Null and empty texts have the end id alone. Rows with equal doc_id are ordered by their text's hash; a null doc_id comes first.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm import pretokens, rangecoder
from skyloom.llm import textkit as K
from skyloom.llm.common import input_partitions, written

MAGIC = b"SKLM2\n"
LANES, BLOCK = 2048, 2048
NULL_ID = -(1 << 63)
SEGMENTS = "part int, segment int, first long, n_docs long, n_tokens long, payload binary"


class LibraryTokenizer:
    """Ids by the tokenizers library's default: each distinct pre-token is encoded once by it, whole texts where it splits otherwise
    or where they hold the text of an added token."""

    def __init__(self, spec: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        split = self.library.pre_tokenizer
        probe = "It's 12  o'clock,\n\n we'll see_ü "
        raw = np.frombuffer(probe.encode(), np.uint8)
        starts, ends, _ = pretokens.spans(raw, np.array([0, len(raw)]))
        ours = [raw[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
        theirs = split and [probe[a:b].encode() for _, (a, b) in split.pre_tokenize_str(probe)]
        self.vocabulary = pretokens.Vocabulary(self.resolve) if ours == theirs and self.library.normalizer is None else None

    def resolve(self, pieces: list[bytes]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not self.vocabulary:
            return self.whole(column)
        held = np.zeros(len(column), bool)
        for text in self.added:
            held |= pc.match_substring(column, text).fill_null(False).to_numpy(zero_copy_only=False)
        if not held.any():
            return self.vocabulary.ids(column)
        mask = pa.array(held)
        ids, rows = self.vocabulary.ids(pc.if_else(mask, pa.scalar("", column.type), column))
        own, at = self.whole(column.filter(mask))
        size = np.diff(rows)
        size[held] = np.diff(at)
        ids = np.insert(ids, np.repeat(rows[:-1][held], np.diff(at)), own)
        return ids, np.append(0, np.cumsum(size))

    def whole(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        made = [x.ids for x in self.library.encode_batch([x or "" for x in column.to_pylist()], add_special_tokens=False)]
        rows = np.zeros(len(made) + 1, np.int64)
        np.cumsum([len(x) for x in made], out=rows[1:])
        return np.fromiter((i for x in made for i in x), np.uint32, int(rows[-1])), rows


_tokenizers: dict[str, LibraryTokenizer] = {}


def tokenizer_of(spec: str) -> LibraryTokenizer:
    """The tokenizer, built once in a Python worker."""
    if spec not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[spec] = LibraryTokenizer(spec)
    return _tokenizers[spec]


def pack(docs: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    """A segment's payload."""
    n = len(ids)
    used = np.flatnonzero(np.bincount(ids))
    place = np.zeros(int(used[-1]) + 1 if n else 1, np.uint32)
    place[used] = np.arange(len(used))
    steps = int(min(BLOCK, max(1, -(-n // LANES), min(n, 512))))
    lanes = -(-n // steps)
    padded = np.zeros(lanes * steps, np.uint32)
    padded[:n] = place[ids]
    codes: list[bytes] = []
    for at in range(0, lanes, LANES):
        group = padded[at * steps : (at + LANES) * steps].reshape(-1, steps).T
        codes += rangecoder.encode(np.ascontiguousarray(group), len(used))
    sums = [rangecoder.checksum(ids[k * steps : (k + 1) * steps]) for k in range(lanes)]
    index = struct.pack("<IIII", len(docs), lanes, steps, len(used)) + docs.astype("<i8").tobytes() + counts.astype("<u8").tobytes() + used.astype("<u4").tobytes()
    index += np.array([len(c) for c in codes], "<u4").tobytes() + np.array(sums, "<u4").tobytes()
    return MAGIC + struct.pack("<I", zlib.crc32(index)) + index + b"".join(codes)


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, counts, ids of a segment; raises ValueError where a checksum fails."""
    if payload[:6] != MAGIC:
        raise ValueError("not a token segment")
    n_docs, lanes, steps, n_used = struct.unpack_from("<IIII", payload, 10)
    ends = np.cumsum([26, n_docs * 8, n_docs * 8, n_used * 4, lanes * 4, lanes * 4])
    if zlib.crc32(payload[10 : ends[5]]) != struct.unpack_from("<I", payload, 6)[0]:
        raise ValueError("the segment's index is damaged")
    docs, counts, used, sizes, sums = (np.frombuffer(payload[a:b], kind) for a, b, kind in zip(ends[:5], ends[1:], ("<i8", "<u8", "<u4", "<u4", "<u4"), strict=True))
    counts = counts.astype(np.int64)
    n = int(counts.sum())
    at = ends[5] + np.cumsum(sizes.astype(np.int64)) - sizes
    codes = [payload[a : a + s] for a, s in zip(at.tolist(), sizes.tolist(), strict=True)]
    ids = np.zeros(lanes * steps, np.uint32)
    for k in range(0, lanes, LANES):
        group = rangecoder.decode(codes[k : k + LANES], steps, n_used)
        ids[k * steps : k * steps + group.size] = used[np.minimum(group.T.ravel(), n_used - 1)]
    ids = ids[:n]
    for k in range(lanes):
        if rangecoder.checksum(ids[k * steps : (k + 1) * steps]) != sums[k]:
            raise ValueError(f"block {k} is damaged")
    return docs, counts, ids


def _write(spec: str, end_id: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(spec)
        part, segment, first = TaskContext.get().partitionId(), 0, 0
        docs, counts, ids, held = [], [], [], 0

        def made() -> pa.RecordBatch:
            payload = pack(np.concatenate(docs), np.concatenate(counts), np.concatenate(ids))
            n = sum(map(len, docs))
            values = ([part], [segment], [first], [n], [held], [payload])
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=["part", "segment", "first", "n_docs", "n_tokens", "payload"])

        for batch in batches:
            for start, stop in K.slices(batch.column(1), 4 << 20):
                own, rows = tokenizer.ids(batch.column(1).slice(start, stop - start))
                with_end = np.insert(own, rows[1:], end_id)
                docs.append(batch.column(0).slice(start, stop - start).fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64))
                counts.append(np.diff(rows) + 1)
                ids.append(with_end)
                held += len(with_end)
                if held >= LANES * BLOCK:
                    yield made()
                    segment, first = segment + 1, first + held
                    docs, counts, ids, held = [], [], [], 0
        if docs:
            yield made()

    return run


def write(docs: DataFrame, spec: str, end_id: int) -> DataFrame:
    """Encodes documents in ascending doc_id order into a table of segments in the shared folder; spec: the tokenizer's JSON."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(input_partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    return written(ranged.mapInArrow(_write(spec, end_id), SEGMENTS))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, first, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            docs, counts, ids = unpack(payload)
            ends = np.cumsum(counts)
            packed = ids.astype("<u4").tobytes()
            for at in range(0, len(docs), 512):
                lo, hi = ends[at : at + 512] - counts[at : at + 512], ends[at : at + 512]
                values = [packed[a * 4 : b * 4] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                own = docs[at : at + 512]
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(own), pa.int32()), pa.array(own, mask=own == NULL_ID), pa.array(lo + first), pa.array(values, pa.binary())], names=["part", "doc_id", "at", "ids"])


def read(segments: DataFrame) -> DataFrame:
    """doc_id, start, ids of every document: start is the number of ids of all documents before it.

    Only one total per part comes to the driver.
    """
    total, starts = 0, []
    for row in segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect():
        starts.append((row["part"], total))
        total += row["n"]
    before = segments.sparkSession.createDataFrame(starts, "part int, before long")
    rows = segments.select("part", "first", "payload").mapInArrow(_read, "part int, doc_id long, at long, ids binary")
    return rows.join(F.broadcast(before), "part").select("doc_id", (F.col("at") + F.col("before")).alias("start"), "ids")
