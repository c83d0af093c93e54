"""Helpers for the Arrow side of the operators: texts as bytes, id columns, packed numbers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

NULL_ID = np.iinfo(np.int64).max  # null ids sort after all others inside the operators


def take(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; ids as long, text as string.

    Whatever else a frame holds, and however it is named, is out of the way after this.
    """
    kinds = {"doc_id": "long", "text": "string"}
    return df.select(*[F.col(f"`{src}`").cast(kinds.get(dst, "string")).alias(dst) for dst, src in columns.items()])


def ids_of(column: pa.Array) -> np.ndarray:
    return column.fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def nullable_ids(values: np.ndarray) -> pa.Array:
    values = np.asarray(values, dtype=np.int64)
    return pa.array(values, mask=values == NULL_ID)


def texts_of(column: pa.Array) -> list[str]:
    """Texts; null counts as empty."""
    return [t or "" for t in column.to_pylist()]


def joined_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one byte array with a space after each, and where each starts and ends.

    The space keeps the last word of one text apart from the first of the next.
    """
    column = column.cast(pa.large_binary()).fill_null(b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    values = column.buffers()[2]
    raw = np.frombuffer(values, dtype=np.uint8) if values else np.zeros(0, np.uint8)
    raw = raw[offsets[0] : offsets[-1]]
    lengths = np.diff(offsets)
    starts = offsets[:-1] - offsets[0] + np.arange(n)
    out = np.full(len(raw) + n, 32, dtype=np.uint8)
    keep = np.ones(len(out), dtype=bool)
    keep[starts + lengths] = False
    out[keep] = raw
    return out, starts, starts + lengths


def pack_numbers(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes; sorted ones should come as differences."""
    values = np.ascontiguousarray(values, dtype="<u8")
    planes = values.view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack_numbers(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    values = np.asarray(values, dtype=np.uint64)
    return pack_numbers(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack_numbers(blob), dtype=np.uint64)


def release() -> None:
    """Give memory that nothing uses back to the system. Python workers outlive their tasks, and keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def released(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``f``, with ``release`` when a task begins and when it has ended."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from f(batches)
        release()

    return run


def with_text(df: DataFrame, at: int) -> tuple[DataFrame, int]:
    """The frame, columns named by position, and where it has column ``at`` as a string: there already, or added.

    A text that is a string is not sent to Python twice.
    """
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    if plain.schema.fields[at].dataType == StringType():
        return plain, at
    return plain.withColumn("t", F.col(f"c{at}").cast("string")), len(df.columns)


def per_batch(f: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield f(batch)

    return run
