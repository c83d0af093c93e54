"""Documents packed into chunks, and keys matched between chunks.

Operators that look for the same content in different documents read the corpus
more than once. Here it is packed into chunks of a few megabytes once, written
to the shared folder, and addressed by chunk number. Instead of one row per
key, a chunk sends each shard of the key space one sorted, compressed block of
its distinct keys; the shard answers with one bit per key. A key that very many
documents hold is one entry per chunk, so it makes no hot task.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from threadline.llm.arrow import pack_numbers, pack_sorted, released, unpack_sorted
from threadline.plans.scratch import Scratch

CHUNK_BYTES = 1_000_000
_ROW_BITS = 16  # rows in a chunk, at most 2**16
_SHARD_BYTES = 16 << 20  # text behind one shard of the key space, about
_LEAST_SHARDS = 64

SCHEMA = "chunk long, n int, bytes long, payload binary"
BITS = "chunk long, shard int, bits binary"
KEYS = "chunk long, shard int, keys binary, more binary, docs binary"


@dataclass(frozen=True)
class Chunks:
    """Packed documents: one row per chunk. Columns of the frame are c0, c1, … inside."""

    df: DataFrame
    names: list[str]
    schema: list
    shards: int  # a power of two

    @property
    def shard_bits(self) -> int:
        return self.shards.bit_length() - 1


def row_of(chunk: int, n: int) -> np.ndarray:
    """Numbers of the rows of a chunk, unique in the data set."""
    return (chunk << _ROW_BITS) + np.arange(n, dtype=np.int64)


def chunk_of(row: F.Column) -> F.Column:
    return F.shiftright(row, _ROW_BITS)


def pack(df: DataFrame, text: str, scratch: Scratch) -> Chunks:
    """Write a frame, all columns and rows, as chunks in the order in which it is read."""
    names = df.columns
    at = [n.lower() for n in names].index(text.lower()) if text not in names else names.index(text)
    plain = df.toDF(*[f"c{i}" for i in range(len(names))])
    plain = plain.withColumn(f"c{at}", F.col(f"c{at}").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            lengths = pc.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
            lo, size = 0, 0
            for i in range(batch.num_rows + 1):
                full = i == batch.num_rows or size and size + lengths[i] > CHUNK_BYTES or i - lo >= 1 << _ROW_BITS
                if full and i > lo:
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, batch.schema) as out:
                        out.write_batch(pa.concat_batches([batch.slice(lo, i - lo)]))
                    payload = press.compress(sink.getvalue())
                    yield pa.record_batch({"chunk": pa.array([number], pa.int64()), "n": pa.array([i - lo], pa.int32()), "bytes": pa.array([size], pa.int64()), "payload": pa.array([payload], pa.binary())})
                    number, lo, size = number + 1, i, 0
                if i < batch.num_rows:
                    size += int(lengths[i])

    # Held in buckets by chunk number: what is sent to chunks moves, they stay.
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"threadline_chunks_{uuid.uuid4().hex}"
    rows = plain.mapInArrow(released(run), SCHEMA).repartition(n, "chunk").write.format("parquet").bucketBy(n, "chunk")
    rows.option("compression", "uncompressed").option("path", f"{scratch.root}/{name}").saveAsTable(name)
    packed = spark.table(name)
    # The frame knows its files and buckets; the caller's catalogue keeps no entry, the files stay.
    spark.sql(f"DROP TABLE {name}")
    size = packed.agg(F.sum("bytes")).first()[0] or 0
    return Chunks(packed, names, [f.dataType for f in plain.schema.fields], 1 << max(_LEAST_SHARDS - 1, int(size) // _SHARD_BYTES).bit_length())


def unpack(payload: bytes) -> pa.Table:
    with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(payload)) as stream:
        return stream.read_all().combine_chunks()


def each_chunk(chunks: DataFrame, f: Callable[..., Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``f(chunk, table, **other columns)`` for each chunk, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: v[0] for k, v in batch.slice(i, 1).to_pydict().items()}
                yield from f(row.pop("chunk"), unpack(row.pop("payload")), **row)

    return chunks.mapInArrow(released(run), schema)


def gather_bits(bits: DataFrame, name: str) -> DataFrame:
    """One row per chunk with the answers of all shards."""
    return bits.groupBy("chunk").agg(F.collect_list(F.struct("shard", "bits")).alias(name))


def answers(shards: np.ndarray, got: list[dict] | None) -> np.ndarray:
    """The bit of each key; ``shards`` are the shards of the keys in sending order (ascending)."""
    out = np.zeros(len(shards), dtype=bool)
    for part in got or ():
        lo, hi = np.searchsorted(shards, [part["shard"], part["shard"] + 1])
        out[lo:hi] = np.unpackbits(np.frombuffer(part["bits"], dtype=np.uint8), count=hi - lo).astype(bool)
    return out


def by_shard(shards: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs of equal shards: shard, start, end."""
    edges = np.flatnonzero(np.diff(shards)) + 1
    for lo, hi in zip(np.concatenate([[0], edges]), np.concatenate([edges, [len(shards)]])):
        if hi > lo:
            yield int(shards[lo]), int(lo), int(hi)


def runs(*sorted_keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal keys in sorted arrays."""
    if not len(sorted_keys[0]):
        return np.zeros(0, dtype=np.int64)
    new = np.zeros(len(sorted_keys[0]), dtype=bool)
    new[0] = True
    for k in sorted_keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def spread(values: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """One value per run, given to each member."""
    return np.repeat(values, np.diff(np.append(starts, n)))


def send(chunk: int, shards: np.ndarray, keys: np.ndarray, more: np.ndarray | None = None, docs: np.ndarray | None = None) -> pa.RecordBatch:
    """One block of sorted keys, and what goes with them, for each shard."""
    parts = list(by_shard(shards))
    column = lambda f: pa.array([f(lo, hi) for _, lo, hi in parts], pa.binary())
    return pa.record_batch({
        "chunk": pa.array([chunk] * len(parts), pa.int64()), "shard": pa.array([p[0] for p in parts], pa.int32()),
        "keys": column(lambda lo, hi: pack_sorted(keys[lo:hi])),
        "more": column(lambda lo, hi: b"" if more is None else pack_numbers(more[lo:hi])),
        "docs": column(lambda lo, hi: b"" if docs is None else pack_numbers(docs[lo:hi])),
    })


def reply(group: pa.Table, blocks: list[np.ndarray], bit: np.ndarray) -> pa.Table:
    """The bits of each block; blocks without a set bit need no answer."""
    bounds = np.cumsum([0, *map(len, blocks)])
    packed = [np.packbits(bit[a:b]).tobytes() if bit[a:b].any() else None for a, b in zip(bounds, bounds[1:])]
    out = pa.table({"chunk": group.column("chunk"), "shard": group.column("shard"), "bits": pa.array(packed, pa.binary())})
    return out.filter(pc.is_valid(out.column("bits")))


def shared(group: pa.Table) -> pa.Table:
    """Bit of each key: do two documents hold it? Keys come with a last bit for that within their chunk."""
    blocks = [unpack_sorted(b) for b in group.column("keys").to_pylist()]
    keys = np.concatenate(blocks)
    order = np.argsort(keys, kind="stable")
    starts = runs(keys[order] >> np.uint64(1))
    several = np.diff(np.append(starts, len(keys))) > 1
    several |= np.bitwise_or.reduceat(keys[order] & np.uint64(1), starts).astype(bool) if len(starts) else False
    bit = np.empty(len(keys), dtype=bool)
    bit[order] = spread(several, starts, len(keys))
    return reply(group, blocks, bit)
