"""Token ids in binary files: bit-plane shuffling with a chunk index.

Ids are cut into blocks of a fixed number of ids. A block is transposed into
byte planes (the low bytes of all its ids, then the next bytes, and so on) and
each plane is compressed with zstandard: high planes are nearly constant and
shrink to a few bytes. Consecutive blocks form a chunk that ends with a
document; the chunk's index holds the documents with their places, and the sizes
of the planes, so any document is read by inflating the blocks it lies in.

A data set is a folder of Parquet files with one row per chunk, written by
Spark's committer: a lost executor's chunks are written again, and nothing but
Spark needs to reach the store.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

BLOCK = 1 << 14  # ids in a block
CHUNK = 1 << 18  # a chunk ends with the first document that brings it to so many ids
_CACHE = 400_000  # words whose ids a worker keeps; those not met for long go first
_GROUP = 1_000  # new words handed to the tokenizer at once
_BETWEEN = "0"  # stands between them
_SLICE = 4_000_000  # a slice of a batch ends with the first text that brings it to so many bytes
SCHEMA = (
    "part int, chunk int, first long, n_ids long, width int, planes binary, plane_sizes array<int>, "
    "doc_ids array<long>, doc_starts array<long>, doc_sizes array<long>"
)


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    # A task has one core; the library's own threads would compete with other tasks.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Ids of whole texts, word by word.

    Words (split at spaces and line breaks) are encoded apart and remembered.
    The tokenizer drops white space before it merges, so that is the same as
    encoding whole texts; ``split=False`` encodes whole texts for tokenizers
    that do not. Words not yet known are handed over a few hundred at a time
    with a digit between them, whose id cuts the result again.
    """

    def __init__(self, path: str, split: bool = True) -> None:
        self._tokenizer, self._split = _tokenizer(path), split
        # Words are remembered in two generations: what is met again moves to the newer one.
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}
        mark = self._apart([_BETWEEN])[0]
        self._mark = int.from_bytes(mark, "little") if len(mark) == 4 else None

    def _apart(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _fresh(self, words: list[str]) -> list[bytes]:
        """Ids of words; those that hold the digit between are encoded alone."""
        plain = [w for w in words if _BETWEEN not in w] if self._mark is not None else []
        groups = [plain[lo : lo + _GROUP] for lo in range(0, len(plain), _GROUP)]
        found: dict[str, bytes] = {}
        for group, e in zip(groups, self._tokenizer.encode_batch_fast([f" {_BETWEEN} ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u4")
            cuts = np.flatnonzero(ids == self._mark)
            if len(cuts) == len(group) - 1:
                raw = ids.tobytes()
                starts, ends = [0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), len(raw)]
                found |= {w: raw[a:b] for w, a, b in zip(group, starts, ends)}
        rest = [w for w in words if w not in found]
        found |= zip(rest, self._apart(rest))
        return [found[w] for w in words]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        out = list(map(self._new.get, words))
        missing = [i for i, ids in enumerate(out) if ids is None]
        for i in missing:
            out[i] = self._old.get(words[i])
        fresh = [i for i in missing if out[i] is None]
        for i, ids in zip(fresh, self._fresh([words[i] for i in fresh])):
            out[i] = ids
        if len(self._new) + len(missing) > _CACHE // 2:
            self._old, self._new = self._new, {}
        if len(missing) <= _CACHE // 2:
            self._new |= {words[i]: out[i] for i in missing}
        return out

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Little-endian 32-bit ids of each text; there are no nulls."""
        column = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        if not self._split:
            return self._apart(column.to_pylist())
        cut = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        coded = cut.values.dictionary_encode()
        ids = pa.array(self._words(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
        _, ends, data = ids.buffers()
        raw = data.to_pybytes() if data else b""
        bounds = np.frombuffer(ends, dtype=np.int64)[cut.offsets.to_numpy()].tolist() if len(ids) else [0] * (len(column) + 1)
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pack_block(ids: np.ndarray, width: int) -> list[bytes]:
    """The compressed byte planes of one block, lowest first."""
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    press = zstandard.ZstdCompressor(level=3)
    return [press.compress(planes[i].tobytes()) for i in range(width)]


def unpack_block(planes: list[bytes]) -> np.ndarray:
    press = zstandard.ZstdDecompressor()
    raw = [np.frombuffer(press.decompress(p), dtype=np.uint8) for p in planes]
    out = np.zeros((len(raw[0]), 4), dtype=np.uint8)
    for i, plane in enumerate(raw):
        out[:, i] = plane
    return out.view("<u4").reshape(-1)


def _chunk_row(part: int, chunk: int, first: int, docs: list[tuple[int | None, bytes]]) -> dict:
    ids = np.frombuffer(b"".join(d[1] for d in docs), dtype="<u4")
    sizes = [len(d[1]) // 4 for d in docs]
    width = max(1, (int(ids.max(initial=0)).bit_length() + 7) // 8)
    planes = [p for lo in range(0, len(ids), BLOCK) for p in pack_block(ids[lo : lo + BLOCK], width)]
    return {
        "part": part, "chunk": chunk, "first": first, "n_ids": len(ids), "width": width, "planes": b"".join(planes),
        "plane_sizes": [len(p) for p in planes], "doc_ids": [d[0] for d in docs],
        "doc_starts": (first + np.cumsum([0, *sizes[:-1]])).tolist(), "doc_sizes": sizes,
    }


_ARROW = pa.schema([
    ("part", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()), ("planes", pa.binary()),
    ("plane_sizes", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64())),
])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most about ``_SLICE`` bytes of text, the second column; a longer text is one alone."""
    size = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + _SLICE, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def write_tokens(df: DataFrame, path: str, tokenizer: str, end_id: int | None = 1, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text and write the ids in ascending order of doc_id (null last, equal ids by text).

    Null texts count as empty: such a document has its end id only. Documents
    are range-partitioned once; a task encodes its range in order and holds one
    chunk at a time.
    """
    source = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, first, held, size = TaskContext.get().partitionId(), 0, 0, [], 0
        encode = encoder(tokenizer).encode
        for batch in batches:
            for part_of in _slices(batch):
                for key, ids in zip(part_of.column(0).to_pylist(), encode(part_of.column(1))):
                    held.append((key, ids + end))
                    size += len(ids) // 4 + len(end) // 4
                    if size >= CHUNK:
                        yield pa.RecordBatch.from_pylist([_chunk_row(part, chunk, first, held)], _ARROW)
                        chunk, first, held, size = chunk + 1, first + size, [], 0
        if held:
            yield pa.RecordBatch.from_pylist([_chunk_row(part, chunk, first, held)], _ARROW)

    ranged = source.repartitionByRange(n, *order).sortWithinPartitions(*order, "text")
    ranged.mapInArrow(run, SCHEMA).write.mode("errorifexists").option("compression", "uncompressed").parquet(path)


def decode_chunk(row: dict) -> np.ndarray:
    """All ids of a chunk."""
    bounds = np.cumsum([0, *row["plane_sizes"]])
    planes = [row["planes"][a:b] for a, b in zip(bounds, bounds[1:])]
    width = row["width"]
    blocks = [unpack_block(planes[i : i + width]) for i in range(0, len(planes), width)]
    return np.concatenate(blocks) if blocks else np.zeros(0, dtype="<u4")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian 32-bit, binary) of every document of a data set, from its files.

    ``start`` counts the ids of all documents before. Chunks are read in any
    order; their places come from the index and one sum per part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_chunk(row)
                at = np.array(row["doc_starts"], dtype=np.int64) - row["first"]
                cut = [ids[a : a + n].tobytes() for a, n in zip(at, row["doc_sizes"])]
                yield pa.record_batch({
                    "part": pa.array([row["part"]] * len(cut), pa.int32()), "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": pa.array(row["doc_starts"], pa.int64()), "n_tokens": pa.array(row["doc_sizes"], pa.int64()), "ids": pa.array(cut, pa.binary()),
                })

    chunks = spark.read.schema(SCHEMA).parquet(path)
    # One row per written part, as many as there were tasks.
    totals = sorted((r["part"], r["n"]) for r in chunks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    bases = np.cumsum([0, *[n for _, n in totals]]).tolist()
    base = spark.createDataFrame([(p, b) for (p, _), b in zip(totals, bases)], "part int, base long")
    docs = chunks.mapInArrow(run, "part int, doc_id long, start long, n_tokens long, ids binary")
    return docs.join(F.broadcast(base), "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids")

