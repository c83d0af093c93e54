"""Document fingerprints: a digest of bucket quartiles that can be compared.

Every three consecutive bytes of a text are hashed into one of ``BUCKETS``
buckets. The digest holds the text's length on a logarithmic scale and, for each
bucket, in which quartile of the bucket counts it lies. Equal texts have equal
digests, and a small edit moves few buckets, so the difference of two digests
bounds how far apart the texts are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from threadline.plans.scratch import Scratch

BUCKETS = 256
_WEIGHT = np.array([0, 1, 2, 6])  # quartiles 0 to 3 apart: opposite ends count more than their distance
_LENGTH_STEP = 1.1


def digest(data: bytes) -> str:
    """Hex digest: two digits of length, then two bits for each bucket.

    Texts of fewer than three bytes have no triplet; their bytes, padded with
    zeros, count as one (none for the empty text).
    """
    raw = np.frombuffer(data if len(data) >= 3 else data.ljust(3, b"\0"), dtype=np.uint8).astype(np.uint32)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for lo in range(0, len(raw) - 2, 1 << 20) if data else ():  # in runs, so that a very long text needs little memory
        part = raw[lo : lo + (1 << 20) + 2]
        code = (part[:-2] | part[1:-1] << np.uint32(8) | part[2:] << np.uint32(16)) * np.uint32(0x9E3779B1)
        counts += np.bincount((code ^ code >> np.uint32(15)) * np.uint32(0x85EBCA77) >> np.uint32(24), minlength=BUCKETS)
    ranked = np.sort(counts)
    q1, q2, q3 = ranked[BUCKETS // 4 - 1], ranked[BUCKETS // 2 - 1], ranked[3 * BUCKETS // 4 - 1]
    code = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = code[0::4] | code[1::4] << 2 | code[2::4] << 4 | code[3::4] << 6
    length = min(255, int(np.rint(np.log1p(len(data)) / np.log(_LENGTH_STEP))))
    return f"{length:02x}{packed.astype(np.uint8).tobytes().hex()}"


def likeness(a: str, b: str) -> float:
    """1 for equal digests, falling to 0; the difference is bounded by unrelated digests."""
    if a == b:
        return 1.0
    x, y = bytes.fromhex(a), bytes.fromhex(b)
    p, q = (np.frombuffer(v[1:], dtype=np.uint8) for v in (x, y))
    apart = sum(_WEIGHT[np.abs((p >> s & 3).astype(np.int8) - (q >> s & 3).astype(np.int8))].sum() for s in (0, 2, 4, 6))
    # Two unrelated digests differ by about 1.75 per bucket; a step of length counts as one bucket.
    return float(max(0.0, 1.0 - (apart + abs(x[0] - y[0])) / (1.75 * BUCKETS)))


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) characters replaced by as many of ``following``, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _row(doc_id: int | None, text: str, mine: str, following: str, theirs: str) -> tuple:
    changed = edited(text, following).encode("utf-8", "surrogatepass")
    other = digest(changed)
    return doc_id, len(text), hashlib.sha256(changed).hexdigest(), mine, other, likeness(mine, other), likeness(mine, theirs)


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_FIELDS = [f.split() for f in _RESULT.split(", ")]
_TYPES = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, digest and number of characters; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            yield pa.record_batch({
                "doc_id": batch.column(0), "n_chars": pa.array(map(len, texts), pa.int64()),
                "fingerprint": pa.array([digest(t.encode("utf-8", "surrogatepass")) for t in texts], pa.string()),
            })

    return df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_chars long, fingerprint string"
    )


def compare_with_next(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every document, of an edited form, and their likeness to each other and the next document.

    The next document is the one with the next smaller id (null ids last, equal
    ids by a hash of the text, then the text); the first follows the last. A
    single document follows itself. Null texts count as empty.

    Documents are range-partitioned once. A task holds one document at a time
    and settles all pairs inside its range; the pair across each boundary is
    settled from the first and last document of the ranges, one row per task.
    """
    scratch = Scratch(df.sparkSession, "fingerprint")
    source = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = source.repartitionByRange(n, *order).sortWithinPartitions(*order, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = before = None
        for batch in batches:
            rows = []
            for key, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                now = (key, t, digest(t.encode("utf-8", "surrogatepass")))
                if before is None:
                    first = now
                else:
                    rows.append(_row(*before, now[1], now[2]))
                before = now
            yield _batch(rows, [None] * len(rows), [None] * len(rows), [""] * len(rows))
        if before is not None:
            ends = [(*first[:1], len(first[1]), "", first[2], "", 0.0, 0.0), (*before[:1], len(before[1]), "", before[2], "", 0.0, 0.0)]
            yield _batch(ends, [part, part], [0, 1], [first[1], before[1]])

    saved = scratch.save(ranged.mapInArrow(run, f"{_RESULT}, part int, place int, text string"), "pairs")
    ends = saved.where("part is not null")
    # One number per range: the ranges that hold documents, in order.
    parts = sorted(r["part"] for r in ends.where("place = 0").select("part").collect())
    follows = [(p, parts[(i + 1) % len(parts)]) for i, p in enumerate(parts)]
    inside = saved.where("part is null").select(*[f[0] for f in _FIELDS])
    if not parts:
        return inside
    links = df.sparkSession.createDataFrame(follows, "part int, next_part int")
    last = ends.where("place = 1").join(links, "part")
    head = ends.where("place = 0").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_print"))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch([_row(*r.values()) for r in batch.to_pylist()])

    across = last.join(head, "next_part").select("doc_id", "text", "fingerprint", "next_text", "next_print").mapInArrow(settle, _RESULT)
    return inside.unionByName(across)


def _batch(rows: list[tuple], part: list | None = None, place: list | None = None, texts: list[str] | None = None) -> pa.RecordBatch:
    columns = {name: pa.array([r[i] for r in rows], _TYPES[kind]) for i, (name, kind) in enumerate(_FIELDS)}
    if part is not None:
        columns |= {"part": pa.array(part, pa.int32()), "place": pa.array(place, pa.int32()), "text": pa.array(texts, pa.string())}
    return pa.record_batch(columns)
