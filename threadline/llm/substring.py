"""Substring deduplication by difference-cover anchors.

A window of ``WINDOW`` words goes if the same words also start in a document
with a smaller id. Positions of a document whose remainder modulo ``PERIOD``
lies in ``COVER`` are anchors. Every difference modulo the period is a
difference of two cover values, so two equal windows, wherever they start,
have anchors at the same offset among their first ``PERIOD`` words. Anchors are
hashed over the words that always remain from there to the window's end.

Only where an anchor is shared by two documents is the match extended: the
windows that hold such an anchor are compared whole, and a window's smallest
document decides. Both comparisons exchange sorted key blocks between chunks
and shards (``chunks``), never pairs of documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from threadline.llm import chunks as ch
from threadline.llm.arrow import ids_of, unpack_numbers, unpack_sorted
from threadline.llm.words import Words, words_of
from threadline.plans.scratch import Scratch

WINDOW = 13
PERIOD = 7
COVER = (0, 1, 3)
_WIDTH = WINDOW - PERIOD + 1


def _anchors(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word positions of anchors, their distinct 48-bit keys in order, and each anchor's key number; and the order."""
    place = np.arange(len(words.doc)) - words.first[words.doc]
    at = np.flatnonzero(np.isin(place % PERIOD, COVER) & (words.room() >= _WIDTH) & (words.counts[words.doc] >= WINDOW))
    keys = words.windows(_WIDTH)[at] >> np.uint64(16)
    order = np.argsort(keys, kind="stable")
    starts = ch.runs(keys[order])
    number = np.empty(len(keys), dtype=np.int64)
    number[order] = ch.spread(np.arange(len(starts)), starts, len(keys))
    return at, keys[order][starts], number, order


def _windows(words: Words, doc_ids: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts of windows that hold a shared anchor, their distinct keys in order, smallest documents and numbers."""
    count = np.zeros(len(words.doc) + 1, dtype=np.int64)
    np.cumsum(shared, out=count[1:])
    n = len(words.doc)
    ends = np.minimum(np.arange(n) + PERIOD, n)
    starts = np.flatnonzero((count[ends] > count[:n]) & (words.room() >= WINDOW))
    high, low = words.windows(WINDOW, 100)[starts], words.windows(WINDOW, 200)[starts] & np.uint64(0xFFFFFFFF)
    docs = doc_ids[words.doc[starts]]
    order = np.lexsort((docs, low, high))
    first = ch.runs(high[order], low[order])
    number = np.empty(len(starts), dtype=np.int64)
    number[order] = ch.spread(np.arange(len(first)), first, len(starts))
    chosen = order[first]
    return starts, high[chosen], low[chosen], docs[chosen], number


def _smaller(group: pa.Table) -> pa.Table:
    """Bit of each window key: does a smaller document outside the chunk hold it?"""
    blocks = [unpack_sorted(b) for b in group.column("keys").to_pylist()]
    high = np.concatenate(blocks)
    low = np.concatenate([unpack_numbers(b) for b in group.column("more").to_pylist()])
    docs = np.concatenate([unpack_numbers(b) for b in group.column("docs").to_pylist()]).view(np.int64)
    order = np.lexsort((docs, low, high))
    starts = ch.runs(high[order], low[order])
    bit = np.empty(len(high), dtype=bool)
    bit[order] = ch.spread(docs[order][starts], starts, len(high)) < docs[order]
    return ch.reply(group, blocks, bit)


def dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """All rows and columns, with n_words, n_removed and kept (kept words, one space between) after them.

    Words are runs without white space (ASCII 9-13 and 32), unchanged. Null
    texts have no words. A null id counts as larger than all others. Rows with
    the same id are one document as far as windows are concerned: they do not
    remove each other's words. Columns of these names may exist already; the
    result then has each twice, the operator's last.
    """
    scratch = scratch or Scratch(df.sparkSession, "substring")
    chunks = ch.pack(df, text, scratch)
    at_id, at_text = chunks.names.index(doc_id), chunks.names.index(text)
    bits = chunks.shard_bits

    def load(table: pa.Table) -> tuple[Words, np.ndarray]:
        return words_of(table.column(at_text)), ids_of(table.column(at_id).cast(pa.int64()))

    def anchors(chunk: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        words, doc_ids = load(table)
        at, keys, number, order = _anchors(words)
        docs = doc_ids[words.doc[at]][order]
        starts = ch.runs(number[order])
        if not len(starts):
            return
        several = np.minimum.reduceat(docs, starts) != np.maximum.reduceat(docs, starts)
        sent = keys << np.uint64(1) | several.astype(np.uint64)
        yield ch.send(chunk, (keys >> np.uint64(48 - bits)).astype(np.int32), sent)

    keys = ch.each_chunk(chunks.df.select("chunk", "payload"), anchors, ch.KEYS)
    shared = keys.repartition(chunks.shards, "shard").groupBy("shard").applyInArrow(ch.shared, ch.BITS)
    shared = scratch.save(ch.gather_bits(shared, "shared"), "shared")

    def candidates(words: Words, doc_ids: np.ndarray, got: list[dict] | None) -> tuple[np.ndarray, ...]:
        at, keys, number, _ = _anchors(words)
        hit = np.zeros(len(words.doc), dtype=bool)
        hit[at] = ch.answers((keys >> np.uint64(48 - bits)).astype(np.int32), got)[number]
        return _windows(words, doc_ids, hit)

    def windows(chunk: int, table: pa.Table, shared: list[dict]) -> Iterator[pa.RecordBatch]:
        words, doc_ids = load(table)
        _, high, low, docs, _ = candidates(words, doc_ids, shared)
        if len(high):
            yield ch.send(chunk, (high >> np.uint64(64 - bits)).astype(np.int32), high, low, docs.view(np.uint64))

    keys = ch.each_chunk(chunks.df.select("chunk", "payload").join(shared, "chunk"), windows, ch.KEYS)
    smaller = keys.repartition(chunks.shards, "shard").groupBy("shard").applyInArrow(_smaller, ch.BITS)
    smaller = scratch.save(ch.gather_bits(smaller, "smaller"), "smaller")

    columns = ", ".join(f"c{i} {t.simpleString()}" for i, t in enumerate(chunks.schema))
    schema = f"{columns}, n_words long, n_removed long, kept string"

    def remove(chunk: int, table: pa.Table, shared: list[dict] | None, smaller: list[dict] | None) -> Iterator[pa.RecordBatch]:
        words, doc_ids = load(table)
        n = len(words.doc)
        gone = np.zeros(n + 1, dtype=np.int64)
        if shared:
            starts, high, _, docs, number = candidates(words, doc_ids, shared)
            bit = ch.answers((high >> np.uint64(64 - bits)).astype(np.int32), smaller)
            dup = starts[bit[number] | (doc_ids[words.doc[starts]] > docs[number])]
            np.add.at(gone, dup, 1)
            np.subtract.at(gone, dup + WINDOW, 1)
        kept = np.cumsum(gone[:n]) == 0
        texts, lost = _joined(words, kept)
        out = table.append_column("n_words", pa.array(words.counts, pa.int64())).append_column("n_removed", pa.array(lost, pa.int64()))
        yield from out.append_column("kept", texts).to_batches(max_chunksize=2000)

    joined = chunks.df.select("chunk", "payload").join(shared.join(smaller, "chunk", "left"), "chunk", "left")
    return ch.each_chunk(joined, remove, schema).toDF(*chunks.names, "n_words", "n_removed", "kept")


def _joined(words: Words, kept: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Kept words of each text with one space between, and the number of the others."""
    data = words.data.copy()
    edge = np.zeros(len(data) + 2, dtype=np.int32)
    edge[words.start[kept]] += 1
    edge[words.end[kept] + 1] -= 1
    data[words.end[kept]] = 32
    inside = np.cumsum(edge[: len(data)]) > 0
    out = data[inside].tobytes()
    sizes = np.zeros(len(words.doc) + 1, dtype=np.int64)
    np.cumsum(np.where(kept, words.end - words.start + 1, 0), out=sizes[1:])
    count = np.zeros(len(words.doc) + 1, dtype=np.int64)
    np.cumsum(kept, out=count[1:])
    bounds = sizes[words.first]
    texts = [out[a : b - 1].decode("utf-8") if b > a else "" for a, b in zip(bounds, bounds[1:])]
    return pa.array(texts, pa.string()), words.counts - np.diff(count[words.first])


