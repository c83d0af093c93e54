"""The prefix trie of conversations, from their sorted order alone.

A conversation is the sequence of its turns (role and text), each turn a digest
of 16 bytes, so a conversation's key is one binary value and keys with a common
prefix are neighbours once sorted. Conversations are dealt into blocks by ranges
of (key, id). Within a block, the lengths of the common prefix of neighbours (LCP)
go into a sparse table for range minima. Each candidate prefix, a conversation
and a depth, then finds the members on its left and on its right by binary
search in that table, on its own; no stack is kept, and all figures of a node are
differences of running sums over its members.

A prefix whose members go beyond a block is open there. Blocks give the part of
an open prefix that they hold, parts are summed by prefix, and what stays is
one row per node. A first turn, or a whole conversation, that a third of the
conversations share is a part per block, never a group. Only the hash of the
ids of equal conversations has to see them in order; it is streamed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadline.plans.scratch import Scratch

DIGEST = 16
BLOCK_BYTES = 8 << 20  # keys of a block, about
_PIECE = 1000  # ids in one piece of a list that goes over blocks
EMPTY_SHA256 = hashlib.sha256().hexdigest()

_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_PART = (
    "block int, kind string, prefix binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, shared long, before long, saved_tokens long, ends_sha256 string, ids string, piece int"
)


def sequences(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): the digests and text sizes of each conversation's turns, in order.

    Turns are ordered by number, null first, equal numbers by digest; repeated
    rows stay repeated turns. Null role or text counts as empty. Rows without a
    conversation id belong to none. Texts are not moved, only their digests.
    """
    said = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text)]
    digest = F.md5(F.concat(F.length(said[0]).cast("string"), F.lit(":"), said[0], said[1]))
    rows = df.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), digest.alias("digest"),
        F.octet_length(said[1]).cast("long").alias("size"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("turn", "digest", "size")))
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


@dataclass(frozen=True)
class _Block:
    """Sorted conversations: turns as pairs of numbers, LCPs with the one before (``lcp[n]``: with the next block's first)."""

    conv: np.ndarray
    length: np.ndarray
    offset: np.ndarray
    key: bytes
    size: np.ndarray  # running sum of text sizes, one more entry than turns for each conversation
    lcp: np.ndarray

    def bytes_of(self, i: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Text bytes of the first ``depth`` turns of conversation i."""
        return self.size[self.offset[i] + i + depth]


def _common(a: bytes, b: bytes) -> int:
    """Turns that two keys begin with in common."""
    n = min(len(a), len(b)) // DIGEST
    if not n:
        return 0
    x, y = (np.frombuffer(v, dtype="<u8", count=2 * n).reshape(-1, 2) for v in (a, b))
    differ = np.flatnonzero((x != y).any(axis=1))
    return int(differ[0]) if len(differ) else n


def _neighbours_lcp(turns: np.ndarray, offset: np.ndarray, length: np.ndarray) -> np.ndarray:
    """LCP of each conversation but the first with the one before it."""
    room = np.minimum(length[:-1], length[1:])
    starts = np.cumsum(np.append(0, room))
    step = np.arange(starts[-1]) - np.repeat(starts[:-1], room)
    left, right = np.repeat(offset[:-2], room) + step, np.repeat(offset[1:-1], room) + step
    differ = np.flatnonzero((turns[left] != turns[right]).any(axis=1))
    # The first difference of each pair, or all it could have in common.
    at = np.searchsorted(differ, starts[:-1])
    first = np.append(differ, starts[-1])[at]
    return np.minimum(first - starts[:-1], room)


def _block(table: pa.Table, before: bytes | None, after: bytes | None) -> _Block:
    table = table.sort_by([("key", "ascending"), ("conv_id", "ascending")]).combine_chunks()
    keys = table.column("key").to_pylist()
    length = np.array([len(k) // DIGEST for k in keys], dtype=np.int64)
    offset = np.append(0, np.cumsum(length))
    key = b"".join(keys)
    turns = np.frombuffer(key, dtype="<u8").reshape(-1, 2)
    sizes = np.zeros(offset[-1] + len(keys), dtype=np.int64)
    flat = table.column("sizes").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    inner = np.arange(offset[-1]) + np.repeat(np.arange(len(keys)), length) + 1
    sizes[inner] = flat
    total = np.cumsum(sizes)
    start = offset[:-1] + np.arange(len(keys))
    total -= np.repeat(total[start], length + 1)
    lcp = np.full(len(keys) + 1, -1, dtype=np.int64)
    lcp[1:-1] = _neighbours_lcp(turns, offset, length)
    lcp[0] = -1 if before is None else _common(before, keys[0])
    lcp[-1] = -1 if after is None else _common(keys[-1], after)
    return _Block(table.column("conv_id").to_numpy(), length, offset, key, total, lcp)


class RangeMinimum:
    """Sparse table: level l holds the minimum of every 2**l neighbours."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while (1 << len(self.levels)) <= len(values):
            last, half = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def right(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """First position from ``start`` on whose value is below ``least``; the number of values if there is none."""
        at, n = start.copy(), len(self.levels[0])
        for level in range(len(self.levels) - 1, -1, -1):
            table = self.levels[level]
            ok = at + (1 << level) <= n
            ok[ok] = table[at[ok]] >= least[ok]
            at[ok] += 1 << level
        return at

    def left(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Last position up to ``start`` whose value is below ``least``; -1 if there is none."""
        at = start + 1
        for level in range(len(self.levels) - 1, -1, -1):
            table = self.levels[level]
            ok = at >= 1 << level
            ok[ok] = table[at[ok] - (1 << level)] >= least[ok]
            at[ok] -= 1 << level
        return at - 1


def _names(key: bytes, offset: int, depth: int) -> list[bytes]:
    """Names of a conversation's prefixes of 0, 1, … ``depth`` turns, each made from the one before."""
    out = [bytes(DIGEST)]
    for k in range(depth):
        out.append(hashlib.blake2b(out[-1] + key[(offset + k) * DIGEST : (offset + k + 1) * DIGEST], digest_size=DIGEST).digest())
    return out


def _parts(number: int, b: _Block) -> pa.Table:
    """Nodes that lie in the block, and its parts of those that go beyond it."""
    n, lcp, length = len(b.conv), b.lcp, b.length
    # Candidates: the prefixes that a conversation does not share with the one before, and all of the first's.
    low = lcp[:-1] + 1
    low[0] = 0
    count = length - low + 1
    base = np.append(0, np.cumsum(count))
    row = np.repeat(np.arange(n), count)
    depth = np.arange(base[-1]) - np.repeat(base[:-1] - low, count)
    # Position j of the table is the LCP of conversations j and j + 1.
    minima = RangeMinimum(lcp[1:n])
    end = minima.right(row, depth) + 1
    start = minima.left(row - 1, depth) + 1
    opens = (depth <= lcp[0]) & (start == 0)
    goes_on = (end == n) & (depth <= lcp[n])
    is_open = opens | goes_on
    # Parents: one turn less; of a first new turn, the prefix's leftmost conversation holds it.
    first_new = (depth == np.repeat(low, count)) & (row > 0)
    parent = np.arange(len(row)) - 1
    up = depth[first_new] - 1
    holder = minima.left(row[first_new] - 1, up) + 1
    parent[first_new] = base[holder] + up - low[holder]
    parent[0] = -1
    children = np.bincount(parent[~is_open & (parent >= 0)], minlength=len(row))
    leaf = np.append(0, np.cumsum(lcp[1:] < length))
    whole = np.append(0, np.cumsum(b.bytes_of(np.arange(n), np.maximum(lcp[:-1], 0))))
    inner = np.where(opens, start, start + 1)
    shared = whole[end] - whole[inner]
    before = b.bytes_of(row, np.maximum(depth - 1, 0))
    members = end - start
    least = np.minimum.reduceat(np.append(b.conv, np.iinfo(np.int64).max), np.stack([start, end], axis=1).ravel())[::2]
    return _rows(number, b, row, depth, parent, is_open, start, end, least, members, children, leaf[end] - leaf[start], shared, before)


def _rows(number, b, row, depth, parent, is_open, start, end, least, members, children, leaves, shared, before) -> pa.Table:
    n = len(b.conv)
    # Conversations that end at a node come first among its members.
    sha: list[str | None] = [EMPTY_SHA256] * len(row)
    pieces: list[tuple[int, int, str]] = []
    length = b.length
    same_end = np.append(np.flatnonzero((b.lcp[1:n] < length[1:]) | (length[1:] != length[:-1])) + 1, n)
    final = np.flatnonzero(depth == length[row])
    stop = same_end[np.searchsorted(same_end, start[final], side="right")]
    for c, s, e in zip(final.tolist(), start[final].tolist(), stop.tolist()):
        ids = b.conv[s:e].tolist()
        if is_open[c]:
            pieces += [(c, i, ",".join(map(str, ids[i : i + _PIECE]))) for i in range(0, len(ids), _PIECE)]
        else:
            sha[c] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    # Only open prefixes need names: they are prefixes of the first conversation or of the last.
    names: dict[int, bytes] = {}
    for c in (0, n - 1):
        wanted = np.flatnonzero(is_open & (start <= c) & (c < end))
        if len(wanted):
            made = _names(b.key, int(b.offset[c]), int(depth[wanted].max()))
            names |= {int(w): made[int(depth[w])] for w in wanted}
    above = np.where(parent >= 0, parent, 0)
    parent_open = is_open[above] & (parent >= 0)
    kind = np.where(is_open, "open", np.where(parent_open, "under", "closed"))
    own = [names.get(i) if o else None for i, o in enumerate(is_open.tolist())]
    up = [names.get(int(p)) if o else None for p, o in zip(parent.tolist(), parent_open.tolist())]
    parent_conv = pa.array(least[above], mask=parent_open | (parent < 0))
    saved = shared - (members - 1) * before
    columns = {
        "block": pa.array(np.full(len(row), number), pa.int32()), "kind": pa.array(kind.tolist()), "prefix": pa.array(own, pa.binary()), "parent": pa.array(up, pa.binary()),
        "conv_id": pa.array(least), "depth": pa.array(depth), "parent_conv_id": parent_conv, "n_convs": pa.array(members), "n_children": pa.array(children),
        "n_leaves": pa.array(leaves), "shared": pa.array(shared), "before": pa.array(before), "saved_tokens": pa.array(saved), "ends_sha256": pa.array(sha, pa.string()),
        "ids": pa.nulls(len(row), pa.string()), "piece": pa.nulls(len(row), pa.int32()),
    }
    nodes = pa.table(columns)
    if not pieces:
        return nodes
    listed = {name: pa.nulls(len(pieces), column.type) for name, column in columns.items()}
    listed |= {
        "block": pa.array([number] * len(pieces), pa.int32()), "kind": pa.array(["ids"] * len(pieces)), "prefix": pa.array([own[c] for c, _, _ in pieces], pa.binary()),
        "ids": pa.array([t for _, _, t in pieces]), "piece": pa.array([i for _, i, _ in pieces], pa.int32()),
    }
    return pa.concat_tables([nodes, pa.table(listed)])


def _streamed_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids of each prefix, whose pieces come one after the other."""
    last, state = None, hashlib.sha256()
    for batch in batches:
        out = []
        for prefix, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if prefix != last:
                if last is not None:
                    out.append((last, state.hexdigest()))
                last, state = prefix, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if out:
            yield pa.record_batch({"prefix": pa.array([p for p, _ in out], pa.binary()), "sha": pa.array([h for _, h in out])})
    if last is not None:
        yield pa.record_batch({"prefix": pa.array([last], pa.binary()), "sha": pa.array([state.hexdigest()])})


def prefix_trie(seqs: DataFrame, scratch: Scratch | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per node of the trie of (conv_id, turns) as ``sequences`` gives them.

    A node is a distinct sequence of the first d turns of a conversation, its
    members the conversations that begin with it. conv_id is the smallest
    member, depth is d, parent_conv_id the conv_id of the prefix one turn shorter
    (root: null), n_convs the number of members, n_children of nodes one turn
    longer, n_leaves of nodes without children in the subtree (the node
    included), saved_tokens the sum over the subtree of (n_convs - 1) times the
    bytes of the node's last text, ends_sha256 the SHA-256 of the ids of members
    that end here, ascending, with commas. Conversations without turns (null or
    empty) are members of the root. No conversations, no nodes. A conversation's
    digests are held in one row (16 bytes and a number per turn).
    """
    spark = seqs.sparkSession
    scratch = scratch or Scratch(spark, "trie")
    turns = F.coalesce("turns", F.array().cast("array<struct<digest: string, size: bigint>>"))
    flat = seqs.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.unhex(F.array_join(F.transform(turns, lambda t: t["digest"]), "")).alias("key"), F.transform(turns, lambda t: t["size"]).alias("sizes"),
    )
    flat = scratch.save(flat, "flat")
    total = flat.agg(F.sum(F.octet_length("key") + 16)).first()[0] or 0
    # Blocks by bytes; equal keys part by id.
    blocks = flat.repartitionByRange(max(1, -(-int(total) // block_bytes)), "key", "conv_id")
    blocks = scratch.save(blocks.withColumn("block", F.spark_partition_id()), "blocks")
    ends = blocks.groupBy("block").agg(F.min(F.struct("key", "conv_id")).alias("low"), F.max(F.struct("key", "conv_id")).alias("high"))
    ends = scratch.save(ends.select("block", F.col("low.key").alias("low"), F.col("high.key").alias("high")), "ends")
    # Numbers of the blocks that are not empty: one per written partition.
    held = sorted(r["block"] for r in ends.select("block").collect())
    nearby = [side for a, b in zip(held, held[1:]) for side in ((b, a, "before"), (a, b, "after"))]
    nearby = spark.createDataFrame(nearby, "block int, near int, side string")
    near = nearby.join(ends.withColumnRenamed("block", "near"), "near").select("block", "side", F.when(F.col("side") == "before", F.col("high")).otherwise(F.col("low")).alias("key"))

    def parts(left: pa.Table, right: pa.Table) -> pa.Table:
        sides = dict(zip(right.column("side").to_pylist(), right.column("key").to_pylist()))
        return _parts(left.column("block")[0].as_py(), _block(left, sides.get("before"), sides.get("after")))

    found = scratch.save(blocks.groupBy("block").cogroup(near.groupBy("block")).applyInArrow(parts, _PART), "parts")
    open_parts = found.where("kind = 'open'")
    merged = open_parts.groupBy("prefix").agg(
        F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("inside"), F.sum("n_leaves").alias("n_leaves"), F.sum("shared").alias("shared"), F.max("before").alias("before"),
    )
    merged = scratch.save(merged, "merged")
    across = merged.groupBy(F.col("parent").alias("prefix")).agg(F.count("*").alias("across"))
    above = merged.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    listed = found.where("kind = 'ids'").select("prefix", "ids", "block", "piece")
    listed = listed.repartition("prefix").sortWithinPartitions("prefix", "block", "piece").select("prefix", "ids").mapInArrow(_streamed_hash, "prefix binary, sha string")
    opened = merged.join(across, "prefix", "left").join(above, "parent", "left").join(listed, "prefix", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", (F.col("inside") + F.coalesce("across", F.lit(0))).alias("n_children"), "n_leaves",
        (F.col("shared") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"), F.coalesce("sha", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
    # Nodes right under an open one learn its smallest member through their block.
    told = open_parts.select(F.col("block").alias("at"), "prefix").join(merged.select("prefix", "conv_id"), "prefix")
    under = found.where("kind = 'under'").select("block", "parent", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")

    def attach(left: pa.Table, right: pa.Table) -> pa.Table:
        conv = dict(zip(right.column("prefix").to_pylist(), right.column("conv_id").to_pylist()))
        parent = pa.array([conv[p] for p in left.column("parent").to_pylist()], pa.int64())
        return left.drop_columns(["block", "parent"]).add_column(2, "parent_conv_id", parent)

    below = under.groupBy("block").cogroup(told.groupBy("at")).applyInArrow(attach, _NODE)
    columns = [c.split()[0] for c in _NODE.split(", ")]
    closed = found.where("kind = 'closed'").select(*columns)
    return closed.unionByName(opened.select(*columns)).unionByName(below)


def trie_of(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """``prefix_trie`` of a table with one row per turn; other columns do not take part."""
    return prefix_trie(sequences(df, conv_id, turn, role, text), scratch)
