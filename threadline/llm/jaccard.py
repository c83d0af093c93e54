"""N-gram Jaccard join: size-aware, with subsets for small sets and inverted lists for large ones.

A document is the set of its distinct word shingles. Two sets of sizes r and s
are linked when 100 * |intersection| >= 75 * |union|, that is when they share at
least ``needed(r, s)`` elements.

* Light sets (up to a boundary) enumerate their subsets of exactly the needed
  size, once for each size a partner may have; partners meet in an equal subset.
* Heavy sets, and light sets that may have a heavy partner, are listed under
  their rarest elements; any partner shares one of those. Lists are scanned for
  candidates.
* The boundary is the size at which one more size of enumerated subsets would
  cost more than listing it, by the sizes that the corpus has.

Elements are ordered by how often their bucket occurs in a sketch of fixed size
that counts the whole corpus; any fixed order gives the same result, and this
one keeps frequent passages out of the lists. Equal sets are one class and meet
as one. Links are found in rounds: each set with the first member of the lists
it shares most, then the first members of different components of a list, then
all pairs left between different components, once for each run of entries they
share, so linked copies cost the length of their group, not its square. Every candidate is
checked on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from threadline.llm import chunks as ch
from threadline.llm.arrow import pack_numbers, pack_sorted, unpack_numbers, unpack_sorted
from threadline.llm.components import components
from threadline.llm.words import mix, words_of
from threadline.plans.scratch import Scratch

SKETCH_BITS = 18  # buckets of the frequency sketch: what tasks receive is this many bytes
SCAN_COST = 4  # cost of a list entry (listing, scanning, checking) in enumerated subsets
_SLICE = 4096
_LARGEST_LIGHT = 24
PARITY = 512
_EARLIER = 2  # keys before an entry that go with it, so that most pairs are formed once
_SIZES = 64
_HASH = np.uint64((1 << 58) - 1)


def needed(r: int, s: int) -> int:
    """Fewest common elements of linked sets of sizes r and s: ceil(3 (r + s) / 7)."""
    return -(-3 * (r + s) // 7)


def partners(n: int) -> range:
    """Sizes a set linked with one of size n may have."""
    return range(-(-3 * n // 4), 4 * n // 3 + 1)


def prefix(n: np.ndarray) -> np.ndarray:
    """How many of its first elements a set is listed under."""
    return n - -(-3 * n // 4) + 1


@lru_cache(maxsize=64)
def _subset_sizes(n: int, boundary: int) -> tuple[tuple[int, int, int], ...]:
    return tuple((needed(n, s), min(n, s), max(n, s)) for s in partners(n) if 1 <= s <= boundary)


def choose_boundary(sizes: np.ndarray, scan_cost: float = SCAN_COST) -> int:
    """The boundary of least cost; ``sizes[n]`` sets have n elements."""
    best, at = None, 0
    for b in range(min(_LARGEST_LIGHT, len(sizes) - 1) + 1):
        light = sum(sizes[n] * sum(comb(n, c) for c, _, _ in _subset_sizes(n, b)) for n in range(1, b + 1))
        listed = sum(sizes[n] * int(prefix(np.int64(n))) for n in range(-(-3 * (b + 1) // 4), len(sizes)))
        cost = light + scan_cost * listed
        if best is None or cost < best:
            best, at = cost, b
    return at


@dataclass(frozen=True)
class Sets:
    """The sets of a chunk's documents: elements in order, set by set; first[i]:first[i + 1] is set i."""

    elements: np.ndarray
    first: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.sizes)


def _shingles(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """58-bit hashes of all shingles, and the text of each."""
    words = words_of(column, lower=True)
    room, counts = words.room(), words.counts
    hashes, docs = [], []
    for w in range(1, width + 1):
        # Texts of fewer words than a shingle have their whole sequence as one.
        at = np.flatnonzero((room >= width) if w == width else (room == w) & (counts[words.doc] == w))
        if len(at):
            hashes.append(words.windows(w, 300 + 16 * w)[at] & _HASH)
            docs.append(words.doc[at])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), len(counts)
    return np.concatenate(hashes), np.concatenate(docs), len(counts)


def sets_of(column: pa.Array, ranks: np.ndarray, width: int) -> Sets:
    """Sets of distinct shingles, rarest bucket first. ``ranks`` are 6-bit frequency classes by bucket."""
    hashes, docs, n = _shingles(column, width)
    elements = ranks[hashes >> np.uint64(58 - SKETCH_BITS)].astype(np.uint64) << np.uint64(58) | hashes
    order = np.lexsort((elements, docs))
    elements, docs = elements[order], docs[order]
    starts = ch.runs(docs, elements)
    return Sets(elements[starts], np.searchsorted(docs[starts], np.arange(n + 1)))


def _marks(sets: Sets) -> list[bytes]:
    """A histogram of each set over about twice as many buckets as it has elements, counted to 255."""
    press, out = zstandard.ZstdCompressor(level=1), []
    for a, b in zip(sets.first, sets.first[1:]):
        bits = max(8, int(2 * (b - a)).bit_length())
        counts = np.bincount((sets.elements[a:b] & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
        out.append(press.compress(np.minimum(counts, 255).astype(np.uint8).tobytes()))
    return out


def _parity(sets: Sets) -> np.ndarray:
    """``PARITY`` bits of each set, 64 to a number: whether an odd number of elements has the bit's number."""
    at = sets.owners() * PARITY + (sets.elements >> np.uint64(20) & np.uint64(PARITY - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=len(sets.sizes) * PARITY) & 1).astype(np.uint8)
    return np.packbits(odd).view("<i8").reshape(-1, PARITY // 64)


def _room(a: bytes, b: bytes) -> int | None:
    """The most elements two sets can share by their histograms; None where one is not counted to the end."""
    unpress = zstandard.ZstdDecompressor()
    x, y = (np.frombuffer(unpress.decompress(v), dtype=np.uint8) for v in (a, b))
    if x.max() == 255 or y.max() == 255:
        return None
    size = min(len(x), len(y))
    x, y = (v.reshape(-1, size).sum(axis=0, dtype=np.int64) for v in (x, y))
    return int(np.minimum(x, y).sum())


def _frequencies(chunks: ch.Chunks, at: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequency class of each bucket, and sets by size (shingles, repeats included) up to ``_SIZES``."""
    buckets = 1 << SKETCH_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sizes = np.zeros(buckets, dtype=np.int64), np.zeros(_SLICE, dtype=np.int64)
        for batch in batches:
            for payload in batch.column(0):
                hashes, docs, n = _shingles(ch.unpack(payload.as_py()).column(at), width)
                counts += np.bincount((hashes >> np.uint64(58 - SKETCH_BITS)).astype(np.int64), minlength=buckets)
                sizes += np.bincount(np.minimum(np.bincount(docs, minlength=n), _SIZES), minlength=_SLICE)
        parts = [sizes, *counts.reshape(-1, _SLICE)]
        yield pa.record_batch({"part": pa.array(range(len(parts)), pa.int32()), "counts": pa.array([pack_numbers(p) for p in parts], pa.binary())})

    def add(group: pa.Table) -> pa.Table:
        total = np.sum([unpack_numbers(b) for b in group.column("counts").to_pylist()], axis=0, dtype=np.uint64)
        return pa.table({"part": group.column("part").slice(0, 1), "counts": pa.array([pack_numbers(total)], pa.binary())})

    schema = "part int, counts binary"
    tables = chunks.df.select("payload").mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema)
    # The sketch: 2**SKETCH_BITS counts whatever the corpus.
    parts = {r["part"]: unpack_numbers(bytes(r["counts"])).astype(np.float64) for r in tables.collect()}
    if not parts:
        return np.zeros(buckets, dtype=np.uint8), np.zeros(_SIZES, dtype=np.int64)
    counts = np.concatenate([parts[i] for i in range(1, len(parts))])
    usual = max(1.0, float(np.median(counts)))
    ranks = np.clip(np.floor(3 * np.log2(np.maximum(counts, 1) / usual)), 0, 63).astype(np.uint8)
    return ranks, parts[0][:_SIZES].astype(np.int64)


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, boundary: int | None = None, scratch: Scratch | None = None) -> DataFrame:
    """row, doc_id, n_shingles, component_id and first (is it the one to keep?) of every row.

    Words are runs without white space (ASCII 9-13 and 32), with A-Z lower-cased.
    A text of fewer words than a shingle is one shingle; texts without words
    and null have none and are linked with nothing. ``component_id`` is the
    smallest doc_id that links reach (null only if all are null), ``first`` the
    row with that id, of equal ones the first in storage order. Rows with the
    same id are rows of their own.
    """
    scratch = scratch or Scratch(df.sparkSession, "jaccard")
    chunks = ch.pack(df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")), "text", scratch)
    return _near(chunks, 0, 1, width, boundary, scratch)


def keep_first(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5) -> DataFrame:
    """All columns of the rows that ``near_duplicates`` calls first, and of those without words."""
    scratch = Scratch(df.sparkSession, "jaccard")
    chunks = ch.pack(df, text, scratch)
    near = _near(chunks, chunks.names.index(doc_id), chunks.names.index(text), width, None, scratch)
    kept = near.where("first").groupBy(ch.chunk_of(F.col("row")).alias("chunk")).agg(F.collect_list(F.col("row")).alias("rows"))

    def choose(chunk: int, table: pa.Table, rows: list[int]) -> Iterator[pa.RecordBatch]:
        yield from table.take(pa.array(np.sort(np.array(rows)) - (chunk << 16))).to_batches(max_chunksize=2000)

    schema = ", ".join(f"c{i} {t.simpleString()}" for i, t in enumerate(chunks.schema))
    return ch.each_chunk(chunks.df.select("chunk", "payload").join(kept, "chunk"), choose, schema).toDF(*chunks.names)


def _near(chunks: ch.Chunks, at_id: int, at_text: int, width: int, boundary: int | None, scratch: Scratch) -> DataFrame:
    spark = chunks.df.sparkSession
    ranks, sizes = _frequencies(chunks, at_text, width)
    limit = choose_boundary(sizes) if boundary is None else boundary
    held = spark.sparkContext.broadcast(ranks)
    bits = chunks.shard_bits

    def listed(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the elements that sets are listed under, and their places within the set."""
        n = sets.sizes
        place = np.arange(len(sets.elements)) - np.repeat(sets.first[:-1], n)
        count = np.where(n >= -(-3 * (limit + 1) // 4), prefix(n), 0)
        at = np.flatnonzero(place < np.repeat(count, n))
        return at, place[at]

    def keys(sets: Sets, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        key = (sets.elements[at] & _HASH) >> np.uint64(10)
        order = np.argsort(key, kind="stable")
        starts = ch.runs(key[order])
        number = np.empty(len(key), dtype=np.int64)
        number[order] = ch.spread(np.arange(len(starts)), starts, len(key))
        distinct = key[order][starts]
        return distinct, np.diff(np.append(starts, len(key))) > 1, number, (distinct >> np.uint64(48 - bits)).astype(np.int32)

    def describe(chunk: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        sets = sets_of(table.column(at_text), held.value, width)
        at, _ = listed(sets)
        key, several, _, shards = keys(sets, at)
        if len(key):
            sent = ch.send(chunk, shards, key << np.uint64(1) | several.astype(np.uint64))
            yield sent.append_column("marks", pa.nulls(sent.num_rows, pa.list_(pa.binary()))).append_column("parity", pa.nulls(sent.num_rows, pa.binary()))
        sums = [np.append(np.uint64(0), np.cumsum(mix(sets.elements ^ np.uint64(c)), dtype=np.uint64))[sets.first] for c in (0x51ED27, 0xA3C59A)]
        yield pa.record_batch({
            "chunk": pa.array([chunk], pa.int64()), "shard": pa.array([-1], pa.int32()), "keys": pa.array([pack_numbers(sets.sizes)], pa.binary()),
            "more": pa.array([pack_numbers(np.diff(sums[0]))], pa.binary()), "docs": pa.array([pack_numbers(np.diff(sums[1]))], pa.binary()),
            "marks": pa.array([_marks(sets)], pa.list_(pa.binary())), "parity": pa.array([_parity(sets).tobytes()], pa.binary()),
        })

    described = scratch.save(ch.each_chunk(chunks.df.select("chunk", "payload"), describe, f"{ch.KEYS}, marks array<binary>, parity binary"), "sets")
    sent = described.where("shard >= 0").drop("marks", "parity")
    shared = sent.repartition(chunks.shards, "shard").groupBy("shard").applyInArrow(ch.shared, ch.BITS)
    shared = scratch.save(ch.gather_bits(shared, "shared"), "shared")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n, a, b = (unpack_numbers(r[k]) for k in ("keys", "more", "docs"))
                yield pa.record_batch({
                    "row": pa.array(ch.row_of(r["chunk"], len(n))), "n": pa.array(n.astype(np.int64)), "a": pa.array(a.view(np.int64)),
                    "b": pa.array(b.view(np.int64)), "marks": pa.array(r["marks"], pa.binary()),
                    "parity": pa.array(np.frombuffer(r["parity"], dtype="<i8").reshape(len(n), -1).tolist(), pa.list_(pa.int64())),
                })

    sets = described.where("shard < 0").select("chunk", "keys", "more", "docs", "marks", "parity").mapInArrow(
        rows, "row long, n long, a long, b long, marks binary, parity array<long>"
    )
    sets = scratch.save(sets, "rows")
    classes = sets.where("n > 0").groupBy("a", "b", "n").agg(F.min("row").alias("class"))
    classes = scratch.save(classes, "classes")
    members = scratch.save(sets.where("n > 0").join(classes, ["a", "b", "n"]).select("row", "class"), "members")
    heads = classes.groupBy(ch.chunk_of(F.col("class")).alias("chunk")).agg(F.collect_list("class").alias("heads"))

    def entries(chunk: int, table: pa.Table, shared: list[dict] | None, heads: list[int]) -> Iterator[pa.RecordBatch]:
        sets = sets_of(table.column(at_text), held.value, width)
        n = sets.sizes
        head = np.zeros(len(n), dtype=bool)
        head[np.array(heads) - (chunk << 16)] = True
        at, place = listed(sets)
        _, _, number, shards = keys(sets, at)
        owner = sets.owners()[at]
        keep = ch.answers(shards, shared)[number] & head[owner]
        owner, place = owner[keep], place[keep]
        before = np.arange(len(owner)) - np.searchsorted(owner, owner)
        yield _entries(sets.elements[at][keep], (chunk << 16) + owner, n[owner], place, before, False)
        found: list[tuple[int, int, int]] = []
        for i in np.flatnonzero(head & (n <= limit)):
            mine = sets.elements[sets.first[i] : sets.first[i + 1]]
            for c, r, s in _subset_sizes(len(mine), limit):
                for subset in combinations(mine.tolist(), c):
                    found.append((hash((r, s, *subset)), i, len(mine)))
        if found:
            key, i, size = (np.array(x, dtype=np.int64) for x in zip(*found))
            yield _entries(key.view(np.uint64), (chunk << 16) + i, size, np.zeros(len(i), np.int64), np.zeros(len(i), np.int64), True)

    source = chunks.df.select("chunk", "payload").join(heads, "chunk").join(shared, "chunk", "left")
    index = scratch.save(ch.each_chunk(source.select("chunk", "payload", "shared", "heads"), entries, "key long, row long, n int, place int, before int, light boolean"), "index")
    scratch.discard(described)
    links = _links(index, sets.select("row", "n", "marks", "parity"), chunks, at_text, width, held, limit, scratch)
    return _labels(chunks, at_id, sets, members, links, scratch)


def _entries(keys: np.ndarray, row: np.ndarray, n: np.ndarray, place: np.ndarray, before: np.ndarray, light: bool) -> pa.RecordBatch:
    return pa.record_batch({
        "key": pa.array(keys.view(np.int64)), "row": pa.array(row.astype(np.int64)), "n": pa.array(n.astype(np.int32)),
        "place": pa.array(place.astype(np.int32)), "before": pa.array(before.astype(np.int32)), "light": pa.array(np.full(len(row), light)),
    })


# What two sets with a common entry can share: of the elements before it those that others hold, and all after it.
# And their first common entry lies early enough in both to leave room for the needed number.
_FIT = (
    "4 * least(n, m) >= 3 * greatest(n, m) and (light or (7 * (least(before, ahead) + least(n - place, m - at)) >= 3 * (n + m)"
    " and 7 * least(n - place, m - at) >= 3 * (n + m)))"
)


def _links(index: DataFrame, sets: DataFrame, chunks: ch.Chunks, at_text: int, width: int, held, limit: int, scratch: Scratch) -> DataFrame:
    """(node, root) for the components of all links between classes."""
    on = ["light", "key"]
    # First round: each set with the first of the lists it shares most.
    # "First" is where least comes before the common entry: the least altered of near copies.
    first = index.groupBy(*on).agg(F.min(F.struct("place", "row", "n", "before")).alias("p"), F.count("*").alias("c")).where("c > 1")
    first = first.select(*on, F.col("p.row").alias("with"), F.col("p.n").alias("m"), F.col("p.place").alias("at"), F.col("p.before").alias("ahead"))
    pairs = index.join(first, on).where(f"row <> with and {_FIT} and (light or greatest(n, m) > {limit})")
    pairs = pairs.groupBy("row", "with").agg(F.count("*").alias("hits"), F.max("n").alias("n"))
    # A set that shares few of its entries waits for the second round, which leaves nothing out.
    pairs = pairs.where("8 * hits >= n div 4 + 1").groupBy("row").agg(F.max(F.struct("hits", -F.col("with"))).alias("best"))
    pairs = _plausible(pairs.select("row", (-F.col("best.col2")).alias("with")), sets, scratch)
    tree = components(_checked(pairs, chunks, at_text, width, held, scratch), scratch)
    # Then the first members of the components of a list with that of its largest one: components that belong together join.
    label = _labelled(index, tree, scratch)
    firsts = label.groupBy(*on, "comp").agg(F.count("*").alias("c"), F.min(F.struct("place", "row", "n", "before")).alias("p"))
    firsts = scratch.save(firsts, "firsts")
    big = firsts.groupBy(*on).agg(F.max(F.struct("c", "comp", "p")).alias("b"), F.count("*").alias("k")).where("k > 1")
    big = big.select(*on, F.col("b.comp").alias("big"), F.col("b.p.row").alias("with"), F.col("b.p.n").alias("m"), F.col("b.p.place").alias("at"), F.col("b.p.before").alias("ahead"))
    pairs = firsts.select(*on, "comp", "p.*").join(big, on).where(f"comp <> big and {_FIT} and (light or greatest(n, m) > {limit})")
    pairs = pairs.groupBy("row", "with").agg(F.count("*").alias("hits")).groupBy("row").agg(F.max(F.struct("hits", -F.col("with"))).alias("best"))
    pairs = _plausible(pairs.select("row", (-F.col("best.col2")).alias("with")), sets, scratch)
    joined = _checked(pairs, chunks, at_text, width, held, scratch).unionByName(tree.select(F.col("node").alias("u"), F.col("root").alias("v")))
    tree = components(joined, scratch)
    for done in (label, firsts):
        scratch.discard(done)
    # Last, every pair of different components that shares a list entry.
    label = _labelled(index, tree, scratch)
    several = label.groupBy(*on).agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select(*on)
    # Entries of a set in order, each with the last few keys before it: sets that share one of those have met already.
    entry = F.struct("light", "place", "key", "n", "before", "comp")
    mixed = label.join(several, on).groupBy("row").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    mixed = mixed.withColumn("keys", F.transform("e", lambda x: x["key"]))
    earlier = lambda i: F.slice("keys", F.greatest(i - (_EARLIER - 1), F.lit(1)), F.least(i, F.lit(_EARLIER)))
    fields = lambda x: [x[c].alias(c) for c in ("light", "place", "key", "n", "before", "comp")]
    mixed = mixed.select("row", F.inline(F.transform("e", lambda x, i: F.struct(*fields(x), earlier(i).alias("earlier")))))
    mixed = scratch.save(mixed.join(sets.select("row", "parity"), "row"), "mixed")
    for done in (index, label):
        scratch.discard(done)
    largest = mixed.groupBy(*on, "comp").agg(F.count("*").alias("c")).groupBy(*on).agg(F.max(F.struct("c", "comp")).alias("big")).select(*on, F.col("big.comp").alias("big"))
    # All pairs but those inside the largest component of a list: one side is never in it.
    minor = mixed.join(largest, on).where("comp <> big").select(*on, "row", "n", "place", "before", "comp", "big", "parity", "earlier")
    other = mixed.select(
        *on, F.col("row").alias("with"), F.col("n").alias("m"), F.col("place").alias("at"), F.col("before").alias("ahead"), F.col("comp").alias("other"),
        F.col("parity").alias("theirs"), F.col("earlier").alias("earlier2"),
    )
    # Bits that differ are elements that only one of the two has; linked sets have at most (n + m) / 7 of those.
    apart = " + ".join(f"bit_count(parity[{i}] ^ theirs[{i}])" for i in range(PARITY // 64))
    cross = minor.join(other, on).where(
        f"comp <> other and (other = big or row < with) and {_FIT} and (light or greatest(n, m) > {limit}) and 7 * ({apart}) <= n + m"
        " and (light or not arrays_overlap(earlier, earlier2))"
    )
    # Small sets may meet in several subsets, others again after elements that only one of them has.
    cross = cross.select(F.least("row", "with").alias("with"), F.greatest("row", "with").alias("row")).distinct().select("row", "with")
    cross = _plausible(cross, sets, scratch)
    scratch.discard(mixed)
    more = _checked(cross, chunks, at_text, width, held, scratch)
    both = more.unionByName(tree.select(F.col("node").alias("u"), F.col("root").alias("v")))
    return components(both, scratch)


def _labelled(index: DataFrame, tree: DataFrame, scratch: Scratch) -> DataFrame:
    label = index.join(tree.withColumnRenamed("node", "row"), "row", "left").withColumn("comp", F.coalesce("root", "row")).drop("root")
    return scratch.save(label, "labels")


def _plausible(pairs: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (row, with) whose histograms leave room for enough common elements."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rooms = map(_room, batch.column("marks").to_pylist(), batch.column("others").to_pylist())
            sizes = zip(batch.column("n").to_pylist(), batch.column("m").to_pylist())
            ok = [room is None or 7 * room >= 3 * (n + m) for room, (n, m) in zip(rooms, sizes)]
            yield pa.record_batch({"row": batch.column("row"), "with": batch.column("with")}).filter(pa.array(ok, pa.bool_()))

    sets = sets.drop("parity")
    other = sets.select(F.col("row").alias("with"), F.col("n").alias("m"), F.col("marks").alias("others"))
    both = pairs.join(sets, "row").join(other, "with").select("row", "with", "n", "m", "marks", "others")
    return scratch.save(both.mapInArrow(bound, "row long, with long"), "pairs")


def _checked(pairs: DataFrame, chunks: ch.Chunks, at_text: int, width: int, held, scratch: Scratch) -> DataFrame:
    """Edges (u, v) of the pairs (row, with) that are linked, checked on their whole sets."""
    rows = pairs.select("row").union(pairs.select(F.col("with").alias("row"))).distinct()
    wanted = rows.groupBy(ch.chunk_of(F.col("row")).alias("chunk")).agg(F.collect_list("row").alias("rows"))

    def fetch(chunk: int, table: pa.Table, rows: list[int]) -> Iterator[pa.RecordBatch]:
        rows = np.sort(np.array(rows, dtype=np.int64))
        sets = sets_of(table.column(at_text).take(pa.array(rows - (chunk << 16))), held.value, width)
        blobs = [pack_sorted(sets.elements[a:b]) for a, b in zip(sets.first, sets.first[1:])]
        yield pa.record_batch({"row": pa.array(rows), "elements": pa.array(blobs, pa.binary())})

    source = chunks.df.select("chunk", "payload").join(wanted, "chunk")
    sets = scratch.save(ch.each_chunk(source, fetch, "row long, elements binary"), "elements")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, right = None, None
        for batch in batches:
            ok = []
            for w, a, b in zip(batch.column("with").to_pylist(), batch.column("mine").to_pylist(), batch.column("theirs").to_pylist()):
                if w != last:
                    last, right = w, unpack_sorted(b)
                left = unpack_sorted(a)
                both = len(np.intersect1d(left, right, assume_unique=True))
                ok.append(100 * both >= 75 * (len(left) + len(right) - both))
            yield pa.record_batch({"u": batch.column("row"), "v": batch.column("with")}).filter(pa.array(ok, pa.bool_()))

    mine = pairs.join(sets.withColumnRenamed("elements", "mine"), "row")
    theirs = sets.join(pairs.select(F.col("with").alias("row")).distinct(), "row", "left_semi").select(F.col("row").alias("with"), F.col("elements").alias("theirs"))
    links = scratch.save(mine.join(theirs, "with").select("row", "with", "mine", "theirs").mapInArrow(check, "u long, v long"), "links")
    scratch.discard(sets)
    return links


def _labels(chunks: ch.Chunks, at_id: int, sets: DataFrame, members: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    def ids(chunk: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        yield pa.record_batch({"row": pa.array(ch.row_of(chunk, table.num_rows)), "doc_id": table.column(at_id).cast(pa.int64()).combine_chunks()})

    keys = ch.each_chunk(chunks.df.select("chunk", "payload"), ids, "row long, doc_id long")
    keys = keys.join(sets.select("row", "n"), "row").join(members, "row", "left")
    keys = keys.join(links.withColumnRenamed("node", "class"), "class", "left")
    keys = scratch.save(keys.select("row", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "class", "row").alias("comp")), "keys")
    lowest = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    least = keys.groupBy("comp").agg(lowest.alias("least")).select("comp", F.col("least.doc_id").alias("component_id"), F.col("least.row").alias("kept"))
    return keys.join(least, "comp").select("row", "doc_id", "n_shingles", "component_id", (F.col("row") == F.col("kept")).alias("first"))
