"""Near duplicates by bottom-k sketches from one hash function.

A document is the set of its distinct word shingles; two are linked when
100 * |intersection| >= 85 * |union|.

* Each distinct set keeps the ``K`` smallest values of one hash function.
  Documents with equal sets are one class, and only its first member goes on.
* An inverted list holds the sets that retain a value. A set is linked only if
  it shares ``need`` retained values with another, so sets with fewer values
  that any other set retains are out, and the others are listed under their
  rarest such values: two sets that share enough meet in one of these lists.
* Sets that meet are compared by the union sketch, the K smallest values of both
  sketches together: the share of them that both retain estimates the Jaccard
  coefficient. What stays is checked on the whole sets.

Sets below ``K`` elements are their own sketch, and bounds for them are exact.
Above, ``need`` is the number of shared values that a pair of exactly 0.85 falls
short of with a probability below ``TAIL``, about one in 10^9 such pairs.

Lists of near copies are as long as their group, so pairs are formed in rounds:
twice each component of a list with the least altered member of its largest one, and
last, between different components, each pair once, at its first common value.
Sets in a crowded list first count the elements they share with any other of
the crowd, which bounds what any two share. The work on a group of copies is its
length, not its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from threadline.llm.arrow import pack_sorted, take, unpack_sorted
from threadline.llm.components import components
from threadline.llm.words import mix, words_of
from threadline.plans.scratch import Scratch

K = 96
LIKE = 85  # per cent
TAIL = 1e-9
ODD_BITS = 512
SMALL = 1000  # up to so many elements the bits of a set are those of all its elements, beyond those of its sketch
CROWD = 32  # from so many sets in a list on, whole sets are compared with the list's others before pairs are formed
BROADCAST_ROWS = 500_000  # a side of so many rows of a few numbers at most is broadcast; beyond, both are shuffled
_SLICE_BYTES = 1 << 20

_SET = "doc_id long, n long, a long, b long"


def least_overlap(k: int = K, like: int = LIKE, tail: float = TAIL) -> int:
    """Most m such that a pair at the threshold shares fewer than m of its k values with probability below ``tail``."""
    p, total = like / 100, 0.0
    for m in range(k + 1):
        total += comb(k, m) * p**m * (1 - p) ** (k - m)
        if total > tail:
            return m
    return k


def needed(n: Column, k: int = K) -> Column:
    """Retained values that a set of n elements shares with any set it is linked with, at least."""
    # Below, the union has fewer than k elements, so the sketches are all of it.
    return F.when(100 * n < LIKE * k, F.expr(f"({LIKE} * n + 99) div 100")).otherwise(F.lit(least_overlap(k)))


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """63-bit hashes of the distinct shingles of each text, ascending; the bounds of each text."""
    words = words_of(column, lower=True)
    room, counts = words.room(), words.counts
    hashes, texts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for w in range(1, width + 1):
        # A text of fewer words than a shingle is one shingle.
        at = np.flatnonzero(room >= width if w == width else (room == w) & (counts[words.doc] == w))
        hashes.append(words.windows(w, 1000 + 16 * w)[at] >> np.uint64(1))
        texts.append(words.doc[at])
    h, t = np.concatenate(hashes), np.concatenate(texts)
    order = np.lexsort((h, t))
    h, t = h[order], t[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return h[new], np.searchsorted(t[new], np.arange(len(counts) + 1))


def _signatures(elements: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Two sums over each set that tell sets apart, whatever their order."""
    sums = [np.append(np.uint64(0), np.cumsum(mix(elements ^ np.uint64(c)), dtype=np.uint64)) for c in (0x6A09E667F3BC, 0xBB67AE8584CA)]
    return [np.diff(s[first]).view(np.int64) for s in sums]


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text) in runs of about a megabyte of text; a longer text is handled alone."""
    for batch in batches:
        sizes = np.append(0, np.cumsum(pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(sizes, sizes[lo] + _SLICE_BYTES, side="right")) - 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))


def _odd(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Bits of each set, 64 to a number: whether an odd number of its values has the bit's number.

    Bits that differ between two sets are values that only one of them has, at least.
    """
    bits = ODD_BITS
    at = np.repeat(np.arange(len(sizes)), sizes) * bits + (values % np.uint64(bits)).astype(np.int64)
    odd = np.packbits((np.bincount(at, minlength=len(sizes) * bits) & 1).astype(np.uint8)).view("<u8")
    return _lists(odd, np.arange(len(sizes) + 1) * (bits // 64))


def _sketches(width: int, k: int):
    """doc_id, n, signatures, sketch, and bits: of the whole set if it is small, else of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _sliced(batches):
            elements, first = shingle_sets(part.column(1), width)
            n = np.diff(first)
            a, b = _signatures(elements, first)
            place = np.arange(len(elements)) - np.repeat(first[:-1], n)
            kept = place < k
            size = np.minimum(n, k)
            counted = kept | np.repeat(n <= SMALL, n)
            yield pa.record_batch({
                "doc_id": part.column(0), "n": pa.array(n.astype(np.int64)), "a": pa.array(a), "b": pa.array(b),
                "sketch": _lists(elements[kept], np.append(0, np.cumsum(size))),
                "odd": _odd(elements[counted], np.where(n <= SMALL, n, size)),
            })

    return run


def _whole_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _sliced(batches):
            elements, first = shingle_sets(part.column(1), width)
            a, b = _signatures(elements, first)
            blobs = [pack_sorted(elements[x:y]) for x, y in zip(first, first[1:])]
            yield pa.record_batch({"a": pa.array(a), "b": pa.array(b), "n": pa.array(np.diff(first).astype(np.int64)), "elements": pa.array(blobs, pa.binary())})

    return run


def union_sketch(x: np.ndarray, y: np.ndarray, k: int) -> tuple[int, int]:
    """Of the k smallest values of two ascending sketches together: how many both retain, and how many there are."""
    union = np.union1d(x, y)[:k]
    both = np.intersect1d(x, y, assume_unique=True)
    return int(np.searchsorted(both, union[-1], side="right")) if len(union) else 0, len(union)


def _estimated(k: int, least: int):
    """Pairs whose union sketch leaves a link possible."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [batch.column(c) for c in ("mine", "theirs")]
            flat = [s.flatten().to_numpy(zero_copy_only=False) for s in sides]
            bounds = [np.append(0, np.cumsum(pc.list_value_length(s).to_numpy(zero_copy_only=False))) for s in sides]
            ok = []
            for i in range(batch.num_rows):
                both, size = union_sketch(*(f[b[i] : b[i + 1]] for f, b in zip(flat, bounds)), k)
                ok.append(100 * both >= LIKE * size if size < k else both >= least)
            yield pa.record_batch({"row": batch.column("row"), "with": batch.column("with")}).filter(pa.array(ok, pa.bool_()))

    return run


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v): pairs whose whole sets are alike enough."""
    last, right = None, None
    for batch in batches:
        ok = []
        for w, a, b in zip(batch.column("with").to_pylist(), batch.column("mine"), batch.column("theirs")):
            if w != last:
                last, right = w, unpack_sorted(b.as_py())
            left = unpack_sorted(a.as_py())
            both = len(np.intersect1d(left, right, assume_unique=True))
            ok.append(100 * both >= LIKE * (len(left) + len(right) - both))
        yield pa.record_batch({"u": batch.column("row"), "v": batch.column("with")}).filter(pa.array(ok, pa.bool_()))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """The frame, broadcast if its counted rows allow it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


class _Corpus:
    """What the rounds share: the sketches and whole sets of the listed rows."""

    def __init__(self, sketches: DataFrame, elements: DataFrame, k: int, scratch: Scratch) -> None:
        self.sketches, self.elements, self.k, self.scratch = sketches, elements, k, scratch

    def _both(self, pairs: DataFrame, rows: int, frame: DataFrame, column: str) -> DataFrame:
        """(row, with, mine, theirs), rows of the same ``with`` together."""
        frame = frame.select("row", F.col(column).alias("mine"))
        mine = frame.join(_small(pairs, rows), "row")
        theirs = frame.join(_small(pairs.select(F.col("with").alias("row")).distinct(), rows), "row", "left_semi")
        return mine.join(theirs.select(F.col("row").alias("with"), F.col("mine").alias("theirs")), "with").select("row", "with", "mine", "theirs")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Links (u, v) among pairs (row, with)."""
        pairs, rows = self.scratch.save_counted(pairs, "pairs")
        likely = self._both(pairs, rows, self.sketches, "sketch").mapInArrow(_estimated(self.k, least_overlap(self.k)), "row long, with long")
        likely, rows = self.scratch.save_counted(likely, "likely")
        links = self._both(likely, rows, self.elements, "elements").mapInArrow(_verified, "u long, v long")
        return self.scratch.save(links, "links")


_ALIKE = f"100 * least(n, m) >= {LIKE} * greatest(n, m)"


def _labelled(index: DataFrame, tree: DataFrame | None) -> DataFrame:
    if tree is None:
        return index.withColumn("comp", F.col("row"))
    return index.join(tree.withColumnRenamed("node", "row"), "row", "left").withColumn("comp", F.coalesce("root", "row")).drop("root")


def _star(index: DataFrame, tree: DataFrame | None) -> DataFrame:
    """Pairs (row, with): the least altered member of each component of a list with that of its largest one, best shared.

    Least altered is the set with the fewest values of its own: of copies of a
    text with edits, the text itself, to which the others are nearest.
    """
    firsts = _labelled(index, tree).groupBy("key", "comp").agg(F.count("*").alias("c"), F.min(F.struct("own", "row", "n")).alias("p"))
    rank = F.struct("c", -F.col("p.own"), -F.col("p.row"), "comp", F.col("p.row").alias("with"), F.col("p.n").alias("m"))
    hubs = firsts.groupBy("key").agg(F.max(rank).alias("h"), F.count("*").alias("k")).where("k > 1").select("key", F.col("h.comp").alias("hub"), "h.with", "h.m")
    met = firsts.select("key", "comp", "p.row", "p.n").join(hubs, "key").where(f"comp <> hub and {_ALIKE}")
    hits = met.groupBy("row", "with").agg(F.count("*").alias("hits"))
    return hits.groupBy("row").agg(F.max(F.struct("hits", -F.col("with"))).alias("best")).select("row", (-F.col("best.col2")).alias("with"))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, element) of packed sets."""
    for batch in batches:
        for row, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            values = unpack_sorted(blob.as_py()).view(np.int64)
            yield pa.record_batch({"row": pa.array(np.full(len(values), row)), "element": pa.array(values)})


def _room(rows: DataFrame, elements: DataFrame) -> DataFrame:
    """(row, room): how many elements of its set each row shares with any other of the rows.

    Two of them cannot share more than the smaller of their rooms. Copies with
    edits of their own, none of which are near enough to each other, are told
    apart by this without looking at their pairs.
    """
    listed = elements.join(rows, "row", "left_semi").select("row", "elements").mapInArrow(_unpacked, "row long, element long")
    common = listed.groupBy("element").agg(F.count("*").alias("c")).where("c > 1").select("element")
    return listed.join(common, "element").groupBy("row").agg(F.count("*").alias("room"))


def _rest(index: DataFrame, tree: DataFrame, corpus: _Corpus) -> DataFrame:
    """Pairs of different components that share a list, each at its first common value."""
    scratch, k = corpus.scratch, corpus.k
    label = scratch.save(_labelled(index, tree), "labels")
    several = label.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("crowd")).where("low < high")
    mixed = scratch.save(label.join(several.select("key", "crowd"), "key"), "lists")
    crowded = mixed.groupBy("row").agg(F.max("crowd").alias("crowd")).where(f"crowd >= {CROWD}").select("row")
    room = scratch.save(_room(scratch.save(crowded, "crowded"), corpus.elements), "room")
    mixed = mixed.drop("crowd").join(corpus.sketches.select("row", "odd", "listed"), "row").join(room, "row", "left")
    mixed = scratch.save(mixed, "mixed")
    sizes = mixed.groupBy("key", "comp").agg(F.count("*").alias("c"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("h")).select("key", F.col("h.comp").alias("hub"))
    before = F.slice("listed", F.lit(1), F.col("place"))
    minor = mixed.join(largest, "key").where("comp <> hub").select("key", "row", "n", "comp", "hub", "odd", "room", before.alias("before"))
    other = mixed.select(
        "key", F.col("row").alias("with"), F.col("n").alias("m"), F.col("comp").alias("other"), F.col("odd").alias("odd2"),
        F.col("room").alias("room2"), before.alias("before2"),
    )
    apart = " + ".join(f"bit_count(odd[{i}] ^ odd2[{i}])" for i in range(ODD_BITS // 64))
    bound = f"least(n, {k}) + least(m, {k}) - 2 * {least_overlap(k)}"
    # Rooms count only where both rows have one: then both were looked at together.
    fit = f"(room is null or room2 is null or {100 + LIKE} * least(room, room2) >= {LIKE} * (n + m))"
    exact = f"n + m - 2 * (({LIKE} * (n + m) + {99 + LIKE}) div {100 + LIKE})"
    met = minor.join(other, "key").where(
        f"comp <> other and (other = hub or row < with) and {_ALIKE} and {fit}"
        f" and case when greatest(n, m) <= {SMALL} then {apart} <= {exact} when least(n, m) > {SMALL} then {apart} <= {bound} else true end"
        " and not arrays_overlap(before, before2)"
    )
    return met.select(F.least("row", "with").alias("with"), F.greatest("row", "with").alias("row")).select("row", "with")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, k: int = K, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Words are runs without white space (ASCII 9-13 and 32), with A-Z
    lower-cased. A text of fewer words than a shingle is one shingle; texts
    without words and null have none and are linked with nothing. component_id
    is the smallest doc_id that links reach, the row's own included (null only
    if all are null); kept says that it is the row's own. Rows with the same id
    are rows of their own. Other columns do not take part; an empty table gives
    an empty result.
    """
    scratch = scratch or Scratch(df.sparkSession, "bottomk")
    docs = take(df, doc_id=doc_id, text=text)
    sets = docs.mapInArrow(_sketches(width, k), f"{_SET}, sketch array<long>, odd array<long>").withColumn("row", F.monotonically_increasing_id())
    sets = scratch.save(sets, "sets")
    classes = sets.where("n > 0").groupBy("a", "b", "n").agg(F.min("row").alias("row"), F.min("doc_id").alias("least"), F.first("doc_id").alias("any_id"))
    classes = scratch.save(classes, "classes")
    first = sets.select("row", "n", "sketch", "odd").join(classes.select("row"), "row", "left_semi")
    first = scratch.save(first, "first")
    # Inverted lists of the values that several sets retain.
    entries = first.select("row", F.explode("sketch").alias("key"))
    counts = entries.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    shared = entries.join(counts, "key").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("c", "key"))).alias("shared"))
    shared = first.select("row", "n").join(shared, "row").withColumn("need", needed(F.col("n"), k)).where("size(shared) >= need")
    rarest = F.slice("shared", F.lit(1), (F.size("shared") - F.col("need") + 1).cast("int"))
    own = F.least(F.col("n"), F.lit(k)) - F.size("shared")
    listed, rows = scratch.save_counted(shared.select("row", "n", own.alias("own"), F.transform(rarest, lambda s: s["key"]).alias("listed")), "listed")
    index = scratch.save(listed.select("row", "n", "own", F.posexplode("listed").alias("place", "key")), "index")
    # Sketches and whole sets of the listed rows; texts are read again for the latter.
    sketches = scratch.save(first.select("row", "sketch", "odd").join(listed.select("row", "listed"), "row"), "sketches")
    wanted = scratch.save(classes.join(_small(listed.select("row"), rows), "row"), "wanted")
    ids = wanted.select(F.col("any_id").alias("wanted_id")).distinct()
    texts = docs.join(_small(ids, rows), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi")
    elements = texts.mapInArrow(_whole_sets(width), "a long, b long, n long, elements binary")
    elements = elements.join(_small(wanted.select("a", "b", "n", "row"), rows), ["a", "b", "n"]).groupBy("row").agg(F.first("elements").alias("elements"))
    corpus = _Corpus(sketches, scratch.save(elements, "elements"), k, scratch)
    tree = None
    for pairs in (_star, _star, lambda i, t: _rest(i, t, corpus)):
        links = corpus.links(pairs(index, tree))
        if tree is not None:
            links = links.unionByName(tree.select(F.col("node").alias("u"), F.col("root").alias("v")))
        tree = components(links, scratch)
    label = classes.join(tree.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    label = scratch.save(label.select("a", "b", "n", "root", "least"), "label")
    smallest = label.groupBy("root").agg(F.min("least").alias("component_id"))
    label = label.join(smallest, "root").select("a", "b", "n", "component_id")
    out = sets.select("doc_id", "n", "a", "b").join(label, ["a", "b", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
