"""Exact top-k search by inner product with two cover trees.

Vectors are dealt to cells around pivots; a cell is cut into blocks of bounded
size, and each block becomes a cover tree: nodes with a centre, a covering
radius and the largest inner product their members may have. Queries are
dealt and indexed the same way. A pair of nodes can be left out when its bound

    <q, d> + rq |d| + rd |q| + rq rd

is below the worst k-th score of the queries in the node. Spark does the top
level of that traversal: query blocks first meet one block of their own cell,
which gives them a k-th score, and then only blocks whose bound reaches it.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from threadline.plans.scratch import Scratch

BLOCK = 16_384  # vectors in a block, about
CELLS = 256
SAMPLE = 4096  # vectors from which pivots are taken; they decide speed only
LEAF = 128
FANOUT = 16
_NONE = -(2**62)
_BLOCKS = "dim int, cell int, piece int, center array<double>, radius double, payload binary"


@dataclass
class Tree:
    """Members in tree order; node i holds members lo[i]:hi[i]; children of i are child[i]:child[i] + kids[i]."""

    ids: np.ndarray
    vectors: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    child: np.ndarray
    kids: np.ndarray

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.__dict__)
        return out.getvalue()

    @staticmethod
    def load(payload: bytes) -> Tree:
        with np.load(io.BytesIO(payload)) as data:
            return Tree(**{k: data[k] for k in data.files})


def build(ids: np.ndarray, vectors: np.ndarray) -> Tree:
    """Cover tree of whole-number vectors: children are a net of half the radius, the centre among them.

    Where a net would have more than ``FANOUT`` centres, the rest joins the
    nearest; radii are measured, so bounds hold in any case.
    """
    points = vectors.astype(np.float64)
    order = np.arange(len(ids))
    nodes: list[list[float]] = []
    centers: list[np.ndarray] = []

    def add(lo: int, hi: int, center: np.ndarray) -> int:
        # A little room for rounding in distances and bounds.
        far = np.sqrt(((points[order[lo:hi]] - center) ** 2).sum(axis=1).max()) if hi > lo else 0.0
        nodes.append([far * (1 + 1e-9), lo, hi, 0, 0])
        centers.append(center)
        return len(nodes) - 1

    add(0, len(ids), points[0] if len(ids) else np.zeros(vectors.shape[1]))
    todo = [0] if len(ids) else []
    while todo:
        i = todo.pop()
        radius, lo, hi = nodes[i][0], int(nodes[i][1]), int(nodes[i][2])
        if hi - lo <= LEAF or radius == 0:
            continue
        members = order[lo:hi]
        net = [centers[i]]
        near = ((points[members] - net[0]) ** 2).sum(axis=1)
        owner = np.zeros(len(members), dtype=np.int64)
        while len(net) < FANOUT:
            far = int(near.argmax())
            if near[far] <= (radius / 2) ** 2:
                break
            net.append(points[members[far]])
            apart = ((points[members] - net[-1]) ** 2).sum(axis=1)
            owner[apart < near] = len(net) - 1
            near = np.minimum(near, apart)
        by = np.argsort(owner, kind="stable")
        order[lo:hi] = members[by]
        bounds = lo + np.searchsorted(owner[by], np.arange(len(net) + 1))
        made = [add(int(a), int(b), c) for a, b, c in zip(bounds, bounds[1:], net) if b > a]
        nodes[i][3], nodes[i][4] = made[0], len(made)
        todo += made
    table = np.array(nodes)
    return Tree(ids[order], vectors[order], np.array(centers), table[:, 0], *(table[:, j].astype(np.int64) for j in range(1, 5)))


def bound(qc: np.ndarray, qr: np.ndarray, dc: np.ndarray, dr: np.ndarray) -> np.ndarray:
    """No inner product of members is larger."""
    q, d = np.sqrt((qc**2).sum(axis=-1)), np.sqrt((dc**2).sum(axis=-1))
    top = (qc * dc).sum(axis=-1) + qr * d + dr * q + qr * dr
    return top + np.abs(top) * 1e-9 + (q + qr) * (d + dr) * 1e-9


@dataclass
class Best:
    """The k best of each query of a tree so far: scores, ties to smaller ids."""

    scores: np.ndarray
    ids: np.ndarray

    @staticmethod
    def start(n: int, k: int) -> Best:
        return Best(np.full((n, k), _NONE), np.full((n, k), np.iinfo(np.int64).max))

    def add(self, lo: int, hi: int, scores: np.ndarray, ids: np.ndarray) -> None:
        k = self.scores.shape[1]
        rows = np.flatnonzero((scores >= self.scores[lo:hi, -1:]).any(axis=1))
        if not len(rows):
            return
        all_scores = np.concatenate([self.scores[lo + rows], scores[rows]], axis=1)
        all_ids = np.concatenate([self.ids[lo + rows], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1)
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
        self.scores[lo + rows] = np.take_along_axis(all_scores, order, axis=1)
        self.ids[lo + rows] = np.take_along_axis(all_ids, order, axis=1)


def search(queries: Tree, data: Tree, best: Best) -> None:
    """Dual-tree search of one pair of blocks, best bound first. A query's own id is no candidate."""
    if not len(queries.ids) or not len(data.ids):
        return
    small = float(np.abs(queries.vectors).max()) * float(np.abs(data.vectors).max()) * queries.vectors.shape[1] < 2.0**52
    kind = np.float64 if small else np.int64
    q, d = queries.vectors.astype(kind), data.vectors.astype(kind)
    root = float(bound(queries.center[0], queries.radius[0], data.center[0], data.radius[0]))
    heap = [(-root, 0, 0)]
    while heap:
        top, i, j = heapq.heappop(heap)
        lo, hi = queries.lo[i], queries.hi[i]
        if -top < best.scores[lo:hi, -1].min():
            continue
        if queries.kids[i] and (not data.kids[j] or queries.radius[i] > data.radius[j]):
            a = np.arange(queries.child[i], queries.child[i] + queries.kids[i])
            b = np.full(len(a), j)
        elif data.kids[j]:
            b = np.arange(data.child[j], data.child[j] + data.kids[j])
            a = np.full(len(b), i)
        else:
            u, v = data.lo[j], data.hi[j]
            scores = (q[lo:hi] @ d[u:v].T).astype(np.int64)
            scores[queries.ids[lo:hi, None] == data.ids[None, u:v]] = _NONE
            best.add(lo, hi, scores, data.ids[u:v])
            continue
        for t, x, y in zip(bound(queries.center[a], queries.radius[a], data.center[b], data.radius[b]), a, b):
            heapq.heappush(heap, (-float(t), int(x), int(y)))


def _whole(vector: str, factor: float) -> F.Column:
    return F.transform(F.col(f"`{vector}`"), lambda x: F.floor(F.lit(factor) * x.cast("double")).cast("long"))


def _sound(vector: str) -> F.Column:
    bad = F.exists(F.col(f"`{vector}`"), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(f"`{vector}`").isNotNull() & (F.size(F.col(f"`{vector}`")) > 0) & ~bad


def top_k(df: DataFrame, k: int, is_query: F.Column, vec_id: str = "vec_id", vector: str = "embedding", factor: float = 64.0) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of all other rows for each query row.

    Components count as floor(factor * x). Ties go to the smaller vec_id.
    Vectors that are null, empty, or hold null or non-finite components take no
    part, nor do rows without an id; vectors of different length do not meet.
    Rows that repeat an id are candidates each, and queries once for each id
    and vector.
    """
    scratch = Scratch(df.sparkSession, "topk")
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), is_query.alias("asked"), F.when(_sound(vector), _whole(vector, factor)).alias("v"))
    rows = scratch.save(rows.where("id is not null and v is not null").withColumn("dim", F.size("v")), "vectors")
    size = rows.count()
    pivots = _pivots(rows, max(1, min(CELLS, -(-size * 2 // BLOCK))))
    rows = scratch.save(_cells(rows, pivots), "cells")
    data = _blocks(scratch, rows, BLOCK, "data")
    asked = _blocks(scratch, rows.where("asked").dropDuplicates(["id", "v"]), BLOCK // 4, "queries")
    names = ["dim", "cell", "piece"]
    q = asked.select("dim", F.struct("cell", "piece").alias("q"), F.col("center").alias("qc"), F.col("radius").alias("qr"), F.col("payload").alias("queries"))
    d = data.select("dim", F.struct("cell", "piece").alias("d"), F.col("center").alias("dc"), F.col("radius").alias("dr"), F.col("payload").alias("data"))
    # One block of the query block's own cell gives each query a k-th score.
    home = data.where("piece = 0").select("dim", F.col("cell").alias("home"), F.struct("cell", "piece").alias("d"), F.col("payload").alias("data"))
    first = q.withColumn("home", F.col("q.cell")).join(home, ["dim", "home"]).select("dim", "q", "d", "queries", "data", F.lit(None).cast("binary").alias("floor"))
    first = scratch.save(first.mapInArrow(_search(k), _FOUND), "first")
    floors = first.where("ids is null").select("dim", "q", "floor", "lowest")
    met = first.where("ids is null").select("dim", "q", "d")
    near = q.join(floors, ["dim", "q"], "left")
    bounds = near.drop("queries").join(d.drop("data"), "dim").select("dim", "q", "d", "qc", "qr", "dc", "dr", "lowest")
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x))
    dot = F.aggregate(F.zip_with("qc", "dc", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    top = dot + F.col("qr") * norm("dc") + F.col("dr") * norm("qc") + F.col("qr") * F.col("dr")
    reach = top + (norm("qc") + F.col("qr")) * (norm("dc") + F.col("dr")) * 1e-8 >= F.coalesce("lowest", F.lit(_NONE))
    pairs = scratch.save(bounds.where(reach).select("dim", "q", "d").join(met, ["dim", "q", "d"], "left_anti"), "pairs")
    rest = pairs.join(near.select("dim", "q", "queries", "floor"), ["dim", "q"]).join(d.select("dim", "d", "data"), ["dim", "d"])
    rest = rest.select("dim", "q", "d", "queries", "data", "floor").mapInArrow(_search(k), _FOUND)
    found = first.where("ids is not null").unionByName(rest.where("ids is not null"))
    found = found.select("query_id", F.explode(F.arrays_zip("ids", "scores")).alias("x")).select("query_id", F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _pivots(rows: DataFrame, cells: int) -> dict[int, np.ndarray]:
    """Centres of cells for each vector length, spread over a bounded sample taken by a hash of the id."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("dim", "v").collect()
    out: dict[int, np.ndarray] = {}
    for dim in {r["dim"] for r in sample}:
        points = np.array([r["v"] for r in sample if r["dim"] == dim], dtype=np.float64)
        chosen, near = [points[0]], ((points - points[0]) ** 2).sum(axis=1)
        while len(chosen) < cells and near.max() > 0:
            chosen.append(points[int(near.argmax())])
            near = np.minimum(near, ((points - chosen[-1]) ** 2).sum(axis=1))
        out[dim] = np.array(chosen)
    return out


def _cells(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_pylist()
            vectors = batch.column("v").to_pylist()
            cell = [0] * len(dims)
            for dim in set(dims) & set(pivots):
                at = [i for i, x in enumerate(dims) if x == dim]
                for lo in range(0, len(at), 1024):
                    some = at[lo : lo + 1024]
                    points = np.array([vectors[i] for i in some], dtype=np.float64)
                    apart = (pivots[dim] ** 2).sum(axis=1) - 2 * points @ pivots[dim].T
                    for i, c in zip(some, apart.argmin(axis=1)):
                        cell[i] = int(c)
            yield batch.append_column("cell", pa.array(cell, pa.int32()))

    return rows.mapInArrow(run, "id long, asked boolean, v array<long>, dim int, cell int")


def _blocks(scratch: Scratch, rows: DataFrame, most: int, label: str) -> DataFrame:
    counts = rows.groupBy("dim", "cell").agg(F.ceil(F.count("*") / F.lit(most)).alias("pieces"))
    dealt = rows.join(counts, ["dim", "cell"]).withColumn("piece", F.pmod(F.xxhash64("id", "v"), F.col("pieces")).cast("int"))

    def index(group: pa.Table) -> pa.Table:
        ids = group.column("id").to_numpy()
        flat = group.column("v").combine_chunks().flatten().to_numpy()
        vectors = flat.reshape(len(ids), -1)
        if np.abs(vectors).max() < 2**31:
            vectors = vectors.astype(np.int32)
        tree = build(ids, vectors)
        cut = lambda c: group.column(c).slice(0, 1)
        return pa.table({
            "dim": cut("dim"), "cell": cut("cell"), "piece": cut("piece"), "center": pa.array([tree.center[0].tolist()]),
            "radius": pa.array([float(tree.radius[0])]), "payload": pa.array([tree.dump()], pa.binary()),
        })

    blocks = dealt.select("id", "v", "dim", "cell", "piece").groupBy("dim", "cell", "piece").applyInArrow(index, _BLOCKS)
    return scratch.save(blocks, label)


_PART = "struct<cell: int, piece: int>"
_FOUND = f"dim int, q {_PART}, d {_PART}, floor binary, lowest long, query_id long, ids array<long>, scores array<long>"


def _search(k: int):
    """Results of pairs of blocks: a row for each query with what reaches its floor, and one with the new floors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = pa.struct([("cell", pa.int32()), ("piece", pa.int32())])
        held: tuple = (None, None)
        for batch in batches:
            for row in batch.to_pylist():
                name = (row["dim"], row["d"]["cell"], row["d"]["piece"])
                if held[0] != name:
                    held = (name, Tree.load(row["data"]))
                queries = Tree.load(row["queries"])
                best = Best.start(len(queries.ids), k)
                if row["floor"] is not None:
                    # Scores below the floor cannot be among the k best; ids after all others keep ties open.
                    best.scores[:] = np.frombuffer(row["floor"], dtype=np.int64)[:, None]
                search(queries, held[1], best)
                real = (best.ids != np.iinfo(np.int64).max) & (best.scores > _NONE)
                some = np.flatnonzero(real.any(axis=1))
                ids = [best.ids[i][real[i]].tolist() for i in some]
                scores = [best.scores[i][real[i]].tolist() for i in some]
                n = len(some)
                yield pa.record_batch({
                    "dim": pa.array([row["dim"]] * (n + 1), pa.int32()), "q": pa.array([row["q"]] * (n + 1), part), "d": pa.array([row["d"]] * (n + 1), part),
                    "floor": pa.array([None] * n + [best.scores[:, -1].tobytes()], pa.binary()),
                    "lowest": pa.array([None] * n + [int(best.scores[:, -1].min())], pa.int64()),
                    "query_id": pa.array([*queries.ids[some].tolist(), None], pa.int64()),
                    "ids": pa.array([*ids, None], pa.list_(pa.int64())), "scores": pa.array([*scores, None], pa.list_(pa.int64())),
                })

    return run
