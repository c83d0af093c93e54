"""PageRank and betweenness as DataFrame loops."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from threadline.plans.scratch import Scratch
from threadline.plans.skew import Partitioned, find_hot_keys, hot_keys_of, partitioned, skew_join


def simple_graph(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Distinct (src, dst) pairs."""
    return edges.select(F.col(source).alias("src"), F.col(target).alias("dst")).distinct()


def _number(name: Column) -> Column:
    return F.when(name.isNotNull(), F.xxhash64(name))


def _numbered(both: DataFrame, scratch: Scratch) -> tuple[DataFrame, int, Callable[[Column], Column]]:
    """(node_id, id) of all names in pairs ``ends``, how many there are, and what makes an id of a name: its hash, or itself if two names share a hash."""
    names = both.select(F.explode("ends").alias("node_id")).distinct()
    names, n = scratch.save_counted(names.select("node_id", _number(F.col("node_id")).alias("id")), "names")
    if names.groupBy("id").count().filter("count > 1").limit(1).count():
        return names.select("node_id", F.col("node_id").alias("id")), n, lambda name: name
    return names, n, _number


_MERGE = 16  # pushed residuals are summed into one table after so many rounds


def pagerank(
    edges: DataFrame,
    source: str = "source_node",
    target: str = "target_node",
    tolerance: float = 1e-4,
    damping: float = 0.85,
) -> DataFrame:
    """PageRank until what is still to come adds up to ``tolerance``; mass of dead ends is spread evenly.

    Ranks are pushed: each node starts with the even share as residual, a node
    that sends adds its residual to its rank and passes it on, damped. Only
    nodes whose residual is above a share of the tolerance send in a round, the
    others wait for more, so a round costs the edges of the nodes that still
    change. Even shares and the mass of dead ends differ by a factor only, which
    the last division takes out; it need not be gathered in each round. The sum
    of residuals is observed while they are written, and what is left is added
    in the end. Rounds know nodes by a number, the hash of their name, unless two
    names share one.
    """
    scratch = Scratch(edges.sparkSession, "pagerank")
    both = edges.select(F.array(source, target).alias("ends"))
    names, n, key = _numbered(both, scratch)
    if n == 0:
        return names.select("node_id", F.lit(0.0).alias("pagerank"))
    plain = both.select(key(F.col("ends")[0]).alias("src"), key(F.col("ends")[1]).alias("dst")).distinct()
    plain, n_edges = scratch.save_counted(plain, "plain")
    ends = plain.select(
        F.inline(
            F.array(
                F.struct(F.col("src").alias("id"), F.lit(1).alias("o")),
                F.struct(F.col("dst").alias("id"), F.lit(0).alias("o")),
            )
        )
    )
    degrees = ends.groupBy("id").agg(F.sum("o").cast("double").alias("out"), F.sum(1 - F.col("o")).alias("into"))
    degrees = scratch.save(degrees, "degrees")
    # An edge tells how many edges leave its end, so residuals need no other join.
    hot, hot_dst = [hot_keys_of(degrees.select(F.col("id").alias("_key"), F.col(c).alias("count")), n_edges) for c in ("out", "into")]
    outs = degrees.select(F.col("id").alias("dst"), "out")
    graph = scratch.save(skew_join(plain, outs, "dst", hot_left=hot_dst, by_left=["src"]), "edges")
    least = tolerance / (10.0 * n)

    def write(state: DataFrame, label: str) -> tuple[DataFrame, float]:
        seen = Observation()
        saved = scratch.save(state.observe(seen, F.sum("residual").alias("left")), label)
        return saved, seen.get.get("left") or 0.0

    state, left = write(degrees.select("id", "out", F.lit((1.0 - damping) / n).alias("residual")), "residual")
    pushed: list[DataFrame] = []
    with partitioned(graph, "src", hot, ["dst"]) as held:
        while left > tolerance:
            active = state.filter(F.col("residual") > least)
            shares = active.filter(F.col("out") > 0).select(
                F.col("id").alias("src"), (F.lit(damping) * F.col("residual") / F.col("out")).alias("residual")
            )
            sent = held.join(shares).select(F.col("dst").alias("id"), "out", "residual")
            waiting = state.filter(F.col("residual") <= least).select("id", "out", "residual")
            pushed.append(active.select("id", "residual"))
            state, left = write(
                sent.unionByName(waiting).groupBy("id").agg(F.max("out").alias("out"), F.sum("residual").alias("residual")),
                "residual",
            )
            if len(pushed) == _MERGE:
                pushed = [scratch.save(_summed(pushed), "pushed")]
    ranks = _summed([*pushed, state.select("id", "residual")]).withColumnRenamed("id", "number")
    ranks = ranks.join(names, F.col("number").eqNullSafe(F.col("id"))).select("node_id", "residual")
    ranks = scratch.save(ranks, "ranks")
    total = ranks.agg(F.sum("residual")).first()[0]
    return ranks.select("node_id", (F.col("residual") / F.lit(total)).alias("pagerank"))


def _summed(parts: list[DataFrame]) -> DataFrame:
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.groupBy("id").agg(F.sum("residual").alias("residual"))


def betweenness(
    edges: DataFrame,
    source: str = "source_node",
    target: str = "target_node",
    pivots: int | None = None,
    batch: int = 100_000,
) -> DataFrame:
    """Betweenness centrality, directed and not normalised.

    Brandes' method level by level, for ``batch`` sources at once. Forward, a
    frame of (source, node, paths) per distance and the shortest-path edges into
    it; backward, the dependencies along those edges. Work is the sum of the
    edges each source reaches. What a batch needs is deleted when its sums are
    written, so the disk holds one batch, whatever the number of sources.
    ``pivots`` asks for an estimate from that many sources (the smallest by
    hash), scaled up; the default is exact. Sources that lead on to the same
    nodes and lie on no cycle stand for each other: one is followed, and counts
    as often as there are such. Rounds know nodes by a number, as in ``pagerank``.
    """
    scratch = Scratch(edges.sparkSession, "betweenness")
    # Every node is in the result, self loops or not.
    names, _, key = _numbered(edges.select(F.array(source, target).alias("ends")), scratch)
    graph = edges.select(key(F.col(source)).alias("src"), key(F.col(target)).alias("dst")).filter(F.col("src") != F.col("dst")).distinct()
    graph, n_edges = scratch.save_counted(graph, "edges")
    sources, total = scratch.save_counted(graph.select(F.col("src").alias("s")).distinct(), "sources")
    scale = 1.0
    if pivots is not None and pivots < total:
        order = ["s"] if key is _number else [F.xxhash64("s"), "s"]
        sources = scratch.save(sources.orderBy(*order).limit(pivots), "pivots")
        scale, total = total / pivots if pivots else 1.0, pivots
    sources, total, weights = _classes(graph, sources, n_edges, scratch)
    batches = max(1, -(-total // batch))
    sums: list[DataFrame] = [names.select("id", F.lit(0.0).alias("delta"))]
    with partitioned(graph, "src", find_hot_keys(graph, "src", total=n_edges), ["dst"]) as held:
        for i in range(batches):
            mine = sources if batches == 1 else sources.filter(F.pmod(F.xxhash64("s"), F.lit(batches)) == i)
            work = Scratch(edges.sparkSession, f"betweenness-{i}")
            found = _dependencies(held, mine, work, weights)
            if found is not None:
                sums.append(scratch.save(found, f"sums{i}"))
            work.drop()
    stacked = sums[0]
    for part in sums[1:]:
        stacked = stacked.unionByName(part)
    scores = stacked.groupBy("id").agg((F.sum("delta") * F.lit(scale)).alias("betweenness_centrality")).withColumnRenamed("id", "number")
    return scores.join(names, F.col("number").eqNullSafe(F.col("id"))).select("node_id", "betweenness_centrality")


def betweenness_estimate(
    edges: DataFrame,
    pivots: int,
    source: str = "source_node",
    target: str = "target_node",
    confidence: float = 0.95,
) -> DataFrame:
    """``betweenness`` from ``pivots`` sources, with the number used and an error bound.

    A source gives a node at most n - 2; by Hoeffding's inequality the scaled sum
    is off by more than ``error_bound`` with a probability of at most
    1 - ``confidence`` for each node. With all sources the bound is 0.
    """
    plain = simple_graph(edges, source, target).filter(F.col("src") != F.col("dst"))
    total = plain.agg(F.count_distinct("src")).first()[0]
    scores = betweenness(edges, source, target, pivots)
    n = scores.count()
    used = min(pivots, total)
    spread = math.sqrt(math.log(2.0 / (1.0 - confidence)) / (2.0 * used)) if used else 0.0
    bound = 0.0 if used == total else total * max(0, n - 2) * spread
    return scores.select("node_id", "betweenness_centrality", F.lit(used).alias("pivots"), F.lit(bound).alias("error_bound"))


_TAIL = 3  # rounds in which nodes without a way on are taken off


def _classes(graph: DataFrame, sources: DataFrame, n_edges: int, scratch: Scratch) -> tuple[DataFrame, int, DataFrame]:
    """(s) of the sources to follow, their number, and (s, weight) of those that stand for several.

    Two sources with the same successors pass the same dependencies on, unless one
    reaches the other. None of them can when they lie on no cycle, which is known
    of nodes that have no way on, or only to such, a few steps long. Successors are
    compared where there are one or two; all other sources stand for themselves.
    """
    rest = graph
    hot = find_hot_keys(graph, "dst", total=n_edges)
    for _ in range(_TAIL):
        going = rest.select(F.col("src").alias("dst")).distinct()
        rest = scratch.save(skew_join(rest, going, "dst", "left_semi", hot_left=hot, by_left=["src"]).select("src", "dst"), "inner")
    few = graph.groupBy(F.col("src").alias("s")).agg(F.count(F.lit(1)).alias("n"), F.min("dst").alias("first"), F.max("dst").alias("second"))
    few = few.filter(F.col("n") <= 2).join(sources, "s", "left_semi").join(rest.select(F.col("src").alias("s")), "s", "left_anti")
    few = scratch.save(few.select("s", "first", "second"), "few")
    kinds = scratch.save(few.groupBy("first", "second").agg(F.min("s").alias("s"), F.count(F.lit(1)).alias("weight")), "kinds")
    kept = sources.join(few, "s", "left_anti").select("s").unionByName(kinds.select("s"))
    kept, total = scratch.save_counted(kept, "followed")
    return kept, total, kinds.filter(F.col("weight") > 1).select("s", "weight")


def _dependencies(held: Partitioned, sources: DataFrame, scratch: Scratch, weights: DataFrame) -> DataFrame | None:
    """(id, delta): dependencies of the sources, by their weights, on each node; None if they reach nothing beyond a step."""
    level, rows = scratch.save_counted(
        sources.select("s", F.col("s").alias("v"), F.lit(1.0).alias("paths")), "level0"
    )
    levels, trees, seen = [level], [], level.select("s", "v")
    while rows:
        hot_level = find_hot_keys(level, "v", total=rows)
        steps = held.join(level.withColumnRenamed("v", "src"), hot_level, ["s"]).select(
            "s", F.col("src").alias("u"), F.col("dst").alias("v"), "paths"
        )
        tree, tree_rows = scratch.save_counted(
            steps.join(seen, ["s", "v"], "left_anti"), f"tree{len(levels)}"
        )
        if tree_rows == 0:
            break
        level, rows = scratch.save_counted(
            tree.groupBy("s", "v").agg(F.sum("paths").alias("paths")), f"level{len(levels)}"
        )
        levels.append(level)
        trees.append(tree)
        seen = seen.unionByName(level.select("s", "v"))

    delta: DataFrame | None = None
    parts: list[DataFrame] = []
    for i in range(len(trees) - 1, 0, -1):  # what reaches the source itself does not count
        # Dependency passed to each predecessor, per path of the reached node.
        below = levels[i + 1]
        if delta is None:
            per_path = below.select("s", "v", (1.0 / F.col("paths")).alias("per_path"))
        else:
            per_path = below.join(delta, ["s", "v"], "left").select(
                "s", "v", ((1.0 + F.coalesce("delta", F.lit(0.0))) / F.col("paths")).alias("per_path")
            )
        passed = (
            trees[i]
            .join(per_path, ["s", "v"])
            .groupBy("s", F.col("u").alias("v"))
            .agg(F.sum(F.col("paths") * F.col("per_path")).alias("delta"))
        )
        delta = scratch.save(passed, f"delta{i}")
        counted = delta.join(weights, "s", "left").select("v", (F.col("delta") * F.coalesce("weight", F.lit(1))).alias("delta"))
        parts.append(counted.groupBy(F.col("v").alias("id")).agg(F.sum("delta").alias("delta")))
    if not parts:
        return None
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.groupBy("id").agg(F.sum("delta").alias("delta"))
