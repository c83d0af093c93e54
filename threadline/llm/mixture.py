"""Mixing sources to target weights by subset-sum budget fitting.

Each source has a target in words. Whole passes over a source come first; for
what remains of the budget, documents are counted by exact length, each length
gives its share, and a bounded-knapsack programme over the remaining counts
fills the rest as exactly as the lengths allow. The programme sees one row per
length of a source, never documents. Which documents of a length are taken is
decided by a seeded hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from threadline.plans.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
_WINDOW = 1 << 17  # words that the programme fills at once, at most, beyond the remainder itself
_BUCKETS = 4096  # seeded hash ranges within one length of a source


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> dict[str | None, float]:
    """Target of each source.

    Sources in order of code points, null last, have the weights in turn and
    share ``share`` times all words by weight. No target is above ``most`` times
    its source; what is cut off goes to the others by weight until none is above.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    budget = min(share, most) * sum(sizes.values())
    result: dict[str | None, float] = {}
    left = list(order)
    while left:
        total = sum(weight[s] for s in left)
        above = [s for s in left if budget * weight[s] / total >= most * sizes[s]]
        if not above:
            return result | {s: budget * weight[s] / total for s in left}
        for s in above:
            result[s] = most * sizes[s]
            budget -= result[s]
            left.remove(s)
    return result


def fit_counts(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many documents of each length to take so that their lengths sum to ``budget`` or little less.

    ``counts`` holds documents by length (above 0). Each length first gives its
    share of the budget, rounded down, then one more while it fits, longest
    first. The bounded programme fills the remaining budget with remaining
    documents of all lengths. Where it cannot, a few documents of each length
    are given back and the programme has more to choose from, then twice as
    many, until the budget is met, all are given back, or the programme's window
    has ``_WINDOW`` words; what it then misses is the least of all tries.
    """
    total = sum(size * n for size, n in counts.items())
    budget = min(budget, total)
    if budget <= 0:
        return dict.fromkeys(counts, 0)
    taken = {size: n * budget // total for size, n in counts.items()}
    left = budget - sum(size * n for size, n in taken.items())
    for size in sorted(counts, reverse=True):
        if size <= left and taken[size] < counts[size]:
            taken[size] += 1
            left -= size
    best, missed = taken, left
    give = 0
    while missed:
        back, room = {}, left
        for size in sorted(counts):
            n = min(taken[size], give, max(0, _WINDOW - room) // size)
            back[size], room = n, room + size * n
        tried = _knapsack(counts, {size: n - back[size] for size, n in taken.items()}, room)
        short = budget - sum(size * n for size, n in tried.items())
        if short < missed:
            best, missed = tried, short
        if all(back[size] == taken[size] for size in counts) or give > _WINDOW:
            break
        give = max(1, 2 * give)
    return best


def _knapsack(counts: dict[int, int], taken: dict[int, int], left: int) -> dict[int, int]:
    # reach has bit v set when the items so far can sum to v. Shortest first, in
    # powers of two, and stopped as soon as the budget itself is reached.
    steps: list[tuple[int, int, int]] = []
    reach, limit = 1, (1 << (left + 1)) - 1
    for size in sorted(counts):
        if size > left or reach >> left & 1:
            break
        rest, many = min(counts[size] - taken[size], left // size), 1
        while rest > 0 and not reach >> left & 1:
            many = min(many, rest)
            wider = (reach | reach << size * many) & limit
            if wider != reach:
                steps.append((size, many, reach))
                reach = wider
            rest -= many
            many *= 2
    value = reach.bit_length() - 1
    for size, many, before in reversed(steps):
        if not before >> value & 1:
            taken[size] += many
            value -= size * many
    return taken


def mix(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 20240607,
) -> DataFrame:
    """doc_id, source, size, source_size, target and passes (0, 1, 2 …) of every document, and its text's hash.

    A document with p passes is taken p times. The size of a text is its number
    of words (null: 0); documents without words are never taken. Equal rows may
    be taken different numbers of times. Sources are one row each on the driver.
    """
    scratch = Scratch(df.sparkSession, "mixture")
    order = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("source"), F.col("key"))
    rows = df.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
        word_count(text).alias("size"), F.xxhash64(F.col(f"`{text}`").cast("string")).alias("key"),
    )
    rows = scratch.save(rows.withColumn("order", order), "sizes")
    return _allot(scratch, rows, weights, share, most)


def mix_rows(df: DataFrame, scratch: Scratch, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """All columns of the documents that the mix takes, each row as often as it is taken.

    Rows and decisions meet by id, source, text and, among equal rows, by number:
    equal rows are counted, not told apart.
    """
    mixed = mix(df, doc_id, text, source, **options)
    takes = mixed.groupBy("doc_id", "source", "key").agg(F.sum("passes").alias("takes"), F.count("*").alias("rows"))
    takes = scratch.save(takes.where("takes > 0"), "takes")
    names = [f"c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*names)
    at = {role: F.col(names[df.columns.index(c)]) for role, c in (("doc_id", doc_id), ("text", text), ("source", source))}
    on = (
        at["doc_id"].cast("long").eqNullSafe(F.col("t.doc_id")) & at["source"].cast("string").eqNullSafe(F.col("t.source"))
        & (F.xxhash64(at["text"].cast("string")) == F.col("t.key"))
    )
    joined = plain.join(takes.alias("t"), on).select(*names, "takes", "rows")
    # Rows that repeat an id, source and text share their takes; what does not divide evenly goes to one of them.
    many = Window.partitionBy(*[at[r].cast("string") for r in ("doc_id", "source")], F.xxhash64(at["text"].cast("string"))).orderBy(*names)
    single = joined.where("rows = 1").withColumn("n", F.col("takes"))
    shared = joined.where("rows > 1").withColumn("i", F.row_number().over(many))
    shared = shared.withColumn("n", F.expr("takes div rows + if(i <= takes % rows, 1, 0)")).drop("i")
    out = single.unionByName(shared).where("n > 0")
    return out.select(*names, F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).drop("col").toDF(*df.columns)


def _allot(scratch: Scratch, rows: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    spark = rows.sparkSession
    lengths = scratch.save(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    sizes = {r["source"]: int(r["words"]) for r in lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words")).collect()}
    target = targets(sizes, weights, share, most)
    plan = []
    for s, words in sizes.items():
        passes = int(target[s] // words) if words else 0
        plan.append((s, words, float(target[s]), passes, int(target[s] - passes * words)))
    schema = "source string, source_size long, target double, whole int, budget long"
    sources = spark.createDataFrame(plan, schema)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        counts = {int(size): int(n) for size, n in zip(group["size"], group["n"]) if size > 0}
        taken = fit_counts(counts, int(group["budget"].iloc[0]))
        return pd.DataFrame({"source": group["source"], "size": group["size"], "extra": [taken.get(int(s), 0) for s in group["size"]]})

    same = lambda a, b: F.col(f"a.{a}").eqNullSafe(F.col(f"b.{b}"))
    budgets = lengths.alias("a").join(sources.alias("b"), same("source", "source")).select("a.source", "a.size", "a.n", "b.budget")
    # A group has a row for each length of a source, not for each document.
    extra = scratch.save(budgets.groupBy("source").applyInPandas(fit, "source string, size long, extra long").where("extra > 0"), "extra")
    chosen = _first(scratch, rows, extra)
    out = chosen.alias("a").join(sources.alias("b"), same("source", "source"))
    return out.select(
        "a.doc_id", "a.source", "a.key", "a.size", "b.source_size", "b.target",
        F.when(F.col("a.size") > 0, F.col("b.whole") + F.col("a.extra")).otherwise(0).cast("int").alias("passes"),
    )


def _first(scratch: Scratch, rows: DataFrame, extra: DataFrame) -> DataFrame:
    """``extra`` = 1 for the first documents by seeded hash of each source and length, as many as asked for.

    The hash range of a length is cut into buckets. Whole buckets are taken or
    left by their counts; only the bucket in which the number is reached is
    ordered, so no task sorts a whole length.
    """
    spot = rows.withColumn("bucket", F.shiftright(F.col("order"), 52) + _BUCKETS // 2)
    cells = spot.groupBy("source", "size", "bucket").agg(F.count("*").alias("n"))
    wanted = cells.alias("a").join(extra.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.size") == F.col("b.size")))
    wanted = wanted.select("a.source", "a.size", "a.bucket", "a.n", "b.extra")
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("extra") - F.coalesce(F.sum("n").over(before), F.lit(0))
    wanted = wanted.withColumn("room", room).where("room > 0").select("source", "size", "bucket", F.when(F.col("room") < F.col("n"), F.col("room")).alias("part"))
    wanted = scratch.save(wanted, "buckets")
    same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.size") == F.col("b.size")) & (F.col("a.bucket") == F.col("b.bucket"))
    joined = spot.alias("a").join(wanted.alias("b"), same, "left").select("a.*", F.col("b.size").isNotNull().alias("hit"), "b.part")
    joined = scratch.save(joined, "hits")
    rank = Window.partitionBy("source", "size", "bucket").orderBy("order", "doc_id")
    edge = joined.where("part is not null").withColumn("rank", F.row_number().over(rank))
    return joined.where("part is null").withColumn("extra", F.col("hit").cast("int")).unionByName(
        edge.withColumn("extra", (F.col("rank") <= F.col("part")).cast("int")).drop("rank")
    )

