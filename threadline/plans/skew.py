"""Joins where one key may hold a large share of the rows.

Adaptive execution splits skewed partitions of a sort-merge join, but not below
one map output and not in every plan shape. Lineage graphs have known hubs (a
control table every program reads, a macro everyone calls), so keys with more
rows than a task should hold are found once, by an exact count, and their rows are
spread over salts. How many salts a key has is a small table that both sides
look up; whether a key is hot depends on its rows alone, not on the size of the
whole, and there is no bound on the salts of a key or on the number of hot keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from threadline.plans.scratch import Scratch

# Below this many rows a key fits one task.
MIN_ROWS = 200_000
# Rows of a hot key that go to one salt, about.
ROWS_PER_SALT = 100_000
# Hot keys up to so many are broadcast to the sides that look them up.
_BROADCAST_KEYS = 500_000


@dataclass(frozen=True)
class HotKeys:
    """(_key, _salts) of the hot keys, how many there are, and the salts of rows without a key."""

    table: DataFrame | None = None
    count: int = 0
    nulls: int = 1

    def __bool__(self) -> bool:
        return self.table is not None or self.nulls > 1

    def _looked_up(self, df: DataFrame, key: str) -> tuple[DataFrame, Column]:
        """The frame with the salts of each row's key; 1 for keys that are not hot."""
        if self.table is None:
            return df, F.lit(1)
        table = self.table.withColumnRenamed("_key", key)
        table = F.broadcast(table) if self.count <= _BROADCAST_KEYS else table
        return df.join(table, key, "left"), F.coalesce("_salts", F.lit(1))

    def spread(self, df: DataFrame, key: str, by: list[str], name: str) -> DataFrame:
        """The frame with a salt for each row, a hash of its other columns.

        A hash, not a random number: a recomputed task must repeat it. Rows
        without a key have no partner and are only spread.
        """
        if not self:
            return df.withColumn(name, F.lit(0))
        found, salts = self._looked_up(df, key)
        salts = F.when(F.col(key).isNull(), F.lit(self.nulls)).otherwise(salts)
        return found.select(*df.columns, F.pmod(F.xxhash64(*by), salts).cast("int").alias(name))

    def copies(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """The frame with each row once for every salt of its key, for the side that is repeated."""
        if self.table is None:
            return df.withColumn(name, F.lit(0))
        found, salts = self._looked_up(df, key)
        return found.select(*df.columns, F.explode(F.sequence(F.lit(0), (salts - 1).cast("int"))).alias(name))


NO_HOT_KEYS = HotKeys()


def find_hot_keys(
    df: DataFrame,
    key: str,
    min_rows: int | None = None,
    rows_per_salt: int | None = None,
    total: int | None = None,
) -> HotKeys:
    """Keys with at least ``min_rows`` rows; the count is pre-aggregated on the map side."""
    total = df.count() if total is None else total
    return hot_keys_of(df.groupBy(F.col(key).alias("_key")).count(), total, min_rows, rows_per_salt)


def hot_keys_of(counts: DataFrame, total: int, min_rows: int | None = None, rows_per_salt: int | None = None) -> HotKeys:
    """``find_hot_keys`` where the rows of each key are known: (_key, count), and ``total`` rows together."""
    min_rows = MIN_ROWS if min_rows is None else min_rows
    rows_per_salt = ROWS_PER_SALT if rows_per_salt is None else rows_per_salt
    if total < min_rows:
        return NO_HOT_KEYS
    salts = F.ceil(F.col("count") / rows_per_salt).cast("long").alias("_salts")
    counts = counts.filter(F.col("count") >= min_rows)
    table, n = Scratch(counts.sparkSession, "hot").save_counted(counts.select("_key", salts), "keys")
    if not n:
        return NO_HOT_KEYS
    without = table.filter(F.col("_key").isNull()).first()
    keyed = table.filter(F.col("_key").isNotNull())
    nulls = 1 if without is None else without["_salts"]
    return HotKeys(None if without is not None and n == 1 else keyed, n, nulls)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    hot_left: HotKeys = NO_HOT_KEYS,
    hot_right: HotKeys = NO_HOT_KEYS,
    by_left: list[str] | None = None,
    by_right: list[str] | None = None,
) -> DataFrame:
    """Equi-join on ``key`` where either side may hold hot keys.

    Rows of a hot key are spread over salts on their own side, by a hash of the
    ``by_`` columns, and repeated once per salt on the other side, so each pair
    of partners still meets exactly once.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    if hot_right and how != "inner":
        raise ValueError("rows on the right may be spread in inner joins only")
    if not hot_left and not hot_right:
        return left.join(right, key, how)
    left = hot_right.copies(hot_left.spread(left, key, by_left or left.columns, "_a"), key, "_b")
    right = hot_left.copies(hot_right.spread(right, key, by_right or right.columns, "_b"), key, "_a")
    return left.join(right, [key, "_a", "_b"], how).drop("_a", "_b")


@dataclass(frozen=True)
class Partitioned:
    """The unchanging side of a loop's join, held partitioned and sorted by its key."""

    df: DataFrame
    key: str
    hot: HotKeys

    def join(
        self, left: DataFrame, hot_left: HotKeys = NO_HOT_KEYS, by_left: list[str] | None = None
    ) -> DataFrame:
        """Inner join with ``left`` on the key. Only ``left`` moves, unless it has hot
        keys of its own; then this side is repeated for them and moves as well."""
        keys, right = [self.key], self.df
        if self.hot:
            left = self.hot.copies(left, self.key, "_b")
            keys.append("_b")
        if hot_left:
            left = hot_left.spread(left, self.key, by_left or left.columns, "_a")
            right = hot_left.copies(right, self.key, "_a")
            keys.append("_a")
        return left.join(right, keys).drop("_a", "_b")


@contextmanager
def partitioned(df: DataFrame, key: str, hot: HotKeys, by: list[str]) -> Iterator[Partitioned]:
    """Hold a durable table partitioned by ``key`` for the rounds of a loop.

    A lost block is rebuilt from the table. Nothing that outlives the loop may
    depend on the held frame.
    """
    keys = [key]
    if hot:
        df = hot.spread(df, key, by, "_b")
        keys.append("_b")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = df.repartition(n, *keys).sortWithinPartitions(*keys).persist(StorageLevel.MEMORY_AND_DISK)
    held.count()  # a join planned before the cache is filled does not see its partitioning
    try:
        yield Partitioned(held, key, hot)
    finally:
        held.unpersist()
