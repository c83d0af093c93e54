"""Sharding by vector bin packing.

What is packed are groups of equal texts, as vectors (bytes, words, rows).
Groups that hold a notable part of any total are packed one by one, and a group
with more bytes than a shard may hold is cut into pieces first. All other groups are
gathered into a fixed number of bundles by a hash of their text, so the packer
sees a number of items that depends on parameters only. Each item goes, largest
first, where the dot product with what the shards have left is highest.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from threadline.llm.mixture import word_count
from threadline.plans.scratch import Scratch

BUNDLES = 4096
_CELL_ROWS = 200_000  # rows of one shard that are numbered together, about


def pack(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item (rows of non-negative vectors).

    Components count as shares of their totals. Items come by their largest
    share, ties in the order given. Each goes to the shard whose residual
    capacity has the highest dot product with it among those that it does not
    overfill; if it overfills all, to the one with most capacity left for it.
    The first component is the law; another one of which an item alone holds more
    than an even share cannot be balanced, and does not keep the rest from a shard.
    """
    share = items / np.maximum(items.sum(axis=0), 1)
    share = share[:, (share.max(axis=0, initial=0.0) <= 1.0 / shards) | (np.arange(share.shape[1]) == 0)]
    left = np.full((shards, share.shape[1]), 1.0 / shards)
    where = np.zeros(len(items), dtype=np.int64)
    for i in np.argsort(-share.max(axis=1), kind="stable"):
        fits = (left + 1e-12 >= share[i]).all(axis=1)
        value = left @ share[i] if fits.any() else (left - share[i]).min(axis=1)
        where[i] = np.argmax(np.where(fits, value, -np.inf) if fits.any() else value)
        left[where[i]] -= share[i]
    return where


def group_key(text: str) -> Column:
    """Equal for equal texts; null counts as the empty text."""
    return F.md5(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary"))


def shard(df: DataFrame, shards: int = 16, doc_id: str = "doc_id", text: str = "text", bundles: int = BUNDLES) -> DataFrame:
    """doc_id, size, words, key of the text, crc, shard and slot of every document.

    The law that holds is ``bytes``: the shards' sums of sizes (UTF-8 bytes and
    one more for each row) are near equal; words and rows are balanced beside
    it. Equal texts share a shard unless their bytes alone are more than an even
    share. Slots number the rows of a shard from 0 without gaps. Null texts have
    size 1. Rows without an id, and equal rows, are rows like others; they are
    told apart by where they are stored, so that many of them fill no one task.
    Other columns do not take part; a text is read whole whatever its length.
    """
    scratch = Scratch(df.sparkSession, "sharding")
    value = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = scratch.save(
        df.select(
            F.col(f"`{doc_id}`").cast("long").alias("doc_id"), (F.octet_length(value) + 1).cast("long").alias("size"),
            word_count(text).alias("words"), F.crc32(value.cast("binary")).alias("crc"), group_key(text).alias("key"),
            # Rows without an id have nothing else to be spread by.
            F.when(F.col(f"`{doc_id}`").isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0)).alias("place"),
        ),
        "sizes",
    )
    total = rows.agg(F.sum("size").alias("size"), F.sum("words").alias("words"), F.count("*").alias("rows")).first()
    if not total["rows"]:
        return rows.drop("place").select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    groups = rows.groupBy("key").agg(F.sum("size").alias("size"), F.sum("words").alias("words"), F.count("*").alias("rows"))
    # Fewer than 3 * bundles groups can hold more than 1 / bundles of one of the three totals.
    large = groups.where(
        (F.col("size") * bundles > total["size"]) | (F.col("words") * bundles > max(total["words"], 1)) | (F.col("rows") * bundles > total["rows"])
    )
    part = F.col("size") / total["size"]
    pieces = F.when(part * shards > 1, F.ceil(part * shards * 16)).otherwise(1).cast("int")
    large = scratch.save(large.select("key", pieces.alias("pieces")), "large")
    bundle = F.pmod(F.xxhash64("key"), F.lit(bundles)).cast("int")
    piece = F.when(F.col("pieces") > 1, F.pmod(F.xxhash64("key", "doc_id", "place"), F.col("pieces"))).otherwise(0).cast("int")
    rows = rows.join(large, "key", "left").withColumn("bundle", F.when(F.col("pieces").isNull(), bundle).otherwise(-1)).withColumn(
        "item", F.when(F.col("pieces").isNull(), F.lit("")).otherwise(F.col("key"))
    ).withColumn("piece", F.when(F.col("pieces").isNull(), 0).otherwise(piece)).drop("pieces")
    rows = scratch.save(rows, "items")
    name = ["bundle", "item", "piece"]
    items = sorted(rows.groupBy(*name).agg(F.sum("size").alias("size"), F.sum("words").alias("words"), F.count("*").alias("rows")).collect())
    where = pack(np.array([[r["size"], r["words"], r["rows"]] for r in items], dtype=np.float64), shards)
    placed = df.sparkSession.createDataFrame(
        [(r["bundle"], r["item"], r["piece"], int(s)) for r, s in zip(items, where)], "bundle int, item string, piece int, shard int"
    )
    return _numbered(scratch, rows.join(placed, name).drop(*name), total["rows"], shards)


def _numbered(scratch: Scratch, rows: DataFrame, total: int, shards: int) -> DataFrame:
    """Slots in the order of cells (hash ranges of the id) and, within a cell, of ids and checksums."""
    cells = max(1, total // (shards * _CELL_ROWS)) * 8
    rows = scratch.save(rows.withColumn("cell", F.pmod(F.xxhash64("doc_id", "crc", "place"), F.lit(cells))), "placed")
    counts = rows.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "cell").orderBy("doc_id", "crc")
    numbered = rows.withColumn("rank", F.row_number().over(within))
    return numbered.join(starts, ["shard", "cell"]).select(
        "doc_id", "size", "words", "crc", "key", "shard", (F.col("start") + F.col("rank") - 1).alias("slot")
    )
