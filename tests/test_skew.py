"""Salted joins: every kind, hot keys on either side, rows without a key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from threadline.plans import skew


@pytest.fixture(scope="module")
def sides(spark):
    left = [("h", i) for i in range(40)] + [(None, i) for i in range(30)] + [(f"k{i % 7}", i) for i in range(20)] + [("only", 0)]
    right = [("h", i) for i in range(3)] + [("g", i) for i in range(25)] + [(f"k{i}", i) for i in range(5)] + [(None, 9)]
    return spark.createDataFrame(left, "key string, a int"), spark.createDataFrame(right, "key string, b int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_joins_equal_plain_ones(sides, how):
    left, right = sides
    hot = skew.find_hot_keys(left, "key", min_rows=10, rows_per_salt=4)
    assert {r["_key"]: r["_salts"] for r in hot.table.collect()} == {"h": 10} and hot.nulls == 8
    other = skew.find_hot_keys(right, "key", min_rows=10, rows_per_salt=4) if how == "inner" else skew.NO_HOT_KEYS
    found = skew.skew_join(left, right, "key", how, hot_left=hot, hot_right=other, by_left=["a"], by_right=["b"])
    want = left.join(right, "key", how)
    assert found.columns == want.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def test_rows_of_hot_and_missing_keys_are_spread(sides):
    left, _ = sides
    hot = skew.find_hot_keys(left, "key", min_rows=10, rows_per_salt=4)
    salts = hot.spread(left, "key", ["a"], "s").groupBy("key").agg(F.count_distinct("s").alias("n")).collect()
    spread = {r["key"]: r["n"] for r in salts}
    assert spread["h"] > 5 and spread[None] > 4 and spread["k0"] == 1


def test_only_missing_keys_are_hot(spark):
    df = spark.createDataFrame([(None, i) for i in range(20)] + [("a", 1)], "key string, a int")
    hot = skew.find_hot_keys(df, "key", min_rows=10, rows_per_salt=5)
    assert hot and hot.table is None and hot.nulls == 4
    assert skew.skew_join(df, df.withColumnRenamed("a", "b"), "key", "left", hot_left=hot, by_left=["a"]).count() == 21
    assert not skew.find_hot_keys(df, "key", min_rows=50)


def test_many_hot_keys(spark):
    df = spark.range(4000).select((F.col("id") % 1000).cast("string").alias("key"), F.col("id").alias("a"))
    hot = skew.find_hot_keys(df, "key", min_rows=4, rows_per_salt=1)
    assert hot.count == 1000
    assert skew.skew_join(df, df.withColumnRenamed("a", "b"), "key", hot_left=hot, hot_right=hot, by_left=["a"], by_right=["b"]).count() == 16_000
