"""Checks fail the job whatever is asked of their result: all of it, a count, or columns without the key."""

import pytest
from pyspark.sql import functions as F

from lectern.operators import lookups as lk
from lectern.operators import titles

ASKED = [lambda df: df.collect(), lambda df: df.count(), lambda df: df.select(df.columns[-1]).collect(), lambda df: df.agg(F.count(F.lit(1))).collect()]


def fails(df, message):
    for ask in ASKED:
        with pytest.raises(Exception, match=message):
            ask(df)


def test_whole_pairs(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = a.select("k", F.col("v").alias("w"))
    fails(lk.whole_pairs(a, b, spark.createDataFrame([(1,), (3,)], "k int"), "k"), "missing pair for section 3")
    fails(lk.whole_pairs(a, b, spark.createDataFrame([(None,)], "k int"), "k"), "missing pair for section null")
    fails(lk.whole_pairs(a, b.where("k = 1"), spark.createDataFrame([(1,), (2,)], "k int"), "k").select("v", "w"), "missing pair")
    assert [tuple(r) for r in lk.whole_pairs(a, b, spark.createDataFrame([(2,), (2,)], "k int"), "k").collect()] == [(2, "y", "y")]


def test_one_reference(spark):
    df = spark.createDataFrame([(1, ["r"])], "k int, found array<string>")
    assert tuple(lk.with_one_reference(df, F.col("found")).first()) == (1, ["r"], "r")
    fails(lk.with_one_reference(spark.createDataFrame([(1, ["r"]), (2, ["a", "b"])], df.schema), F.col("found")), "several references")
    fails(lk.with_one_reference(spark.createDataFrame([(1, ["r"]), (2, [])], df.schema), F.col("found")), "no reference")
    fails(lk.with_one_reference(spark.createDataFrame([(1, None)], df.schema), F.col("found")), "no reference")


def test_unique_match(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "a"), (2, 2, "a")], "d int, o int, text string")
    assert [tuple(r) for r in titles.unique_match(df.where("d = 1"), ["d"], "o", F.col("text") == "b").collect()] == [(1, 2)]
    fails(titles.unique_match(df, ["d"], "o", F.col("text") == "a"), "matches: 2")
    fails(titles.unique_match(df, ["d"], "o", F.col("text") == "b"), "matches: 0")
