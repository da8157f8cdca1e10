"""Splitting and chunking ordered blocks by windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def split_at(blocks: DataFrame, keys: list[str], order: str, heading: Column, front_matter: bool = False) -> DataFrame:
    """`chapter`: how many headings there are up to a block. Blocks before the first one go, or are chapter 0."""
    out = blocks.withColumn("chapter", F.sum(heading.cast("int")).over(Window.partitionBy(*keys).orderBy(order)))
    return out if front_matter else out.where("chapter > 0")


def section_bounds(heads: DataFrame, keys: list[str], at: str, sentinel: int = 2147483647) -> DataFrame:
    """`ends`: where the next section begins; the sentinel for the last."""
    return heads.withColumn("ends", F.lead(at, 1, sentinel).over(Window.partitionBy(*keys).orderBy(at)))


def weight_chunks(blocks: DataFrame, keys: list[str], order: str, weight: str, chunks: int) -> DataFrame:
    """`chunk` from 0: blocks cut into `chunks` of about equal weight, at most one cut after a block.

    f counts the cuts that the weight so far calls for. Cuts made are the most that never run ahead of f and never
    grow by more than one a block: the least over all earlier blocks j of f(j) + (blocks since j), a running minimum.
    """
    by = Window.partitionBy(*keys).orderBy(order)
    whole = F.greatest(F.lit(1), F.sum(weight).over(Window.partitionBy(*keys)))
    nth = F.row_number().over(by)
    out = blocks.withColumn("_n", nth).withColumn("_f", F.floor(F.sum(weight).over(by) * float(chunks) / whole))
    out = out.withColumn("_cuts", F.least(F.lit(chunks - 1), F.col("_n") + F.least(F.lit(0), F.min(F.col("_f") - F.col("_n")).over(by))))
    return out.withColumn("chunk", F.coalesce(F.lag("_cuts").over(by), F.lit(0)).cast("long")).drop("_n", "_f", "_cuts")


def reindexed(blocks: DataFrame, keys: list[str], order: list[str], name: str = "index") -> DataFrame:
    """Blocks numbered anew across parts, from 1."""
    return blocks.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def pages_of(blocks: DataFrame, text: str, offset: str) -> DataFrame:
    """`page` of a character offset in form-feed separated text, from 1."""
    before = F.substring(F.col(text), F.lit(1), F.col(offset))
    return blocks.withColumn("page", F.length(before) - F.length(F.replace(before, F.lit("\f"))) + 1)
