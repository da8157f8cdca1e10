"""An automaton over ordered rows as an associative scan: no row's state waits for the row before.

A row is the map of the few states to states that it makes, written as one character for each state ("02010": state 0
stays, 1 becomes 2 ...). Maps are composed, and composition is associative: rows are dealt to blocks of BLOCK places,
each block is composed to one map, blocks of blocks in turn, and the states at which blocks are entered are handed down
again. So a document of any length is worked on in parallel, and a group never has more than BLOCK rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block, and blocks of a block of the next level.
BLOCK = 256
STATES = "0123456789"


def composed(steps: Column, n: int) -> Column:
    """The map of all steps, an array of maps in order, one after the other."""
    return F.aggregate(steps, F.lit(STATES[:n]), lambda before, step: F.call_function("translate", before, F.lit(STATES[:n]), step))


def after(state: Column, step: Column) -> Column:
    """The state that a step makes of one."""
    return F.substring(step, state.cast("int") + 1, F.lit(1))


def before_each(steps: Column, entry: Column) -> Column:
    """A character for each step of an array: the state before it, entered at `entry`."""
    start = F.struct(entry.alias("now"), F.lit("").alias("seen"))
    return F.aggregate(steps, start, lambda a, step: F.struct(after(a["now"], step).alias("now"), F.concat(a["seen"], a["now"]).alias("seen")))["seen"]


def _handed_down(blocks: DataFrame, keys: list[str], n: int, first: str) -> DataFrame:
    """keys, block, entry of each (keys, block, step) of blocks of one level."""
    up = F.floor(F.col("block") / BLOCK)
    groups = blocks.groupBy(*keys, up.alias("up")).agg(F.array_sort(F.collect_list(F.struct("block", "step"))).alias("own"))
    steps = F.transform("own", lambda x: x["step"])
    tops = groups.select(*keys, F.col("up").alias("block"), composed(steps, n).alias("step"))
    # Few are left: the third level has a row for each 16 million rows of a document.
    w = tops.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("block", "step"))).alias("own"))
    w = w.withColumn("seen", before_each(steps, F.lit(first)))
    entered = w.select(*keys, F.posexplode_outer("own").alias("at", "x"), "seen").select(*keys, F.col("x.block").alias("up"), F.substring("seen", F.col("at") + 1, F.lit(1)).alias("entry"))
    return _spread(_joined(groups, entered, keys, "up"), keys, steps)


def _spread(groups: DataFrame, keys: list[str], steps: Column) -> DataFrame:
    seen = groups.withColumn("seen", before_each(steps, F.col("entry")))
    return seen.select(*keys, F.posexplode_outer("own").alias("at", "x"), "seen").select(*keys, F.col("x.block").alias("block"), F.substring("seen", F.col("at") + 1, F.lit(1)).alias("entry"))


def _joined(a: DataFrame, b: DataFrame, keys: list[str], more: str) -> DataFrame:
    """a with b's columns; null keys are equal."""
    b = b.select(*[F.col(k).alias(f"_b_{k}") for k in [*keys, more]], "entry")
    on = [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in [*keys, more]]
    return a.join(b, on).drop(*[f"_b_{k}" for k in [*keys, more]])


def with_entries(blocks: DataFrame, keys: list[str], steps: Column, n: int, first: str = "0") -> DataFrame:
    """blocks (keys, block, an array of rows) with `entry`, the state at which each block is entered.

    steps: from a block's columns its rows' maps, in order. Each sequence starts at state `first`.
    """
    maps = blocks.select(*keys, "block", composed(steps, n).alias("step"))
    return _joined(blocks, _handed_down(maps, keys, n, first), keys, "block")
