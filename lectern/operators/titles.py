"""Titles: candidates, contents regions, continuation lines, and finding titles again among blocks in order."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import forms as fm
from lectern.functions import text as tx
from lectern.operators.lookups import checked


def title_key(c: Column) -> Column:
    """Cleaned, in lower case, ё as е, without dot leaders and a page number at the end."""
    t = F.regexp_replace(F.translate(F.lower(tx.clean(c)), "ё", "е"), r"[\s.…·]*\d*$", "")
    return F.trim(t)


def is_candidate(cleaned: Column, most: int = 160) -> Column:
    n = tx.word_count(cleaned)
    return (cleaned != "") & (F.length(cleaned) <= most) & (n <= 18) & ~cleaned.rlike("[.;:,]$")


def match_text(c: Column) -> Column:
    """Text as titles and page lines are compared: compatibility forms, no punctuation but in words, title_key's case and letters.

    Python gets nulls but where there is a letter or sign that has such a form.
    """

    @F.pandas_udf("string")
    def compatible(x: pd.Series) -> pd.Series:
        return x.map(lambda s: s and unicodedata.normalize("NFKC", s))

    c = fm.page_line(F.coalesce(c, F.lit("")))
    c = F.coalesce(compatible(F.when(c.rlike(r"[^\x00-\x7FА-Яа-яЁё«»„“”–—’]"), c)), c)
    return F.translate(F.lower(tx.clean(F.regexp_replace(c, r"[^\p{L}\p{N}_\s/’'&-]+", " "))), "ё", "е")


def matches(title: Column, line: Column) -> Column:
    """Equal, or one begins with the other; both are match_texts. Nothing matches an empty one."""
    return (title != "") & (line != "") & (line.startswith(title) | title.startswith(line))


def contents_region(blocks: DataFrame, keys: list[str], order: str, start: Column, candidate: Column) -> DataFrame:
    """Blocks after the first start marker up to the first that is no candidate."""
    first = F.min(F.when(start, F.col(order))).over(Window.partitionBy(*keys))
    x = blocks.withColumn("_start", first)
    end = F.min(F.when((F.col(order) > F.col("_start")) & ~candidate, F.col(order))).over(Window.partitionBy(*keys))
    x = x.withColumn("_end", end)
    return x.where(f"{order} > _start and (_end is null or {order} < _end)").drop("_start", "_end")


def continued(lines: Column, most: int = 180) -> Column:
    """An array of lines in which one that begins in lower case joins the line before, up to `most` characters together."""

    def step(acc: Column, line: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joins = (F.size(acc) > 0) & line.rlike(r"^\p{Ll}") & (F.length(last) + F.length(line) < most)
        return F.when(joins, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.concat_ws(" ", last, line)))).otherwise(F.array_append(acc, line))

    return F.aggregate(lines, F.array().cast("array<string>"), step)


def placed(titles: DataFrame, blocks: DataFrame, keys: list[str], begin: int = 0) -> DataFrame:
    """keys, no, title, at: for each title in order the first block behind the last one found, at null if there is none.

    titles: keys, no, title (a key); blocks: keys, at, key. A title that is not found leaves the cursor where it is. An
    equi-join makes a table of each title's places; a document's row holds its titles and these places, never its blocks,
    and each place is looked at once, by its own title.
    """
    spots = titles.select(*keys, "no", "title").join(blocks.select(*keys, F.col("key").alias("title"), "at"), [*keys, "title"])
    spots = spots.where(F.col("at") >= begin).groupBy(*keys, "no").agg(F.array_sort(F.collect_list(F.col("at").cast("long"))).alias("spots"))
    x = titles.select(*keys, "no", "title").join(spots, [*keys, "no"], "left")
    start = F.struct(F.lit(begin - 1).cast("long").alias("cursor"), F.array().cast("array<bigint>").alias("out"))

    def step(acc: Column, t: Column) -> Column:
        hit = F.get(F.filter(F.coalesce(t["spots"], F.array().cast("array<bigint>")), lambda a: a > acc["cursor"]), F.lit(0))
        bound = F.get(F.transform(F.array(hit), lambda h: F.struct(F.coalesce(h, acc["cursor"]).alias("cursor"), F.array_append(acc["out"], h).alias("out"))), F.lit(0))
        return bound

    docs = x.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("no", "title", "spots"))).alias("t")).withColumn("found", F.aggregate("t", start, step)["out"])
    return docs.select(*keys, F.posexplode_outer("t").alias("_k", "x"), "found").select(*keys, F.col("x.no").alias("no"), F.col("x.title").alias("title"), F.get("found", "_k").alias("at"))


def unique_match(blocks: DataFrame, keys: list[str], order: str, test: Column) -> DataFrame:
    """keys and the one block that matches; a key with none or several fails the job."""
    x = blocks.groupBy(*keys).agg(F.count_if(test).alias("n"), F.min(F.when(test, F.col(order))).alias(order))
    return checked(x, F.col("n") == 1, F.concat(F.lit("matches: "), F.col("n").cast("string"))).select(*keys, order)
