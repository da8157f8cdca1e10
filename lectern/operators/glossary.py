"""Term candidates, conflicts, review triage and decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import text as tx

#: Categories that reviewers always look at.
HIGH_CATEGORIES = ("personal_name", "place_name", "scripture_title", "philosophical_term", "honorific")


def ranked_counts(pairs: DataFrame, key: str, value: str, seen: str) -> DataFrame:
    """key and `ranked`, `value [n]` by count, then first seen. Counts are aggregated before anything is collected."""
    n = pairs.groupBy(key, value).agg(F.count("*").alias("n"), F.min(seen).alias("first"))
    entry = F.struct((-F.col("n")).alias("neg"), "first", F.col(value).alias("v"), "n")
    return n.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("e"), F.count("*").alias("variant_count")).select(key, "variant_count", F.array_join(F.transform("e", lambda x: F.concat(x["v"], F.lit(" ["), x["n"].cast("string"), F.lit("]"))), " | ").alias("ranked"))


def candidate_aggregate(candidates: DataFrame) -> DataFrame:
    """One row for each key of (key, variant, source_label, category, kind, italic, file, example, seen): counts, modes and examples.

    Two levels: counts by key and value, then by key. The mode's ties go to what was seen first; examples are the
    first five different ones; `seen` is the explicit order of arrival.
    """
    base = candidates.groupBy("key").agg(F.count("*").alias("n"), F.count_if("italic").alias("italic_count"), F.count_if(~F.col("italic")).alias("plain_count"), F.count_distinct("file").alias("files"), F.count_if(F.col("kind") == "glossary_headword").alias("headwords"))
    category = candidates.groupBy("key", "category").agg(F.count("*").alias("c"), F.min("seen").alias("s")).groupBy("key").agg(F.max_by("category", F.struct("c", -F.col("s"))).alias("category"))
    example = candidates.groupBy("key", "example").agg(F.min("seen").alias("s")).withColumn("k", F.row_number().over(Window.partitionBy("key").orderBy("s"))).where("k <= 5")
    example = example.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s", "example"))), lambda x: x["example"]), " | ").alias("examples"))
    variants = ranked_counts(candidates, "key", "variant", "seen").withColumnRenamed("ranked", "variants")
    return base.join(category, "key").join(example, "key").join(variants, "key")


def approved_form(candidates: DataFrame, key_of: Column, hint_of: Column | None = None) -> DataFrame:
    """The variant that stands for each key.

    Of variants whose own key (or, by hint_of, their hint's) it is: one whose own key it is, unmarked, short, in lower
    case, frequent. If there are none: one that is unmarked, frequent, short.
    """
    keyed = candidates.withColumns({"_own": key_of, "_hint": F.lit(None).cast("string") if hint_of is None else hint_of})
    n = keyed.groupBy("key", "variant").agg(F.count("*").alias("n"), F.first("_own").alias("_own"), F.first("_hint").alias("_hint"))
    own, hint_of = F.col("_own") == F.col("key"), None if hint_of is None else F.col("_hint")
    fits = own if hint_of is None else own | F.coalesce(hint_of == F.col("key"), F.lit(False))
    marks, upper = F.col("variant").rlike(f"[{tx.MARKS}{tx.LATIN_MARKED}]"), F.substring("variant", 1, 1).rlike(r"\p{Lu}")
    number = lambda c: c.cast("long")
    pick = lambda a, b, name: F.when(fits, number(a)).otherwise(number(b)).alias(name)
    rank = F.struct((~fits).alias("a"), pick(~own, marks, "b"), pick(marks, -F.col("n"), "c"), number(F.length("variant")).alias("d"), pick(upper, F.lit(0), "e"), pick(-F.col("n"), F.lit(0), "f"), F.col("variant").alias("g"))
    return n.groupBy("key").agg(F.min_by("variant", rank).alias("approved_form"))


def italic_policy(italic: Column, plain: Column) -> Column:
    return F.when((italic > 0) & (plain > 0), "conditional").when(italic > 0, "yes").otherwise("no")


def numbered_terms(df: DataFrame, key: str = "key") -> DataFrame:
    """`id` by sorted key over all rows, before any filter; ids of filtered rows leave gaps.

    Two steps, so that no task sorts the whole table: rank within the key's first character, then the counts before it.
    """
    first = F.substring(key, 1, 1)
    df = df.withColumn("_h", first)
    n = df.groupBy("_h").agg(F.count("*").alias("_n"))
    before = n.withColumn("_before", F.sum("_n").over(Window.orderBy("_h")) - F.col("_n")).drop("_n")
    place = F.row_number().over(Window.partitionBy("_h").orderBy(key)) + F.col("_before")
    return df.join(F.broadcast(before), "_h").withColumn("id", F.concat(F.lit("term-"), F.lpad(place.cast("string"), 5, "0"))).drop("_h", "_before")


def triage(form: Column, category: Column, italic: Column, diacritics: Column, status: Column, conflict: Column) -> Column:
    """(action, priority) suggested for a term, by the first rule that holds."""
    pair = lambda a, p: F.struct(F.lit(a).alias("action"), F.lit(p).alias("priority"))
    high = category.isin(*HIGH_CATEGORIES)
    open_ = status.contains("needs_review") | conflict
    return (
        F.when(F.lower(form).rlike(r"^[а-яё]\s") | form.rlike(r"^[\[(,;:.\-–—]"), pair("drop", "high"))
        .when((tx.count_char(form, " ") >= 4) & (category == "other"), pair("drop", "medium"))
        .when(open_ & high, pair("review", "high"))
        .when(open_, pair("review", "medium"))
        .when(high, pair("keep", "medium"))
        .when((italic == "conditional") | (diacritics == "needs_review"), pair("review", "medium"))
        .otherwise(pair("review", "low"))
    )


def outcome(decision: Column, merge_into: Column) -> Column:
    """What becomes of a reviewed row: approved, dropped or pending."""
    d, into = F.lower(F.trim(F.coalesce(decision, F.lit("")))), F.trim(F.coalesce(merge_into, F.lit("")))
    return F.when(d == "drop", "dropped").when(d.isin("keep", "rename", "reclassify") | ((d == "merge") & (into != "")), "approved").otherwise("pending")


def merged_groups(rows: DataFrame, target: str, order: str, lists: list[str]) -> DataFrame:
    """A row for each target form: its first row's values, and the different non-empty values of `lists` in order, joined."""
    first = [F.min_by(c, order).alias(c) for c in rows.columns if c not in (target, order, *lists)]
    # What repeats is dropped before anything is collected: values at their first place.
    joined = None
    for c in lists:
        once = rows.where(F.coalesce(c, F.lit("")) != "").groupBy(target, c).agg(F.min(order).alias("_at")).groupBy(target)
        once = once.agg(F.array_join(F.array_sort(F.collect_list(F.struct("_at", F.col(c).alias("_v"))))["_v"], " | ").alias(c))
        joined = once if joined is None else joined.join(once, target, "full_outer")
    out = rows.groupBy(target).agg(F.count("*").alias("rows"), *first)
    return out if joined is None else out.join(joined, target, "left")
