"""Joins whose outcome is checked: notes to paragraphs, blocks to issues, pairs that must be whole, single references, bundles by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_paragraphs(notes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, note_id, paragraph_index: the first paragraph of each note, counted over all notes. notes: keys, note_id, paragraph_index."""
    return notes.where("note_id is not null").groupBy(*keys, "note_id").agg(F.min("paragraph_index").cast("int").alias("paragraph_index"))


def with_issues(blocks: DataFrame, issues: DataFrame, keys: list[str], order: list[str], part: str | None = "word/document.xml") -> DataFrame:
    """blocks with `issues`, the array of their issues (issue_id, kind, severity) in order: empty if there are none. Issues of other parts are left out."""
    own = issues if part is None else issues.where(F.col("part") == part)
    one = F.struct(F.struct(*order).alias("_o"), "issue_id", "kind", "severity")
    own = own.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("_i"))
    pick = F.transform("_i", lambda x: F.struct(x["issue_id"].alias("issue_id"), x["kind"].alias("kind"), x["severity"].alias("severity")))
    return blocks.join(own, keys, "left").withColumn("issues", F.coalesce(pick, F.array().cast("array<struct<issue_id:string,kind:string,severity:string>>"))).drop("_i")


def checked(df: DataFrame, holds: Column, message: Column) -> DataFrame:
    """df; fails if `holds` is not true in a row that an action reads.

    The check is the condition of a filter, not a column: it stays when columns are pruned, and count() needs it as well.
    """
    return df.where(F.when(F.coalesce(holds, F.lit(False)), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def whole_pairs(left: DataFrame, right: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The pairs of the wanted keys; fails if a side lacks one."""
    l, r = left.withColumn("_l", F.lit(True)), right.withColumn("_r", F.lit(True))
    x = wanted.select(key).distinct().join(l, key, "left").join(r, key, "left")
    return checked(x, F.col("_l").isNotNull() & F.col("_r").isNotNull(), F.concat(F.lit("missing pair for section "), F.coalesce(F.col(key).cast("string"), F.lit("null")))).drop("_l", "_r")


def extra_bundles(files: DataFrame, folder: str = "folder", name: str = "name") -> DataFrame:
    """folder, key, name: of each folder and key the bundle `key.json`, else `key.issues.json`."""
    x = files.where(F.col(name).endswith(".json"))
    long_ = F.col(name).endswith(".issues.json")
    x = x.withColumns({"key": F.when(long_, F.regexp_replace(name, r"\.issues\.json$", "")).otherwise(F.regexp_replace(name, r"\.json$", "")), "_r": long_.cast("int")})
    return x.groupBy(folder, "key").agg(F.min_by(name, "_r").alias(name))


def with_one_reference(texts: DataFrame, found: Column, name: str = "reference") -> DataFrame:
    """texts with the only reference of each; fails if there is none or several. found: an array of references."""
    n = F.size(found)
    return checked(texts, n == 1, F.when(n > 1, "several references").otherwise("no reference")).withColumn(name, F.get(found, F.lit(0)))


def priority_histogram(issues: DataFrame, priority: str = "priority") -> DataFrame:
    """One row: high, medium, low; any other priority counts as low."""
    p = F.coalesce(priority, F.lit("low"))
    return issues.agg(F.count_if(p == "high").alias("high"), F.count_if(p == "medium").alias("medium"), F.count_if(~p.isin("high", "medium")).alias("low"))


def first_of_each(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both tables, of equal keys the first table's."""
    return first.unionByName(second.join(first.select(*keys).distinct(), keys, "left_anti"))


def examples(df: DataFrame, by: str, order: list[str], most: int = 12) -> DataFrame:
    """The first rows of each value of `by`."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_n") <= most).drop("_n")


def review_outcome(applied: DataFrame, comments_before: DataFrame, bundles: DataFrame, keys: list[str]) -> DataFrame:
    """keys, comments, skipped, problem: whether all comments of a file are in it, from it alone, and some bundle gave them; problem is null if so."""
    n = applied.groupBy(*keys).agg(F.count_if(F.col("status") == "applied").alias("comments"), F.count_if(F.col("status") == "skipped").alias("skipped"))
    x = bundles.select(*keys).distinct().withColumn("_b", F.lit(True)).join(n, keys, "full").join(comments_before.groupBy(*keys).agg(F.count("*").alias("_before")), keys, "left")
    problem = F.when(F.coalesce("_before", F.lit(0)) > 0, "has comments already").when(F.col("_b").isNull(), "no bundle").when(F.coalesce("skipped", F.lit(0)) > 0, "skipped comments")
    return x.select(*keys, F.coalesce("comments", F.lit(0)).alias("comments"), F.coalesce("skipped", F.lit(0)).alias("skipped"), problem.alias("problem"))


def reference_status(refs: DataFrame, files: DataFrame, keys: list[str]) -> DataFrame:
    """keys, refs, unresolved, status: error, no_references, editorial_queue (some have no page) or clean. files: keys, error."""
    n = refs.groupBy(*keys).agg(F.count("*").alias("refs"), F.count_if(~F.col("resolved")).alias("unresolved"))
    x = files.join(n, keys, "left")
    status = F.when(F.col("error").isNotNull(), "error").when(F.coalesce("refs", F.lit(0)) == 0, "no_references").when(F.col("unresolved") > 0, "editorial_queue").otherwise("clean")
    return x.select(*keys, F.coalesce("refs", F.lit(0)).alias("refs"), F.coalesce("unresolved", F.lit(0)).alias("unresolved"), status.alias("status"))
