"""Writers of reports, bundles and review packs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators import glossary_tables as gt

#: Issues that a Markdown report lists; the rest is counted.
LISTED = 200


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite").option("header", True).option("escape", '"')
    (w.partitionBy(*by) if by else w).csv(path)


def markdown_report(issues: DataFrame, title: str, order: list[str], most: int = LISTED) -> str:
    """A report on the driver: counts by kind, the first `most` issues in order, and how many more there are. A report's limit is its feature."""
    kinds = issues.groupBy("kind").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "kind").collect()
    total = sum(k["n"] for k in kinds)
    lines = [f"# {title}", "", f"- issues: {total}", *(f"- {k['kind']}: {k['n']}" for k in kinds), ""]
    for r in issues.orderBy(*order).limit(most).collect():
        lines.append(f"- [{r['severity']}] {r['kind']}: {r['excerpt']}")
    if total > most:
        lines += ["", f"{total - most} more omitted."]
    return "\n".join(lines) + "\n"


def write_outcomes(decided: DataFrame, path: str) -> None:
    """Reviewed rows by what became of them: approved, dropped, pending; and the aliases of merged ones, with their notes."""
    write_csv(decided, f"{path}/rows", ["outcome"])
    noted = decided if "review_notes" in decided.columns else decided.withColumn("review_notes", F.lit(""))
    write_csv(gt.alias_rows(noted), f"{path}/aliases")


def write_packs(blocks: DataFrame, path: str, chunk: str = "chunk") -> None:
    """A folder of text for each chunk of blocks, in order."""
    blocks.repartition(chunk).sortWithinPartitions(chunk, "block_index").select(chunk, F.concat(F.lit("["), F.col("block_index").cast("string"), F.lit("] "), "text").alias("value")).write.mode("overwrite").partitionBy(chunk).text(path)


# ---- documents, bundles, the glossary's review pack -----------------------------------------------


def document_rows(blocks: DataFrame, key: str = "source_path", version: int = 1) -> DataFrame:
    """A row for each document, as json_blocks reads it: version, key, source_format, metadata (block_count, counts of sections and kinds), blocks in order.

    blocks: key, source_format, block_index and the block columns; those that are not there are null. A document's blocks
    make one row, as its text did.
    """
    names = ("part", "section", "text", "style_name", "kind", "word_count", "char_count", "footnote_refs", "digit_signature", "has_quote_marks", "translit_score", "verse_id", "source_locator")
    ints = {"word_count", "char_count", "footnote_refs", "translit_score"}
    col = lambda c: F.col(c) if c in blocks.columns else F.lit(None).cast("int" if c in ints else "boolean" if c == "has_quote_marks" else "string")
    x = blocks.withColumns({c: col(c) for c in (*names, "source_format")})
    x = x.withColumn("section", F.coalesce("section", F.lit("body")))
    counts = None
    for c in ("section", "kind"):
        n = x.groupBy(key, c).agg(F.count("*").alias("n")).groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce(c, F.lit("")), "n")))).alias(f"{c}_counts"))
        counts = n if counts is None else counts.join(n, key)
    whole = x.groupBy(key).agg(F.first("source_format", ignorenulls=True).alias("source_format"), F.array_sort(F.collect_list(F.struct(F.col("block_index").cast("int").alias("index"), *names))).alias("blocks"))
    meta = F.struct(F.size("blocks").alias("block_count"), "section_counts", "kind_counts").alias("metadata")
    return whole.join(counts, key).select(F.lit(version).alias("version"), key, "source_format", meta, "blocks")


def write_documents(blocks: DataFrame, path: str, key: str = "source_path") -> None:
    """A JSON line for each document."""
    write_json(document_rows(blocks, key), path)


def issue_rows(issues: DataFrame, keys: list[str], order: list[str], story: str = "main_story") -> DataFrame:
    """Issues as bundles hold them: keys, order and id, kind, severity, title, message, suggestion, anchor, context. Notes are anchored in their own part."""
    note = F.col("footnote_id").isNotNull() if "footnote_id" in issues.columns else F.lit(False)
    id_ = F.col("footnote_id").cast("int") if "footnote_id" in issues.columns else F.lit(None).cast("int")
    anchor = F.struct(F.when(note, "word/footnotes.xml").otherwise(F.coalesce("part", F.lit("word/document.xml"))).alias("part"), F.greatest(F.lit(1), "paragraph_index").cast("int").alias("paragraph_index"), F.when(~note, story).alias("story_label"), id_.alias("footnote_id"))
    context = F.struct(*[F.when(F.coalesce(c, F.lit("")) != "", F.col(c)).alias(c) for c in ("excerpt", "source_excerpt", "target_excerpt")])
    return issues.select(*keys, *order, F.col("issue_id").alias("id"), "kind", "severity", "title", "message", "suggestion", anchor.alias("anchor"), context.alias("context"))


def write_bundles(issues: DataFrame, path: str, key: str, order: list[str], story: str = "main_story") -> None:
    """A folder of JSON lines for each key, in order. Rows are dealt by key and place, so a key with very many issues is many files, each with its own range of places."""
    x = issue_rows(issues, [key], order, story)
    x.repartitionByRange(key, *order).sortWithinPartitions(key, *order).drop(*order).write.mode("overwrite").partitionBy(key).json(path)


def write_review_pack(rows: DataFrame, path: str) -> None:
    """The review sheet (gt.REVIEW) as tables: master, priority_high, by_category; and the reports summary.md and priority_high.md as text, each written by one task, streaming."""
    master = rows.select(*gt.REVIEW)
    write_csv(master.repartitionByRange("id").sortWithinPartitions("id"), f"{path}/master")
    high = master.where("review_priority = 'high'")
    write_csv(high.repartitionByRange("id").sortWithinPartitions("id"), f"{path}/priority_high")
    write_csv(master.withColumn("name", gt.safe_name(F.col("category"))), f"{path}/by_category", ["name"])
    _text(_summary(master), f"{path}/summary.md")
    _text(_sheet(high), f"{path}/priority_high.md")


def _text(lines: DataFrame, path: str) -> None:
    """lines (o, value) as one text file in the order of o: a file that is demanded whole, sorted by one task, which spills what it can't hold."""
    lines.repartition(1).sortWithinPartitions("o").select("value").write.mode("overwrite").text(path)


def _summary(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    heads = ((1, "## Suggested actions", "suggested_action"), (2, "## Review priority", "review_priority"), (3, "## Categories", "category"))
    out = rows.agg(F.count("*").alias("n")).select(F.struct(F.lit(0).alias("a"), F.lit(0).cast("long").alias("b"), F.lit("").alias("c")).alias("o"), F.concat(F.lit("# Glossary review pack\n\n- total rows: "), F.col("n").cast("string"), F.lit("\n")).alias("value"))
    for k, head, c in heads:
        title = spark.createDataFrame([(head,)], "value string").select(F.struct(F.lit(k).alias("a"), F.lit(-(1 << 62)).cast("long").alias("b"), F.lit("").alias("c")).alias("o"), "value")
        n = rows.groupBy(c).agg(F.count("*").alias("n")).select(F.struct(F.lit(k).alias("a"), (-F.col("n")).alias("b"), F.col(c).alias("c")).alias("o"), F.concat(F.lit("- `"), F.col(c), F.lit("`: "), F.col("n").cast("string")).alias("value"))
        out = out.unionByName(title).unionByName(n)
    return out


def _sheet(rows: DataFrame) -> DataFrame:
    """The sheet of urgent terms by category, to be filled in."""
    fields = F.concat_ws(
        "\n", F.concat(F.lit("### "), "approved_form"), *[F.concat(F.lit(f"- `{c}`: `"), c, F.lit("`")) for c in ("id", "suggested_action", "review_priority", "conflict_flag")],
        F.when(F.col("conflict_variants") != "", F.concat(F.lit("- `conflict_variants`: "), "conflict_variants")), F.when(F.col("source_examples") != "", F.concat(F.lit("- `examples`: "), "source_examples")),
        F.concat(F.lit("- decision: "), F.when(F.col("suggested_action") == "review", "keep").otherwise(F.col("suggested_action"))), F.lit("- approved_form:"), F.concat(F.lit("- category: "), "category"), F.lit("- merge_into:"), F.lit("- notes:\n"),
    )
    terms_ = rows.select(F.struct("category", F.col("id").alias("id")).alias("o"), fields.alias("value"))
    heads = rows.select("category").distinct().select(F.struct("category", F.lit("").alias("id")).alias("o"), F.concat(F.lit("## "), "category", F.lit("\n")).alias("value"))
    return terms_.unionByName(heads)
