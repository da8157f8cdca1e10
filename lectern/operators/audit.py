"""Style audit over run and paragraph tables: what differs from the canonical styles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Styles that every file has.
SYSTEM = ("", "Normal", "footnote text", "footnote reference", "Default Paragraph Font")


def style_sets(paragraphs: DataFrame, canonical: Sequence[str], character: Sequence[str] = (), system: Sequence[str] = SYSTEM, style: str = "style_name") -> DataFrame:
    """style, status, n: used styles that are not canonical, and canonical ones that are not used. The lists are the house's."""
    used = paragraphs.groupBy(F.coalesce(style, F.lit("")).alias("style")).agg(F.count("*").alias("n"))
    odd = used.where(~F.col("style").isin(*canonical, *character, *system)).withColumn("status", F.lit("noncanonical_paragraph_style"))
    wanted = paragraphs.sparkSession.createDataFrame([(s,) for s in canonical], "style string")
    missing = wanted.join(used, "style", "left_anti").select("style", F.lit(0).cast("long").alias("n"), F.lit("canonical_style_unused").alias("status"))
    return odd.select("style", "status", "n").unionByName(missing.select("style", "status", "n"))


def run_issues(runs: DataFrame, font: str, character: Sequence[str] = ()) -> DataFrame:
    """Issues of runs (keys, run_font, italic, bold, char_style, overrides): at most one of a kind for each paragraph, with counts."""
    found = F.filter(
        F.array(
            F.when((F.coalesce("run_font", F.lit("")) != "") & (F.col("run_font") != font), F.lit("run_unexpected_font")),
            F.when((F.col("italic") | F.col("bold")) & (F.coalesce("char_style", F.lit("")) == ""), F.lit("manual_emphasis_without_char_style")),
            F.when(F.size("overrides") > 0, F.lit("run_override")),
            F.when(F.coalesce("char_style", F.lit("")).isin("", *character) == F.lit(False), F.lit("noncanonical_character_style")),
        ),
        lambda x: x.isNotNull(),
    )
    x = runs.withColumn("kind", F.explode(found))
    return x.groupBy("source_path", "paragraph_index", "kind").agg(F.count("*").alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("overrides")))).alias("tags"))


def expected_emphasis(fragments: DataFrame, terms: DataFrame) -> DataFrame:
    """Terms (phrase, automation) in paragraphs that are set otherwise than wanted: always italic but roman, or never but italic.

    fragments: source_path, paragraph_index, text, italics (array). Terms are found by their first word, never crossed.
    """
    from lectern.operators.pairing import phrase_hits

    hits = phrase_hits(fragments.select("source_path", "paragraph_index", "text", "italics"), terms, ["source_path", "paragraph_index", "italics"], ignore_case=True)
    italic = F.exists("italics", lambda i: F.lower(i).contains(F.lower(F.col("phrase"))))
    kind = F.when((F.col("automation") == "always") & ~italic, "glossary_expected_italic").when((F.col("automation") == "never") & italic, "glossary_expected_roman")
    return hits.withColumn("kind", kind).where("kind is not null").select("source_path", "paragraph_index", "phrase", "kind")
