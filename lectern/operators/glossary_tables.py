"""The glossary's tables with the columns that reviewers exchange: draft, conflicts, review sheet, and what a review leaves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import forms as fm
from lectern.functions import text as tx
from lectern.operators import glossary as gl

# The columns of the exchanged tables, in their order.
BASE = ("id", "lemma_ru", "lemma_en", "category", "approved_form", "declension_notes", "italic_required", "diacritics_policy", "capitalization_notes", "variants_found", "preferred_source", "source_examples", "editor_decision", "status", "notes")
CONFLICTS = ("normalized_key", "approved_form", "variant_count", "variants", "italic_required", "diacritics_policy", "sources", "examples")
REVIEW = ("id", "normalized_key", *BASE[1:], "conflict_flag", "conflict_variants", "conflict_sources", "review_priority", "suggested_action", "decision", "approved_form_override", "category_override", "italic_required_override", "diacritics_policy_override", "merge_into", "review_notes")
ALIASES = ("source_form", "target_form", "notes")
#: What a label of a primary source has in it.
PRIMARY = ("our", "bvks_ru")


def terms(candidates: DataFrame, approved: DataFrame, primary: Sequence[str] = PRIMARY) -> DataFrame:
    """A row for each key: gl.candidate_aggregate with approved_form, italic_required, diacritics_policy, sources, preferred_source, supported (by a primary source) and id.

    candidates: see gl.candidate_aggregate; approved: key, approved_form. Ids count all keys, so filtered terms leave gaps.
    """
    label = F.lower("source_label")
    once = candidates.groupBy("key", "source_label").agg(F.min("seen").alias("s"))
    own = F.lit(False)
    for p in primary:
        own = own | label.contains(p)
    support = once.groupBy("key").agg(F.max(own).alias("supported"), F.min_by("source_label", F.struct(fm.source_priority(F.col("source_label")), "s")).alias("preferred_source"))
    # Whether all, some or none of the variants have marks needs no list of them.
    marked = F.col("variant").rlike(fm.TERM_MARKS)
    marks = candidates.groupBy("key").agg(F.max(marked).alias("some"), F.max(~marked).alias("plain"))
    policy = F.when(F.col("some") & F.col("plain"), "diacritics_in_quotes_only").when(F.col("some"), "needs_review").otherwise("no_diacritics_in_prose")
    sources = gl.ranked_counts(candidates, "key", "source_label", "seen").select("key", F.col("ranked").alias("sources"))
    x = gl.candidate_aggregate(candidates).join(approved.select("key", "approved_form"), "key").join(support, "key").join(marks.select("key", policy.alias("diacritics_policy")), "key").join(sources, "key")
    return gl.numbered_terms(x.withColumn("italic_required", gl.italic_policy(F.col("italic_count"), F.col("plain_count"))))


def base_rows(terms_: DataFrame, high_signal_only: bool = False, all_sources: bool = False) -> DataFrame:
    """The draft: BASE. Terms of primary sources unless all_sources; with high_signal_only also headwords or of a known category."""
    x = terms_ if all_sources else terms_.where("supported")
    if high_signal_only:
        x = x.where("headwords > 0 or category <> 'other'")
    status = F.when((F.col("variant_count") > 1) | (F.col("italic_required") == "conditional"), "needs_review").otherwise("draft")
    given = {"lemma_ru": F.col("approved_form"), "variants_found": F.col("variants"), "source_examples": F.col("examples"), "status": status, "notes": F.lit("auto-generated draft")}
    blank = {c: F.lit("") for c in ("lemma_en", "declension_notes", "capitalization_notes", "editor_decision")}
    return x.withColumns(given | blank).select(*BASE)


def conflict_rows(terms_: DataFrame, all_sources: bool = False) -> DataFrame:
    """Terms whose variants, italics or marks disagree: CONFLICTS."""
    x = terms_ if all_sources else terms_.where("supported")
    x = x.where("variant_count > 1 or italic_required = 'conditional' or diacritics_policy = 'diacritics_in_quotes_only'")
    return x.withColumn("normalized_key", F.col("key")).select(*CONFLICTS)


def review_rows(base: DataFrame, conflicts: DataFrame) -> DataFrame:
    """The review sheet: REVIEW. Conflicts are met by their approved form; of several with one form the last by key counts."""
    form = lambda c: tx.weak_key(F.col(c))
    last = conflicts.where(F.coalesce("approved_form", F.lit("")) != "").groupBy(form("approved_form").alias("normalized_key")).agg(F.max_by(F.struct(F.col("variants").alias("v"), F.col("sources").alias("s")), "normalized_key").alias("_c"))
    x = base.withColumn("normalized_key", form("approved_form")).join(last, "normalized_key", "left")
    there = F.col("_c").isNotNull()
    said = gl.triage(F.col("approved_form"), F.col("category"), F.col("italic_required"), F.col("diacritics_policy"), F.col("status"), there)
    x = x.withColumns({"conflict_flag": F.when(there, "yes").otherwise("no"), "conflict_variants": F.coalesce("_c.v", F.lit("")), "conflict_sources": F.coalesce("_c.s", F.lit("")), "_t": said})
    blank = {c: F.lit("") for c in ("decision", "approved_form_override", "category_override", "italic_required_override", "diacritics_policy_override", "merge_into", "review_notes")}
    return x.withColumns({"review_priority": F.col("_t.priority"), "suggested_action": F.col("_t.action")} | blank).select(*REVIEW)


def safe_name(category: Column) -> Column:
    """A category as part of a file's name."""
    return F.regexp_replace(F.lower(category), "[^a-z0-9_]+", "_")


def alias_rows(reviewed: DataFrame) -> DataFrame:
    """Forms that were merged into another: ALIASES. reviewed: approved_form, decision, merge_into, review_notes."""
    into = F.trim(F.coalesce("merge_into", F.lit("")))
    merged = reviewed.where((F.lower(F.trim(F.coalesce("decision", F.lit("")))) == "merge") & (into != ""))
    return merged.select(F.col("approved_form").alias("source_form"), into.alias("target_form"), F.coalesce("review_notes", F.lit("")).alias("notes"))
