"""The chapter and corpus pipelines: every producer's issues in one table, with totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators import pairing as pr
from lectern.operators import references as rf
from lectern.sources.tables import table

from .blocks import ISSUES, document_blocks, stylistic
from .terms import FORMS
from .registry import registry

QUERIES, ORACLE, query = registry()


def review_issues(spark, blocks: DataFrame) -> DataFrame:
    """All findings over blocks: stylistic rules, discouraged forms and references, in the order of their producers."""
    style = stylistic(blocks).select("doc_id", "block_index", "kind", "severity", F.lit(0).alias("producer"))
    forms = pr.phrase_hits(blocks, spark.createDataFrame(FORMS, "phrase string, form string"), ["doc_id", "block_index"]).select("doc_id", "block_index", F.lit("stylistic_glossary_discouraged_form").alias("kind"), F.lit("warning").alias("severity"), F.lit(1).alias("producer"))
    refs = rf.extracted(blocks, ["doc_id", "block_index"]).where("needs_normalization").select("doc_id", "block_index", F.lit("scripture_reference_format").alias("kind"), F.lit("info").alias("severity"), F.lit(2).alias("producer"))
    return style.unionByName(forms).unionByName(refs)


_WORD = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
_ALL = ISSUES + ", g AS (SELECT doc_id, block_index, 'stylistic_glossary_discouraged_form' AS kind, 'warning' AS severity FROM b JOIN (VALUES " + ", ".join(f"('{a}')" for a, _ in FORMS) + rf") AS t(phrase) ON regexp_matches(text, '{_WORD[0]}' || phrase || '{_WORD[1]}')), u AS (SELECT doc_id, block_index, kind, severity FROM f UNION ALL SELECT * FROM g)"


@query(_ALL + " SELECT kind, severity, count(*) AS n, count(DISTINCT doc_id) AS docs FROM u GROUP BY kind, severity")
def pipeline_totals(spark, sf_dir):
    """The corpus roll-up of all producers."""
    u = review_issues(spark, document_blocks(spark, sf_dir))
    return u.groupBy("kind", "severity").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs"))


@query(_ALL + " SELECT d.doc_id, count(u.kind) AS issues, CASE WHEN count(u.kind) = 0 THEN 'clean' WHEN count(u.kind) FILTER (u.severity = 'warning') > 0 THEN 'editorial_queue' ELSE 'notes_only' END AS status FROM documents d LEFT JOIN u ON u.doc_id = d.doc_id GROUP BY d.doc_id")
def document_status(spark, sf_dir):
    """Each document's place in the editorial queue."""
    u = review_issues(spark, document_blocks(spark, sf_dir)).groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if(F.col("severity") == "warning").alias("w"))
    d = table(spark, sf_dir, "documents").select("doc_id").join(u, "doc_id", "left")
    return d.select("doc_id", F.coalesce("n", F.lit(0)).alias("issues"), F.when(F.col("n").isNull(), "clean").when(F.col("w") > 0, "editorial_queue").otherwise("notes_only").alias("status"))


@query(r"SELECT doc_id, len(regexp_extract_all(text, '[\x{E000}-\x{F8FF}]')) AS private_use, length(text) AS chars FROM documents WHERE regexp_matches(coalesce(text, ''), '[\x{E000}-\x{F8FF}]') OR lang = 'fr'")
def private_use_scan(spark, sf_dir):
    """Characters of a legacy font's private area, for documents that have some or are in a language with marks."""
    d = table(spark, sf_dir, "documents")
    n = tx.private_use_count(F.col("text"))
    return d.where((F.coalesce(n, F.lit(0)) > 0) | (F.col("lang") == "fr")).select("doc_id", n.cast("long").alias("private_use"), F.length("text").cast("long").alias("chars"))


@query(r"WITH m AS (SELECT conv_id, turn, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS exchange, text FROM conversations) SELECT conv_id, exchange::BIGINT AS exchange, string_agg(text, ' ' ORDER BY turn) AS section_text, count(*) AS parts FROM m WHERE exchange > 0 GROUP BY conv_id, exchange")
def section_texts(spark, sf_dir):
    """Ordered texts of each section; what stands before the first heading goes."""
    from lectern.operators.segments import split_at

    m = split_at(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", F.col("role") == "user").withColumnRenamed("chapter", "exchange")
    g = m.groupBy("conv_id", "exchange").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"), F.count("*").alias("parts"))
    return g.select("conv_id", "exchange", F.array_join(F.col("t.text"), " ").alias("section_text"), "parts")
