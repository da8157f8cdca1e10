"""Alignment and updates. Documents are the old side; the new side lacks table lines and has other numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators import alignment as al
from lectern.operators import semantic as sm
from lectern.operators.folders import new_folder, stored
from lectern.sources.tables import table, text_blocks, with_features

from .blocks import BLOCKS, document_blocks
from .registry import registry

QUERIES, ORACLE, query = registry()


def _sides(spark, sf_dir):
    old = document_blocks(spark, sf_dir)
    d = table(spark, sf_dir, "documents").withColumn("text", F.regexp_replace("text", r"(?m)^[^\n]*\|[^\n]*\n?", "")).withColumn("text", F.regexp_replace("text", r"\d\d", "7"))
    new = with_features(text_blocks(d, ["doc_id"]))
    sides = [x.withColumns({"pos": F.col("block_index"), "key": tx.text_key(F.col("kind"), F.col("text"))}) for x in (old, new)]
    return sides


def _ops(spark, sf_dir, value="signature"):
    old, new = _sides(spark, sf_dir)
    return al.opcodes(old, new, "doc_id", "pos", value)


@query()
def align_opcodes(spark, sf_dir):
    return _ops(spark, sf_dir)


@query()
def structural_review(spark, sf_dir):
    return al.structural_issues(_ops(spark, sf_dir), "doc_id")


@query()
def aligned_suspicious(spark, sf_dir):
    old, new = _sides(spark, sf_dir)
    pairs = al.matched(al.opcodes(old, new, "doc_id", "pos", "signature"), "doc_id")
    x = al.suspicious(pairs, old, new, "doc_id").withColumn("review", sm.aligned_review(F.col("reasons")))
    return x.select("doc_id", "i", "j", "s_kind", "t_kind", "s_digit_signature", "t_digit_signature", "reasons", "review.kind", "review.severity")


@query()
def range_projection(spark, sf_dir):
    """Where each changed range of the old side lies on the new one."""
    ops = stored(_ops(spark, sf_dir, "key"), f"{new_folder(spark, 'ranges')}/opcodes")
    ranges = ops.where("tag <> 'equal'").select("doc_id", F.when(F.col("i2") > F.col("i1"), F.col("i1") + 1).otherwise(F.greatest(F.lit(1), "i1")).alias("lo"), F.when(F.col("i2") > F.col("i1"), F.col("i2")).otherwise(F.greatest(F.lit(1), "i1")).alias("hi")).distinct()
    totals = ops.groupBy("doc_id").agg(F.max("j2").alias("total"))
    return al.projected(ranges, al.matched(ops, "doc_id"), totals, "doc_id")


@query()
def update_candidates(spark, sf_dir):
    """Changed passages with flags and priority."""
    old, new = _sides(spark, sf_dir)
    ops = stored(al.opcodes(old, new, "doc_id", "pos", "key"), f"{new_folder(spark, 'updates')}/opcodes")
    x = al.changed_passages(ops, old, new, "doc_id")
    return x.select("doc_id", "seq", "tag", "char_ratio", "c.flags", "c.meaningful", "c.priority", "c.severity")


@query(BLOCKS + "SELECT lang, doc_id, block_index, row_number() OVER (PARTITION BY lang ORDER BY doc_id, block_index) AS n FROM b")
def reindex_blocks(spark, sf_dir):
    """Blocks numbered across the documents of a language."""
    from lectern.operators.segments import reindexed

    b = reindexed(document_blocks(spark, sf_dir), ["lang"], ["doc_id", "block_index"], "n")
    return b.select("lang", "doc_id", "block_index", F.col("n").cast("long").alias("n"))
