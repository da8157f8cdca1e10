"""The queries of this subpackage: each gets its rows through its operator and derives the columns that are asked for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention_lm, chat, decontaminate, fingerprint, language, line_runs, ngram_join, packing, passages, token_store, upsert, url_rules, whitening
from .common import shared_dir, table


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"), 85, 4)


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


URL_RULES = [url_rules.host_rule("block", "net/"), url_rules.host_rule("allow", "example.net/en/"), url_rules.host_rule("block", "example.com/de/"), url_rules.host_rule("allow", "org/fr/")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judged(table(spark, sf_dir, "pages"), URL_RULES)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (page_id null) and pages (doc_id null), by a text model of the labelled documents."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs)
    columns = ["declared", "text_lang", "lang", "confidence", "keep"]
    none = F.lit(None).cast("long")
    own = language.documents_identified(docs, model).select("doc_id", none.alias("page_id"), *columns)
    return own.unionByName(language.pages_identified(table(spark, sf_dir, "pages"), model).select(none.alias("doc_id"), "page_id", *columns))


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.merged_spans(passages.repeated_passages(table(spark, sf_dir, "documents")))


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    store = token_store.write_store(docs, TOKENIZER)
    return store.read(docs.select("doc_id").distinct()).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.scores(table(spark, sf_dir, "documents"), TOKENIZER)


def op4_chat_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(table(spark, sf_dir, "conversations"))


def _crc(c: Column) -> Column:
    return F.crc32(c.cast("string").cast("binary"))


def op11_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients = table(spark, sf_dir, "clients")
    files = upsert.write_files(clients.where(_crc(F.col("client_id")) % 7 > 3), "client_id", 1 + clients.count() // 700, shared_dir(spark))

    def action(change: Column, first: Column) -> Column:
        h = _crc(first) % 12
        return F.when(h > 7, upsert.IGNORE).when((change["op"] == "D") | (_crc(change["change_id"]) % 8 < h), upsert.DELETE)

    sets = ["source", "segment", "city", "balance"]
    changes = table(spark, sf_dir, "client_changes").select("client_id", "seq", "change_id", "op", *sets)
    upsert.upsert(spark, files, changes, ["seq", "change_id"], sets, action)
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    sums = {"cents": F.floor(F.lit(100) * F.col("balance") + 0.5), "rows_crc": F.crc32(F.concat_ws("|", text("source"), text("segment"), text("city")).cast("binary"))}
    return upsert.described(spark, files, sums)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).drop("embedding")


def op12_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = line_runs.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"), 10, 1)
    return x.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: DuckDB's own reading of op12: lines at line feeds, keys stripped and lowered, counted over documents.
OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce("text", ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d),
k AS (SELECT r, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS "key" FROM l),
c AS (SELECT "key" FROM k WHERE "key" <> '' GROUP BY "key" HAVING count(DISTINCT r) >= 10),
m AS (SELECT r, pos, line, "key" IN (SELECT "key" FROM c) AS gone FROM k),
g AS (SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept FROM m GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM g JOIN d USING (r)"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_decontamination, op2_best_fit_packing, op3_token_store, op4_chat_quotations, op5_url_filter, op6_ngram_jaccard, op7_language_id, op8_substring_dedup, op9_fingerprint, op10_attention_lm, op11_upsert, op12_line_runs, op13_whitening)}
ORACLE: dict[str, str] = {"op12_line_runs": OP12_SQL}
