"""Block features, kinds, signatures and the stylistic review queue over `documents`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators import issues as iss
from lectern.sources.tables import first_of, table, text_blocks, with_features

from .registry import registry

QUERIES, ORACLE, query = registry()


def document_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_features(text_blocks(table(spark, sf_dir, "documents"), ["doc_id", "lang", "source"]))


SPACE = r"[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LETTERS = "[A-Za-zĀāĪīŪūṚṛṜṝḶḷṂṃṄṅÑñṆṇṬṭḌḍḤḥŚśṢṣ]"
#: The blocks of `documents` with all features, as `b`.
BLOCKS = rf"""
WITH parts AS (SELECT doc_id, lang, source, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
lines AS (SELECT doc_id, lang, source, unnest(p) AS raw_text, unnest(range(1, len(p) + 1)) AS paragraph_index FROM parts),
cleaned AS (SELECT *, trim(regexp_replace(raw_text, '{SPACE}+', ' ', 'g')) AS text FROM lines),
kept AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY paragraph_index) AS block_index,
  length(text) - length(replace(text, ' ', '')) + 1 AS word_count, length(text) AS char_count,
  array_to_string(list_slice(regexp_extract_all(text, '\d+(?:\.\d+)?(?:-\d+(?:\.\d+)?)?'), 1, 8), '|') AS digit_signature,
  regexp_matches(text, '[«»"]') AS has_quote_marks,
  len(regexp_extract_all(text, '[\x{{304}}\x{{323}}\x{{307}}\x{{303}}\x{{301}}]')) + len(regexp_extract_all(text, '{LETTERS}')) AS translit_score,
  len(regexp_extract_all(text, '(?:^|[^\p{{L}}\p{{N}}_])[A-Za-z][A-Za-z-]{{2,}}')) AS latin_words
  FROM cleaned WHERE text <> ''),
b AS (SELECT *, CASE
  WHEN word_count <= 12 AND NOT regexp_matches(text, '[.!?:;,]$') THEN 'heading_like'
  WHEN regexp_matches(text, '^\d+[.)]\s+') THEN 'list_numbered'
  WHEN regexp_matches(text, '^[\-–—*]\s+') THEN 'list_bulleted'
  WHEN regexp_matches(text, '^[«"]') AND regexp_matches(text, '[»"]$') AND word_count <= 120 THEN 'quote_like'
  WHEN regexp_matches(text, '(?i)(^|[^\p{{L}}\p{{N}}_])(sb|bg|cc|adi|madhya|antya|gaudiya)($|[^\p{{L}}\p{{N}}_])') AND regexp_matches(text, '\d') THEN 'source_like'
  WHEN word_count <= 40 AND NOT regexp_matches(text, '[.!?]') AND (regexp_matches(text, '[\x{{304}}\x{{323}}\x{{307}}\x{{303}}\x{{301}}ĀāĪīŪūṚṛṜṝḶḷṂṃṄṅÑñṆṇṬṭḌḍḤḥŚśṢṣ]') OR (latin_words >= 3 AND latin_words >= greatest(3, word_count // 2))) THEN 'shloka_like'
  ELSE 'body' END AS kind FROM kept)
"""


@query(BLOCKS + "SELECT lang, kind, count(*) AS n, sum(word_count)::BIGINT AS words FROM b GROUP BY lang, kind")
def block_kind_counts(spark, sf_dir):
    return document_blocks(spark, sf_dir).groupBy("lang", "kind").agg(F.count("*").alias("n"), F.sum("word_count").alias("words"))


@query(BLOCKS + "SELECT doc_id, block_index, paragraph_index, kind, word_count, char_count, digit_signature, has_quote_marks, translit_score FROM b")
def block_features(spark, sf_dir):
    return document_blocks(spark, sf_dir).select("doc_id", "block_index", "paragraph_index", "kind", "word_count", "char_count", "digit_signature", "has_quote_marks", "translit_score")


SIGNATURE = "kind || ':' || CASE WHEN word_count >= 80 THEN 'l' WHEN word_count >= 25 THEN 'm' ELSE 's' END || ':0:' || CASE WHEN digit_signature <> '' THEN 'd' ELSE 'n' END || ':' || CASE WHEN translit_score >= 3 THEN 't' ELSE 'p' END"


@query(BLOCKS + f"SELECT {SIGNATURE} AS signature, count(*) AS n, count(DISTINCT doc_id) AS docs FROM b GROUP BY 1")
def block_signatures(spark, sf_dir):
    return document_blocks(spark, sf_dir).groupBy("signature").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs"))


@query(BLOCKS + "SELECT doc_id, digit_signature, len(regexp_extract_all(text, '\\d+(?:\\.\\d+)?(?:-\\d+(?:\\.\\d+)?)?')) AS n_numbers FROM b WHERE digit_signature <> ''")
def digit_signatures(spark, sf_dir):
    b = document_blocks(spark, sf_dir).where("digit_signature <> ''")
    return b.select("doc_id", "digit_signature", F.size(tx.digits(F.col("text"))).alias("n_numbers"))


@query(BLOCKS + "SELECT doc_id, block_index, word_count FROM b WHERE word_count >= 8 AND regexp_matches(text, '[.!?…:]') AND NOT (len(regexp_extract_all(text, ' — ')) >= 2 AND len(regexp_extract_all(text, ';')) >= 1)")
def prose_filter(spark, sf_dir):
    return document_blocks(spark, sf_dir).where(tx.looks_prose(F.col("text"))).select("doc_id", "block_index", "word_count")


@query(BLOCKS + "SELECT doc_id, block_index, CASE WHEN char_count > 60 THEN rtrim(text[1:59]) || '…' ELSE text END AS excerpt, kind || '|' || lower(text) AS text_key FROM b")
def block_excerpts(spark, sf_dir):
    t = F.col("text")
    return document_blocks(spark, sf_dir).select("doc_id", "block_index", tx.excerpt(t, 60).alias("excerpt"), tx.text_key(F.col("kind"), t).alias("text_key"))


# ---- stylistic rules -----------------------------------------------------------------------------

#: Kind, severity and, in SQL, the test. Order matters: issues are numbered in it.
RULES = (
    ("stylistic_double_spaces", "info", r"regexp_matches(raw_text, '[ \t]{2,}')"),
    ("stylistic_space_before_punctuation", "warning", r"regexp_matches(raw_text, '[ \t\x{a0}]+[,;:.!?»)\]]')"),
    ("stylistic_missing_space_after_punctuation", "warning", "regexp_matches(raw_text, '[,;:!?][А-Яа-яЁёA-Za-z]')"),
    ("stylistic_straight_quotes", "info", "contains(raw_text, '\"')"),
    ("stylistic_unbalanced_quotes", "warning", "length(replace(raw_text, '«', '')) <> length(replace(raw_text, '»', ''))"),
    ("stylistic_latin_cyrillic_mix", "warning", "regexp_matches(raw_text, '[А-Яа-яЁё][A-Za-z][А-Яа-яЁё]|[A-Za-z][А-Яа-яЁё][A-Za-z]')"),
    ("stylistic_digit_inside_cyrillic_word", "warning", r"regexp_matches(raw_text, '[А-Яа-яЁё]\d+[А-Яа-яЁё]')"),
    ("stylistic_ascii_dash_with_spaces", "info", r"regexp_matches(raw_text, '\s-\s')"),
    ("stylistic_three_dots", "info", "contains(raw_text, '...')"),
    ("stylistic_repeated_punctuation", "warning", r"regexp_matches(raw_text, '!!|\?\?|;;|,,|::')"),
    ("stylistic_unbalanced_parentheses", "warning", "length(replace(raw_text, '(', '')) <> length(replace(raw_text, ')', ''))"),
    ("stylistic_long_sentence_review", "info", r"kind = 'body' AND len(list_filter(string_split(regexp_replace(text, '([.!?…])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: len(regexp_extract_all(s, '\S+')) >= 45)) > 0"),
    ("stylistic_diacritics_in_prose", "info", "kind = 'body' AND regexp_matches(text, '[\\x{304}\\x{323}\\x{307}\\x{303}\\x{301}ĀāĪīŪūṚṛṜṝḶḷṂṃṄṅÑñṆṇṬṭḌḍḤḥŚśṢṣ]')"),
    ("stylistic_missing_terminal_punctuation", "info", r"""kind = 'body' AND word_count >= 14 AND NOT regexp_matches(text, '[.!?…»"]\s*$')"""),
)


def _tests() -> list[Column]:
    """The tests of RULES, in order."""
    raw, t = F.col("raw_text"), F.col("text")
    body = F.col("kind") == "body"
    return [
        raw.rlike(r"[ \t]{2,}"),
        raw.rlike("[ \\t\u00a0]+[,;:.!?»)\\]]"),
        raw.rlike("[,;:!?][А-Яа-яЁёA-Za-z]"),
        raw.contains('"'),
        tx.count_char(raw, "«") != tx.count_char(raw, "»"),
        raw.rlike("[А-Яа-яЁё][A-Za-z][А-Яа-яЁё]|[A-Za-z][А-Яа-яЁё][A-Za-z]"),
        raw.rlike(r"[А-Яа-яЁё]\d+[А-Яа-яЁё]"),
        raw.rlike(r"\s-\s"),
        raw.contains("..."),
        raw.rlike(r"!!|\?\?|;;|,,|::"),
        tx.count_char(raw, "(") != tx.count_char(raw, ")"),
        body & F.exists(F.split(t, r"(?<=[.!?…])\s+"), lambda s: tx.word_count(F.trim(s)) >= 45),
        body & t.rlike(f"[{tx.MARKS}{tx.LATIN_MARKED}]"),
        body & (F.col("word_count") >= 14) & ~t.rlike(r'[.!?…»"]\s*$'),
    ]


def stylistic(blocks: DataFrame) -> DataFrame:
    """At most one issue for each block and rule, in rule order."""
    one = [F.when(test, F.struct(F.lit(k).alias("pos"), F.lit(name).alias("kind"), F.lit(severity).alias("severity"))) for k, ((name, severity, _), test) in enumerate(zip(RULES, _tests(), strict=True))]
    found = F.filter(F.array(*one), lambda x: x.isNotNull())
    return blocks.withColumn("issue", F.explode(found)).select(*[c for c in blocks.columns if c != "kind"], F.col("kind").alias("block_kind"), "issue.pos", "issue.kind", "issue.severity")


_FOUND = ", ".join(f"CASE WHEN {sql} THEN {{'pos': {k}, 'kind': '{name}', 'severity': '{severity}'}} END" for k, (name, severity, sql) in enumerate(RULES))
#: A row for each block and rule that it breaks, as `f`.
ISSUES = BLOCKS + f", found AS (SELECT doc_id, lang, block_index, paragraph_index, text, unnest(list_filter([{_FOUND}], lambda x: x IS NOT NULL)) AS i FROM b), f AS (SELECT doc_id, lang, block_index, paragraph_index, text, i.pos AS pos, i.kind AS kind, i.severity AS severity FROM found) "


@query(ISSUES + "SELECT doc_id, block_index, paragraph_index, kind, severity, 'sty-' || lpad((row_number() OVER (PARTITION BY doc_id ORDER BY block_index, pos))::VARCHAR, 4, '0') AS issue_id FROM f")
def stylistic_issues(spark, sf_dir):
    f = stylistic(document_blocks(spark, sf_dir))
    return iss.numbered(f, "sty-", ["doc_id"], ["block_index", "pos"]).select("doc_id", "block_index", "paragraph_index", "kind", "severity", "issue_id")


@query(ISSUES + "SELECT r.kind, r.severity, count(f.doc_id) AS n FROM (VALUES " + ", ".join(f"('{k}', '{s}')" for k, s, _ in RULES) + ") AS r(kind, severity) LEFT JOIN f ON f.kind = r.kind GROUP BY r.kind, r.severity")
def stylistic_rule_counts(spark, sf_dir):
    """Every rule with its count, zero where nothing breaks it."""
    b = document_blocks(spark, sf_dir).select("raw_text", "text", "kind", "word_count")
    counts = b.agg(*[F.count_if(t).alias(name) for (name, _, _), t in zip(RULES, _tests(), strict=True)])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(s).alias("severity"), F.col(k).alias("n")) for k, s, _ in RULES])).alias("r")).select("r.*")


@query(ISSUES + "SELECT lang, kind, count(*) AS n, grouping(lang, kind)::BIGINT AS level FROM f GROUP BY ROLLUP(lang, kind)")
def issue_kind_rollup(spark, sf_dir):
    f = stylistic(document_blocks(spark, sf_dir))
    return f.rollup("lang", "kind").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


@query(ISSUES + "SELECT doc_id, kind, block_index, excerpt FROM (SELECT *, CASE WHEN length(text) > 40 THEN rtrim(text[1:39]) || '…' ELSE text END AS excerpt, row_number() OVER (PARTITION BY doc_id, kind, lower(CASE WHEN length(text) > 40 THEN rtrim(text[1:39]) || '…' ELSE text END) ORDER BY block_index) AS k FROM f) WHERE k = 1")
def issue_dedup(spark, sf_dir):
    """The first issue of each document, kind and message."""
    f = stylistic(document_blocks(spark, sf_dir)).withColumn("excerpt", tx.excerpt(F.col("text"), 40)).withColumn("key", F.lower("excerpt"))
    return first_of(f, ["doc_id", "kind", "key"], ["block_index"]).select("doc_id", "kind", "block_index", "excerpt")


@query(ISSUES + "SELECT doc_id, count(*) AS issues, count(*) FILTER (severity = 'warning') AS warnings, count(*) FILTER (severity = 'info') AS infos, count(DISTINCT kind) AS kinds, max(block_index) AS last_block FROM f GROUP BY doc_id")
def review_issue_rollup(spark, sf_dir):
    """Flagship: the review queue's totals for each document."""
    f = stylistic(document_blocks(spark, sf_dir))
    return f.groupBy("doc_id").agg(F.count("*").alias("issues"), F.count_if(F.col("severity") == "warning").alias("warnings"), F.count_if(F.col("severity") == "info").alias("infos"), F.count_distinct("kind").alias("kinds"), F.max("block_index").cast("long").alias("last_block"))


@query(BLOCKS + "SELECT doc_id, block_index FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(text) ORDER BY block_index) AS k FROM b) WHERE k = 1")
def dedup_first(spark, sf_dir):
    b = document_blocks(spark, sf_dir).withColumn("key", tx.weak_key(F.col("text")))
    return first_of(b, ["doc_id", "key"], ["block_index"]).select("doc_id", "block_index")


@query(BLOCKS + "SELECT doc_id, min(block_index) AS first_block, count(*) AS blocks, kind, sum(word_count)::BIGINT AS words FROM (SELECT *, block_index - row_number() OVER (PARTITION BY doc_id, kind ORDER BY block_index) AS island FROM b) GROUP BY doc_id, kind, island")
def kind_runs(spark, sf_dir):
    """Maximal runs of blocks of one kind: how adjacent runs of one format become one."""
    b = document_blocks(spark, sf_dir)
    island = F.col("block_index") - F.row_number().over(Window.partitionBy("doc_id", "kind").orderBy("block_index"))
    return b.withColumn("island", island).groupBy("doc_id", "kind", "island").agg(F.min("block_index").cast("long").alias("first_block"), F.count("*").alias("blocks"), F.sum("word_count").alias("words")).drop("island")


@query(BLOCKS + ", c AS (SELECT *, floor(sum(word_count) OVER (PARTITION BY doc_id ORDER BY block_index) * 4.0 / greatest(1, sum(word_count) OVER (PARTITION BY doc_id))) AS f FROM b), d AS (SELECT *, least(3, block_index + least(0, min(f - block_index) OVER (PARTITION BY doc_id ORDER BY block_index))) AS cuts FROM c) SELECT doc_id, block_index, word_count, coalesce(lag(cuts) OVER (PARTITION BY doc_id ORDER BY block_index), 0)::BIGINT AS chunk FROM d")
def weight_chunks(spark, sf_dir):
    from lectern.operators.segments import weight_chunks as cut

    return cut(document_blocks(spark, sf_dir), ["doc_id"], "block_index", "word_count", 4).select("doc_id", "block_index", "word_count", "chunk")


@query(BLOCKS + ", h AS (SELECT *, sum((kind = 'heading_like')::INT) OVER (PARTITION BY doc_id ORDER BY block_index) AS chapter FROM b) SELECT doc_id, chapter::BIGINT AS chapter, min(block_index) AS first_block, max(block_index) AS last_block, sum(word_count)::BIGINT AS words FROM h WHERE chapter > 0 GROUP BY doc_id, chapter")
def split_by_heading(spark, sf_dir):
    from lectern.operators.segments import split_at

    b = split_at(document_blocks(spark, sf_dir), ["doc_id"], "block_index", F.col("kind") == "heading_like")
    return b.groupBy("doc_id", "chapter").agg(F.min("block_index").cast("long").alias("first_block"), F.max("block_index").cast("long").alias("last_block"), F.sum("word_count").alias("words"))


@query(BLOCKS + "SELECT doc_id, block_index AS starts, lead(block_index, 1, 2147483647) OVER (PARTITION BY doc_id ORDER BY block_index) AS ends FROM b WHERE kind = 'heading_like'")
def section_lead_bounds(spark, sf_dir):
    from lectern.operators.segments import section_bounds

    return section_bounds(document_blocks(spark, sf_dir).where("kind = 'heading_like'"), ["doc_id"], "block_index").select("doc_id", F.col("block_index").cast("long").alias("starts"), F.col("ends").cast("long").alias("ends"))


@query(BLOCKS + ", w AS (SELECT doc_id, block_index, kind, last_value(CASE WHEN kind <> 'heading_like' THEN block_index END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY block_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_text, lead(kind, 1) OVER (PARTITION BY doc_id ORDER BY block_index) AS next_kind, lead(kind, 2) OVER (PARTITION BY doc_id ORDER BY block_index) AS second_kind FROM b) SELECT * FROM w WHERE kind = 'heading_like'")
def heading_neighbours(spark, sf_dir):
    """The last text block before each heading and the kinds of the two blocks after it."""
    by = Window.partitionBy("doc_id").orderBy("block_index")
    before = F.last(F.when(F.col("kind") != "heading_like", F.col("block_index").cast("long")), ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))
    b = document_blocks(spark, sf_dir).withColumns({"previous_text": before, "next_kind": F.lead("kind", 1).over(by), "second_kind": F.lead("kind", 2).over(by)})
    return b.where("kind = 'heading_like'").select("doc_id", F.col("block_index").cast("long").alias("block_index"), "kind", "previous_text", "next_kind", "second_kind")


@query(BLOCKS + r", t AS (SELECT doc_id, block_index, regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(replace(raw_text, chr(160), ' '), '[ \t]{2,}', ' ', 'g'), '\s+([,.;:!?…])', '\1', 'g'), '...', '…'), '([A-Za-z0-9А-ЯЁа-яё])\s+-\s+([А-ЯЁа-яёA-Za-z0-9])', '\1 — \2', 'g'), '([,;:!?])([А-ЯЁа-яёA-Za-z])', '\1 \2', 'g') AS new_text, raw_text FROM b) SELECT doc_id, block_index, new_text, new_text <> raw_text AS changed FROM t")
def typography_normalised(spark, sf_dir):
    b = document_blocks(spark, sf_dir).withColumn("t", tx.typography(F.col("raw_text")))
    return b.select("doc_id", "block_index", F.col("t.text").alias("new_text"), (F.col("t.text") != F.col("raw_text")).alias("changed"))


_ACTION_TESTS = {"nbsp_to_space": "contains(raw_text, chr(160))", "double_spaces": r"regexp_matches(replace(raw_text, chr(160), ' '), '[ \t]{2,}')", "space_before_punctuation": r"regexp_matches(raw_text, '\s+[,.;:!?…]')", "three_dots": "contains(raw_text, '...')", "inverted_nested_guillemets": "regexp_matches(raw_text, '»[^«»]{1,200}«')", "spaced_ascii_dash": r"regexp_matches(raw_text, '[A-Za-z0-9А-ЯЁа-яё]\s+-\s+[А-ЯЁа-яёA-Za-z0-9]')", "space_after_punctuation": "regexp_matches(raw_text, '[,;:!?][А-ЯЁа-яёA-Za-z]')"}


@query(BLOCKS + " UNION ALL ".join(f"SELECT '{a}' AS action, count(*) FILTER ({t}) AS n FROM b" for a, t in _ACTION_TESTS.items()))
def typography_actions(spark, sf_dir):
    """Blocks that each rewrite changes; zero where none does."""
    b = document_blocks(spark, sf_dir).select(tx.typography(F.col("raw_text"))["actions"].alias("a"))
    counts = b.agg(*[F.count_if(F.array_contains("a", name)).alias(name) for name, _, _ in tx.TYPOGRAPHY])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(n).alias("action"), F.col(n).alias("n")) for n, _, _ in tx.TYPOGRAPHY])).alias("r")).select("r.*")


@query(BLOCKS + ", q AS (SELECT doc_id, block_index, text, string_split(text, chr(34)) AS p FROM b WHERE contains(text, chr(34))) SELECT doc_id, block_index, len(p) - 1 AS quotes, CASE WHEN len(p) % 2 = 0 THEN text ELSE list_reduce(list_transform(range(1, len(p) + 1), lambda i: CASE WHEN i = 1 THEN p[1] WHEN contains(text, '«') OR contains(text, '»') THEN CASE WHEN i % 2 = 0 THEN '„' ELSE '“' END || p[i] WHEN len(p) = 5 AND regexp_matches(ltrim(p[3]), '^[А-ЯЁа-яёA-Za-z0-9]') THEN '«„“»'[i - 1] || p[i] ELSE CASE WHEN i % 2 = 0 THEN '«' ELSE '»' END || p[i] END), lambda a, x: a || x) END AS quoted FROM q")
def typographic_quotes(spark, sf_dir):
    b = document_blocks(spark, sf_dir).where(F.col("text").contains('"'))
    return b.select("doc_id", "block_index", tx.count_char(F.col("text"), '"').cast("long").alias("quotes"), tx.typographic_quotes(F.col("text")).alias("quoted"))
