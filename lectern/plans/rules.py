"""Rules over texts, pairs, references and reports: diacritics, rewrites, semantic findings, producers of issues, checked joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lectern.functions import diacritics as di
from lectern.functions import forms as fm
from lectern.functions import text as tx
from lectern.operators import lookups as lk
from lectern.operators import producers as pd_
from lectern.operators import semantic as sm
from lectern.operators import titles as tl
from lectern.sources.tables import table, text_blocks, with_features

from .blocks import BLOCKS, ISSUES, document_blocks, stylistic
from .pages import _HITS, _MIRROR, _resolved
from .terms import _CANDIDATES, candidates, stored_candidates
from .registry import registry

QUERIES, ORACLE, query = registry()


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


# ---- diacritics: blocks, with a style by kind ----------------------------------------------------

_STYLE_OF = {"heading_like": "Заголовок 1", "source_like": "Сноска", "quote_like": "Цитата 1", "list_numbered": "Шлока"}
_L = rf"[A-Za-zА-Яа-яЁё{di.MARKED}\x{{304}}\x{{323}}\x{{307}}\x{{303}}\x{{301}}]"
_M = rf"[{di.MARKED}\x{{304}}\x{{323}}\x{{307}}\x{{303}}\x{{301}}]"
#: A text without marks in SQL: letters with marks and, of what normal forms take apart, letters with acute and tilde.
_TWO = [(k, v) for k, v in di.PLAIN.items() if len(v) > 1]
_ONE = [(k, v) for k, v in di.PLAIN.items() if len(v) == 1]
_ACUTE = ("áéíóúýÁÉÍÓÚÝãõÃÕ", "aeiouyAEIOUYaoAO")


def _plain_sql(c: str) -> str:
    out = f"translate({c}, '{''.join(k for k, _ in _ONE)}{_ACUTE[0]}', '{''.join(v for _, v in _ONE)}{_ACUTE[1]}')"
    for k, v in _TWO:
        out = f"replace({out}, '{k}', '{v}')"
    out = rf"regexp_replace({out}, '[\x{{304}}\x{{323}}\x{{307}}\x{{303}}\x{{301}}]', '', 'g')"
    for k, v in di.SPELLED.items():
        out = rf"regexp_replace({out}, '(^|[^\p{{L}}\p{{N}}_]){k}', '\1{v}', 'g')"
    return out


_DIACRITICS = (
    BLOCKS
    + rf""", g AS (SELECT doc_id, block_index, text, CASE kind {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in _STYLE_OF.items())} ELSE '' END AS style FROM b),
w AS (SELECT *, regexp_extract_all(text, '{_L}+(?:[-‑]{_L}+)*') AS ws FROM g),
s AS (SELECT *, len(ws) AS n, len(list_filter(ws, lambda x: regexp_matches(x, '{_M}'))) AS marked, len(list_filter(ws, lambda x: list_contains({_list(w.replace('ё', 'е') for w in di.PROSE_WORDS)}, replace(lower(x), 'ё', 'е')))) AS prose,
 CASE WHEN regexp_matches(text, '{_M}') THEN len(list_filter(regexp_extract_all(replace(lower({_plain_sql('text')}), 'ё', 'е'), '{_L}+(?:[-‑]{_L}+)*'), lambda x: list_has_any(list_concat([x], string_split(replace(x, '‑', '-'), '-')), {_list(di.VERSE_WORDS)}))) ELSE 0 END AS verse FROM w),
r AS (SELECT *, marked / greatest(n, 1) AS m, prose / greatest(n, 1) AS p FROM s),
v AS (SELECT *, regexp_matches(text, '{_M}') AND n BETWEEN 1 AND 120 AND NOT (prose >= 3 AND p >= 0.12) AND ((n >= 8 AND m >= 0.30 AND p <= 0.18) OR (n >= 4 AND m >= 0.55 AND prose = 0 AND regexp_matches(text, '[,;।]')) OR (n >= 4 AND verse >= 1 AND marked >= 2 AND p <= 0.18) OR (n <= 3 AND regexp_matches(text, '[-‑].{{8,}}[-‑]') AND prose = 0)) AS is_verse FROM r),
d AS (SELECT *, CASE WHEN marked = 0 THEN 'none no-diacritics' WHEN style IN ('Шлока', 'Шлока в цитате') THEN 'preserve style:' || style WHEN style LIKE 'toc%' OR style LIKE 'Заголовок%' THEN 'normalize_prose style:' || style
 WHEN style LIKE 'Сноска%' THEN 'normalize_prose footnote-prose-style:' || style WHEN regexp_matches(text, '^\s*[A-Za-zА-Яа-яЁё]{{1,6}}\s*(?:\d[\d.,:;–—-]*)?:') THEN 'normalize_prose reference-or-abbreviation-entry'
 WHEN style IN ('Цитата 1', 'Цитата 2') AND is_verse THEN 'preserve quote-style-transliteration:' || style WHEN is_verse THEN 'preserve transliteration-block' ELSE 'normalize_prose russian-prose-with-diacritics' END AS said FROM v)
"""
)


def _decided(spark, sf_dir):
    style = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in _STYLE_OF.items() for x in kv]), F.col("kind")), F.lit(""))
    # Texts without marks need no style, and so no kind.
    b = document_blocks(spark, sf_dir).select("doc_id", "block_index", "text", F.when(di.has_marks(F.col("text")), style).alias("style"))
    # Python gets nulls but where there are marks (in a branch it would see every text); without any there is no verse either way.
    b = b.withColumn("plain", F.coalesce(di.without_marks(F.when(di.has_marks(F.col("text")), F.col("text"))), F.col("text")))
    return b.withColumn("d", di.decision(F.col("text"), F.col("plain"), F.col("style")))


@query(_DIACRITICS + "SELECT split_part(said, ' ', 1) AS action, substr(said, strpos(said, ' ') + 1) AS reason, count(*) AS n FROM d GROUP BY said")
def diacritic_reasons(spark, sf_dir):
    """How many blocks each reason decided."""
    return _decided(spark, sf_dir).groupBy(F.col("d.action").alias("action"), F.col("d.reason").alias("reason")).agg(F.count("*").alias("n"))


@query(_DIACRITICS + ", e AS (SELECT said, doc_id, block_index, row_number() OVER (PARTITION BY said ORDER BY doc_id, block_index) AS k FROM d) SELECT substr(said, strpos(said, ' ') + 1) AS reason, doc_id, block_index FROM e WHERE k <= 12")
def diacritic_examples(spark, sf_dir):
    """The first twelve blocks of each reason."""
    x = _decided(spark, sf_dir).select(F.col("d.reason").alias("reason"), "doc_id", "block_index")
    return lk.examples(x, "reason", ["doc_id", "block_index"])


@query(_DIACRITICS + f"SELECT doc_id, block_index, {_plain_sql('text')} AS fixed FROM d WHERE said LIKE 'normalize_prose%' AND {_plain_sql('text')} <> text")
def dediacritized_prose(spark, sf_dir):
    """Blocks of prose whose letters lose their marks."""
    x = _decided(spark, sf_dir).where("d.action = 'normalize_prose' and plain <> text")
    return x.select("doc_id", "block_index", F.col("plain").alias("fixed"))


# ---- rewrites and forms --------------------------------------------------------------------------

_LINE = "text || ' в ' || turn || '  % рис. ' || turn || ' — № ' || conv_id || ' т. 3 и Гл.  ' || turn"


def _no_break_sql(c: str) -> list[str]:
    out = [c]
    for _, pattern, put in fm.NO_BREAK:
        groups = put.replace("$", "\\").replace(" ", "' || chr(160) || '").replace("\\'", "'")
        out.append(f"regexp_replace({out[-1]}, '{pattern.replace(chr(39), chr(39) * 2)}', '{groups}', 'g')")
    return out


_NO_BREAK = _no_break_sql("line")


@query(f"WITH m AS (SELECT conv_id, turn, {_LINE} AS line FROM conversations) SELECT conv_id, turn, {_NO_BREAK[-1]} AS fixed, " + ", ".join(f"len(regexp_extract_all({c}, '{p.replace(chr(39), chr(39) * 2)}')) AS {n}" for c, (n, p, _) in zip(_NO_BREAK, fm.NO_BREAK)) + " FROM m")
def nbsp_fixes(spark, sf_dir):
    """No-break spaces in messages that end in short references, with counts by rule."""
    one = lambda c: F.col(c).cast("string")
    line = F.concat("text", F.lit(" в "), one("turn"), F.lit("  % рис. "), one("turn"), F.lit(" — № "), one("conv_id"), F.lit(" т. 3 и Гл.  "), one("turn"))
    x = table(spark, sf_dir, "conversations").select("conv_id", "turn", fm.no_break(line).alias("f"))
    return x.select("conv_id", "turn", F.col("f.text").alias("fixed"), *[F.col(f"f.{n}").cast("long").alias(n) for n, _, _ in fm.NO_BREAK])


@query(BLOCKS + r""", c AS (SELECT doc_id, block_index, regexp_replace(regexp_replace(trim(text), '^["''«„“”]+', ''), '["''»“”.,;:!?]+$', '') AS t FROM b)
SELECT doc_id, block_index, trim(CASE WHEN t LIKE '(%' AND t LIKE '%)' AND length(t) - length(translate(t, '()', '')) = 2 THEN substr(t, 2, length(t) - 2) ELSE t END) AS term FROM c""")
def candidate_texts(spark, sf_dir):
    """Blocks as terms are cleaned. The tables' texts hold no entities, which SQL leaves as they are."""
    return document_blocks(spark, sf_dir).select("doc_id", "block_index", fm.candidate_text(F.col("text")).alias("term"))


@query(BLOCKS + rf""", n AS (SELECT *, len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_''-]+')) AS words FROM b) SELECT doc_id, block_index, words, CASE WHEN words <= 12 AND NOT regexp_matches(text, '[.!?:;,]$') THEN 'heading_like' WHEN regexp_matches(text, '{_M}') AND words <= 50 THEN 'sanskrit_or_term' WHEN regexp_matches(text, '^[0-9ivxlcdmIVXLCDM .–-]+$') THEN 'page_or_number' ELSE 'body' END AS class FROM n""")
def source_block_classes(spark, sf_dir):
    """Classes of a source's blocks in review packs, by Unicode words."""
    return document_blocks(spark, sf_dir).select("doc_id", "block_index", fm.pack_words(F.col("text")).cast("long").alias("words"), fm.source_block_class(F.col("text")).alias("class"))


@query(r"""WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]*(.*)$', 1) AS path FROM pages), q AS (SELECT page_id, path, list_filter(string_split(path, '/'), lambda x: x <> '') AS parts FROM p)
SELECT page_id, CASE WHEN len(parts) > 0 THEN '/' || array_to_string(parts, '/') || '/' ELSE '' END AS web_path, CASE lower(regexp_extract(path, '(\.[^./]*)$', 1)) WHEN '.html' THEN 'html' WHEN '.htm' THEN 'html' WHEN '.txt' THEN 'text' WHEN '.md' THEN 'text' WHEN '.doc' THEN 'doc' WHEN '.docx' THEN 'docx' END AS format FROM q""")
def page_formats(spark, sf_dir):
    """Normalised paths and formats by suffix of the pages' addresses."""
    path = F.regexp_extract("url", r"^[a-z]+://[^/]*(.*)$", 1)
    return table(spark, sf_dir, "pages").select("page_id", fm.web_path(path).alias("web_path"), fm.source_format(path).alias("format"))


@query("WITH v AS (SELECT event_id, user_id, CASE event_id % 4 WHEN 0 THEN 'text ' || event_id % 17 WHEN 1 THEN event_id % 17 || '-' || event_id % 23 WHEN 2 THEN 'intro' ELSE event_id % 17 || '' END AS verse FROM events) SELECT event_id, verse, row_number() OVER (PARTITION BY user_id ORDER BY coalesce(try_cast(regexp_extract(verse, '(\\d+)', 1) AS BIGINT), 1000000000), coalesce(try_cast(regexp_extract(verse, '\\d+\\D+(\\d+)', 1) AS BIGINT), -1), verse, event_id) AS place FROM v".replace("\\\\", "\\"))
def verse_order(spark, sf_dir):
    """Verses of a chapter in natural order."""
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    a, b = (i % 17).cast("string"), (i % 23).cast("string")
    verse = F.when(i % 4 == 0, F.concat(F.lit("text "), a)).when(i % 4 == 1, F.concat(a, F.lit("-"), b)).when(i % 4 == 2, "intro").otherwise(a)
    x = e.select("event_id", "user_id", verse.alias("verse")).withColumn("place", F.row_number().over(Window.partitionBy("user_id").orderBy(fm.verse_key(F.col("verse")), "event_id")))
    return x.select("event_id", "verse", F.col("place").cast("long").alias("place"))


# ---- semantic findings: a message and the next one are the two sides ------------------------------

_SIDE = "(SELECT conv_id * 1000 + turn AS doc_id, '' AS lang, '' AS source, replace(coalesce({0}, ''), chr(10), ' ') || {1} AS text FROM conversations_next)"
_NEXT = "WITH conversations_next AS (SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM conversations)"
_REFS = "(?i)(?:^|[^\\p{{L}}\\p{{N}}_])((?:{0})\\s+[\\d.,:;\\- ]+)".format("шб|бг|чч|ав|гв|сдж|шбут|шпу|sb|bg|cc|adi|madhya|antya")


def _blocks_of(sub: str) -> str:
    return "(" + BLOCKS.replace("FROM documents", "FROM " + sub) + "SELECT * FROM b)"


_PAIRS = (
    _NEXT
    + ", s AS (SELECT * FROM " + _blocks_of(_SIDE.format("text", "' «SB 1.' || conv_id % 3 || ' '")) + "), t AS (SELECT * FROM " + _blocks_of(_SIDE.format("next", "CASE WHEN turn % 2 = 0 THEN ' SB 1.' ELSE ' BG 2.' END || turn % 3 || ' '")) + ")"
    + f", x AS (SELECT s.doc_id, [trim(y) FOR y IN regexp_extract_all(s.text || ' ', '{_REFS}', 1)] AS sr, [trim(y) FOR y IN regexp_extract_all(t.text || ' ', '{_REFS}', 1)] AS tr, s.digit_signature AS sd, t.digit_signature AS td, s.has_quote_marks AS sq, t.has_quote_marks AS tq, s.kind AS sk, t.kind AS tk FROM s JOIN t ON s.doc_id = t.doc_id)"
)
_HIGH = ", ".join(f"'{k}'" for k in sm.HIGH_IMPACT)


def _message_pairs(spark, sf_dir):
    m = table(spark, sf_dir, "conversations").withColumn("next", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn")))
    key = (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id")
    mod = lambda c: (F.col(c) % 3).cast("string")
    flat = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" "))
    source = F.concat(flat("text"), F.lit(" «SB 1."), mod("conv_id"), F.lit(" "))
    target = F.concat(flat("next"), F.when(F.col("turn") % 2 == 0, " SB 1.").otherwise(" BG 2."), mod("turn"), F.lit(" "))
    sides = []
    for name, c in (("source", source), ("target", target)):
        b = with_features(text_blocks(m.select(key, c.alias("text")), ["doc_id"]))
        sides.append(b.select("doc_id", *[F.col(x).alias(f"{name}_{x}") for x in ("text", "digit_signature", "has_quote_marks", "kind")]))
    return sides[0].join(sides[1], "doc_id")


@query(_PAIRS + f", f AS (SELECT doc_id, sr <> tr AND len(sr) > 0 AS a, sd <> '' AND sd <> td AS b, sq <> tq AND (sk IN ({_HIGH}) OR tk IN ({_HIGH})) AS c FROM x) SELECT doc_id, 1::INT AS seq, 'semantic_reference_mismatch' AS kind, 'warning' AS severity FROM f WHERE a UNION ALL SELECT doc_id, 1 + a::INT, 'semantic_missing_or_shifted_digits', 'warning' FROM f WHERE b UNION ALL SELECT doc_id, 1 + a::INT + b::INT, 'semantic_quote_or_citation_mismatch', 'info' FROM f WHERE c")
def semantic_pairs(spark, sf_dir):
    """What the second side of a pair may have lost."""
    return sm.pair_findings(_message_pairs(spark, sf_dir), ["doc_id"])


# ---- producers: reports as issues ----------------------------------------------------------------


@query(ISSUES + ", a AS (SELECT f.doc_id, f.block_index, f.kind, f.severity, b.text, b.paragraph_index, row_number() OVER (PARTITION BY f.doc_id ORDER BY f.block_index, f.kind) AS n FROM f JOIN b USING (doc_id, block_index)) SELECT doc_id, 'audit-' || lpad(n::VARCHAR, 4, '0') AS issue_id, kind, severity, 'Found: ' || kind || '.' || chr(10) || 'Excerpt: ' || text AS message, paragraph_index::INT AS paragraph_index FROM a")
def audit_issues(spark, sf_dir):
    """Findings of an audit as issues, numbered within a document."""
    b = document_blocks(spark, sf_dir).select("doc_id", "block_index", F.col("text").alias("excerpt"), "paragraph_index")
    report = stylistic(document_blocks(spark, sf_dir)).select("doc_id", "block_index", "kind", "severity").join(b, ["doc_id", "block_index"])
    return pd_.from_style_audit(report, ["doc_id"], ["block_index", "kind"]).select("doc_id", "issue_id", "kind", "severity", "message", "paragraph_index")


_FOUND = _HITS + f", k AS (SELECT conv_id, turn, work, raw, path, CASE work WHEN 'bg' THEN 'БГ ' ELSE 'ШБ ' END || replace(path, '/', '.') AS canonical, '/en/library/' || work || '/' || path || '/' AS web_path FROM h), l AS (SELECT k.*, p.web_path IS NOT NULL AS resolved FROM k LEFT JOIN {_MIRROR} p ON p.web_path = k.web_path)"


def _scan(spark, sf_dir):
    return _resolved(spark, sf_dir).select("conv_id", "turn", "work", F.col("raw").alias("raw_text"), F.col("canonical").alias("normalized_ref"), F.col("canonical").alias("replacement_text"), "web_path", F.lit("").alias("h1"), F.lit("").alias("block_excerpt"), (F.col("turn") + 1).alias("paragraph_index"), "resolved", "needs_normalization")


@query(_FOUND + r""", u AS (SELECT *, row_number() OVER (PARTITION BY conv_id, resolved ORDER BY turn, work, raw) AS n FROM l WHERE NOT resolved OR raw <> canonical)
SELECT conv_id, CASE WHEN resolved THEN 'refscan-format-' ELSE 'refscan-unresolved-' END || lpad(n::VARCHAR, 4, '0') AS issue_id, CASE WHEN resolved THEN 'scripture_reference_format' ELSE 'scripture_reference_unresolved' END AS kind, CASE WHEN resolved THEN 'info' ELSE 'warning' END AS severity,
CASE WHEN resolved THEN concat_ws(chr(10), 'The reference is resolved but not in its canonical form.', 'Current: ' || raw, 'Preferred: ' || canonical, 'Path: ' || web_path) ELSE concat_ws(chr(10), 'The reference is recognised but has no page in the mirror.', 'Reference: ' || canonical, CASE WHEN raw <> canonical THEN 'Raw text: ' || raw END, 'Expected path: ' || web_path) END AS message, (turn + 1)::INT AS paragraph_index FROM u""")
def reference_issues(spark, sf_dir):
    """References without a page, or in another form, as issues."""
    return pd_.from_reference_scan(_scan(spark, sf_dir), ["conv_id"], ["turn", "work", "raw_text"]).select("conv_id", "issue_id", "kind", "severity", "message", "paragraph_index")


@query(ISSUES + ", a AS (SELECT f.doc_id, f.block_index, f.kind, f.severity, b.text, b.paragraph_index FROM f JOIN b USING (doc_id, block_index)) SELECT doc_id, block_index, kind, '[' || upper(severity) || '] Review' || chr(10) || 'Kind: ' || kind || chr(10) || chr(10) || 'Suggested action:' || chr(10) || 'Look again.' || chr(10) || chr(10) || 'Context:' || chr(10) || '- excerpt: ' || text || chr(10) || chr(10) || 'Metadata:' || chr(10) || '- paragraph_index: ' || paragraph_index AS body FROM a")
def issue_bodies(spark, sf_dir):
    """Issues as readers see them."""
    # An issue still has its block's columns: no join.
    x = stylistic(document_blocks(spark, sf_dir))
    body = pd_.issue_text(F.col("severity"), F.lit("Review"), F.col("kind"), F.lit(""), F.lit("Look again."), {"excerpt": F.col("text")}, {"paragraph_index": F.col("paragraph_index"), "ignored": F.col("text")})
    return x.select("doc_id", "block_index", "kind", body.alias("body"))


# ---- checked joins -------------------------------------------------------------------------------


@query(ISSUES + ", i AS (SELECT doc_id, block_index, count(*) AS n, array_to_string(list(kind ORDER BY kind), '|') AS kinds FROM f GROUP BY ALL) SELECT b.doc_id, b.block_index, coalesce(n, 0) AS n, coalesce(kinds, '') AS kinds FROM b LEFT JOIN i USING (doc_id, block_index)")
def blocks_with_issues(spark, sf_dir):
    """Every block with all issues that lie on it."""
    b = document_blocks(spark, sf_dir)
    i = stylistic(b).select("doc_id", "block_index", F.col("kind").alias("issue_id"), "kind", "severity", F.lit("word/document.xml").alias("part"))
    x = lk.with_issues(b.select("doc_id", "block_index"), i, ["doc_id", "block_index"], ["kind"])
    return x.select("doc_id", "block_index", F.size("issues").cast("long").alias("n"), F.array_join(F.col("issues.kind"), "|").alias("kinds"))


@query("WITH n AS (SELECT l_orderkey, l_suppkey AS note_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) AS k FROM lineitem) SELECT l_orderkey, note_id, min(k)::INT AS paragraph_index FROM n GROUP BY ALL")
def first_note_paragraphs(spark, sf_dir):
    """The first line of each supplier in an order: a note's first paragraph."""
    k = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_suppkey"))
    # A task keeps its rows for sorting and twice as groups, so parts are not put together: a part of 64 MB would take 1 GB.
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "l_orderkey")
    notes = lines.select("l_orderkey", F.col("l_suppkey").alias("note_id"), k.alias("paragraph_index"))
    return lk.first_paragraphs(notes, ["l_orderkey"])


@query("SELECT c.c_custkey, c.c_mktsegment, n.n_name FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey")
def whole_pairs(spark, sf_dir):
    """Customers with their nation, which each must have."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = c.select("c_custkey", "c_nationkey").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return lk.whole_pairs(c.drop("c_nationkey"), n, c, "c_custkey").select("c_custkey", "c_mktsegment", "n_name")


@query("WITH f AS (SELECT n_regionkey AS folder, n_name || '.json' AS name, n_name AS key, 0 AS r FROM nation WHERE n_nationkey % 3 <> 0 UNION ALL SELECT n_regionkey, n_name || '.issues.json', n_name, 1 FROM nation WHERE n_nationkey % 2 = 0) SELECT folder, key, arg_min(name, r) AS name FROM f GROUP BY ALL")
def extra_bundles(spark, sf_dir):
    """Of each folder and key the bundle of the preferred name."""
    n = table(spark, sf_dir, "nation")
    named = lambda where, end: n.where(where).select(F.col("n_regionkey").alias("folder"), F.concat("n_name", F.lit(end)).alias("name"))
    return lk.extra_bundles(named("n_nationkey % 3 <> 0", ".json").unionByName(named("n_nationkey % 2 = 0", ".issues.json")))


@query(_FOUND + " SELECT DISTINCT m.conv_id, CASE WHEN count(l.raw) OVER (PARTITION BY m.conv_id) = 0 THEN 'no_references' WHEN count(*) FILTER (NOT l.resolved) OVER (PARTITION BY m.conv_id) > 0 THEN 'editorial_queue' ELSE 'clean' END AS status, count(l.raw) OVER (PARTITION BY m.conv_id) AS refs, count(*) FILTER (NOT l.resolved) OVER (PARTITION BY m.conv_id) AS unresolved FROM (SELECT DISTINCT conv_id FROM conversations) m LEFT JOIN l ON l.conv_id = m.conv_id")
def reference_status(spark, sf_dir):
    """Each conversation's place in the queue of references."""
    files = table(spark, sf_dir, "conversations").select("conv_id", F.lit(None).cast("string").alias("error")).distinct()
    return lk.reference_status(_resolved(spark, sf_dir), files, ["conv_id"])


@query("SELECT count(*) FILTER (o_orderpriority = '1-URGENT') AS high, count(*) FILTER (o_orderpriority = '2-HIGH') AS medium, count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS low FROM orders")
def priority_histogram(spark, sf_dir):
    p = F.when(F.col("o_orderpriority") == "1-URGENT", "high").when(F.col("o_orderpriority") == "2-HIGH", "medium").otherwise(F.col("o_orderpriority"))
    return lk.priority_histogram(table(spark, sf_dir, "orders").select(p.alias("priority")))


@query(_CANDIDATES + ", a AS (SELECT key, count(DISTINCT variant) AS variants, bool_or(italic) AS it, bool_or(NOT italic) AS pl, bool_or(source_label IN ('en', 'fr')) AS own FROM c GROUP BY key), m AS (SELECT key, arg_min(category, (-n, s)) AS category FROM (SELECT key, category, count(*) AS n, min(seen) AS s FROM c GROUP BY ALL) GROUP BY key) SELECT category, count(*) AS total, count(*) FILTER (own) AS kept, count(*) FILTER (NOT own) AS dropped, count(*) FILTER (own AND (variants > 1 OR (it AND pl))) AS conflicts FROM a JOIN m USING (key) GROUP BY category")
def extraction_summary(spark, sf_dir):
    """Terms by category: all, kept for a primary source, dropped, in conflict."""
    c = stored_candidates(spark, sf_dir)
    a = c.groupBy("key").agg(F.count_distinct("variant").alias("variants"), F.max("italic").alias("it"), F.max(~F.col("italic")).alias("pl"), F.max(F.col("source_label").isin("en", "fr")).alias("own"))
    n = c.groupBy("key", "category").agg(F.count("*").alias("n"), F.min("seen").alias("s")).groupBy("key").agg(F.min_by("category", F.struct(-F.col("n"), "s")).alias("category"))
    own = F.col("own")
    return a.join(n, "key").groupBy("category").agg(F.count("*").alias("total"), F.count_if(own).alias("kept"), F.count_if(~own).alias("dropped"), F.count_if(own & ((F.col("variants") > 1) | (F.col("it") & F.col("pl")))).alias("conflicts"))


@query(_CANDIDATES + ", l AS (SELECT DISTINCT key, CASE source_label WHEN 'de' THEN 'vedabase_de' WHEN 'es' THEN 'bvks_en' WHEN 'fr' THEN 'our_fr' ELSE source_label END AS label FROM c) SELECT key, arg_min(label, (CASE WHEN label LIKE '%our%' THEN 0 WHEN label LIKE '%vedabase%' THEN 2 WHEN label LIKE '%bvks_en%' THEN 3 ELSE 9 END, label)) AS preferred_source FROM l GROUP BY key")
def preferred_sources(spark, sf_dir):
    """The source of each term that comes first."""
    names = F.create_map(*[F.lit(x) for kv in {"de": "vedabase_de", "es": "bvks_en", "fr": "our_fr"}.items() for x in kv])
    l = candidates(spark, sf_dir).select("key", F.coalesce(F.try_element_at(names, F.col("source_label")), F.col("source_label")).alias("label"))
    return l.groupBy("key").agg(F.min_by("label", F.struct(fm.source_priority(F.col("label")), "label")).alias("preferred_source"))


# ---- titles: every fifth block of a document is a title of its contents, and so is one word of every seventh ------------

_TITLES = (
    BLOCKS
    + """, t AS (SELECT doc_id, block_index * 2 AS no, lower(text) AS title FROM b WHERE block_index % 5 = 2 UNION ALL SELECT doc_id, block_index * 2 + 1, lower(string_split(text, ' ')[1]) FROM b WHERE block_index % 7 = 3),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS k FROM t), k AS (SELECT doc_id, block_index, lower(text) AS key FROM b)"""
)


@query(
    _TITLES.replace("WITH parts", "WITH RECURSIVE parts", 1)
    + """, walk AS (SELECT doc_id, 0::BIGINT AS k, 0::BIGINT AS no, '' AS title, 0::BIGINT AS cursor, NULL::BIGINT AS at_block FROM o WHERE k = 1
UNION ALL SELECT o.doc_id, o.k, o.no, o.title, coalesce(f.hit, w.cursor), f.hit FROM walk w JOIN o ON o.doc_id = w.doc_id AND o.k = w.k + 1, LATERAL (SELECT min(block_index) AS hit FROM k WHERE k.doc_id = o.doc_id AND k.key = o.title AND k.block_index > w.cursor) f)
SELECT doc_id, no, title, at_block FROM walk WHERE k > 0"""
)
def title_places(spark, sf_dir):
    """Where each title of a document's contents is found again, in order."""
    b = document_blocks(spark, sf_dir).select("doc_id", "block_index", F.lower("text").alias("key"))
    i = F.col("block_index")
    t = b.where(i % 5 == 2).select("doc_id", (i * 2).alias("no"), F.col("key").alias("title")).unionByName(b.where(i % 7 == 3).select("doc_id", (i * 2 + 1).alias("no"), F.get(F.split("key", " "), F.lit(0)).alias("title")))
    return tl.placed(t, b.withColumnRenamed("block_index", "at"), ["doc_id"], 1).select("doc_id", F.col("no").cast("long").alias("no"), "title", F.col("at").alias("at_block"))
