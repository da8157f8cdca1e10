"""Semantic paragraph styles over the lines of `documents`, some of which are dressed up as what the rules look for."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import diacritics as di
from lectern.functions import styles as st
from lectern.operators import classify as cl
from lectern.operators import properties as pp
from lectern.sources.tables import table

from .blocks import BLOCKS, SPACE, document_blocks
from .registry import registry
from .rules import _L, _M, _list, _plain_sql

QUERIES, ORACLE, query = registry()

_VERSE, _SPELLED = "кр̣ш̣н̣а говинда̄ ха̄ре мура̄ре", "джай гуру-дев прабху"
#: What becomes of a line by (7 doc_id + 5 place) mod 23: in front, behind, or in its place.
DRESSES = {
    0: ("'«' || line || '»'"), 1: ("'Текст ' || pos"), 2: ("'БГ ' || pos || '.' || (doc_id % 20)"), 3: ("'Изображение ' || line"), 4: ("'Дорогой ' || line"), 5: f"'{_VERSE}'", 6: f"'{_VERSE}'",
    7: "'— ' || line", 8: "'«' || line", 9: f"'{_SPELLED}'", 10: "'«Бхагавад-гита» 2.' || pos", 11: "'АБВ: ' || line", 12: "'«да»'",
}
HINTS = [
    {"match": {"type": "index", "value": 3}, "style": "Цитата 2", "note": "third"},
    {"match": {"type": "text", "value": "текст 4"}, "action": "review_only", "style": "Письмо"},
    {"match": {"type": "regex", "value": "^Дорогой [A-H]"}, "action": "ignore"},
    {"match": {"type": "regex", "value": "^«.*»$"}, "action": "no such action"},
]
_DRESSED = "CASE (7 * doc_id + 5 * pos) % 23 " + " ".join(f"WHEN {k} THEN {v}" for k, v in DRESSES.items()) + " ELSE line END"
_INDENT, _STYLE = "CASE WHEN (doc_id + pos) % 11 = 0 THEN 1200 ELSE 0 END", "CASE WHEN (3 * doc_id + pos) % 17 = 0 THEN 'Заголовок 1' WHEN pos % 2 = 0 THEN 'Normal' ELSE 'Основной текст' END"


def dressed_paragraphs(spark, sf_dir):
    """doc_id, pos, text, style_name, left_indent, first_line_indent, paragraph_italic: every line, empty ones too."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line")).withColumn("pos", F.col("pos") + 1)
    return d.select("doc_id", "pos", F.expr(_DRESSED).alias("text"), F.expr(_STYLE).alias("style_name"), F.expr(_INDENT).alias("left_indent"), F.lit(0).alias("first_line_indent"), F.expr("(doc_id + 2 * pos) % 19 = 0").alias("paragraph_italic"))


# The SQL takes the rules one by one: flags, then the automaton as a recursion over the places.
_N, _E = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"
_MK = r"[\x{304}\x{323}\x{307}\x{303}\x{301}]"
_STARTS, _PARTS = " OR ".join(f"starts_with(t, '{s}')" for s in st.WORK_STARTS), " OR ".join(f"contains(t, '{s}')" for s in st.PART_NAMES)
_STEMS = "|".join(st.STEMS)
_STATE_OF = " ".join(f"WHEN '{s}' THEN {k}" for k, s in enumerate(cl.STATE_STYLES) if k)
_RULE = """CASE WHEN NOT f.open THEN ' ' WHEN f.pos = 3 THEN 'h' WHEN f.t4 OR f.dear THEN ' ' WHEN f.caption THEN 'c' WHEN f.source THEN 's' WHEN f.letter THEN 'l'
 WHEN {s} IN (1, 2) AND f.translation THEN 't' WHEN f.verse THEN CASE WHEN {s} = 3 THEN 'q' ELSE 'v' END WHEN f.block_quote AND f.alone THEN 'b'
 WHEN {s} IN (3, 4) AND f.block_quote THEN {s}::VARCHAR WHEN f.quote AND f.near THEN 'n' ELSE ' ' END"""
_STEP = "CASE {r} WHEN 'h' THEN 4 WHEN 'v' THEN 1 WHEN 'q' THEN 2 WHEN 'b' THEN 3 WHEN 'n' THEN 3 WHEN '3' THEN 3 WHEN '4' THEN 4 ELSE 0 END"
_DECISIONS = rf"""
WITH RECURSIVE lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos FROM documents),
p AS (SELECT doc_id, pos, {_DRESSED} AS raw, {_STYLE} AS style_name, {_INDENT} >= 1000 AS block, (doc_id + 2 * pos) % 19 = 0 AS italic FROM lines),
c AS (SELECT *, trim(regexp_replace(raw, '{SPACE}+', ' ', 'g')) AS t FROM p),
w AS (SELECT *, CASE WHEN t = '' THEN 0 ELSE length(t) - length(replace(t, ' ', '')) + 1 END AS n, regexp_extract_all(raw, '{_L}+(?:[-‑]{_L}+)*') AS ws, regexp_matches(raw, '{_M}') AS has_marks,
 regexp_extract_all(lower(t), '[а-яё'']+(?:-[а-яё'']+)*') AS cw, regexp_extract_all(t, '(?i)[а-яёa-z0-9\x{{304}}\x{{323}}\x{{307}}\x{{303}}\x{{301}}-]+') AS mw,
 len(regexp_extract_all(t, '{_MK}')) + len(regexp_extract_all(t, '(?i)[а-яё]{_MK}')) + len(regexp_extract_all(t, '(?i){_N}[а-яё-]{{2,}}{_MK}[а-яё-]*[а-яё]')) AS score FROM c),
s AS (SELECT *, len(ws) AS k, len(list_filter(ws, lambda x: regexp_matches(x, '{_M}'))) AS marked, len(list_filter(ws, lambda x: list_contains({_list(x.replace('ё', 'е') for x in di.PROSE_WORDS)}, replace(lower(x), 'ё', 'е')))) AS prose,
 CASE WHEN has_marks THEN len(list_filter(regexp_extract_all(replace(lower({_plain_sql('raw')}), 'ё', 'е'), '{_L}+(?:[-‑]{_L}+)*'), lambda x: list_has_any(list_concat([x], string_split(replace(x, '‑', '-'), '-')), {_list(di.VERSE_WORDS)}))) ELSE 0 END AS verses,
 len(list_filter(mw, lambda x: regexp_matches(x, '{_MK}'))) / greatest(len(mw), 1) AS ratio, len(list_filter(cw, lambda x: regexp_matches(x, '{_STEMS}'))) AS stems FROM w),
q AS (SELECT *, has_marks AND k BETWEEN 1 AND 120 AND NOT (prose >= 3 AND prose / greatest(k, 1) >= 0.12) AND ((k >= 8 AND marked / greatest(k, 1) >= 0.30 AND prose / greatest(k, 1) <= 0.18) OR (k >= 4 AND marked / greatest(k, 1) >= 0.55 AND prose = 0 AND regexp_matches(raw, '[,;।]'))
  OR (k >= 4 AND verses >= 1 AND marked >= 2 AND prose / greatest(k, 1) <= 0.18) OR (k <= 3 AND regexp_matches(t, '[-‑].{{8,}}[-‑]') AND prose = 0)) AS quoted,
 t <> '' AND NOT regexp_matches(t, '[А-ЯЁA-Z]') AND NOT regexp_matches(t, '[.!?«»“”"():;,]') AND len(cw) BETWEEN 1 AND 16 AND (len(cw) > 1 OR length(cw[1]) >= 5) AND len(list_filter(cw, lambda x: NOT regexp_matches(x, '[а-яё]'))) = 0
  AND (stems >= 2 OR (stems >= 1 AND len(list_filter(cw, lambda x: contains(x, '-'))) > 0) OR (len(cw) <= 4 AND stems >= 1 AND NOT list_has_any(cw, {_list(st.SMALL_WORDS)}))) AS spelled,
 regexp_matches(t, '^[А-ЯЁA-Z][А-ЯЁA-Zа-яёa-z]{{0,7}}:\s') AS entry,
 t <> '' AND (regexp_matches(t, '(?i)^текст\s+\d+[а-яa-z]?$') OR (regexp_matches(t, '^«[^»]{{2,80}}»\s+\d') AND n <= 28) OR (regexp_matches(t, '(?i){_N}(?:{"|".join(st.WORK_NAMES)})(?:[^\p{{L}}\p{{N}}_].*)?\d') AND (n <= 18 OR (({_STARTS}) AND n <= 28) OR (starts_with(t, '«') AND ({_PARTS}) AND n <= 24)))) AS source,
 regexp_matches(t, '(?i)^(?:{st.CAPTIONS}){_E}') OR (n <= 24 AND NOT regexp_matches(t, '[?!]|:$') AND (regexp_matches(t, '(?i)\((?:стр\.|p\.|pp\.)\s*\d') OR (regexp_matches(t, '(?i)^(?:{st.SHORT_CAPTIONS})') AND (has_marks OR n <= 10)))) AS caption,
 regexp_matches(t, '(?i)^(?:{st.LETTERS}|(?:{st.LETTER_ENDS}){_E})') AS letter FROM s),
l AS (SELECT *, style_name <> 'Заголовок 1' AND t <> '' AS open, lower(t) = 'текст 4' AS t4, regexp_matches(raw, '^Дорогой [A-H]') AS dear, (starts_with(t, '«') AND ends_with(t, '»')) OR starts_with(t, '—') AS translation,
 NOT source AND NOT caption AND ((t <> '' AND NOT entry AND (quoted OR (score >= 4 AND ratio >= 0.45) OR (score >= 2 AND ratio >= 0.7) OR spelled)) OR (block AND has_marks AND n <= 18)) AS verse,
 NOT entry AND starts_with(t, '«') AND (ends_with(t, '»') OR length(t) <= 800) AS quote, block OR n BETWEEN 8 AND 180 AS alone FROM q),
f AS (SELECT *, t <> '' AND NOT source AND NOT entry AND (quote OR (block AND (regexp_matches(t, '^[«“"]') OR n BETWEEN 8 AND 260))) AS block_quote,
 coalesce(lead(source) OVER o, false) OR coalesce(lead(source, 2) OVER o, false) OR coalesce(lag(open AND pos <> 3 AND NOT t4 AND NOT dear AND NOT caption AND source, 2) OVER o, false) AS near FROM l WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
run AS (SELECT doc_id, pos, {_RULE.format(s='0')} AS rule, {_STEP.format(r='(' + _RULE.format(s='0') + ')')} AS state FROM f WHERE pos = 1
 UNION ALL SELECT f.doc_id, f.pos, {_RULE.format(s='run.state')}, {_STEP.format(r='(' + _RULE.format(s='run.state') + ')')} FROM run JOIN f ON f.doc_id = run.doc_id AND f.pos = run.pos + 1),
x AS (SELECT f.*, CASE WHEN open AND rule = ' ' AND NOT t4 AND NOT dear THEN CASE WHEN score >= 2 OR quote THEN 'm' WHEN block OR italic THEN 'i' ELSE ' ' END WHEN open AND t4 AND f.pos <> 3 THEN 'r' ELSE rule END AS rule FROM f JOIN run USING (doc_id, pos)),
said(rule, new_style, confidence, reason) AS (VALUES {", ".join(f"('{c}', '{s}', '{k}', '{r}')" for c, (s, k, r) in cl.RULES.items())}, {", ".join(f"('{c}', NULL, 'low', '{r}')" for c, r in cl.REVIEWS.items())}, ('h', 'Цитата 2', 'hint', 'hint:third'), ('r', 'Письмо', 'hint', 'hint:text')),
d AS (SELECT doc_id, pos, style_name AS old_style, new_style, confidence, reason, rule NOT IN ('m', 'i', 'r') AS applied FROM x JOIN said USING (rule))
"""


@query(_DECISIONS + "SELECT * FROM d")
def style_classification(spark, sf_dir):
    """What rules and hints say of each paragraph."""
    return cl.semantic_styles(dressed_paragraphs(spark, sf_dir), ["doc_id"], "pos", HINTS)


@query(_DECISIONS + "SELECT old_style, coalesce(new_style, '') AS new_style, reason, count(*) AS n, count(DISTINCT doc_id) AS docs FROM d GROUP BY ALL")
def style_report(spark, sf_dir):
    """How often each style was given or asked about, by reason."""
    x = cl.semantic_styles(dressed_paragraphs(spark, sf_dir), ["doc_id"], "pos", HINTS)
    return x.groupBy("old_style", F.coalesce("new_style", F.lit("")).alias("new_style"), "reason").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs"))


@query(_DECISIONS + "SELECT doc_id, pos AS value, new_style AS style, 'current:' || reason AS note, old_style, confidence AS current_confidence FROM d")
def style_hint_template(spark, sf_dir):
    """Every decision as a hint for an editor to change."""
    x = cl.hint_template(cl.semantic_styles(dressed_paragraphs(spark, sf_dir), ["doc_id"], "pos", HINTS), ["doc_id"], "pos")
    return x.select("doc_id", F.col("match.value").alias("value"), "style", "note", "old_style", "current_confidence")


# ---- properties: every block is a paragraph of two runs, with properties by its place ------------------------------------

_RUN_STYLES = {"k1": (pp.ITALIC, {"i": ""}), "em": ("Emphasis", {"i": ""}), "st": ("Strong", {"b": ""}), "fn": ("footnote reference", {})}
_IDS = ["k1", "em", "st", "fn", "zz"]
_PROPS = {"i": "(doc_id + 3 * block_index + run) % 4 = 0", "b": "(2 * doc_id + block_index + run) % 7 = 0", "color": "(doc_id + block_index + 2 * run) % 6 = 0"}
_OFF = "(doc_id + block_index) % 5 = 0"
_CHAR = f"CASE (doc_id + block_index + run) % 9 {' '.join(f'WHEN {k} THEN {chr(39)}{v}{chr(39)}' for k, v in enumerate(_IDS))} END"


def property_runs(spark, sf_dir):
    b = document_blocks(spark, sf_dir).select("doc_id", "block_index", "text", F.explode(F.array(F.lit(1), F.lit(2))).alias("run"))
    entry = lambda k, test, v: F.when(F.expr(test), F.struct(F.lit(k).alias("k"), v.alias("v")))
    switch = F.when(F.expr(_OFF), "0").otherwise("")
    own = F.array_compact(F.array(*[entry(k, t, switch if k in pp.SWITCHES else F.lit("1")) for k, t in _PROPS.items()], entry("rStyle", f"({_CHAR}) IS NOT NULL", F.expr(_CHAR))))
    return b.withColumn("props", F.map_from_entries(own))


_RUNS = (
    BLOCKS
    + f""", r0 AS (SELECT doc_id, block_index, run FROM b, (VALUES (1), (2)) v(run)), r AS (SELECT *, {_OFF} AS off, {', '.join(f'{t} AS has_{k}' for k, t in _PROPS.items())}, {_CHAR} AS style FROM r0)
"""
)


@query(
    _RUNS
    + """, c AS (SELECT 'removed' AS bucket, 'i' AS name FROM r WHERE has_i UNION ALL SELECT 'removed', 'b' FROM r WHERE has_b UNION ALL SELECT 'removed', 'color' FROM r WHERE has_color UNION ALL SELECT 'mapped', CASE style WHEN 'em' THEN 'Emphasis->Char Курсив' ELSE 'Strong->Char Полужирный' END FROM r WHERE style IN ('em', 'st') UNION ALL SELECT 'removed_style', style FROM r WHERE style = 'zz')
SELECT bucket, name, count(*) AS n FROM c GROUP BY ALL"""
)
def style_enforcement(spark, sf_dir):
    """How many direct properties and character styles are taken away or mapped when the house's styles are enforced."""
    styles = spark.createDataFrame([(1, k, name, props) for k, (name, props) in _RUN_STYLES.items()], "house int, style_id string, style_name string, props map<string,string>")
    x = pp.enforced_runs(property_runs(spark, sf_dir).withColumn("house", F.lit(1)), styles, "house")
    return pp.counters(x, {"removed": F.col("removed"), "mapped": F.array_compact(F.array("mapped")), "removed_style": F.array_compact(F.array("removed_style"))})


@query(
    _RUNS
    + f""", s AS (SELECT *, CASE style {' '.join(f"WHEN '{k}' THEN '{n}'" for k, (n, _) in _RUN_STYLES.items())} ELSE coalesce(style, '') END AS name FROM r),
o AS (SELECT *, has_i AND NOT off AS i, has_b AND NOT off AS b FROM s), k AS (SELECT doc_id, block_index, 'run_override' AS kind, i::INT + b::INT + has_color::INT AS n FROM o UNION ALL SELECT doc_id, block_index, 'manual_emphasis_without_char_style', (i AND name <> '{pp.ITALIC}')::INT + b::INT FROM o
 UNION ALL SELECT doc_id, block_index, 'noncanonical_character_style', (name NOT IN ('', '{pp.ITALIC}'))::INT FROM o UNION ALL SELECT doc_id, block_index, 'paragraph_override', (block_index % 3 = 0)::INT FROM b UNION ALL SELECT doc_id, block_index, 'noncanonical_paragraph_style', (kind = 'list_bulleted')::INT FROM b),
g AS (SELECT doc_id, block_index, kind, sum(n) AS n FROM k GROUP BY ALL HAVING sum(n) > 0) SELECT kind, count(*) AS paragraphs, sum(n)::BIGINT AS found FROM g GROUP BY kind"""
)
def style_audit(spark, sf_dir):
    """Findings of formatting by kind: paragraphs that have them, and how many in all."""
    b = document_blocks(spark, sf_dir)
    p = b.select("doc_id", "block_index", F.when(F.col("kind") == "list_bulleted", "List Bullet").otherwise("Normal").alias("style_name"), F.when(F.col("block_index") % 3 == 0, F.create_map(F.lit("ind"), F.lit("1"))).otherwise(F.expr("cast(map() as map<string,string>)")).alias("props"))
    names = F.create_map(*[F.lit(x) for k, (n, _) in _RUN_STYLES.items() for x in (k, n)])
    style = F.try_element_at("props", F.lit("rStyle"))
    r = property_runs(spark, sf_dir).withColumns({"char_style": F.coalesce(F.try_element_at(names, style), style), "fonts": F.array().cast("array<string>")})
    x = pp.audit(p, r, ["doc_id", "block_index"], "Gaura Times", ["Normal"])
    return x.groupBy("kind").agg(F.count("*").alias("paragraphs"), F.sum(F.aggregate(F.map_values("counts"), F.lit(0).cast("long"), lambda a, v: a + v)).alias("found"))
