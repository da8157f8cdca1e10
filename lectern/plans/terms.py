"""Pairing, glossary and review decisions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lectern.functions import hints as hn
from lectern.functions import text as tx
from lectern.operators import candidates as cd
from lectern.operators import glossary as gl
from lectern.operators import glossary_tables as gt
from lectern.operators import issues as iss
from lectern.operators import pairing as pr
from lectern.operators.folders import new_folder, stored
from lectern.sources.tables import table

from .blocks import BLOCKS, ISSUES, document_blocks, stylistic
from .registry import registry

QUERIES, ORACLE, query = registry()


# ---- pairing: documents are the source side, their labels the target side ------------------------


@query("SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'source_only' WHEN d.doc_id IS NULL THEN 'target_only' ELSE 'both' END AS side, d.lang, l.quality FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id")
def chapter_pairing(spark, sf_dir):
    return pr.paired(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels").select("doc_id", "quality"), ["doc_id"])


@query("SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)")
def pair_inner(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "lang", "quality", "toxic")


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def source_only(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")


@query("SELECT doc_id, quality FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE l.doc_id = d.doc_id)")
def target_only(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id", "quality").join(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", "left_anti")


@query("SELECT d.doc_id, l.quality, p.url, p.page_id IS NULL AS optional_missing FROM documents d JOIN labels l USING (doc_id) LEFT JOIN pages p ON p.page_id = d.doc_id")
def three_way_pairing(spark, sf_dir):
    optional = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), "url")
    return pr.three_way(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id", "quality"), optional, ["doc_id"])


@query("SELECT 'source' AS side, count(*) AS n FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels) UNION ALL SELECT 'only', count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)")
def key_sets(spark, sf_dir):
    d, l = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id")
    return d.intersect(l).agg(F.count("*").alias("n")).select(F.lit("source").alias("side"), "n").unionByName(d.exceptAll(l).distinct().agg(F.count("*").alias("n")).select(F.lit("only").alias("side"), "n"))


# ---- phrases and hints ---------------------------------------------------------------------------

#: (discouraged form, the form to use): stand-ins, as the tables have no glossary.
FORMS = [("the the", "the"), ("of of", "of"), ("Than", "than"), ("and and", "and"), ("la la", "la"), ("der", "die"), ("is", "are"), ("to to", "to")]
#: (lemma, form): where the source has the lemma, the target needs the form.
TERMS = [("the", "and"), ("of", "of"), ("la", "de"), ("en", "el"), ("die", "der"), ("is", "in")]
_B = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"


@query(BLOCKS + "SELECT doc_id, block_index, phrase, form FROM b JOIN (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in FORMS) + rf") AS f(phrase, form) ON regexp_matches(text, '{_B[0]}' || phrase || '{_B[1]}')")
def glossary_discouraged(spark, sf_dir):
    """Every block and discouraged form that it holds as a whole phrase, case kept."""
    forms = spark.createDataFrame(FORMS, "phrase string, form string")
    return pr.phrase_hits(document_blocks(spark, sf_dir), forms, ["doc_id", "block_index"])


@query("WITH p AS (SELECT conv_id, turn, text AS source, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS target FROM conversations) SELECT conv_id, turn, lemma, form FROM p JOIN (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in TERMS) + rf") AS t(lemma, form) ON target IS NOT NULL AND len(regexp_extract_all(source, '\S+')) <= 45 AND regexp_matches(lower(source), '{_B[0]}' || lemma || '{_B[1]}') AND NOT regexp_matches(lower(target), '{_B[0]}' || form || '{_B[1]}')")
def protected_term_gap(spark, sf_dir):
    """A short message that holds a lemma whose form the next message lacks."""
    m = table(spark, sf_dir, "conversations").withColumn("target", F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))).where("target is not null")
    m = m.where(tx.word_count(tx.clean(F.col("text"))) <= 45)
    terms = spark.createDataFrame(TERMS, "phrase string, form string")
    found = pr.phrase_hits(m, terms, ["conv_id", "turn", "target"], ignore_case=True)
    there = F.concat(F.lit(r"(?<![\p{L}\p{N}_])\Q"), "form", F.lit(r"\E(?![\p{L}\p{N}_])"))
    return found.where(F.regexp_count(F.lower("target"), there) == 0).select("conv_id", "turn", F.col("phrase").alias("lemma"), "form")


HINTS = [("index", "3", "ignore"), ("regex", "[0-9]{3}", "review_only"), ("text", "the.", "set_style"), ("regex", "[|]", "set_style"), ("index", "7", "review_only")]


@query(BLOCKS + "SELECT doc_id, block_index, CASE WHEN block_index = 3 THEN 0 WHEN regexp_matches(text, '[0-9]{3}') THEN 1 WHEN lower(text) = 'the.' THEN 2 WHEN regexp_matches(text, '[|]') THEN 3 WHEN block_index = 7 THEN 4 END AS rule FROM b WHERE block_index IN (3, 7) OR regexp_matches(text, '[0-9]{3}|[|]') OR lower(text) = 'the.'")
def hint_first_match(spark, sf_dir):
    b = document_blocks(spark, sf_dir).withColumn("rule", pr.first_rule(None, HINTS, "block_index", "text"))
    return b.where("rule is not null").select("doc_id", "block_index", "rule")


# ---- term candidates: lines of documents, some of which explain a term or have italics --------------------------------

#: Heads of entries and italic fragments, taken in turn; some are no terms, or not all of them.
HEADS = ("Вриндаван", "Вриндавана", "Майяпур (Навадвип, Пури)", "Бхакти-йога, преданное служение", "Шри Кришна", "Веданта", "Веды", "Ашрам", "СССР", "Дом", "и веда", "Говинда (ISKCON)", "Харе Кришна", "Радха-кунд", "Майяпур")
ITALICS = ("бхакти", "санньяси", "вайшнавы", "Гуны", "гуна", "экадаши,", "слово", "шри", "вриндаван", "лила 5", "ведический", "веда/веды", "Харе кришна", "бхакти-лата", "ачарьев", "дхама", "Гуна", "-юга", "bhakti", "майапур", "ашрамы", "чайтанья-чаритамриты")
_HEAD_OF = f"list_extract([{', '.join(f"'{h}'" for h in HEADS)}], CAST((3 * doc_id + block_index) % {len(HEADS)} + 1 AS INT))"
_FRAGMENT = f"list_extract([{', '.join(f"'{h}'" for h in ITALICS)}], CAST((5 * doc_id + 7 * block_index + _N_) % {len(ITALICS)} + 1 AS INT))"


def glossary_blocks(spark, sf_dir):
    """Every third block explains a term, every second has one or two italic fragments."""
    b = document_blocks(spark, sf_dir)
    pick = lambda words, n: F.get(F.array(*map(F.lit, words)), (n % len(words)).cast("int"))
    d, i = F.col("doc_id"), F.col("block_index")
    text = F.when(i % 3 == 0, F.concat(pick(HEADS, 3 * d + i), F.when(i % 2 == 0, " — ").otherwise(" – "), "text")).otherwise(F.col("text"))
    one, two = pick(ITALICS, 5 * d + 7 * i), pick(ITALICS, 5 * d + 7 * i + 3)
    italics = F.when(i % 4 == 0, F.array(one, two)).when(i % 2 == 0, F.array(one)).otherwise(F.array().cast("array<string>"))
    return b.select("doc_id", "lang", "block_index", text.alias("text"), italics.alias("italics"))


def _said(group: str) -> str:
    stems = [hn.plain_key(h) for h in hn.HINTS[group]]
    return "(" + " OR ".join([f"len(list_filter(parts, lambda p: {' OR '.join(f'starts_with(p, {chr(39)}{h}{chr(39)})' for h in stems if ' ' not in h)})) > 0"] + [rf"regexp_matches(k, '(^|[^a-zа-яё]){h}($|[^a-zа-яё])')" for h in stems if " " in h]) + ")"


def _base_sql() -> str:
    """The first hint that stands for a key `k`."""
    out, skip = [], {hn.plain_key(h) for h in hn.NO_BASE}
    for h in [h for stems in hn.HINTS.values() for h in stems if " " not in h]:
        norm, fits = hn.plain_key(h), []
        if norm not in skip:
            fits += [f"starts_with(k, '{norm}')"] if len(norm) >= 5 else []
            fits += [f"starts_with(k, '{norm[:-1]}')"] if len(norm) >= 6 and norm[-1] in hn.VOWELS else []
        free = "" if "-" in norm else "NOT contains(k, '-') AND "
        out.append(f"WHEN k = '{norm}'" + (f" OR {free}({' OR '.join(fits)})" if fits else "") + f" THEN '{h}'")
    return "CASE WHEN contains(k, ' ') THEN '' " + " ".join(out) + " ELSE '' END"


_KEY = "replace(lower(translate(V, 'йЙёЁ', 'иИеЕ')), '–', '-')"
_EDGES = "trim(regexp_replace(regexp_replace(trim(V), '^[\"''«„“”]+', ''), '[\"''»“”.,;:!?]+$', ''))"
_CANDIDATES = (
    BLOCKS
    + rf""", gb AS (SELECT doc_id, lang, block_index, CASE WHEN block_index % 3 = 0 THEN {_HEAD_OF} || CASE WHEN block_index % 2 = 0 THEN ' — ' ELSE ' – ' END || text ELSE text END AS text,
 CASE WHEN block_index % 4 = 0 THEN [{_FRAGMENT.replace('_N_', '0')}, {_FRAGMENT.replace('_N_', '3')}] WHEN block_index % 2 = 0 THEN [{_FRAGMENT.replace('_N_', '0')}] ELSE []::VARCHAR[] END AS italics FROM b),
t0 AS (SELECT *, {_EDGES.replace('V', 'text')} AS clean FROM gb), h0 AS (SELECT *, {_EDGES.replace('V', "regexp_extract(clean, '^([A-ZА-ЯЁ«][^—–-]{1,120}?)[ ]+[—–-][ ]+.+$', 1)")} AS head FROM t0 WHERE length(clean) <= 240),
h1 AS (SELECT *, string_split(head, ' ') AS ws FROM h0 WHERE head <> ''), h2 AS (SELECT * FROM h1 WHERE len(ws) <= 4 AND lower(ws[1]) NOT IN ({', '.join(f"'{c}'" for c in hn.CONJUNCTIONS)}) AND NOT (len(ws) > 1 AND regexp_matches(ws[1], '^\p{{Ll}}') AND NOT regexp_matches(head, '[-(]'))),
h3 AS (SELECT doc_id, lang, block_index, clean[1:120] AS context, list_distinct(list_filter(list_concat([head], CASE WHEN regexp_matches(head, '^[^()]+\([^()]+\)$') THEN list_concat([trim(regexp_extract(head, '^([^()]+)\(', 1))], list_transform(regexp_split_to_array(regexp_extract(head, '\(([^()]+)\)$', 1), '[,;/]'), lambda x: trim(x))) ELSE []::VARCHAR[] END,
 CASE WHEN contains(head, ',') AND length(head) <= 80 THEN list_filter(list_transform(string_split(head, ','), lambda x: trim(x)), lambda x: len(string_split(x, ' ')) <= 4) ELSE []::VARCHAR[] END), lambda x: x <> '')) AS vs FROM h2),
i0 AS (SELECT doc_id, lang, block_index, unnest(italics) AS raw, unnest(range(len(italics))) AS pos FROM gb), i1 AS (SELECT *, {_EDGES.replace('V', 'raw')} AS variant FROM i0),
u AS (SELECT doc_id, lang, block_index, 'glossary_headword' AS kind, false AS italic, variant, context FROM (SELECT *, unnest(vs) AS variant FROM h3) UNION ALL SELECT doc_id, lang, block_index, 'italic', true, variant, variant[1:120] FROM i1),
ff AS (SELECT * FROM u WHERE length(variant) BETWEEN 2 AND 120 AND length(variant) - length(replace(variant, ' ', '')) <= 8 AND NOT (upper(regexp_replace(variant, '[^A-Za-zА-Яа-яЁё]', '', 'g')) = regexp_replace(variant, '[^A-Za-zА-Яа-яЁё]', '', 'g') AND length(regexp_replace(variant, '[^A-Za-zА-Яа-яЁё]', '', 'g')) BETWEEN 1 AND 5)
 AND NOT regexp_matches(variant, '[<>()@\dA-Za-z]') AND regexp_matches(variant, '^[А-Яа-яЁё]') AND (NOT italic OR (length(variant) - length(replace(variant, ' ', '')) <= 2 AND NOT regexp_matches(variant, '[,;:/.…]|-$')))),
n0 AS (SELECT *, {_KEY.replace('V', 'variant')} AS k FROM (SELECT DISTINCT variant FROM ff)), n1 AS (SELECT *, flatten(list_transform(regexp_extract_all(k, '[a-zа-яё-]+'), lambda w: list_concat([w], string_split(w, '-')))) AS parts FROM n0),
nn AS (SELECT variant, k, CASE {' '.join(f"WHEN {_said(g)} THEN '{g}'" for g in hn.HINTS)} END AS category, {_base_sql()} AS base FROM n1),
c AS (SELECT CASE WHEN base <> '' THEN {_KEY.replace('V', 'base')} ELSE k END AS key, ff.variant, lang AS source_label, category, kind, italic, doc_id AS file, lang || ':' || doc_id || ':' || context AS example, (doc_id * 100000 + block_index * 10 + CASE WHEN italic THEN 5 ELSE 0 END)::BIGINT AS seen FROM ff JOIN nn ON nn.variant = ff.variant WHERE category IS NOT NULL)"""
)


def candidates(spark, sf_dir):
    found = cd.from_blocks(glossary_blocks(spark, sf_dir), cd.hint_table(spark), ["doc_id", "lang", "block_index"])
    return found.select(
        "key", "variant", F.col("lang").alias("source_label"), "category", "kind", "italic", F.col("doc_id").alias("file"), F.concat_ws(":", "lang", F.col("doc_id").cast("string"), "context").alias("example"),
        (F.col("doc_id") * 100000 + F.col("block_index") * 10 + F.when(F.col("italic"), 5).otherwise(0)).alias("seen"),
    )


def stored_candidates(spark, sf_dir):
    """candidates, written once: several aggregations rest on them, and each would extract them anew."""
    return stored(candidates(spark, sf_dir), f"{new_folder(spark, 'terms')}/candidates")


@query(_CANDIDATES + " SELECT key, variant, source_label, category, kind, italic, file, example FROM c")
def term_candidates(spark, sf_dir):
    """Every term that an entry explains or that stands in italics, with its key and category."""
    return candidates(spark, sf_dir).drop("seen")


_AGGREGATE = _CANDIDATES + """, v AS (SELECT key, variant, count(*) AS n, min(seen) AS first FROM c GROUP BY key, variant),
rv AS (SELECT key, count(*) AS variant_count, string_agg(variant || ' [' || n || ']', ' | ' ORDER BY n DESC, first) AS variants FROM v GROUP BY key),
e AS (SELECT key, example, min(seen) AS s FROM c GROUP BY key, example), e5 AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY s) AS k FROM e),
ex AS (SELECT key, string_agg(example, ' | ' ORDER BY s) AS examples FROM e5 WHERE k <= 5 GROUP BY key),
g AS (SELECT key, category, row_number() OVER (PARTITION BY key ORDER BY count(*) DESC, min(seen)) AS k FROM c GROUP BY key, category),
base AS (SELECT key, count(*) AS n, count(*) FILTER (italic) AS italic_count, count(*) FILTER (NOT italic) AS plain_count, count(DISTINCT file) AS files, count(*) FILTER (kind = 'glossary_headword') AS headwords FROM c GROUP BY key),
a AS (SELECT base.*, g.category, ex.examples, rv.variant_count, rv.variants FROM base JOIN g ON g.key = base.key AND g.k = 1 JOIN ex ON ex.key = base.key JOIN rv ON rv.key = base.key),
t AS (SELECT *, CASE WHEN italic_count > 0 AND plain_count > 0 THEN 'conditional' WHEN italic_count > 0 THEN 'yes' ELSE 'no' END AS italic_required FROM a)"""


@query(_AGGREGATE + " SELECT key, n, italic_count, plain_count, files, headwords, category, examples, variant_count, variants FROM a")
def candidate_aggregate(spark, sf_dir):
    return gl.candidate_aggregate(stored_candidates(spark, sf_dir)).select("key", "n", "italic_count", "plain_count", "files", "headwords", "category", "examples", "variant_count", "variants")


@query(
    _CANDIDATES
    + f""", v AS (SELECT key, variant, count(*) AS n FROM c GROUP BY key, variant), w AS (SELECT v.*, nn.k = key AS own, nn.k = key OR (nn.base <> '' AND {_KEY.replace('V', 'nn.base')} = key) AS fits FROM v JOIN nn ON nn.variant = v.variant)
SELECT key, variant AS approved_form FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY NOT fits, CASE WHEN fits THEN NOT own ELSE false END, CASE WHEN fits THEN 0 ELSE -n END, length(variant), regexp_matches(variant, '^[А-ЯA-Z]'), -n, variant) AS k FROM w) WHERE k = 1"""
)
def approved_form(spark, sf_dir):
    hint = F.when(F.col("base") != "", hn.normal_key(F.col("base")))
    found = stored_candidates(spark, sf_dir)
    known = cd.described(found, cd.hint_table(spark), "variant").select(F.col("term").alias("variant"), F.col("key").alias("own_key"), hint.alias("hint_key"))
    return gl.approved_form(found.join(known, "variant"), F.col("own_key"), F.col("hint_key"))


def _terms(spark, sf_dir):
    """Terms, written once: what asks for them joins, numbers or groups them."""
    folder = new_folder(spark, "terms")
    a = gl.candidate_aggregate(stored(candidates(spark, sf_dir), f"{folder}/candidates"))
    a = stored(a, f"{folder}/aggregate")
    return a.withColumn("italic_required", gl.italic_policy(F.col("italic_count"), F.col("plain_count")))


@query(_AGGREGATE + " SELECT key, variant_count, variants, italic_required FROM t WHERE variant_count > 1 OR italic_required = 'conditional'")
def glossary_conflicts(spark, sf_dir):
    return _terms(spark, sf_dir).where("variant_count > 1 or italic_required = 'conditional'").select("key", "variant_count", "variants", "italic_required")


#: All terms with what the exchanged tables say of them; English and French stand for the primary sources.
_SHEET = _AGGREGATE + f""", av AS (SELECT key, variant, count(*) AS n FROM c GROUP BY key, variant), aw AS (SELECT av.*, nn.k = key AS own, nn.k = key OR (nn.base <> '' AND {_KEY.replace('V', 'nn.base')} = key) AS fits FROM av JOIN nn ON nn.variant = av.variant),
ap AS (SELECT key, variant AS approved_form FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY NOT fits, CASE WHEN fits THEN NOT own ELSE false END, CASE WHEN fits THEN 0 ELSE -n END, length(variant), regexp_matches(variant, '^[А-ЯA-Z]'), -n, variant) AS k FROM aw) WHERE k = 1),
sn AS (SELECT key, source_label, count(*) AS n, min(seen) AS s FROM c GROUP BY ALL), sr AS (SELECT key, string_agg(source_label || ' [' || n || ']', ' | ' ORDER BY n DESC, s) AS sources, arg_min(source_label, s) AS preferred_source, bool_or(source_label IN ('en', 'fr')) AS supported FROM sn GROUP BY key),
sh AS (SELECT t.*, 'term-' || lpad((row_number() OVER (ORDER BY t.key))::VARCHAR, 5, '0') AS id, ap.approved_form, sr.sources, sr.preferred_source, sr.supported, 'no_diacritics_in_prose' AS diacritics_policy FROM t JOIN ap USING (key) JOIN sr USING (key)),
ba AS (SELECT id, approved_form AS lemma_ru, '' AS lemma_en, category, approved_form, '' AS declension_notes, italic_required, diacritics_policy, '' AS capitalization_notes, variants AS variants_found, preferred_source, examples AS source_examples, '' AS editor_decision, CASE WHEN variant_count > 1 OR italic_required = 'conditional' THEN 'needs_review' ELSE 'draft' END AS status, 'auto-generated draft' AS notes FROM sh WHERE supported),
co AS (SELECT key AS normalized_key, approved_form, variant_count, variants, italic_required, diacritics_policy, sources, examples FROM sh WHERE supported AND (variant_count > 1 OR italic_required = 'conditional'))"""


def _sheet(spark, sf_dir):
    """Candidates and terms are written once: a dozen aggregations rest on them."""
    folder = new_folder(spark, "glossary")
    found = stored(candidates(spark, sf_dir), f"{folder}/candidates")
    known = stored(cd.described(found, cd.hint_table(spark), "variant"), f"{folder}/described")
    own = known.select(F.col("term").alias("variant"), F.col("key").alias("own_key"), F.when(F.col("base") != "", hn.normal_key(F.col("base"))).alias("hint_key"))
    approved = gl.approved_form(found.join(own, "variant"), F.col("own_key"), F.col("hint_key"))
    return stored(gt.terms(found, stored(approved, f"{folder}/approved"), ("en", "fr")), f"{folder}/terms")


@query(_SHEET + " SELECT * FROM ba")
def glossary_base(spark, sf_dir):
    """The glossary's draft with all its columns."""
    return gt.base_rows(_sheet(spark, sf_dir))


@query(_SHEET + " SELECT * FROM co")
def glossary_conflict_rows(spark, sf_dir):
    """Terms in conflict with all columns of their table."""
    return gt.conflict_rows(_sheet(spark, sf_dir))


@query(_SHEET + """, lc AS (SELECT lower(approved_form) AS k, arg_max({'v': variants, 's': sources}, normalized_key) AS c FROM co GROUP BY 1)
SELECT ba.*, lower(approved_form) AS normalized_key, CASE WHEN c IS NULL THEN 'no' ELSE 'yes' END AS conflict_flag, coalesce(c.v, '') AS conflict_variants, coalesce(c.s, '') AS conflict_sources,
CASE WHEN category IN ('personal_name', 'place_name', 'scripture_title', 'philosophical_term', 'honorific') THEN CASE WHEN status = 'needs_review' OR c IS NOT NULL THEN 'high' ELSE 'medium' END WHEN status = 'needs_review' OR c IS NOT NULL THEN 'medium' ELSE 'low' END AS review_priority,
CASE WHEN category IN ('personal_name', 'place_name', 'scripture_title', 'philosophical_term', 'honorific') AND NOT (status = 'needs_review' OR c IS NOT NULL) THEN 'keep' ELSE 'review' END AS suggested_action,
'' AS decision, '' AS approved_form_override, '' AS category_override, '' AS italic_required_override, '' AS diacritics_policy_override, '' AS merge_into, '' AS review_notes FROM ba LEFT JOIN lc ON lc.k = lower(approved_form)""")
def glossary_review_rows(spark, sf_dir):
    """The review sheet with all its columns."""
    s = _sheet(spark, sf_dir)
    return gt.review_rows(gt.base_rows(s), gt.conflict_rows(s))


@query(_AGGREGATE + " SELECT id, key FROM (SELECT 'term-' || lpad((row_number() OVER (ORDER BY key))::VARCHAR, 5, '0') AS id, * FROM t) WHERE headwords > 0 OR category <> 'other'")
def numbered_terms(spark, sf_dir):
    """Ids over all sorted keys, then only terms with high signal: ids have gaps."""
    return gl.numbered_terms(_terms(spark, sf_dir)).where("headwords > 0 or category <> 'other'").select("id", "key")


_TRIAGE = "CASE WHEN conflict AND high THEN 'review/high' WHEN conflict THEN 'review/medium' WHEN high THEN 'keep/medium' WHEN italic_required = 'conditional' THEN 'review/medium' ELSE 'review/low' END"


@query(_AGGREGATE + f", r AS (SELECT *, variant_count > 1 OR italic_required = 'conditional' AS conflict, category <> 'other' AS high FROM t) SELECT key, conflict, {_TRIAGE} AS suggestion FROM r")
def review_triage(spark, sf_dir):
    t = _terms(spark, sf_dir)
    conflicts = t.where("variant_count > 1 or italic_required = 'conditional'").select("key", F.lit(True).alias("c"))
    x = t.join(conflicts, "key", "left").withColumn("conflict", F.coalesce("c", F.lit(False)))
    s = gl.triage(F.col("key"), F.col("category"), F.col("italic_required"), F.lit(""), F.when(F.col("conflict"), "needs_review").otherwise("draft"), F.col("conflict"))
    return x.withColumn("s", s).select("key", "conflict", F.concat_ws("/", "s.action", "s.priority").alias("suggestion"))


@query(_AGGREGATE + f", r AS (SELECT *, variant_count > 1 OR italic_required = 'conditional' AS conflict, category <> 'other' AS high FROM t), s AS (SELECT category, {_TRIAGE} AS suggestion FROM r) SELECT category, suggestion, count(*) AS n FROM s GROUP BY GROUPING SETS ((category), (suggestion), ())")
def review_histograms(spark, sf_dir):
    t = _terms(spark, sf_dir).withColumn("conflict", F.expr("variant_count > 1 or italic_required = 'conditional'"))
    s = gl.triage(F.col("key"), F.col("category"), F.col("italic_required"), F.lit(""), F.when(F.col("conflict"), "needs_review").otherwise("draft"), F.col("conflict"))
    x = t.select("category", s.alias("s")).select("category", F.concat_ws("/", "s.action", "s.priority").alias("suggestion"))
    return x.groupingSets([["category"], ["suggestion"], []], "category", "suggestion").agg(F.count("*").alias("n"))


# Decisions: labels are the reviewers' sheet. Quality 1 keeps, toxic drops, the rest merge into their language or wait.
_DECISIONS = "WITH d AS (SELECT doc_id, lang, source, quality, toxic, CASE WHEN toxic = 1 THEN 'drop' WHEN quality = 1 THEN 'keep' WHEN lang = 'en' THEN 'merge' WHEN lang = 'fr' THEN 'defer' ELSE 'Merge ' END AS decision, CASE WHEN lang IN ('en', 'de') THEN 'all_' || lang ELSE '' END AS merge_into FROM documents JOIN labels USING (doc_id)), o AS (SELECT *, CASE WHEN decision = 'drop' THEN 'dropped' WHEN decision = 'keep' OR (lower(trim(decision)) = 'merge' AND merge_into <> '') THEN 'approved' ELSE 'pending' END AS outcome FROM d)"


def decided(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(table(spark, sf_dir, "labels"), "doc_id")
    lang = F.col("lang")
    d = d.withColumn("decision", F.when(F.col("toxic") == 1, "drop").when(F.col("quality") == 1, "keep").when(lang == "en", "merge").when(lang == "fr", "defer").otherwise("Merge "))
    d = d.withColumn("merge_into", F.when(lang.isin("en", "de"), F.concat(F.lit("all_"), lang)).otherwise(""))
    return d.withColumn("outcome", gl.outcome(F.col("decision"), F.col("merge_into")))


@query(_DECISIONS + " SELECT doc_id, decision, outcome FROM o")
def apply_review(spark, sf_dir):
    return decided(spark, sf_dir).select("doc_id", "decision", "outcome")


@query(_DECISIONS + ", a AS (SELECT *, CASE WHEN decision = 'keep' THEN source ELSE merge_into END AS target FROM o WHERE outcome = 'approved'), n AS (SELECT target, source, min(doc_id) AS f FROM a GROUP BY target, source) SELECT a.target, count(*) AS rows, arg_min(a.lang, a.doc_id) AS lang, any_value(s.sources) AS source FROM a JOIN (SELECT target, string_agg(source, ' | ' ORDER BY f) AS sources FROM n GROUP BY target) s ON s.target = a.target GROUP BY a.target")
def merge_review_groups(spark, sf_dir):
    a = decided(spark, sf_dir).where("outcome = 'approved'").withColumn("target", F.when(F.col("decision") == "keep", F.col("source")).otherwise(F.col("merge_into")))
    return gl.merged_groups(a.select("target", "doc_id", "lang", "source"), "target", "doc_id", ["source"])


# ---- bundles and anchors -------------------------------------------------------------------------


@query(ISSUES + "SELECT 'documents' AS target_path, ['labels', 'style'] AS source_reports, (SELECT count(*) FROM f) + (SELECT count(*) FROM labels WHERE toxic = 1) AS issues")
def bundle_merge(spark, sf_dir):
    """Two producers' issues in one bundle."""
    one = stylistic(document_blocks(spark, sf_dir)).select("doc_id", "kind", "severity", F.lit("documents").alias("target"), F.lit("style").alias("report"))
    two = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id", F.lit("label_toxic").alias("kind"), F.lit("error").alias("severity"), F.lit("").alias("target"), F.lit("labels").alias("report"))
    return iss.bundle_header(iss.merged([two, one]), "target", "report")


_ANCHORS = ISSUES + ", q AS (SELECT doc_id, kind, paragraph_index + CASE WHEN severity = 'info' THEN 2 ELSE 0 END AS paragraph_index FROM f)"


def _anchored(spark, sf_dir):
    f = stylistic(document_blocks(spark, sf_dir))
    return f.select("doc_id", "kind", (F.col("paragraph_index") + F.when(F.col("severity") == "info", 2).otherwise(0)).alias("paragraph_index"))


@query(_ANCHORS + " SELECT q.doc_id, q.kind, q.paragraph_index, CASE WHEN p.doc_id IS NULL THEN 'skipped' ELSE 'applied' END AS status FROM q LEFT JOIN (SELECT DISTINCT doc_id, paragraph_index FROM lines) p ON p.doc_id = q.doc_id AND p.paragraph_index = q.paragraph_index")
def apply_validation(spark, sf_dir):
    """Issues whose anchor was moved are applied only where such a paragraph is."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("p", "line")).select("doc_id", (F.col("p") + 1).alias("paragraph_index"))
    return iss.applied_or_skipped(_anchored(spark, sf_dir), lines, ["doc_id", "paragraph_index"]).select("doc_id", "kind", "paragraph_index", "status")


@query(ISSUES + "SELECT doc_id, kind, block_index, row_number() OVER (PARTITION BY doc_id ORDER BY block_index, kind) - 1 AS stack, (760.0 - 24.0 * (row_number() OVER (PARTITION BY doc_id ORDER BY block_index, kind) - 1))::DOUBLE AS y FROM f")
def annotation_layout(spark, sf_dir):
    x = iss.stacked(stylistic(document_blocks(spark, sf_dir)), "doc_id", ["block_index", "kind"])
    return x.select("doc_id", "kind", "block_index", F.col("stack").cast("long").alias("stack"), F.element_at("rect", 2).alias("y"))
