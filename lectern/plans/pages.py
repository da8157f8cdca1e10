"""Page manifest, links and blocks over `pages`; references over `conversations`."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import forms as fm
from lectern.functions import text as tx
from lectern.operators import references as rf
from lectern.sources import html as h
from lectern.sources.tables import table, with_features

from .registry import registry

QUERIES, ORACLE, query = registry()


LINKS = """regexp_extract_all(html, 'href="(/[^"]*)"', 1)"""
PATH = r"regexp_extract(url, '://[^/?#]*([^?#]*)', 1)"


@query(f"SELECT page_id, unnest({LINKS}) AS href FROM pages")
def page_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(h.absolute_links(F.col("html"))).alias("href"))


_PARTS = f"list_filter(string_split({PATH}, '/'), lambda x: x <> '')"


# Of each page the parent of its own path stands in for the chapter above it, so that chapters have verses below them.
@query(f"""WITH p AS (SELECT page_id, html, CASE WHEN len({_PARTS}) > 0 THEN '/' || array_to_string({_PARTS}, '/') || '/' ELSE '' END AS own FROM pages), w AS (SELECT page_id, html, regexp_replace(own, '/(\\d+)[^/]*/$', '/\\1/') AS web_path FROM p),
u AS (SELECT page_id, html, CASE WHEN page_id % 5 = 0 THEN regexp_replace(web_path, '[^/]+/$', '') WHEN page_id % 7 = 0 THEN regexp_replace(web_path, '[^/]+/$', 'advanced-view/') ELSE web_path END AS web_path FROM w),
c AS (SELECT regexp_replace(web_path, '[^/]+/$', '') AS parent, bool_or(web_path LIKE '%/advanced-view/') AS has_view, count(*) FILTER (regexp_matches(web_path, '/\\d+(-\\d+)?/$')) AS verses FROM u GROUP BY 1)
SELECT page_id, regexp_extract(html, '<html[^>]* lang="([^"]*)"', 1) AS lang, regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1) AS title, regexp_extract(html, '<h1[^>]*>([^<]*)</h1>', 1) AS h1, len({LINKS}) AS links, len(list_distinct({LINKS})) AS distinct_links,
CASE WHEN regexp_matches(web_path, '/\\d+(-\\d+)?/$') OR web_path LIKE '%/advanced-view/' OR web_path = '' THEN NULL WHEN has_view THEN 'advanced_view' WHEN verses > 0 THEN 'verse_pages' END AS assembly_mode FROM u LEFT JOIN c ON c.parent = u.web_path""")
def page_manifest(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    links, i = h.absolute_links(F.col("html")), F.col("page_id")
    own = F.regexp_replace(fm.web_path(F.regexp_extract("url", "://[^/?#]*([^?#]*)", 1)), r"/(\d+)[^/]*/$", "/$1/")
    path = F.when(i % 5 == 0, F.regexp_replace(own, "[^/]+/$", "")).when(i % 7 == 0, F.regexp_replace(own, "[^/]+/$", "advanced-view/")).otherwise(own)
    p = p.select("page_id", h.language(F.col("html")).alias("lang"), h.first_tag(F.col("html"), "title").alias("title"), h.first_tag(F.col("html"), "h1").alias("h1"), links.alias("l"), path.alias("web_path"))
    return h.assembled(p, "web_path").select("page_id", "lang", "title", "h1", F.size("l").cast("long").alias("links"), F.size(F.array_distinct("l")).cast("long").alias("distinct_links"), "assembly_mode")


@query(f"""WITH p AS (SELECT page_id, {_PARTS} AS parts FROM pages) SELECT page_id, parts[1] AS locale, parts[2] AS work_id, CASE WHEN len(parts) = 0 THEN 'root' WHEN len(parts) = 1 THEN 'locale' WHEN regexp_matches(parts[len(parts)], '^\\d+(-\\d+)?(\\.html)?$') THEN 'verse' ELSE 'chapter' END AS page_type, len(parts) AS path_depth FROM p""")
def page_paths(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", h.path_info(F.regexp_extract("url", "://[^/?#]*([^?#]*)", 1)).alias("i"))
    return p.select("page_id", "i.locale", "i.work_id", "i.page_type", F.col("i.path_depth").cast("long").alias("path_depth"))


@query(f"""WITH p AS (SELECT {_PARTS} AS parts, regexp_extract(html, '<html[^>]* lang="([^"]*)"', 1) AS lang FROM pages), q AS (SELECT parts[1] AS locale, lang, CASE WHEN len(parts) > 1 THEN 'verse' ELSE 'chapter' END AS view FROM p) SELECT locale, lang, view, count(*) AS n FROM q GROUP BY GROUPING SETS ((locale), (lang), (view))""")
def page_type_grouping_sets(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(h.language(F.col("html")).alias("lang"), h.path_info(F.regexp_extract("url", "://[^/?#]*([^?#]*)", 1)).alias("i"))
    p = p.select("lang", "i.locale", F.when(F.col("i.path_depth") > 1, "verse").otherwise("chapter").alias("view"))
    return p.groupingSets([["locale"], ["lang"], ["view"]], "locale", "lang", "view").agg(F.count("*").alias("n"))


@query()
def page_blocks(spark, sf_dir):
    """Blocks of every page with features; by a parser, so tests hold it against a plain one."""
    b = h.html_blocks(table(spark, sf_dir, "pages"), "page_id", "html").where("error is null")
    b = with_features(b).withColumn("kind", tx.section_kind(F.col("section"), F.col("text"), F.col("kind")))
    return b.select("page_id", "block_index", "section", "kind", "word_count", "digit_signature", F.size("italics").alias("italics"))


# The tables hold no references, so each message gets two of its own.
_TEXT = "text || ' (Bg. 2 . ' || (turn + 1) || ', SB 1.1.' || conv_id || '-' || (conv_id + 1) || ')'"
_HITS = rf"""
WITH m AS (SELECT conv_id, turn, {_TEXT} AS t FROM conversations),
r AS (SELECT conv_id, turn, 'bg' AS work, unnest(regexp_extract_all(t, '(?i)(?:бг|bg)\.?\s*\d+\s*\.\s*\d+(?:\s*[-–—]\s*\d+)?')) AS raw FROM m
UNION ALL SELECT conv_id, turn, 'sb', unnest(regexp_extract_all(t, '(?i)(?:шб|sb)\.?\s*\d+\s*\.\s*\d+\s*\.\s*\d+(?:\s*[-–—]\s*\d+)?')) FROM m),
h AS (SELECT *, array_to_string(regexp_extract_all(raw, '\d+(?:-\d+)?'), '/') AS path FROM r)
"""


def _message_hits(spark, sf_dir):
    m = table(spark, sf_dir, "conversations")
    one = lambda c: F.col(c).cast("string")
    m = m.withColumn("text", F.concat("text", F.lit(" (Bg. 2 . "), (F.col("turn") + 1).cast("string"), F.lit(", SB 1.1."), one("conv_id"), F.lit("-"), (F.col("conv_id") + 1).cast("string"), F.lit(")")))
    return rf.extracted(m, ["conv_id", "turn"])


@query(_HITS + "SELECT conv_id, turn, work, raw, path, CASE work WHEN 'bg' THEN 'БГ ' ELSE 'ШБ ' END || replace(path, '/', '.') AS canonical, raw <> (CASE work WHEN 'bg' THEN 'БГ ' ELSE 'ШБ ' END || replace(path, '/', '.')) AS needs_normalization FROM h")
def reference_hits(spark, sf_dir):
    return _message_hits(spark, sf_dir).select("conv_id", "turn", "work", "raw", F.array_join("path", "/").alias("path"), "canonical", "needs_normalization")


_MIRROR = "(SELECT DISTINCT '/en/library/sb/1/1/' || page_id || '-' || (page_id + 1) || '/' AS web_path FROM pages)"


def _resolved(spark, sf_dir):
    i = F.col("page_id")
    mirror = table(spark, sf_dir, "pages").select(F.concat(F.lit("/en/library/sb/1/1/"), i.cast("string"), F.lit("-"), (i + 1).cast("string"), F.lit("/")).alias("web_path"))
    return rf.resolved(_message_hits(spark, sf_dir), mirror, rf.web_path(F.col("work"), F.col("path")))


@query(_HITS + f"SELECT conv_id, turn, work, '/en/library/' || work || '/' || path || '/' AS web_path, p.web_path IS NOT NULL AS resolved FROM h LEFT JOIN {_MIRROR} p ON p.web_path = '/en/library/' || work || '/' || path || '/'")
def reference_resolution(spark, sf_dir):
    return _resolved(spark, sf_dir).select("conv_id", "turn", "work", "web_path", "resolved")


@query(_HITS + f"SELECT work, count(*) AS total, count(p.web_path) AS resolved, count(*) - count(p.web_path) AS unresolved, count(p.web_path) AS format_candidates FROM h LEFT JOIN {_MIRROR} p ON p.web_path = '/en/library/' || work || '/' || path || '/' GROUP BY ROLLUP(work)")
def reference_rollup(spark, sf_dir):
    return rf.totals(_resolved(spark, sf_dir))
