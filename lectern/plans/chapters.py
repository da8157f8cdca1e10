"""Chapters over `pages`: each eight of them become a chapter's page, four verses, a view, and pages of other works."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.sources import chapters as ch
from lectern.sources.tables import table

from .registry import registry

QUERIES, ORACLE, query = registry()

_CHAPTER = "CAST(floor(page_id / 8) + 1 AS BIGINT)"
_PATH = """CASE page_id % 8 WHEN 0 THEN '/en/library/bg/' || c || '/' WHEN 1 THEN '/en/library/bg/' || c || '/10/' WHEN 2 THEN '/en/library/bg/' || c || '/2-3/' WHEN 3 THEN '/en/library/bg/' || c || '/1/' WHEN 4 THEN '/en/library/bg/' || c || '/4a/'
 WHEN 5 THEN CASE WHEN c % 3 = 0 THEN '/en/library/bg/' || c || '/advanced-view/' ELSE '/en/library/sb/1/' || c || '/' END WHEN 6 THEN '/en/library/sb/1/' || c || '/' || page_id || '/' ELSE '/en/library/cc/adi/' || c || '/' END"""
_LINK = "'<a href=\"/en/library/bg/' || c || '/"
_HTML = f"""CASE WHEN page_id % 8 = 5 AND c % 3 = 0 THEN '<html lang="ru"><title>View ' || c || '</title><h1>All ' || c || '</h1><div class="av-verses"><div><h2 id="t1">' || {_LINK}1/">TEXT 1</a></h2><div class="av-translation"><p>First.</p></div></div><div><h2>Text 2-3:</h2><div class="av-synonyms"><p>word — meaning</p></div><div class="av-purport"><p>Second of ' || c || '.</p><p>And more.</p></div></div></div></html>'
 WHEN page_id % 8 IN (0, 5, 7) THEN '<html lang="en"><title>Chapter ' || c || '</title><h1>Head ' || c || '</h1>' || {_LINK}1/">1</a>' || {_LINK}2-3">2</a>' || {_LINK}1/">1</a>' || {_LINK}4a/">4</a>' || CASE WHEN c % 2 = 0 THEN {_LINK}10/">10</a>' ELSE '' END || {_LINK}">up</a></html>'
 ELSE '<html><title>V</title><h1>x</h1><div class="av-translation"><p>Translation of page ' || page_id || '.</p></div><div class="av-purport"><p>Purport of page ' || page_id || ' goes on.</p><p>Page ' || page_id || '</p></div></html>' END"""


def mirror(spark, sf_dir):
    return table(spark, sf_dir, "pages").selectExpr("page_id", f"{_CHAPTER} AS c").selectExpr(f"{_PATH} AS web_path", f"{_HTML} AS html")


_SQL = f"""
WITH p AS (SELECT page_id, page_id % 8 AS r, {_CHAPTER} AS c FROM pages), q AS (SELECT *, {_PATH} AS path FROM p),
h AS (SELECT *, CASE WHEN r IN (0, 1, 2, 3, 4) OR (r = 5 AND c % 3 = 0) THEN '/en/library/bg/' || c || '/' WHEN r IN (5, 6) THEN '/en/library/sb/1/' || c || '/' ELSE path END AS chapter_path, r = 5 AND c % 3 = 0 AS is_view FROM q),
m AS (SELECT chapter_path, bool_or(is_view) AS has_view FROM h GROUP BY chapter_path),
v AS (SELECT h.chapter_path, h.page_id, h.c, CASE r WHEN 1 THEN '10' WHEN 2 THEN '2-3' WHEN 3 THEN '1' WHEN 4 THEN '4a' ELSE page_id::VARCHAR END AS verse_id, CASE r WHEN 1 THEN 10 WHEN 2 THEN 2 WHEN 3 THEN 1 WHEN 4 THEN 4 ELSE page_id END AS o, path AS source_locator FROM h JOIN m USING (chapter_path) WHERE r IN (1, 2, 3, 4, 6) AND NOT has_view),
b AS (SELECT chapter_path, verse_id, source_locator, o * 10 + k AS o, section, text FROM v, (VALUES (1, 'translation'), (2, 'purport'), (3, 'purport')) s(k, section), LATERAL (SELECT CASE k WHEN 1 THEN 'Translation of page ' || page_id || '.' WHEN 2 THEN 'Purport of page ' || page_id || ' goes on.' ELSE 'Page ' || page_id END AS text)
 UNION ALL SELECT chapter_path, CASE k WHEN 1 THEN '1' ELSE '2-3' END, CASE k WHEN 1 THEN chapter_path || '1/' ELSE path END, k, section, CASE k WHEN 1 THEN 'First.' WHEN 2 THEN 'word — meaning' WHEN 3 THEN 'Second of ' || c || '.' ELSE 'And more.' END FROM h, (VALUES (1, 'translation'), (2, 'synonyms'), (3, 'purport'), (4, 'purport')) s(k, section) WHERE is_view),
n AS (SELECT *, row_number() OVER (PARTITION BY chapter_path ORDER BY o) AS block_index FROM b)
"""


@query(_SQL + "SELECT chapter_path, verse_id, 'verse:' || verse_id AS part, source_locator, block_index, section, text FROM n")
def chapter_blocks(spark, sf_dir):
    """Blocks of all chapters, numbered over their verses, from views or verse pages."""
    return ch.assembled(mirror(spark, sf_dir))[1].select("chapter_path", "verse_id", "part", "source_locator", F.col("block_index").cast("long").alias("block_index"), "section", "text")


@query(
    _SQL
    + """, t AS (SELECT chapter_path, count(DISTINCT verse_id) AS verse_count, count(*) AS block_count, count(*) FILTER (section = 'purport') AS purports FROM n GROUP BY chapter_path),
o AS (SELECT chapter_path, bool_or(r = 0 OR (r = 5 AND NOT is_view) OR r = 7) AS has_page, any_value(c) AS c, any_value(CASE WHEN r IN (5, 6) AND NOT is_view THEN 'sb' WHEN r = 7 THEN 'cc/adi' ELSE 'bg' END) AS work_id FROM h GROUP BY chapter_path),
x AS (SELECT o.*, has_view, coalesce(verse_count, 0) AS verse_count, coalesce(block_count, 0) AS block_count, coalesce(purports, 0) AS purports, CASE WHEN has_view THEN coalesce(verse_count, 0) WHEN has_page AND work_id = 'bg' THEN 3 + CASE WHEN c % 2 = 0 THEN 1 ELSE 0 END ELSE 0 END AS linked FROM o JOIN m USING (chapter_path) LEFT JOIN t USING (chapter_path))
SELECT chapter_path, work_id, CASE WHEN has_view THEN 'advanced_view' ELSE 'verse_pages' END AS source_mode, CASE WHEN has_view THEN 'View ' || c WHEN has_page THEN 'Chapter ' || c ELSE '' END AS title, CASE WHEN has_view THEN 'All ' || c WHEN has_page THEN 'Head ' || c ELSE '' END AS chapter_title,
CASE WHEN has_view THEN 'ru' ELSE 'en' END AS lang, verse_count, linked AS linked_verse_count, NOT has_view AND linked > 0 AND linked <> verse_count AS is_partial, block_count, purports, CASE WHEN verse_count = 0 THEN 'no verse pages' END AS error FROM x"""
)
def chapter_manifest(spark, sf_dir):
    """What each chapter is made of, and whether verses that it links to are missing."""
    x = ch.assembled(mirror(spark, sf_dir))[0]
    purports = F.coalesce(F.try_element_at("section_counts", F.lit("purport")), F.lit(0))
    return x.select("chapter_path", "work_id", "source_mode", "title", "chapter_title", "lang", "verse_count", "linked_verse_count", "is_partial", "block_count", purports.alias("purports"), "error")
