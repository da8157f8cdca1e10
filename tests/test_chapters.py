"""Chapters: where pages stand, verses of a view, both ways of putting a chapter together, and partial chapters."""

import pytest
from pyspark.sql import functions as F

from lectern.sources import chapters as ch


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "c string").select(f(F.col("c")).alias("x")).first()["x"]


@pytest.mark.parametrize("path, kind, work, chapter, verse", [
    ("/en/library/bg/2/13/", "verse", "bg", "/en/library/bg/2/", "13"), ("/en/library/bg/2/", "chapter", "bg", "/en/library/bg/2/", None), ("/en/library/sb/1/2/", "chapter", "sb", "/en/library/sb/1/2/", None), ("/en/library/sb/1/", "subwork", "sb", None, None),
    ("/en/library/sb/1/2/3-4/", "verse", "sb", "/en/library/sb/1/2/", "3-4"), ("/en/library/cc/adi/5/", "chapter", "cc/adi", "/en/library/cc/adi/5/", None), ("/en/library/cc/", "work", "cc", None, None), ("/en/library/bg/2/advanced-view/", "advanced_view", "bg", "/en/library/bg/2/", None),
    ("/en/library/bg/advanced-view/", "advanced_view", "bg", None, None), ("/en/library/bg/2/13/x/", "other", "bg", "/en/library/bg/2/", None), ("/en/library/iso/1/", "other", "iso", None, None), ("/en/library/iso/", "work", "iso", None, None),
    ("/en/library/", "library_index", "", None, None), ("/en/other/", "other", "", None, None), ("", "other", "", None, None), (None, "other", "", None, None),
])
def test_places(spark, path, kind, work, chapter, verse):
    x = one(spark, ch.page_place, path)
    assert (x["page_type"], x["work_id"], x["chapter_path"], x["verse_id"]) == (kind, work, chapter, verse)


def test_place_details(spark):
    x = one(spark, ch.page_place, "/ru/library/sb/1/2/3/")
    assert (x["locale"], x["chapter_number"], x["chapter_key"], x["view_path"], x["path_depth"]) == ("ru", "2", "1/2", "/ru/library/sb/1/2/advanced-view/", 4)
    assert [one(spark, ch.label_id, s) for s in ("TEXT 5", "Тексты 1-2:", "verse  7", "Other:", "")] == ["5", "1-2", "7", "Other", ""]


def page(*blocks, links=(), title=""):
    return f"<html lang='x'><title>{title}</title><h1>head</h1>" + "".join(f'<div class="av-{s}"><p>{t}</p></div>' for s, t in blocks) + "".join(f'<a href="{x}">.</a>' for x in links) + "</html>"


def run(spark, *pages):
    chapters, blocks = ch.assembled(spark.createDataFrame(list(pages), "web_path string, html string"))
    return {r["chapter_path"]: r for r in chapters.collect()}, [(r["chapter_path"], r["verse_id"], r["block_index"], r["section"], r["text"], r["kind"]) for r in blocks.orderBy("chapter_path", "block_index").collect()]


def test_verse_pages(spark):
    bg = "/en/library/bg/1/"
    pages = [
        (bg, page(links=[bg + "1/", bg + "2", bg + "10/", bg + "1/", "/en/library/bg/2/1/", "/x"], title="T")), (bg + "10/", page(("purport", "ten"), ("synonyms", "a — b"))), (bg + "2/", page(("translation", "two"))), (bg + "2/", page(("translation", "two"))), ("/en/", "x"),
    ]
    chapters, blocks = run(spark, *pages)
    c = chapters[bg]
    assert (c["source_mode"], c["verse_count"], c["linked_verse_count"], c["is_partial"], c["title"], c["chapter_title"], c["block_count"], c["section_counts"], c["error"]) == ("verse_pages", 2, 3, True, "T", "head", 3, {"purport": 1, "synonyms": 1, "translation": 1}, None)
    assert [(v, i, s, t) for _, v, i, s, t, _ in blocks] == [("2", 1, "translation", "two"), ("10", 2, "purport", "ten"), ("10", 3, "synonyms", "a — b")] and blocks[2][5] == "synonyms"


def test_view_goes_first_and_none_is_an_error(spark):
    bg = "/en/library/bg/1/"
    view = f'<html><title>V</title><div class="x av-verses"><div><h2 id="b1"><a href="{bg}1/">TEXT 1</a></h2><div class="av-purport"><p>one</p></div></div><div><h2>Text 2:</h2><p>no section</p><div class="av-translation"><p>two</p><p>more</p></div></div></div></html>'
    chapters, blocks = run(spark, (bg + "advanced-view/", view), (bg + "1/", page(("purport", "other"))), ("/en/library/sb/1/1/", page()), ("/en/library/bg/3/advanced-view/", "<h2>TEXT 1</h2>"), ("/en/library/bg/4/1/", None))
    assert [(v, i, t) for c, v, i, _, t, _ in blocks if c == bg] == [("1", 1, "one"), ("2", 2, "two"), ("2", 3, "more")]
    assert (chapters[bg]["source_mode"], chapters[bg]["verse_count"], chapters[bg]["is_partial"]) == ("advanced_view", 2, False)
    assert chapters["/en/library/sb/1/1/"]["error"] == "no verse pages" and chapters["/en/library/bg/3/"]["error"] == "the view has no verses"
    assert (chapters["/en/library/bg/4/"]["verse_count"], chapters["/en/library/bg/4/"]["block_count"], chapters["/en/library/bg/4/"]["error"]) == (1, 0, None)
    assert ch.view_verses(spark.createDataFrame([(1, view)], "k int, html string"), ["k"]).orderBy("verse_index").select("heading_id", "verse_path", "verse_label").collect() == [("b1", bg + "1/", "TEXT 1"), ("", "", "Text 2:")]
