"""The glossary's exchanged tables, and files of documents, bundles and review packs."""

from pyspark.sql import functions as F

from lectern.operators import glossary_tables as gt
from lectern.operators import sinks
from lectern.sources.tables import csv_rows, json_blocks

COLS = "key string, variant string, source_label string, category string, kind string, italic boolean, file string, example string, seen long"


def terms(spark):
    rows = [
        ("guru", "гуру", "our_ru", "honorific", "italic", True, "f1", "e1", 1), ("guru", "гуру", "x_vedabase", "honorific", "glossary_headword", False, "f2", "e2", 2), ("guru", "гуру́", "our_ru", "other", "italic", True, "f1", "e1", 3),
        ("abc", "абв", "our_ru", "other", "italic", True, "f1", "e3", 4), ("only", "там", "x_vedabase", "place_name", "italic", True, "f3", "e4", 5),
    ]
    approved = spark.createDataFrame([("guru", "гуру"), ("abc", "абв"), ("only", "там")], "key string, approved_form string")
    return gt.terms(spark.createDataFrame(rows, COLS), approved)


def test_rows(spark):
    t = terms(spark).cache()
    base = {r["approved_form"]: r for r in gt.base_rows(t).collect()}
    assert gt.base_rows(t).columns == list(gt.BASE) and set(base) == {"гуру", "абв"}
    g = base["гуру"]
    assert (g["id"], g["status"], g["italic_required"], g["diacritics_policy"], g["preferred_source"], g["variants_found"]) == ("term-00002", "needs_review", "conditional", "diacritics_in_quotes_only", "our_ru", "гуру [2] | гуру́ [1]")
    assert (base["абв"]["id"], base["абв"]["status"], base["абв"]["diacritics_policy"]) == ("term-00001", "draft", "no_diacritics_in_prose")
    assert [r["approved_form"] for r in gt.base_rows(t, high_signal_only=True).collect()] == ["гуру"] and gt.base_rows(t, all_sources=True).count() == 3
    c = gt.conflict_rows(t).collect()
    assert gt.conflict_rows(t).columns == list(gt.CONFLICTS) and [(r["normalized_key"], r["variant_count"], r["sources"]) for r in c] == [("guru", 2, "our_ru [2] | x_vedabase [1]")]
    r = {x["approved_form"]: x for x in gt.review_rows(gt.base_rows(t), gt.conflict_rows(t)).collect()}
    assert (r["гуру"]["conflict_flag"], r["гуру"]["review_priority"], r["гуру"]["suggested_action"]) == ("yes", "high", "review") and r["абв"]["conflict_flag"] == "no" and r["абв"]["decision"] == ""


def test_review_pack(spark, tmp_path):
    t = terms(spark)
    rows = gt.review_rows(gt.base_rows(t, all_sources=True), gt.conflict_rows(t))
    sinks.write_review_pack(rows, str(tmp_path))
    master = csv_rows(spark, str(tmp_path / "master"))
    assert master.columns == list(gt.REVIEW) and master.count() == 3 and csv_rows(spark, str(tmp_path / "priority_high")).count() == 1
    assert {p.name for p in (tmp_path / "by_category").iterdir() if p.is_dir()} == {"name=honorific", "name=other", "name=place_name"}
    summary = "".join(p.read_text() for p in (tmp_path / "summary.md").glob("part-*"))
    assert "- total rows: 3" in summary and summary.index("## Suggested actions") < summary.index("- `review`: 2") < summary.index("- `keep`: 1") < summary.index("## Categories") < summary.index("- `other`: 1")
    sheet = "".join(p.read_text() for p in (tmp_path / "priority_high.md").glob("part-*"))
    assert sheet.index("## honorific") < sheet.index("### гуру") < sheet.index("- decision: keep")
    aliases = gt.alias_rows(spark.createDataFrame([("a", " Merge", "b ", "n"), ("c", "merge", " ", "n"), ("d", None, None, None)], "approved_form string, decision string, merge_into string, review_notes string"))
    assert [tuple(r) for r in aliases.collect()] == [("a", "b", "n")] and aliases.columns == list(gt.ALIASES)


def test_documents_round_trip(spark, tmp_path):
    b = spark.createDataFrame([("p", "text", 2, "Second 12.", "body", 2), ("p", "text", 1, "First", "heading_like", 1), ("q", "html", 1, "x", "body", 1)], "source_path string, source_format string, block_index int, text string, kind string, word_count int")
    d = {r["source_path"]: r for r in sinks.document_rows(b).collect()}
    assert [x["text"] for x in d["p"]["blocks"]] == ["First", "Second 12."] and d["p"]["metadata"]["kind_counts"] == {"body": 1, "heading_like": 1} and d["q"]["metadata"]["block_count"] == 1
    sinks.write_documents(b, str(tmp_path / "d"))
    back = spark.read.json(str(tmp_path / "d")).select("source_path", F.explode("blocks.text").alias("t"))
    assert {(r["source_path"], r["t"]) for r in back.collect()} == {("p", "First"), ("p", "Second 12."), ("q", "x")}
    one = tmp_path / "one"
    sinks.write_json(sinks.document_rows(b.where("source_path = 'p'")), str(one))
    assert [(r["block_index"], r["text"], r["digit_signature"]) for r in json_blocks(spark, str(one)).orderBy("block_index").collect()] == [(1, "First", ""), (2, "Second 12.", "12")]


def test_bundles(spark, tmp_path):
    i = spark.createDataFrame([("a", 2, "x-2", "k", "info", "t", "m", "s", None, 0, None, "e", None, ""), ("a", 1, "x-1", "k", "info", "t", "m", "s", "word/document.xml", 7, 5, "", "se", "te"), ("b", 1, "y", "k", "info", "t", "m", "s", "p", 3, None, None, None, None)], "k string, o int, issue_id string, kind string, severity string, title string, message string, suggestion string, part string, paragraph_index int, footnote_id int, excerpt string, source_excerpt string, target_excerpt string")
    sinks.write_bundles(i, str(tmp_path / "b"), "k", ["o"])
    r = {x["id"]: x for x in spark.read.json(str(tmp_path / "b")).collect()}
    assert (r["x-2"]["anchor"]["part"], r["x-2"]["anchor"]["paragraph_index"], r["x-2"]["anchor"]["story_label"]) == ("word/document.xml", 1, "main_story")
    assert (r["x-1"]["anchor"]["part"], r["x-1"]["anchor"]["footnote_id"], r["x-1"]["context"]["source_excerpt"]) == ("word/footnotes.xml", 5, "se") and r["y"]["k"] == "b"
