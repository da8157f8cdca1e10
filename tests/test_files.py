"""Readers and writers of files, and the stream."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from lectern.operators import sinks
from lectern.sources import docx, html
from lectern.sources.tables import csv_rows, glossary_policy, hint_rules, json_blocks, text_files
from lectern.streaming import review

W = f'xmlns:w="{docx.NAMESPACE}"'
BODY = f'<w:document {W}><w:body><w:p><w:pPr><w:pStyle w:val="H"/><w:ind w:left="720"/></w:pPr><w:r><w:rPr><w:i/></w:rPr><w:t>Head</w:t></w:r></w:p><w:p/><w:tbl><w:tr><w:tc><w:p><w:r><w:t>cell</w:t><w:br/><w:t>two</w:t></w:r><w:r><w:footnoteReference w:id="2"/></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>'
STYLES = f'<w:styles {W}><w:style w:type="paragraph" w:styleId="H"><w:name w:val="Heading 1"/></w:style><w:style w:type="paragraph" w:default="1" w:styleId="N"><w:name w:val="Normal"/></w:style></w:styles>'
NOTES = f'<w:footnotes {W}><w:footnote w:type="separator" w:id="0"><w:p/></w:footnote><w:footnote w:id="2"><w:p><w:r><w:t>note</w:t></w:r></w:p></w:footnote></w:footnotes>'


def word_file() -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", BODY)
        z.writestr("word/styles.xml", STYLES)
        z.writestr("word/footnotes.xml", NOTES)
        z.writestr("[Content_Types].xml", "<Types></Types>")
    return out.getvalue()


def test_docx(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(word_file())
    (tmp_path / "broken.docx").write_bytes(b"no zip")
    rows = docx.docx_paragraphs(spark, str(tmp_path)).collect()
    good = [(r["part"], r["paragraph_index"], r["block_index"], r["style_name"], r["text"], r["footnote_refs"], r["in_table"]) for r in rows if r["error"] is None]
    assert ("word/document.xml", 1, 1, "Heading 1", "Head", 0, False) in good and ("word/document.xml", 2, None, "Normal", "", 0, False) in good
    assert ("word/document.xml", 3, 2, "Normal", "cell\ntwo", 1, True) in good and ("word/footnotes.xml", 1, 1, "Normal", "note", 0, False) in good
    assert sum(r["error"] is not None for r in rows) == 1


def test_comments(spark, tmp_path):
    new, n = docx.with_comments(word_file(), [(1, "first\nline"), (3, "third"), (9, "no such place")], "editor", "2024-01-01T00:00:00Z")
    assert n == 2
    again, m = docx.with_comments(new, [(2, "more")], "editor", "2024-01-01T00:00:00Z")
    with zipfile.ZipFile(io.BytesIO(again)) as z:
        text = z.read("word/comments.xml").decode()
        assert m == 1 and text.count("<w:comment ") == 3 and z.read("[Content_Types].xml").count(b"/word/comments.xml") == 1
    (tmp_path / "a.docx").write_bytes(word_file())
    path = spark.read.format("binaryFile").load(str(tmp_path)).select("path").first()[0]
    r = docx.commented_files(spark, str(tmp_path), spark.createDataFrame([(path, 1, "x"), (path, 50, "y")], "source_path string, paragraph_index int, body string"), "e", "2024-01-01T00:00:00Z").first()
    assert (r["asked"], r["written"]) == (2, 1)


def test_html(spark):
    page = '<html lang="en"><head><title>T</title><script>var a="<p>no</p>"</script></head><body><nav><a href="/x">x</a></nav><h1>H</h1><div class="av-translation"><p>one <i>it</i> two</p></div><p>un<p>closed &amp; more'
    assert html.parse(page) == [("body", "T", []), ("translation", "one it two", ["it"]), ("body", "un", []), ("body", "closed & more", [])]
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "k int, h string")
    assert html.html_blocks(df, "k", "h").where("k = 1").count() == 4
    js = spark.createDataFrame([('{"__html":"<p>a\\"b</p>"}',)], "h string").select(html.json_strings(F.col("h"), '"__html":')).first()[0]
    assert js == ['<p>a"b</p>']


def test_readers(spark, tmp_path):
    (tmp_path / "001_x.txt").write_text("one\nline\n\ntwo")
    assert [(r["chapter_key"], r["text"]) for r in text_files(spark, str(tmp_path)).orderBy("block_index").collect()] == [("001", "one line"), ("001", "two")]
    (tmp_path / "g.csv").write_text("approved_form,lemma_en,allowed_forms,discouraged_forms,italic_automation\nA,a | b,,x|,ALWAYS\n,,,,\nB,,,,\n")
    g = {r["approved_form"]: r for r in glossary_policy(spark, str(tmp_path / "g.csv")).collect()}
    assert set(g) == {"A", "B"} and g["A"]["lemma_en"] == ["a", "b"] and g["A"]["italic_automation"] == "always" and g["B"]["italic_automation"] == "skip"
    (tmp_path / "h.json").write_text(json.dumps({"input": "x", "rules": [{"match": {"type": "index", "value": 3}, "action": "ignore"}, {"match": {"type": "text"}}]}))
    assert [(r["rule_pos"], r["value"], r["action"]) for r in hint_rules(spark, str(tmp_path / "h.json")).collect()] == [(0, "3", "ignore")]
    (tmp_path / "d.json").write_text(json.dumps({"version": 1, "source_path": "p", "blocks": [{"text": "Some words 12.", "kind": "", "word_count": 0}, {"index": 9, "text": "x", "kind": "body"}]}))
    b = json_blocks(spark, str(tmp_path / "d.json")).orderBy("block_index").collect()
    assert [(r["block_index"], r["kind"], r["word_count"], r["digit_signature"]) for r in b] == [(1, "body", 3, "12"), (9, "body", 1, "")]


def test_sinks(spark, tmp_path):
    issues = spark.createDataFrame([(k, "style", "info", f"e{k}") for k in range(5)], "o int, kind string, severity string, excerpt string")
    text = sinks.markdown_report(issues, "R", ["o"], 3)
    assert "- issues: 5" in text and "2 more omitted." in text and "e2" in text and "e3" not in text
    sinks.write_csv(issues, str(tmp_path / "c"), ["kind"])
    assert csv_rows(spark, str(tmp_path / "c")).count() == 5
    rows = spark.createDataFrame([("a", "merge", "b", "approved"), ("c", "drop", "", "dropped")], "approved_form string, decision string, merge_into string, outcome string")
    sinks.write_outcomes(rows, str(tmp_path / "o"))
    assert csv_rows(spark, str(tmp_path / "o/aliases")).first()["target_form"] == "b"


def test_stream(spark, tmp_path):
    docs = spark.createDataFrame([(1, "en", "a ,b"), (2, "en", "fine words.")], "doc_id long, lang string, text string")
    docs.write.parquet(str(tmp_path / "in"))
    issues = review.review_stream(spark, str(tmp_path / "in"), docs.schema)
    q = review.write_reviews(issues, str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert {(r["doc_id"], r["kind"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {(1, "stylistic_space_before_punctuation"), (1, "stylistic_missing_space_after_punctuation")}
