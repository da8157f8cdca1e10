"""Rules, producers and checked joins on rows that the tables do not have."""

import pytest
from pyspark.sql import functions as F

from lectern.functions import diacritics as di
from lectern.functions import forms as fm
from lectern.functions import text as tx
from lectern.operators import lookups as lk
from lectern.operators import producers as pr
from lectern.operators import references as rf
from lectern.operators import semantic as sm
from lectern.sources import html as h
from lectern.sources.tables import labelled_union


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    ("text", "style", "said"),
    [
        ("Обычный текст без знаков.", "", ("none", "no-diacritics")),
        ("Кр̣шн̣а пришел домой.", "", ("normalize_prose", "russian-prose-with-diacritics")),
        ("Кр̣шн̣а", "Шлока", ("preserve", "style:Шлока")),
        ("Кр̣шн̣а", "Заголовок 2", ("normalize_prose", "style:Заголовок 2")),
        ("намо ма̄ра̄йан̣а̄йа\nта̄м̇ ра̄ма̄йа", "Сноска", ("preserve", "transliteration-block")),
        ("намо ма̄ра̄йан̣а̄йа та̄м̇ ра̄ма̄йа", "Сноска", ("normalize_prose", "footnote-prose-style:Сноска")),
        ("ШБ 1.2: Кр̣шн̣а", "", ("normalize_prose", "reference-or-abbreviation-entry")),
        ("ом намо бхагавате ва̄судева̄йа кр̣ш̣н̣а̄йа", "Цитата 1", ("preserve", "quote-style-transliteration:Цитата 1")),
        ("ом намо бхагавате ва̄судева̄йа кр̣ш̣н̣а̄йа", "", ("preserve", "transliteration-block")),
        ("ча-ра̄майападмана-кр̣т", "", ("preserve", "transliteration-block")),
    ],
)
def test_diacritic_decisions(spark, text, style, said):
    df = spark.createDataFrame([(text, style)], "t string, s string").withColumn("p", di.without_marks(F.col("t")))
    assert tuple(df.select(di.decision(F.col("t"), F.col("p"), F.col("s")).alias("d")).select("d.action", "d.reason").first()) == said


@pytest.mark.parametrize(("text", "plain"), [("", ""), (None, None), ("р̣ши Р̣ши", "риши Риши"), ("ачарйа Мадхйа", "ачарья Мадхья"), ("Śrī ñ", "Шrи н"), ("ёлка й", "ёлка й"), ("e\u0301", "e")])
def test_without_marks(spark, text, plain):
    assert one(spark, text, di.without_marks) == plain


def test_forms(spark):
    nb = "\u00a0"
    got = one(spark, 'и в доме 5 % (о том) № 7, рис. 3 и т. 4 — конец', fm.no_break)
    assert got["text"] == f"и{nb}в доме 5{nb}% (о{nb}том) №{nb}7, рис.{nb}3 и{nb}т.{nb}4{nb}— конец" and (got["percent"], got["numero"], got["references"], got["dash_left"]) == (1, 1, 2, 1)
    assert one(spark, " «(Name&nbsp;of &amp; it).» ", fm.candidate_text) == "Name of & it"
    assert one(spark, "(a) and (b)", fm.candidate_text) == "(a) and (b)"
    assert one(spark, "/x/vedabase/ru/sb/1/index.html", fm.mirrored_path) == "/ru/sb/1/" and one(spark, "/x/y.html", fm.mirrored_path) == "" and one(spark, "vedabase/index.html", fm.mirrored_path) == "/"
    assert [one(spark, x, fm.source_format) for x in ("a.DOCX", "b/vedabase/c.html", "d.htm", "e.md", "f.pdf", "g.doc")] == ["docx", "mirror_html", "html", "text", None, "doc"]
    assert tuple(one(spark, "texts 7-9", fm.verse_key)) == (7, 9, "texts 7-9") and tuple(one(spark, None, fm.verse_key)) == (10**9, -1, "")
    assert one(spark, " a\f\n\n\nb ", fm.section_text) == "a\n\nb\n" and one(spark, "a\ufeff  \fb", fm.page_line) == "a b"
    assert [one(spark, v, fm.diacritics_policy, "array<string>") for v in ([], ["a"], ["ā"], ["a", "ā"])] == ["draft", "no_diacritics_in_prose", "needs_review", "diacritics_in_quotes_only"]
    assert [one(spark, x, fm.source_block_class) for x in ("Title here", "12–14 .", "Text about Kṛṣṇa.", "Plain text, it is.")] == ["heading_like", "page_or_number", "sanskrit_or_term", "body"]
    assert one(spark, "А-б, 1!", tx.stable_token) == "аб1"


def test_references_keep_their_places(spark):
    text = "Bg 2.13 and again Bg 2.13, then SB 1.2.3-4"
    df = spark.createDataFrame([(1, text)], "k int, text string")
    rows = rf.extracted(df, ["k"]).orderBy("hit").collect()
    assert [(text[r["start"] - 1 : r["end"] - 1], r["work"]) for r in rows] == [("Bg 2.13", "bg"), ("Bg 2.13", "bg"), ("SB 1.2.3-4", "sb")]
    found = rf.extracted(df, ["k"]).groupBy("k").agg(F.collect_list(F.struct("start", "end", "replacement")).alias("f"))
    new = df.join(found, "k").select(rf.rewritten(F.col("text"), F.col("f")).alias("r")).first()["r"]
    assert new["replaced"] == 3 and "Bg" not in new["text"] and new["text"].count("2.13") == 2 and " and again " in new["text"]


def test_assembly(spark):
    p = spark.createDataFrame([(1, "/a/b/"), (2, "/a/b/advanced-view/"), (3, "/a/c/"), (4, "/a/c/1/"), (5, "/a/c/2-3/"), (6, "/a/d/"), (7, "/a/d/e/")], "page_id int, web_path string")
    got = {r["page_id"]: (r["assembly_mode"], r["verse_child_count"]) for r in h.assembled(p, "web_path").collect()}
    assert got[1] == ("advanced_view", 0) and got[3] == ("verse_pages", 2) and got[6] == (None, 0) and got[4] == (None, 0)


def test_labelled_union(spark):
    rows = labelled_union({"x": spark.range(1), "y": spark.range(2).withColumn("z", F.lit(1))}).orderBy("source_pos", "id").collect()
    assert [(r["source_label"], r["id"], r["z"]) for r in rows] == [("x", 0, None), ("y", 0, 1), ("y", 1, 1)]


def test_semantic(spark):
    df = spark.createDataFrame([(1, "see SB 1.2 here", "1.2", False, "body", "see SB 1.3", "1.3", True, "heading1"), (2, "", "", False, "body", "x", "", False, "body"), (3, "no", "", True, "body", "SB 1.1 x", "1.1", False, "body")], "k int, source_text string, source_digit_signature string, source_has_quote_marks boolean, source_kind string, target_text string, target_digit_signature string, target_has_quote_marks boolean, target_kind string")
    assert [(r["k"], r["seq"], r["kind"]) for r in sm.pair_findings(df, ["k"]).orderBy("k", "seq").collect()] == [(1, 1, "semantic_reference_mismatch"), (1, 2, "semantic_missing_or_shifted_digits"), (1, 3, "semantic_quote_or_citation_mismatch")]
    assert [tuple(one(spark, r, sm.aligned_review, "array<string>")) for r in (["kind_mismatch", "digit_signature"], ["footnote_refs", "kind_mismatch"], ["footnote_refs"], [])] == [("semantic_number_mismatch", "warning"), ("semantic_block_kind_mismatch", "warning"), ("semantic_footnote_mismatch", "info"), ("semantic_aligned_review", "info")]
    g = spark.createDataFrame([("honorific", "a", "b"), ("other", "a", "b"), ("place_name", " ", "b")], "category string, approved_form string, lemma_en string")
    assert sm.protected_entries(g).count() == 1 and one(spark, "honorific", sm.term_severity) == "warning" and one(spark, "place_name", sm.term_severity) == "info"


def test_producers(spark):
    style = spark.createDataFrame([("f", 3, " A  b", "Old", None, "why")], "k string, paragraph_index int, text string, old_style string, new_style string, reason string")
    r = pr.from_style_review(style, ["k"], ["paragraph_index"]).first()
    assert (r["issue_id"], r["kind"], r["paragraph_index"], r["excerpt"]) == ("semantic-0001", "semantic_style_review", 3, "A b") and "Suggested style: <none>" in r["message"]
    notes = spark.createDataFrame([("f", 5, 1), ("f", 5, 2), ("f", 6, 3), ("f", None, 4)], "k string, note_id int, paragraph_index int")
    report = spark.createDataFrame([("f", 9, "gone", "S", "r"), ("f", 6, "kept", "S", "r")], "k string, note_id int, text string, new_style string, reason string")
    got = pr.from_note_review(report, lk.first_paragraphs(notes, ["k"]), ["k"], ["text"]).collect()
    assert [(r["issue_id"], r["paragraph_index"]) for r in got] == [("footnote-0002", 3)]
    pairs = spark.createDataFrame([("f", "a", "b", None)], "k string, source_excerpt string, target_excerpt string, target_index int")
    assert pr.from_alignment(pairs, ["k"], ["source_excerpt"]).first()["paragraph_index"] == 1
    review = spark.createDataFrame([("x", "Fatal"), (None, "info")], "kind string, severity string")
    assert [tuple(r) for r in pr.from_review(review).collect()] == [("x", "warning")]


def test_checked_joins(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    with pytest.raises(Exception, match="missing pair for section 3"):
        lk.whole_pairs(a, a.select("k", F.col("v").alias("w")), spark.createDataFrame([(1,), (3,)], "k int"), "k").collect()
    assert [tuple(r) for r in lk.first_of_each(a, spark.createDataFrame([(2, "z"), (3, "z")], "k int, v string"), ["k"]).orderBy("k").collect()] == [(1, "x"), (2, "y"), (3, "z")]
    applied = spark.createDataFrame([(1, "applied"), (2, "skipped"), (3, "applied"), (4, "applied")], "k int, status string")
    got = lk.review_outcome(applied, spark.createDataFrame([(3,)], "k int"), spark.createDataFrame([(1,), (2,), (3,)], "k int"), ["k"]).orderBy("k").collect()
    assert [(r["comments"], r["problem"]) for r in got] == [(1, None), (0, "skipped comments"), (1, "has comments already"), (1, "no bundle")]
    files = spark.createDataFrame([(1, None), (2, None), (3, "broken"), (4, None)], "k int, error string")
    refs = spark.createDataFrame([(1, True), (2, True), (2, False)], "k int, resolved boolean")
    assert [r["status"] for r in lk.reference_status(refs, files, ["k"]).orderBy("k").collect()] == ["clean", "editorial_queue", "error", "no_references"]
    assert tuple(lk.priority_histogram(spark.createDataFrame([("high",), ("odd",), (None,)], "priority string")).first()) == (1, 0, 2)
