"""Text functions on Unicode edge cases; segments, issues, references and alignment against plain Python."""

from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.functions import diacritics
from lectern.operators import alignment, glossary, issues, references, segments
from lectern.sources.tables import first_of, text_blocks, with_features


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


@pytest.mark.parametrize("text", ["a  b c\t\n d", "", None, "   ", "й ё́  x"])
def test_clean(spark, text):
    assert one(spark, text, tx.clean) == " ".join((text or "").split())


@pytest.mark.parametrize(
    ("text", "style", "kind"),
    [("", None, "empty"), ("A short line", None, "heading_like"), ("1. first of the items in a list that is long enough to be one.", None, "list_numbered"), ("— an item that has a full stop at its end.", None, "list_bulleted"), ("«quoted words end here.»", None, "heading_like"), ("any text.", "Heading 2", "heading2"), ("any", "Цитата 1", "quote1"), ("see Bg 2.13 and more words here.", None, "source_like"), ("x", "Перевод шлоки", "shloka_translation")],
)
def test_kind(spark, text, style, kind):
    got = spark.createDataFrame([(text, style)], "t string, s string").select(tx.kind(tx.clean(F.col("t")), F.col("s"))).first()[0]
    assert got == kind


def test_score_to_three(spark):
    """All that a signature asks of the letters' count, without counting all of them."""
    texts = ["", "a", "ab", "a-b", "a b c", "а̄", "а̄ x", "а̄а̄ x", "Āā", "Āāṣ", "1 2 3", "йй\nx\ny", "x\n\ny z", "\u0301\u0301\u0301", "ж́ж́", "a" * 500]
    rows = spark.createDataFrame([(x,) for x in texts], "text string").select(tx.translit_score(F.col("text")).alias("n"), tx.translit_score_to_three(F.col("text")).alias("m")).collect()
    assert all(min(r["n"], 3) == min(r["m"], 3) for r in rows) and {min(r["n"], 3) for r in rows} == {0, 1, 2, 3}


def test_digits_and_excerpt(spark):
    assert one(spark, "1.5-2.5 and 3 4 5 6 7 8 9 10", tx.digit_signature) == "1.5-2.5|3|4|5|6|7|8|9"
    assert one(spark, "abcdef ghij", lambda c: tx.excerpt(c, 8)) == "abcdef…"
    assert one(spark, "Ишо 5", lambda c: tx.contains_phrase(c, "ишо")) and not one(spark, "Ишоп", lambda c: tx.contains_phrase(c, "ишо"))
    assert one(spark, "Kṛṣṇa (Hari, Rāma) ", tx.head_and_variants) == ["Kṛṣṇa", "Hari, Rāma", "Hari", "Rāma"]
    assert spark.range(1).select(tx.cm_to_twips(F.lit(1.27))).first()[0] == 720


@pytest.mark.parametrize(("text", "want"), [('a "b" c', "a «b» c"), ('"a "b" c"', "«a „b“ c»"), ('"a" "b"', "«a» «b»"), ('odd " one', 'odd " one'), ("none", "none"), ('« "x" »', "« „x“ »")])
def test_quotes(spark, text, want):
    assert one(spark, text, tx.typographic_quotes) == want


def test_typography(spark):
    r = one(spark, "a  b ,c...x - y", tx.typography)
    assert r["text"] == "a b, c…x — y"
    assert list(r["actions"]) == ["nbsp_to_space", "double_spaces", "space_before_punctuation", "three_dots", "spaced_ascii_dash", "space_after_punctuation"]
    assert one(spark, r["text"], tx.typography)["actions"] == []


def chunks(words, n):
    total, cur, produced, out = max(1, sum(words)), 0, 0, []
    for w in words:
        out.append(produced)
        cur += w
        if produced < n - 1 and cur >= total / n * (produced + 1):
            produced += 1
    return out


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=12), st.integers(1, 6))
def test_weight_chunks(spark, words, n):
    df = spark.createDataFrame([(1, k, w) for k, w in enumerate(words)], "d int, o int, w int")
    got = [r["chunk"] for r in segments.weight_chunks(df, ["d"], "o", "w", n).orderBy("o").collect()]
    assert got == chunks(words, n)


def test_references(spark):
    t = "См. БГ 2.13, шб 1 . 2 . 3–4, ЧЧ Ади-лила 1.5; чч Нечто 1.5 и Isopanisad 7."
    got = [(h["work"], list(h["path"])) for h in one(spark, t, references.hits)]
    assert ("bg", ["2", "13"]) in got and ("sb", ["1", "2", "3-4"]) in got and ("cc", ["adi", "1", "5"]) in got and ("iso", ["7"]) in got
    assert len(got) == 4
    x = references.extracted(spark.createDataFrame([(1, t)], "k int, text string"), ["k"]).where("work = 'bg'").first()
    assert x["canonical"] == "БГ 2.13" and not x["needs_normalization"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=8), st.lists(st.sampled_from("abc"), max_size=8))
def test_alignment(spark, a, b):
    side = lambda s: spark.createDataFrame([(1, k + 1, x) for k, x in enumerate(s)], "d int, o int, v string")
    got = [(r["tag"], r["i1"], r["i2"], r["j1"], r["j2"]) for r in alignment.opcodes(side(a), side(b), "d", "o", "v").orderBy("seq").collect()]
    assert got == SequenceMatcher(a=a, b=b, autojunk=False).get_opcodes()


def test_projection(spark):
    pairs = spark.createDataFrame([(1, 2, 3), (1, 5, 6)], "d int, i int, j int")
    ranges = spark.createDataFrame([(1, 1, 1), (1, 2, 4), (1, 3, 4), (1, 6, 7)], "d int, lo int, hi int")
    got = {(r["lo"], r["hi"]): (r["target_lo"], r["target_hi"]) for r in alignment.projected(ranges, pairs, spark.createDataFrame([(1, 8)], "d int, total int"), "d").collect()}
    assert got == {(1, 1): (3, 3), (2, 4): (3, 3), (3, 4): (4, 4), (6, 7): (6, 6)}


def test_issues(spark):
    assert [r[0] for r in spark.createDataFrame([("ERROR ",), ("odd",), (None,)], "s string").select(issues.severity(F.col("s"))).collect()] == ["error", "warning", "warning"]
    df = spark.createDataFrame([(1, 1, "A"), (1, 2, "a"), (2, 3, "b")], "k int, o int, message string")
    assert issues.keep_first(df, ["k"], ["o"]).count() == 2 and first_of(df, ["k"], [F.desc("o")]).count() == 2
    assert spark.range(1).select(issues.body([("Kind", F.lit("x")), ("Empty", F.lit(""))])).first()[0] == "Kind: x"


def test_decisions(spark):
    rows = [("keep", ""), ("Drop", ""), ("merge", ""), ("merge", "x"), ("defer", ""), (None, None), ("odd", "")]
    got = [r[0] for r in spark.createDataFrame(rows, "d string, m string").select(glossary.outcome(F.col("d"), F.col("m"))).collect()]
    assert got == ["approved", "dropped", "pending", "approved", "pending", "pending", "pending"]


def test_blocks_keep_both_indices(spark):
    b = with_features(text_blocks(spark.createDataFrame([(1, "one\n\n two ")], "d int, text string"), ["d"])).orderBy("block_index").collect()
    assert [(r["block_index"], r["paragraph_index"], r["text"]) for r in b] == [(1, 1, "one"), (2, 3, "two")]


def test_legacy_symbols_and_messages(spark):
    r = one(spark, "кр", tx.legacy_symbols)
    assert r["text"] == "крр̣—р̣" and dict(r["replaced"]) == {"": 2, "": 1}
    got = spark.createDataFrame([("struct_delete", "a", None), ("struct_replace", "a", "b")], "k string, s string, t string").select(alignment.message(F.col("k"), F.col("s"), F.col("t")).alias("m")).select("m.*").collect()
    assert got[0]["title"] == "Possibly left out" and "<insertion point>" in got[0]["message"] and got[1]["title"] == "Structure differs"
