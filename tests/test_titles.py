"""Titles and the style audit on small rows."""

import random

import pytest
from pyspark.sql import functions as F

from lectern.operators import audit, titles


def test_titles(spark):
    lines = ["First line", "goes on here", "Second", "third " + "x" * 200]
    assert spark.createDataFrame([(lines,)], "l array<string>").select(titles.continued(F.col("l"))).first()[0] == ["First line goes on here", "Second", lines[3]]
    df = spark.createDataFrame([(1, k, t) for k, t in enumerate(["x.", "Contents", "One", "Two", "Prose ends here.", "Three"])], "d int, o int, text string")
    got = titles.contents_region(df, ["d"], "o", F.col("text") == "Contents", titles.is_candidate(F.col("text"))).orderBy("o").collect()
    assert [r["text"] for r in got] == ["One", "Two"]
    assert spark.createDataFrame([("Ёлка ..... 12",)], "t string").select(titles.title_key(F.col("t"))).first()[0] == "елка"
    assert titles.unique_match(df, ["d"], "o", F.col("text") == "One").first()["o"] == 2
    with pytest.raises(Exception, match="matches: 0"):
        titles.unique_match(df, ["d"], "o", F.col("text") == "none").collect()


def test_audit(spark):
    p = spark.createDataFrame([("Body",), ("Odd",), ("Odd",), (None,)], "style_name string")
    got = {(r["style"], r["status"]): r["n"] for r in audit.style_sets(p, ("Body", "Heading 1")).collect()}
    assert got["Odd", "noncanonical_paragraph_style"] == 2 and ("Heading 1", "canonical_style_unused") in got and ("Body", "canonical_style_unused") not in got
    runs = spark.createDataFrame([("f", 1, "Arial", True, False, None, ["color"]), ("f", 1, None, False, False, "Italic", []), ("f", 2, "Serif", False, False, "Own", [])], "source_path string, paragraph_index int, run_font string, italic boolean, bold boolean, char_style string, overrides array<string>")
    kinds = {(r["paragraph_index"], r["kind"]) for r in audit.run_issues(runs, "Serif", ("Italic",)).collect()}
    assert kinds == {(1, "run_unexpected_font"), (1, "manual_emphasis_without_char_style"), (1, "run_override"), (2, "noncanonical_character_style")}
    f = spark.createDataFrame([("f", 1, "the Term and Name", ["name"])], "source_path string, paragraph_index int, text string, italics array<string>")
    t = spark.createDataFrame([("term", "always"), ("name", "never"), ("and", "skip")], "phrase string, automation string")
    assert {(r["phrase"], r["kind"]) for r in audit.expected_emphasis(f, t).collect()} == {("term", "glossary_expected_italic"), ("name", "glossary_expected_roman")}


def test_placed(spark):
    rng = random.Random(4)
    docs = {d: ([rng.choice("abcdz") for _ in range(rng.randrange(1, 9))], [rng.choice("abcde") for _ in range(rng.randrange(30))]) for d in range(40)}
    t = spark.createDataFrame([(d, k, x) for d, (ts, _) in docs.items() for k, x in enumerate(ts)], "d int, no int, title string")
    b = spark.createDataFrame([(d, k, x) for d, (_, bs) in docs.items() for k, x in enumerate(bs)], "d int, at int, key string")
    for begin in (0, 5):
        got = {(r["d"], r["no"]): r["at"] for r in titles.placed(t, b, ["d"], begin).collect()}
        for d, (ts, bs) in docs.items():
            pos = begin
            for k, x in enumerate(ts):
                found = next((i for i in range(pos, len(bs)) if bs[i] == x), None)
                assert got.pop((d, k)) == found
                pos = pos if found is None else found + 1
        assert not got


def test_matches(spark):
    pairs = [("Ёлка: 1", "елка 1 и ещё", True), ("Глава", "Гла", True), ("Глава", "Главы нет", False), ("", "x", False), ("ﬁn", "FIN.", True), ("a & b", "A & B — c", True), (None, "x", False)]
    x = spark.createDataFrame([p[:2] for p in pairs], "a string, b string").select(titles.matches(titles.match_text(F.col("a")), titles.match_text(F.col("b"))).alias("m"))
    assert [r["m"] for r in x.collect()] == [p[2] for p in pairs]
