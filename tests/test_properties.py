"""Properties as maps: differences, enforced and normalised formatting, configured styles, the audit."""

from pyspark.sql import functions as F

from lectern.operators import properties as pp


def test_differences_and_wanted(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3", "c": "4"}), ({"a": None}, {"a": None}), ({}, {})], "have map<string,string>, want map<string,string>")
    assert [r[0] for r in df.select(pp.differences(F.col("have"), F.col("want"))).collect()] == [{"a": ("1", None), "b": ("2", "3"), "c": (None, "4")}, {}, {}]
    names = spark.createDataFrame([("Шлока",), ("Цитата 4",), ("Шлока в цитате 2",), ("Письмо",), (None,)], "s string")
    assert [r[0] for r in names.select(pp.wanted(F.col("s"))).collect()] == [{"left": "1134", "firstLine": "0", "jc": "center", "i": "", "iCs": ""}, {"left": "2835", "firstLine": "0"}, {"left": "1701", "firstLine": "0", "jc": "center", "i": "", "iCs": ""}, None, None]


def test_configured(spark):
    s = spark.createDataFrame([("f", "Шлока", {"left": "5", "font": "x"}), ("f", "Other", {"left": "5"}), ("f", "Цитата 3", {"left": "2268", "firstLine": "0"})], "source_path string, style_name string, props map<string,string>")
    got = {r["style_name"]: r for r in pp.configured_styles(s).collect()}
    assert len(got) == 7 and {n for n, r in got.items() if r["is_new"]} == {"Шлока в цитате", "Перевод шлоки", "Цитата 1", "Цитата 2"}
    assert got["Шлока"]["props"] == {"font": "x", "left": "1134", "firstLine": "0", "jc": "center", "i": "", "iCs": ""} and got["Шлока"]["changed"]["left"] == ("5", "1134")
    assert got["Other"]["props"] == {"left": "5"} and got["Other"]["changed"] == {} == got["Цитата 3"]["changed"] and got["Цитата 2"]["props"]["left"] == "1701"


STYLES = [("f", "k", pp.ITALIC, {"i": ""}), ("f", "em", "Emphasis", {"i": ""}), ("f", "st", "Strong", {"b": "", "i": "0"}), ("f", "bi", "Both", {"b": "", "iCs": ""}), ("f", "fn", "footnote reference", {})]


def test_enforced(spark):
    styles = spark.createDataFrame(STYLES, "source_path string, style_id string, style_name string, props map<string,string>")
    runs = spark.createDataFrame([("f", k, p) for k, p in enumerate([{"rStyle": "k", "i": ""}, {"rStyle": "em"}, {"rStyle": "st", "color": "1", "b": ""}, {"rStyle": "bi"}, {"rStyle": "fn"}, {"rStyle": "zz"}, {"i": ""}, {}, None])], "source_path string, run int, props map<string,string>")
    out = pp.enforced_runs(runs, styles).orderBy("run").collect()
    assert [(r["props"], sorted(r["removed"]), r["mapped"], r["removed_style"]) for r in out] == [
        ({"rStyle": "k"}, ["i"], None, None), ({"rStyle": pp.ITALIC}, [], f"Emphasis->{pp.ITALIC}", None), ({"rStyle": pp.BOLD}, ["b", "color"], f"Strong->{pp.BOLD}", None), ({}, [], None, "Both"), ({"rStyle": "fn"}, [], None, None), ({}, [], None, "zz"), ({}, ["i"], None, None), ({}, [], None, None), ({}, [], None, None),
    ]
    n = pp.counters(pp.enforced_runs(runs, styles), {"removed": F.col("removed"), "mapped": F.array_compact(F.array("mapped"))})
    assert {(r["bucket"], r["name"]): r["n"] for r in n.collect()} == {("removed", "i"): 2, ("removed", "b"): 1, ("removed", "color"): 1, ("mapped", f"Emphasis->{pp.ITALIC}"): 1, ("mapped", f"Strong->{pp.BOLD}"): 1}
    p = spark.createDataFrame([({"pStyle": "x", "ind": "1", "sectPr": ""},), ({},), (None,)], "props map<string,string>")
    assert [(r["props"], r["removed"]) for r in pp.enforced_paragraphs(p).collect()] == [({"pStyle": "x", "sectPr": ""}, ["ind"]), ({}, []), (None, [])]


def test_normalized(spark):
    rows = [(None, {"i": "", "iCs": "", "u": ""}), ("", {"b": "1"}), ("", {"b": "", "i": ""}), ("", {"i": "0"}), ("Emphasis", {"i": ""}), ("Odd", {"i": ""}), ("Default Paragraph Font", {"iCs": ""})]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, char_style string, props map<string,string>")
    got = [(r["char_style"], r["props"], r["outcome"]) for r in pp.normalized_runs(df, {"Emphasis": pp.ITALIC}).orderBy("k").collect()]
    assert got == [(pp.ITALIC, {"u": ""}, "converted_manual_italic"), (pp.BOLD, {}, "converted_manual_bold"), ("", {"b": "", "i": ""}, "skipped_combined_emphasis"), ("", {"i": "0"}, None), (pp.ITALIC, {}, "converted_manual_italic"), ("Odd", {"i": ""}, None), (pp.ITALIC, {}, "converted_manual_italic")]


def test_audit(spark):
    p = spark.createDataFrame([(1, "Body", {"pStyle": "B", "ind": "1", "jc": "c"}), (2, "House", {"sectPr": ""}), (3, None, None)], "p int, style_name string, props map<string,string>")
    r = spark.createDataFrame([(1, "a", "", [], {"i": "", "color": "1"}), (1, "b", pp.ITALIC, ["Gaura"], {"i": "", "b": "0"}), (1, " ", "Odd", ["Gaura"], {"b": ""}), (2, "c", "Odd", None, {"b": ""}), (2, "d", "Footnote Reference", [], {"rStyle": "x"})], "p int, text string, char_style string, fonts array<string>, props map<string,string>")
    got = {(x["p"], x["kind"]): x["counts"] for x in pp.audit(p, r, ["p"], "Gaura", ["House"]).collect()}
    assert got == {
        (1, "paragraph_override"): {"ind": 1, "jc": 1}, (1, "noncanonical_paragraph_style"): {"Body": 1}, (1, "run_override"): {"color": 1, "i": 2}, (1, "manual_emphasis_without_char_style"): {"italic": 1}, (1, "gaura_times_run"): {"Gaura": 1},
        (2, "run_override"): {"b": 1}, (2, "manual_emphasis_without_char_style"): {"bold": 1}, (2, "noncanonical_character_style"): {"Odd": 1},
    }
