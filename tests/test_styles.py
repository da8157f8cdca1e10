"""Paragraph styles: the automaton against a plain loop over documents of any length, its rules and hints."""

import random

import pytest
from pyspark.sql import functions as F

from lectern.functions import styles as st
from lectern.functions import text as tx
from lectern.operators import classify as cl
from lectern.operators import scan

SCHEMA = "doc long, at int, text string, style_name string, left_indent int, first_line_indent int, paragraph_italic boolean"
VERSE = "кр̣ш̣н̣а говинда̄ ха̄ре мура̄ре"


def rows(texts, doc=1, **more):
    return [(doc, k + 1, t, more.get("style", "Normal"), more.get("left", 0), 0, False) for k, t in enumerate(texts)]


def given(spark, data, hints=()):
    got = cl.semantic_styles(spark.createDataFrame(data, SCHEMA), ["doc"], "at", list(hints)).orderBy("doc", "at").collect()
    return [(r["at"], r["new_style"], r["reason"], r["applied"]) for r in got]


def test_rules_in_order(spark):
    texts = [VERSE, "«Перевод»", VERSE, "— перевод", "«цитата из восьми слов или около того, длинная»", VERSE, "БГ 2.13", "«Короткая»", "просто текст", "Дорогой Прабху", "Изображение храма", "Текст 12", "джай гуру-дев прабху", "«да»", "«и ещё»"]
    got = given(spark, rows(texts))
    assert [(a, s) for a, s, _, _ in got] == [
        (1, "Шлока"), (2, "Перевод шлоки"), (3, "Шлока"), (4, "Перевод шлоки"), (5, "Цитата 1"), (6, "Шлока в цитате"), (7, "Источник"), (8, None), (10, "Письмо"), (11, "Подпись к иллюстрации"), (12, "Источник"), (13, "Шлока"), (14, "Перевод шлоки"), (15, None),
    ]
    assert got[7][2:] == ("possible-semantic-style-needs-review", False)


def test_near_source_and_continued(spark):
    assert [s for _, s, r, _ in given(spark, rows(["«Короткая»", "x", "БГ 2.13", "x", "«ещё»", "«и ещё»"])) if r != "scripture-reference-pattern"] == ["Цитата 1", "Цитата 1", "Цитата 1"]
    assert [r for _, _, r, _ in given(spark, rows(["«Короткая»", "", "БГ 2.13", "", "«ещё»", "«и ещё»"]))] == ["quoted-block-near-source", "scripture-reference-pattern", "quoted-block-near-source", "continued-quote-block"]
    # A heading between breaks the chain, and is no style that was given.
    data = rows(["«Короткая»", "БГ 1.1", "«ещё»"])
    data[1] = (1, 2, "БГ 1.1", "Заголовок 1", 0, 0, False)
    assert [(a, r) for a, _, r, _ in given(spark, data)] == [(1, "quoted-block-near-source"), (3, "possible-semantic-style-needs-review")]


def test_looks(spark):
    data = rows(["слово " * 10], left=900) + [(2, 1, "слово", "Normal", 900, 200, False), (3, 1, "слово", "Основной текст", 0, 0, True), (4, 1, None, "Normal", 2000, 0, True), (5, 1, "x " * 300, None, 2000, 0, True), (6, 1, VERSE, "Цитата 1", 0, 0, False)]
    assert [(r["doc"], r["reason"]) for r in cl.semantic_styles(spark.createDataFrame(data, SCHEMA), ["doc"], "at").orderBy("doc").collect()] == [(2, "visual-block-or-paragraph-italic-needs-review"), (3, "visual-block-or-paragraph-italic-needs-review")]
    one = lambda f, t: spark.range(1).select(f(tx.clean(F.lit(t)))).first()[0]
    assert one(st.looks_source, "Ади-лила, глава 3, стих 5") and one(st.looks_source, "текст 5а") and one(st.looks_source, "«Гита» 4") and not one(st.looks_source, "шбх 5") and not one(st.looks_source, "Bg без числа")
    assert not one(st.looks_source, "Bg 5 " + "слово " * 20) and one(st.looks_source, "БГ 5 " + "слово " * 20)
    assert one(st.looks_caption, "Без подписи") and one(st.looks_caption, "Храм (стр. 5)") and not one(st.looks_caption, "Храм (стр. 5)!") and one(st.looks_caption, "Перед храмом") and not one(st.looks_caption, "Перед " + "словом " * 11)
    assert one(st.looks_letter, "Дорогая Радха") and one(st.looks_letter, "Ваш слуга,") and not one(st.looks_letter, "Ваш слугаа") and not one(st.looks_letter, "О дорогой")
    assert one(st.looks_spelled_verse, "намо вишну падая") and not one(st.looks_spelled_verse, "что такое шри") and not one(st.looks_spelled_verse, "Намо вишну") and not one(st.looks_spelled_verse, "намо, вишну")


HINTS = [
    {"match": {"type": "index", "value": 2}, "style": "Цитата 2", "note": "n"}, {"match": {"type": "text", "value": " ЁЖ  и "}, "action": "review_only", "style": "Письмо"}, {"match": {"type": "regex", "value": "^!"}, "action": "ignore"},
    {"match": {"type": "regex", "value": "^«"}, "action": "set_style"}, {"match": {"type": "regex"}, "style": "x"}, {"match": {"type": "odd", "value": 1}, "style": "x"},
]


def test_hints(spark):
    got = given(spark, rows(["ёж и", "слово", "«да»", "! БГ 1.1", "еж  И"]), HINTS)
    assert got == [(1, "Письмо", "hint:text", False), (2, "Цитата 2", "hint:n", True), (3, "Цитата 2", "continued-quote-block", True), (5, "Письмо", "hint:text", False)]
    decisions = cl.semantic_styles(spark.createDataFrame(rows(["слово", "слово"]), SCHEMA), ["doc"], "at", HINTS)
    assert [tuple(r) for r in cl.hint_template(decisions, ["doc"], "at").collect()] == [(1, ("index", 2), "review_only", "Цитата 2", "current:hint:n", "Normal", "hint")]


KINDS = [VERSE, "«да»", "— да", "«цитата из восьми слов или около того, длинная»", "БГ 2.13", "просто текст", "", "Дорогой друг", "«незакрытая"]


def loop(texts):
    """The rules, one paragraph after the other."""
    out, style = {}, [None] * (len(texts) + 2)
    source = lambda k: 0 <= k < len(texts) and texts[k].startswith("БГ")
    for k, t in enumerate(texts):
        prev, before = style[k - 1] if k else None, style[k - 2] if k > 1 else None
        new = None
        if source(k):
            new = "Источник"
        elif t.startswith("Дорогой"):
            new = "Письмо"
        elif prev in ("Шлока", "Шлока в цитате") and (t.startswith("—") or t.startswith("«") and t.endswith("»")):
            new = "Перевод шлоки"
        elif t == VERSE:
            new = "Шлока в цитате" if prev == "Цитата 1" else "Шлока"
        elif t.startswith("«") and (len(t.split()) >= 8 or prev == "Цитата 1" or source(k + 1) or source(k + 2) or before == "Источник"):
            new = "Цитата 1"
        style[k] = new
        if new or t.startswith("«"):
            out[k + 1] = new
    return out


@pytest.mark.parametrize("block", [4, 256])
def test_against_loop(spark, monkeypatch, block):
    """Documents of many blocks, and of blocks of blocks."""
    monkeypatch.setattr(scan, "BLOCK", block)
    rng = random.Random(block)
    docs = {d: [rng.choice(KINDS) for _ in range(n)] for d, n in enumerate([1, 3, 5, 100, 700, 0])}
    docs[9] = ["«да»"] * 2 + ["БГ 2.13"] + ["«да»"] * 600
    docs[None] = ["«да»", "БГ 1.1"]
    data = [r for d, texts in docs.items() for r in rows(texts, d)]
    got = {}
    for r in cl.semantic_styles(spark.createDataFrame(data, SCHEMA).repartition(3), ["doc"], "at").collect():
        got.setdefault(r["doc"], {})[r["at"]] = r["new_style"]
    assert got == {d: loop(t) for d, t in docs.items() if loop(t)}


def test_scan_is_any_automaton(spark, monkeypatch):
    monkeypatch.setattr(scan, "BLOCK", 3)
    rng = random.Random(1)
    steps = ["".join(rng.choice("0123") for _ in range(4)) for _ in range(100)]
    blocks = spark.createDataFrame([(7, k // 3, steps[k : k + 3]) for k in range(0, 100, 3)], "d int, block long, steps array<string>")
    got = {r["block"]: r["entry"] for r in scan.with_entries(blocks, ["d"], F.col("steps"), 4, "2").collect()}
    state, want = "2", {}
    for k, s in enumerate(steps):
        if k % 3 == 0:
            want[k // 3] = state
        state = s[int(state)]
    assert got == want


def test_no_rows(spark):
    assert cl.semantic_styles(spark.createDataFrame([], SCHEMA), ["doc"], "at").collect() == []


def test_styles_keep_all_paragraphs(spark):
    got = cl.styles(spark.createDataFrame(rows([VERSE, "x", "БГ 1.1"]), SCHEMA), ["doc"], "at").orderBy("at").collect()
    assert [r["new_style"] for r in got] == ["Шлока", "Normal", "Источник"]
