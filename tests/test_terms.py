"""Term candidates: keys, guards, headwords, hints by prefix against a plain scan of all hints, and the candidates of blocks."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from lectern.functions import diacritics
from lectern.functions import hints as hn
from lectern.operators import candidates as cd


def one(spark, f, *values):
    kinds = ", ".join(f"c{k} string" for k in range(len(values)))
    return spark.createDataFrame([values], kinds).select(f(*[F.col(f"c{k}") for k in range(len(values))])).first()[0]


def test_without_marks(spark):
    assert one(spark, diacritics.without_marks, "Kṛṣṇa й ё видйа́ r̄ р̣ши") == "Kришн\u0061 й ё видья r риши"


def test_keys(spark):
    assert [one(spark, hn.normal_key, x) for x in ("«Майяпур»", "Ёлка  —  да", "Кр̣шн̣а́", "Ñāma.", None, "(бхакти)", "A&amp;B")] == ["маияпур", "елка - да", "кршна", "nama", "", "бхакти", "a&b"]
    assert hn.plain_key("Майяпур — Ё") == "маияпур - е"


@pytest.mark.parametrize("term, kind, may", [
    ("бхакти", "italic", True), ("бхакти йога да нет", "italic", False), ("бхакти йога да нет", "glossary_headword", True), ("я", "italic", False), ("я" * 121, "italic", False), ("а б в г д е ж з и к", "glossary_headword", False), ("СССР", "italic", False),
    ("сайт www.a", "italic", False), ("а@б", "italic", False), ("а<б", "italic", False), ("а (б)", "glossary_headword", False), ("аb", "italic", False), ("а1", "italic", False), ("-а б", "glossary_headword", False), ("«аб»в", "italic", False), ("кр̣шна", "italic", False),
    ("а, б", "italic", False), ("а, б", "glossary_headword", True), ("аб-", "italic", False), ("а/б", "italic", False), ("", "italic", False), (None, "italic", False),
])
def test_guards(spark, term, kind, may):
    assert one(spark, hn.may_be_term, term, kind) is may


def test_headwords(spark):
    got = lambda x: one(spark, hn.headwords, x)
    assert got("Вриндаван — место") == ["Вриндаван"] and got("Майяпур (Пури, Гокула; Матх) – место") == ["Майяпур (Пури, Гокула; Матх)", "Майяпур", "Пури", "Гокула", "Матх", "Майяпур (Пури", "Гокула; Матх)"]
    assert got("Бхакти, служение — это") == ["Бхакти, служение", "Бхакти", "служение"] and got("Если так — то да") == [] and got("слово — не с большой") == [] and got("«Гита» — книга") == ["Гита"]
    assert got("Одно два три четыре пять — да") == [] and got("Слово - да" + "а" * 240) == [] and got(None) == [] and got("Слово без тире") == []


HINTS = {"b": ("гита", "бхакти", "радха-кунд"), "a": ("харе кришна", "гит", "вриндавана", "йо", "юга"), "c": ("шри",)}


def plain(term):
    """What all hints, one after the other, say of a term: key, category, base."""
    key = hn.plain_key(term)
    words = re.findall(r"[a-zа-яё-]+", key)
    parts = words + [p for w in words for p in w.split("-") if p]
    category = next((c for c, hs in HINTS.items() for h in map(hn.plain_key, hs) if (re.search(rf"(?<![a-zа-яё]){re.escape(h)}(?![a-zа-яё])", key) if " " in h else any(p.startswith(h) for p in parts))), "other")
    base = ""
    for h in [h for hs in HINTS.values() for h in hs]:
        n = hn.plain_key(h)
        if " " in key or " " in n or base:
            continue
        longer = not ("-" in key and "-" not in n) and n != "шри" and (len(n) >= 5 and key.startswith(n) or len(n) >= 6 and n[-1] in hn.VOWELS and len(n) >= 5 and key.startswith(n[:-1]))
        base = h if key == n or longer else base
    return key, category, base


def test_hints_by_prefix(spark):
    rng = random.Random(2)
    parts = ["гит", "гита", "бхакти", "йога", "вриндаван", "вриндавана", "харе", "кришна", " ", "-", "радха-кунд", "юга", "шри", "а", "ы", "ё"]
    terms = {"".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))).strip() for _ in range(400)} - {""}
    table = cd.hint_table(spark, HINTS, ("шри",))
    got = {r["term"]: (r["key"], r["category"], r["base"]) for r in cd.described(spark.createDataFrame([(t,) for t in [*terms, *list(terms)[:9], None]], "term string"), table).collect()}
    assert got == {t: plain(t) for t in terms}
    assert unicodedata.normalize("NFC", got["вриндавана"][2]) == "вриндавана" if "вриндавана" in got else True


def test_candidates_of_blocks(spark):
    rows = [(1, "Вриндавана (Гокула) — место", ["бхакти", "слово", None]), (2, "просто текст", None), (3, None, ["Ашрам."]), (4, "Гуны — три", [])]
    got = cd.from_blocks(spark.createDataFrame(rows, "b int, text string, italics array<string>"), cd.hint_table(spark), ["b"]).collect()
    assert sorted((r["b"], r["kind"], r["variant"], r["key"], r["category"]) for r in got) == [
        (1, "glossary_headword", "Вриндавана", "вриндаван", "place_name"), (1, "glossary_headword", "Гокула", "гокула", "place_name"), (1, "italic", "бхакти", "бхакти", "philosophical_term"), (3, "italic", "Ашрам", "ашрам", "philosophical_term"),
    ]
