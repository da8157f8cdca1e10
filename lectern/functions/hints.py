"""Terms: keys, guards, headwords and their variants. Hints are stems and phrases that tell what a term is about."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions import forms as fm

# Hints by category, in order of precedence; hints that are no base of a longer word; words that begin no headword.
HINTS = {
    "scripture_title": ("бхагавад-гита", "шримад-бхагаватам", "чайтанья-чаритамрита", "чайтанья-бхагавата", "рамаяна", "упанишад", "пурана", "веданта", "веда", "веды", "гита"),
    "place_name": ("вриндаван", "вриндавана", "майяпур", "навадвип", "нилачал", "пури", "радха-кунд", "гокула", "дхам", "дхама", "матх", "кунд", "гимала", "ямуна", "ганга"),
    "honorific": ("шри", "шримати", "шрила", "шрипада"),
    "personal_name": ("махапрабху", "госвами", "свами", "прабху", "махарадж", "тхакур", "деви", "мата", "бабаджи", "ачарья", "ачарйа", "баларама", "вишну", "джаганнатх"),
    "philosophical_term": (
        "бхакти", "санньяс", "вайшнав", "карми", "майявади", "лила", "гуна", "юга", "экадаши", "шастр", "шакта", "харе кришна", "арати", "абхишека", "ашрам", "брахман", "брахмачари", "гаятри", "даршан", "исккон", "абхидхея", "бхога",
    ),
}
NO_BASE = ("шри", "шримати", "шрила", "шрипада", "веда", "веды", "гита", "дхам", "дхама", "матх", "кунд", "пури")
CONJUNCTIONS = ("а", "и", "но", "или", "да", "то", "что", "как", "если", "когда")
VOWELS = "аеёиоуыэюя"
MARKED = r"[\x{300}-\x{36f}āīūṛṝḷḹṅñṭḍṇśṣṃḥĀĪŪṚṜḶḸṄÑṬḌṆŚṢṂḤ]"

#: Texts whose letters lose their marks without Unicode's tables: ASCII, Cyrillic, quotes and dashes.
_SIMPLE = r"^[\x00-\x7FА-Яа-яЁё«»„“”‘’–—…№]*$"


def plain_key(text: str) -> str:
    """normal_key of a hint, on the driver."""
    text = "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn").lower()
    return " ".join(text.replace("ё", "е").replace("—", "-").replace("–", "-").split())


def normal_key(term: Column) -> Column:
    """The key of a term: cleaned, letters without marks (й as и, ё as е), lower case, dashes as hyphens, single spaces.

    Plain Cyrillic and ASCII stay in the JVM; Python gets nulls but for other letters.
    """

    @F.pandas_udf("string")
    def bare(x: pd.Series) -> pd.Series:
        return x.map(lambda s: s and "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn"))

    c = fm.candidate_text(F.coalesce(bare(F.when(~term.rlike(_SIMPLE), term)), term))
    c = F.replace(F.lower(F.translate(c, "йЙёЁ", "иИеЕ")), F.lit("ё"), F.lit("е"))
    return F.trim(F.regexp_replace(F.translate(c, "—–", "--"), r"[\s\x{a0}]+", " "))


def tokens(key: Column) -> Column:
    """Words of a key and their parts between hyphens."""
    words = F.regexp_extract_all(key, F.lit("([a-zа-яё-]+)"), 1)
    return F.array_distinct(F.filter(F.flatten(F.transform(words, lambda w: F.concat(F.array(w), F.split(w, "-")))), lambda w: w != ""))


def _all_caps(c: Column) -> Column:
    letters = F.regexp_replace(c, "[^A-Za-zА-Яа-яЁё]", "")
    return (letters != "") & (F.upper(letters) == letters) & (F.length(letters) <= 5)


def may_be_term(c: Column, kind: Column) -> Column:
    """The guards that ask nothing of a term's category. c: cleaned; kind: glossary_headword, italic or another.

    2 to 120 characters, at most eight spaces; no short capitals, addresses, angle brackets or parentheses, Latin letters,
    digits or marks; a Cyrillic letter first. Italic: at most three words, no punctuation inside, no hyphen at an end.
    """
    spaces = lambda v: F.length(v) - F.length(F.replace(v, F.lit(" ")))
    italic = lambda v: (spaces(v) <= 2) & ~v.rlike("[,;:/.…]") & ~v.rlike("^-|-$")
    guards = lambda v: (
        F.length(v).between(2, 120) & (spaces(v) <= 8) & ~_all_caps(v) & ~v.rlike(r"(?i)https?://|www\.|@|\.com\b") & ~v.rlike("[<>()]")
        & ~v.rlike(r"\p{IsLatin}") & ~v.rlike(r"(?U)\d") & v.rlike("^[А-Яа-яЁё]") & ~v.rlike(MARKED) & F.when(kind == "italic", italic(v)).otherwise(True)
    )
    return F.coalesce(F.exists(F.array(c), guards), F.lit(False))


def _tidy(x: Column) -> Column:
    """candidate_text of a part of a text that is one already: no entities are left in it."""

    def whole(y: Column) -> Column:
        wrapped = y.startswith("(") & y.endswith(")") & (F.length(y) - F.length(F.translate(y, "()", "")) == 2)
        return F.when(wrapped, F.trim(F.substring(y, F.lit(2), F.length(y) - 2))).otherwise(y)

    bare = F.regexp_replace(F.regexp_replace(F.trim(x), "^[\"'«„“”]+", ""), "[\"'»“”.,;:!?]+$", "")
    return F.get(F.transform(F.array(F.trim(bare)), whole), F.lit(0))


def headword_variants(head: Column) -> Column:
    """The head, what stands before its parentheses, each part in them, and parts between commas of up to four words; each once."""
    inside, base = F.regexp_extract(head, r"^[^()]+\(([^()]+)\)$", 1), F.regexp_extract(head, r"^([^()]+)\([^()]+\)$", 1)
    parts = F.when(inside != "", F.concat(F.array(base), F.split(inside, "[,;/]"))).otherwise(F.array().cast("array<string>"))
    listed = F.when(head.contains(",") & (F.length(head) <= 80), F.split(head, r"\s*,\s*")).otherwise(F.array().cast("array<string>"))
    short = F.filter(F.transform(listed, _tidy), lambda x: F.size(F.split(x, " ")) <= 4)
    return F.array_distinct(F.filter(F.concat(F.array(head), F.transform(parts, _tidy), short), lambda x: x != ""))


def headwords(block: Column) -> Column:
    """Variants of the word that a block explains (`Word — meaning`); empty if it is no entry. block: cleaned."""

    def of(head: Column) -> Column:
        words = F.split(head, " ")
        first = F.element_at(words, 1)
        wrong = F.lower(first).isin(*CONJUNCTIONS) | (F.size(words) > 1) & first.rlike(r"^\p{Ll}") & ~head.rlike(r"[-(]")
        return F.when((head != "") & (F.size(words) <= 4) & ~wrong, headword_variants(head)).otherwise(F.array().cast("array<string>"))

    entry = F.regexp_extract(block, r"^([A-ZА-ЯЁ«][^—–-]{1,120}?)\s+[—–-]\s+.+$", 1)
    # The head is bound to a lambda's variable: worked out once, however often the rules name it.
    return F.when(F.length(block) <= 240, F.flatten(F.transform(F.array(_tidy(entry)), of))).otherwise(F.array().cast("array<string>"))
