"""How diacritics in a text are to be treated, and texts without them."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Combining marks, letters with marks, styles, words of prose and of verse, letters and words as they are written without marks.
MARKS = "̣̄̇̃́"
MARKED = "ĀāĪīŪūṚṛṜṝḶḷḸḹṂṃṀṁṄṅÑñṆṇṬṭḌḍḤḥŚśṢṣ"
VERSE_STYLES, QUOTE_STYLES = ("Шлока", "Шлока в цитате"), ("Цитата 1", "Цитата 2")
NOTE_STYLES, PROSE_PREFIXES = ("Сноска", "Сноска 1", "Сноска 2", "Сноска 3", "Сноска 4"), ("toc", "Заголовок")
PROSE_WORDS = "а без был была были было в во все всех где для его ее её если глава и из или их к как когда который которые между на не но о об однако он она они от по после при с со так также то что чтобы это номер стих стихи стр том".split()
VERSE_WORDS = "бху виджнана виграхайа дайине дайитайа деве деви ити крпабдхайе кр̣ш̣н̣а кришна нама намах намас намине намо ом прабхаве сту тале те".split()
PLAIN = dict(zip("āĀīĪūŪṛṚṝṜḷḶḹḸṃṂṁṀṅṄṇṆñÑṭṬḍḌḥḤśŚṣṢ", "а А и И у У ри Ри ри Ри ли Ли ли Ли м М м М н Н н Н н Н т Т д Д х Х ш Ш ш Ш".split(), strict=True))
VOWELS = {"Р̣": "Ри", "р̣": "ри", "Л̣": "Ли", "л̣": "ли", "Р̥": "Ри", "р̥": "ри", "Л̥": "Ли", "л̥": "ли"}
SPELLED = {
    "саннйа": "саннья", "Саннйа": "Саннья", "ачарйа": "ачарья", "Ачарйа": "Ачарья", "ачарй": "ачарь", "Ачарй": "Ачарь", "вайрагйа": "вайрагья", "Вайрагйа": "Вайрагья",
    "вайрагй": "вайрагь", "Вайрагй": "Вайрагь", "видйа": "видья", "Видйа": "Видья", "видй": "видь", "Видй": "Видь", "Мадхйа": "Мадхья", "мадхйа": "мадхья", "Антйа": "Антья", "антйа": "антья",
    "Чатур-масйа": "Чатур-масья", "чатур-масйа": "чатур-масья", "Майапур": "Майяпур", "майапур": "майяпур", "Чатур-масй": "Чатур-мась", "чатур-масй": "чатур-мась",
}

#: Java tries the members of a class one after the other, for every character: the ranges first tell whether it may be one.
_ANY = rf"[Ññ\x{{100}}-\x{{3ff}}\x{{1e00}}-\x{{1eff}}&&[{MARKED}{MARKS}]]"
_LETTER = f"[A-Za-zА-Яа-яЁё{_ANY}]"
WORD = f"{_LETTER}+(?:[-‑]{_LETTER}+)*"
#: An entry of a list of abbreviations or references.
ENTRY = r"^\s*[A-Za-zА-Яа-яЁё]{1,6}\s*(?:\d[\d.,:;–—-]*)?:"


def has_marks(c: Column) -> Column:
    return c.rlike(_ANY)


def without_marks(c: Column) -> Column:
    """The text in plain letters: vocalic consonants, letters with marks, marks, and words that are then spelt otherwise, in that order. Unicode's normal forms need Python."""

    @F.pandas_udf("string")
    def plain(x: pd.Series) -> pd.Series:
        spelled = [(re.compile(rf"\b{old}"), new) for old, new in SPELLED.items()]
        letters, marks = str.maketrans(PLAIN), dict.fromkeys(map(ord, MARKS))

        def one(s: str | None) -> str | None:
            if not s:
                return s
            for old, new in VOWELS.items():
                s = s.replace(old, new)
            s = unicodedata.normalize("NFC", unicodedata.normalize("NFD", s.translate(letters)).translate(marks))
            for old, new in spelled:
                s = old.sub(new, s)
            return s

        return x.map(one)

    return plain(c)


def stats(raw: Column, plain: Column) -> Column:
    """Words, marked ones, words of Russian prose, words of verse (in the text without marks) and non-empty lines of a text."""
    words = F.regexp_extract_all(raw, F.lit(WORD), 0)
    prose = F.array(*[F.lit(w.replace("ё", "е")) for w in PROSE_WORDS])
    verse = F.array(*map(F.lit, VERSE_WORDS))
    said = F.regexp_extract_all(F.replace(F.lower(plain), F.lit("ё"), F.lit("е")), F.lit(WORD), 0)
    return F.struct(
        F.size(words).alias("words"),
        F.size(F.filter(words, lambda w: w.rlike(_ANY))).alias("marked"),
        F.size(F.filter(words, lambda w: F.array_contains(prose, F.replace(F.lower(w), F.lit("ё"), F.lit("е"))))).alias("prose"),
        F.size(F.filter(said, lambda w: F.arrays_overlap(F.concat(F.array(w), F.split(w, "[-‑]")), verse))).alias("verse"),
        F.greatest(F.lit(1), F.size(F.filter(F.split(raw, "\r\n|\n|\r"), lambda x: F.trim(x) != ""))).alias("lines"),
    )


def looks_verse(raw: Column, s: Column) -> Column:
    """Whether a text is quoted verse in transliteration, by what `stats` says of it."""
    n = F.greatest(s["words"], F.lit(1))
    marked, prose = s["marked"] / n, s["prose"] / n
    long_ = F.regexp_replace(raw, r"[\s ]+", " ").rlike("[-‑].{8,}[-‑]")
    return (
        has_marks(raw) & s["words"].between(1, 120) & ~((s["prose"] >= 3) & (prose >= 0.12))
        & (
            (((s["lines"] >= 2) | (s["words"] >= 8)) & (marked >= 0.30) & (prose <= 0.18))
            | ((s["words"] >= 4) & (marked >= 0.55) & (s["prose"] == 0) & raw.rlike("[,;।]"))
            | ((s["words"] >= 4) & (s["verse"] >= 1) & (s["marked"] >= 2) & (prose <= 0.18))
            | ((s["words"] <= 3) & long_ & (s["prose"] == 0))
        )
    )


def decision(raw: Column, plain: Column, style: Column | None = None) -> Column:
    """(action, reason): none, preserve or normalize_prose, by the first rule that holds. plain: the text without marks."""
    style = F.coalesce(style, F.lit("")) if style is not None else F.lit("")
    pair = lambda a, r: F.struct(F.lit(a).alias("action"), (r if isinstance(r, Column) else F.lit(r)).alias("reason"))
    prefixed = F.lit(False)
    for p in PROSE_PREFIXES:
        prefixed |= style.startswith(p)

    def by(s: Column) -> Column:
        verse = looks_verse(raw, s)
        note = verse & (s["lines"] >= 2) & (s["marked"] / F.greatest(s["words"], F.lit(1)) >= 0.40)
        return (
            F.when(style.isin(*VERSE_STYLES), pair("preserve", F.concat(F.lit("style:"), style)))
            .when(prefixed, pair("normalize_prose", F.concat(F.lit("style:"), style)))
            .when(style.isin(*NOTE_STYLES) & ~note, pair("normalize_prose", F.concat(F.lit("footnote-prose-style:"), style)))
            .when(F.trim(F.regexp_replace(raw, r"[\s ]+", " ")).rlike(ENTRY), pair("normalize_prose", "reference-or-abbreviation-entry"))
            .when(style.isin(*QUOTE_STYLES) & verse, pair("preserve", F.concat(F.lit("quote-style-transliteration:"), style)))
            .when(verse, pair("preserve", "transliteration-block"))
            .otherwise(pair("normalize_prose", "russian-prose-with-diacritics"))
        )

    # Every mark stands in some word, so only texts with marks are counted; bound to a variable, once each.
    return F.when(~has_marks(raw), pair("none", "no-diacritics")).otherwise(F.get(F.transform(F.array(stats(raw, plain)), by), F.lit(0)))
