"""What a paragraph looks like: source, caption, letter, verse, its translation, quotation. Column functions, JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions import diacritics as di
from lectern.functions import text as tx

# Styles that a rule may replace, names of works and parts, openings of captions and letters, stems of transliterated words.
BODY_STYLES = ("Основной текст", "Normal", "Normal (Web)")
WORK_NAMES = ("шб", "бг", "чч", "нп", "SB", "Bg", "Cc", "ади-лила", "мадхья-лила", "антья-лила", "шри мад-бхагаватам", "шримад-бхагаватам", "бхагавад-гита", "шри чайтанья-чаритамрита", "шри чайтанья чаритамрита")
WORK_STARTS = ("ШБ", "БГ", "ЧЧ", "Ади-лила", "Мадхья-лила", "Антья-лила")
PART_NAMES = ("Ади-лила", "Мадхья-лила", "Антья-лила")
CAPTIONS = r"изображени[ея]|подпись|подпись к изображени|подпись к изображениям|без подписи"
SHORT_CAPTIONS = r"ом̇\s+виш|первая страница|последняя страница|место явления|бхаджан-кутир|пушпа-самадхи|перед\s+|на\s+|во время\s+|при[её]м\s+|прибытие\s+|закладка\s+|санкиртана\s+"
LETTERS, LETTER_ENDS = r"дорог[а-я]+|уважаем[а-я]+|пожалуйста,\s*примите мои смиренные поклоны", "ваш слуга|искренне ваш"
STEMS = (
    "адхокш ананта аравинд асми атма бгаван бхагав бхадж бхакт бхри бху бхув брахм вайшнав ванд вишну врадж вринд гатен гаура говинд госвам гуру джай джана джива дев дой дуратй йа йад йас йо йукта"
    " кали кама каруна криш кршн локан мад майа мам ман матах море нама нирвиш нитй ом пада прабху прабхупад прачар прем са сарасват сарва сев сукх татх томар твад ха хари чайтан чарана шакти шри шримат шунй"
).split()
SMALL_WORDS = ("и", "в", "на", "не", "но", "что", "как")
#: Left indent, in twentieths of a point, from which a paragraph is a block of its own.
BLOCK_INDENT = 1000

_W = r"[\p{L}\p{N}_]"
#: A border of a word whose letters are letters, digits and underscores, but not combining marks.
_B = rf"(?:(?<={_W})(?!{_W})|(?<!{_W})(?={_W}))"
_M = f"[{di.MARKS}]"
ENTRY = r"^[А-ЯЁA-Z][А-ЯЁA-Zа-яёa-z]{0,7}:\s"


def marks_score(c: Column) -> Column:
    """Combining marks, Cyrillic letters with one, and words with one."""
    return F.regexp_count(c, F.lit(_M)) + F.regexp_count(c, F.lit(f"(?iu)[а-яё]{_M}")) + F.regexp_count(c, F.lit(f"(?iu){_B}[а-яё-]{{2,}}{_M}[а-яё-]*{_B}"))


def marked_ratio(clean: Column) -> Column:
    """The share of words with a combining mark."""
    words = F.regexp_extract_all(clean, F.lit(f"((?iu)[а-яёa-z0-9{di.MARKS}-]+)"), 1)
    return F.coalesce(F.size(F.filter(words, lambda w: w.rlike(_M))) / F.nullif(F.size(words), F.lit(0)), F.lit(0.0))


def looks_source(clean: Column) -> Column:
    """A verse's label, a quoted title with a number, or a short line with a work's name and a number, which may follow at once."""
    n = tx.word_count(clean)
    starts = [clean.startswith(s) for s in WORK_STARTS]
    parts = [clean.contains(s) for s in PART_NAMES]
    some = lambda tests: F.greatest(*tests)
    named = clean.rlike(rf"(?iu){_B}(?:{'|'.join(WORK_NAMES)})(?:{_B}.*)?\d")
    near = (n <= 18) | some(starts) & (n <= 28) | clean.startswith("«") & some(parts) & (n <= 24)
    return (clean != "") & (clean.rlike(r"(?iu)^текст\s+\d+[а-яa-z]?$") | clean.rlike(r"^«[^»]{2,80}»\s+\d") & (n <= 28) | named & near)


def looks_caption(clean: Column) -> Column:
    n = tx.word_count(clean)
    short = (n <= 24) & ~clean.rlike("[?!]|:$")
    page = clean.rlike(r"(?iu)\((?:стр\.|p\.|pp\.)\s*\d")
    return clean.rlike(rf"(?iu)^(?:{CAPTIONS}){_B}") | short & (page | clean.rlike(rf"(?iu)^(?:{SHORT_CAPTIONS})") & (di.has_marks(clean) | (n <= 10)))


def looks_letter(clean: Column) -> Column:
    return clean.rlike(rf"(?iu)^(?:{LETTERS}|(?:{LETTER_ENDS}){_B})")


def looks_spelled_verse(clean: Column) -> Column:
    """Verse spelled in plain Cyrillic: no capitals, no punctuation, at most 16 words, with stems that only transliteration has."""
    words = F.regexp_extract_all(F.lower(clean), F.lit("([а-яё']+(?:-[а-яё']+)*)"), 1)
    of = F.struct(words.alias("w"), F.size(F.filter(words, lambda w: w.rlike("|".join(STEMS)))).alias("hits"))

    def verse(x: Column) -> Column:
        w, n = x["w"], F.size(x["w"])
        real = ~F.exists(w, lambda v: ~v.rlike("[а-яё]"))
        few = (n <= 4) & (x["hits"] >= 1) & ~F.arrays_overlap(w, F.array(*map(F.lit, SMALL_WORDS)))
        return n.between(1, 16) & ((n > 1) | (F.length(F.element_at(w, 1)) >= 5)) & real & ((x["hits"] >= 2) | (x["hits"] >= 1) & F.exists(w, lambda v: v.contains("-")) | few)

    plain = (clean != "") & ~clean.rlike("[А-ЯЁA-Z]") & ~clean.rlike('[.!?«»“”"():;,]')
    return F.when(plain, F.exists(F.array(of), verse)).otherwise(False)


def looks_verse_paragraph(raw: Column, clean: Column, stats: Column, block: Column, source: Column, caption: Column) -> Column:
    """Verse by its marks, its lines or its stems, or a short marked block. stats: of the raw text; source, caption: looks_source, looks_caption."""
    score, ratio = marks_score(clean), marked_ratio(clean)
    marked = clean.rlike(_M) & ((score >= 4) & (ratio >= 0.45) | (score >= 2) & (ratio >= 0.7) | raw.contains("\n") & (score >= 2) & (ratio >= 0.35))
    shloka = (clean != "") & ~clean.rlike(ENTRY) & (F.coalesce(di.looks_verse(raw, stats), F.lit(False)) | marked | looks_spelled_verse(clean))
    return ~source & ~caption & (shloka | block & di.has_marks(raw) & (tx.word_count(clean) <= 18))


def looks_translation(clean: Column) -> Column:
    return clean.startswith("«") & clean.endswith("»") | clean.startswith("—")


def looks_quote(clean: Column) -> Column:
    return (clean != "") & ~clean.rlike(ENTRY) & clean.startswith("«") & (clean.endswith("»") | (F.length(clean) <= 800))


def looks_block_quote(clean: Column, block: Column, source: Column, quote: Column) -> Column:
    """A quotation by its marks or by its indent. source, quote: looks_source, looks_quote."""
    n = tx.word_count(clean)
    return (clean != "") & ~source & ~clean.rlike(ENTRY) & (quote | block & (clean.rlike('^[«“"]') | n.between(8, 260)))


def is_block(left: Column, first_line: Column) -> Column:
    left, first_line = F.coalesce(left, F.lit(0)), F.coalesce(first_line, F.lit(0))
    return F.greatest(left, left + F.greatest(F.lit(0), first_line)) >= BLOCK_INDENT


def match_key(c: Column) -> Column:
    """Text as hints are compared: no-break spaces, white space and case made one, ё as е."""
    return F.lower(F.regexp_replace(F.regexp_replace(tx.clean(c), "ё", "е"), "Ё", "Е"))
