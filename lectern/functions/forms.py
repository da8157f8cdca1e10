"""Paths, formats, labels, candidates' texts and no-break spaces: small forms over single columns. JVM-side but for entities."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import diacritics as di

#: Characters of a word in review packs; Python's word characters, marked Latin letters, apostrophe and hyphen.
PACK_WORD = r"[\p{L}\p{N}_'-]+"
#: No-break rewrites in order (name, Java pattern, replacement).
LETTER = "A-Za-zА-Яа-яЁё"
NO_BREAK = (
    ("one_letter", rf"(?m)(^|[\s(\[«„\"'])([ВвКкСсУуИиОоАаЯя])\x20+([{LETTER}0-9])", "$1$2 $3"),
    ("percent", r"(\d)\x20+(%)", "$1 $2"),
    ("numero", r"(№)\x20+(\d)", "$1 $2"),
    ("references", r"([Рр]ис\.|[Тт]абл\.|[Гг]л\.|[Сс]тр\.|[Пп]рим\.|[Тт]\.)\x20+(\d)", "$1 $2"),
    ("dash_left", rf"([{LETTER}0-9»”)\]])\x20+([—–])\x20+([{LETTER}0-9«„\"(\[])", "$1 $2 $3"),
)


def no_break(c: Column) -> Column:
    """(text, and the places rewritten by each rule): no-break spaces after one-letter words, before percent signs and dashes, and in short references."""
    counts = []
    for name, pattern, put in NO_BREAK:
        counts.append(F.regexp_count(c, F.lit(pattern)).alias(name))
        c = F.regexp_replace(c, pattern, put)
    return F.struct(c.alias("text"), *counts)


def candidate_text(c: Column, unwrap: bool = True) -> Column:
    """A term's text: entities resolved, white space collapsed, quotes before and quotes and punctuation behind it gone; unwrap: also one pair of parentheses around it."""

    @F.pandas_udf("string")
    def unescaped(x: pd.Series) -> pd.Series:
        return x.map(lambda s: s and html.unescape(s))

    def bare(x: Column) -> Column:
        x = F.trim(F.regexp_replace(x, r"(?! ?[\x21-\x7e])(?: [\s\x{a0}]+|[\t\n\x0b\f\r\x{a0}][\s\x{a0}]*)", " "))
        return F.regexp_replace(F.regexp_replace(x, "^[\"'«„“”]+", ""), "[\"'»“”.,;:!?]+$", "")

    def unwrapped(x: Column) -> Column:
        one = x.startswith("(") & x.endswith(")") & (F.length(x) - F.length(F.translate(x, "()", "")) == 2)
        return F.when(one, F.substring(x, F.lit(2), F.length(x) - 2)).otherwise(x)

    c = F.coalesce(c, F.lit(""))
    # Python gets nulls but where there is an entity. What follows is bound to a lambda's variable and worked out once.
    c = bare(F.coalesce(unescaped(F.when(F.instr(c, "&") > 0, c)), c))
    return F.trim(F.get(F.transform(F.array(c), unwrapped), F.lit(0)) if unwrap else c)


def pack_words(c: Column) -> Column:
    return F.regexp_count(c, F.lit(PACK_WORD))


def source_block_class(c: Column) -> Column:
    """heading_like, sanskrit_or_term, page_or_number or body."""
    n = pack_words(c)
    return F.when((n <= 12) & ~c.rlike("[.!?:;,]$"), "heading_like").when(di.has_marks(c) & (n <= 50), "sanskrit_or_term").when(c.rlike("^[0-9ivxlcdmIVXLCDM .–-]+$"), "page_or_number").otherwise("body")


def source_format(path: Column, forced: str | None = None) -> Column:
    """doc, docx, text, mirror_html, html; null: not supported."""
    if forced:
        return F.lit(forced)
    suffix = F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))
    return F.when(suffix == ".doc", "doc").when(suffix == ".docx", "docx").when(suffix.isin(".txt", ".md"), "text").when(suffix.isin(".html", ".htm"), F.when(path.contains("/vedabase/"), "mirror_html").otherwise("html"))


def web_path(c: Column) -> Column:
    """Without empty parts and between slashes; empty without any part."""
    parts = F.filter(F.split(F.coalesce(c, F.lit("")), "/"), lambda p: p != "")
    return F.when(F.size(parts) > 0, F.concat(F.lit("/"), F.array_join(parts, "/"), F.lit("/"))).otherwise("")


def mirrored_path(path: Column, root: str = "vedabase") -> Column:
    """The web path of a mirror's file: what stands below the root's folder, without index.html; empty outside the root."""
    parts = F.split(path, "/")
    below = F.slice(parts, F.array_position(parts, root).cast("int") + 1, 1 << 20)
    below = F.when(F.lower(F.try_element_at(below, F.lit(-1))) == "index.html", F.slice(below, 1, F.size(below) - 1)).otherwise(below)
    return F.when(F.array_position(parts, root) == 0, "").when(F.size(below) == 0, "/").otherwise(F.concat(F.lit("/"), F.array_join(below, "/"), F.lit("/")))


def verse_key(c: Column) -> Column:
    """What verses are ordered by: the first number, the second, the text."""
    n = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(\d+)"), 1)
    return F.struct(F.coalesce(F.try_element_at(n, F.lit(1)).cast("long"), F.lit(10**9)).alias("first"), F.coalesce(F.try_element_at(n, F.lit(2)).cast("long"), F.lit(-1)).alias("second"), F.coalesce(c, F.lit("")).alias("token"))


def section_text(c: Column) -> Column:
    """Form feeds as line ends, at most one empty line in a row, one line end behind."""
    return F.concat(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "\f", "\n"), "\n{3,}", "\n\n"), r"^\s+|\s+$", ""), F.lit("\n"))


def page_line(c: Column) -> Column:
    """A page's line without control and zero-width characters."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[\f\x08�​﻿]", " "), r"\s+", " "))


def source_priority(label: Column) -> Column:
    """Which source of a term is preferred: the smallest."""
    l = F.lower(label)
    return F.when(l.contains("our") | l.contains("bvks_ru"), 0).when(l.contains("vedabase_ru"), 1).when(l.contains("vedabase"), 2).when(l.contains("bvks_en"), 3).otherwise(9)


def diacritics_policy(variants: Column) -> Column:
    """By whether all, some or none of a term's variants have marks."""
    some, other = F.exists(variants, lambda v: v.rlike(TERM_MARKS)), F.exists(variants, lambda v: ~v.rlike(TERM_MARKS))
    return F.when(F.size(variants) == 0, "draft").when(some & other, "diacritics_in_quotes_only").when(some, "needs_review").otherwise("no_diacritics_in_prose")


#: Fixed value: what counts as a mark in a term.
TERM_MARKS = "[̀-ͯāīūṛṝḷḹṅñṭḍṇśṣṃḥĀĪŪṚṜḶḸṄÑṬḌṆŚṢṂḤ]"
