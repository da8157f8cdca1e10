"""Blocks and fields of HTML pages."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Class names of sections and the sections they open.
SECTION_CLASSES = {"av-bengali": "bengali", "av-devanagari": "devanagari", "av-verse_text": "verse_text", "av-synonyms": "synonyms", "av-translation": "translation", "av-purport": "purport", "av-commentary": "commentary"}
_BREAKS = {"p", "div", "br", "li", "tr", "section", "article", "blockquote", "ul", "ol", "table"}
_HEADS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_SILENT = {"script", "style", "nav", "template", "noscript"}


class _Blocks(HTMLParser):
    """Blocks in document order with section and italic fragments; headings apart, navigation and scripts left out."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, str, list[str]]] = []
        self.heads: list[str] = []
        self.sections: list[tuple[str, str]] = []
        self.text: list[str] = []
        self.italics: list[str] = []
        self.silent = self.italic = self.head = 0

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            if self.head:
                self.heads.append(text)
            else:
                self.blocks.append((self.sections[-1][1] if self.sections else "body", text, [x for x in (" ".join(i.split()) for i in self.italics) if x]))
        self.text, self.italics = [], []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _SILENT:
            self.flush()
            self.silent += 1
        elif tag in _BREAKS or tag in _HEADS:
            self.flush()
            self.head += tag in _HEADS
        elif tag in ("i", "em"):
            self.italic += 1
            self.italics.append("")
        for name in (dict(attrs).get("class") or "").split():
            if name in SECTION_CLASSES:
                self.flush()
                self.sections.append((tag, SECTION_CLASSES[name]))
                break

    def handle_endtag(self, tag: str) -> None:
        if tag in _SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in _BREAKS or tag in _HEADS:
            self.flush()
            self.head = max(0, self.head - (tag in _HEADS))
        elif tag in ("i", "em"):
            self.italic = max(0, self.italic - 1)
        if self.sections and self.sections[-1][0] == tag:
            self.flush()
            self.sections.pop()

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.text.append(data)
            if self.italic and self.italics:
                self.italics[-1] += data


def parse(page: str | None) -> list[tuple[str, str, list[str]]]:
    """(section, text, italic fragments) of a page's blocks; what the parser can't read gives the blocks before it."""
    p = _Blocks()
    try:
        p.feed(page or "")
        p.close()
    finally:
        p.flush()
    return p.blocks


def html_blocks(df: DataFrame, key: str, page: str) -> DataFrame:
    """A row for each block: key, block_index, section, text, italics, error. A page that can't be parsed is one row with its error; the job goes on."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keep = [], []
            for k, page_ in enumerate(batch.column("page").to_pylist()):
                try:
                    rows += [(i, *b, None) for i, b in enumerate(parse(page_), 1)]
                    keep += [k] * (len(rows) - len(keep))
                except Exception as e:  # noqa: BLE001
                    rows.append((0, None, None, [], str(e)))
                    keep.append(k)
            types = [pa.int32(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string()]
            yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(keep, pa.int64())), *(pa.array([r[n] for r in rows], t) for n, t in enumerate(types))], [key, "block_index", "section", "text", "italics", "error"])

    return df.select(key, F.col(page).alias("page")).mapInArrow(run, f"{key} {kind}, block_index int, section string, text string, italics array<string>, error string")


def absolute_links(page: Column) -> Column:
    return F.regexp_extract_all(page, F.lit('href="(/[^"]*)"'), 1)


def first_tag(page: Column, tag: str) -> Column:
    """The text of a tag's first occurrence, as it stands; empty if there is none."""
    return F.regexp_extract(page, f"<{tag}[^>]*>([^<]*)</{tag}>", 1)


def language(page: Column) -> Column:
    return F.regexp_extract(page, '<html[^>]* lang="([^"]*)"', 1)


def json_strings(page: Column, marker: str) -> Column:
    """JSON string values that follow a marker such as `"__html":`, unescaped."""
    raw = F.regexp_extract_all(page, F.lit(f'{marker}\\s*("(?:[^"\\\\]|\\\\.)*")'), 1)
    return F.filter(F.transform(raw, lambda s: F.from_json(F.concat(F.lit('{"v":'), s, F.lit("}")), "v string")["v"]), lambda v: v.isNotNull())


def path_info(web_path: Column) -> Column:
    """What a page's address path says: locale, parts, work, kind of page, depth."""
    parts = F.filter(F.split(F.regexp_replace(web_path, r"[?#].*$", ""), "/"), lambda x: x != "")
    depth = F.size(parts)
    at = lambda i: F.try_element_at(parts, F.lit(i))
    kind = F.when(depth == 0, "root").when(depth == 1, "locale").when(F.try_element_at(parts, depth).rlike(r"^\d+(?:-\d+)?(?:\.html)?$"), "verse").otherwise("chapter")
    return F.struct(at(1).alias("locale"), F.slice(parts, 2, F.greatest(depth - 1, F.lit(0))).alias("parts"), at(2).alias("work_id"), kind.alias("page_type"), depth.alias("path_depth"))


def assembled(pages: DataFrame, path: str) -> DataFrame:
    """pages with verse_child_count and assembly_mode: how a chapter's page can be put together.

    advanced_view if the mirror has that page below it, else verse_pages if it has verses below it, else null; null for
    verses and views themselves. Children are counted by an aggregation and one join, whatever their number.
    """
    verse = r"/\d+(-\d+)?/$"
    below = pages.select(F.regexp_replace(path, r"[^/]+/$", "").alias("_of"), F.col(path).endswith("/advanced-view/").alias("_view"), F.col(path).rlike(verse).alias("_verse"))
    below = below.groupBy("_of").agg(F.max("_view").alias("_view"), F.count_if("_verse").alias("_n"))
    chapter = ~F.col(path).rlike(verse) & ~F.col(path).endswith("/advanced-view/") & (F.col(path) != "")
    x = pages.join(below.withColumnRenamed("_of", path), path, "left")
    mode = F.when(chapter & F.coalesce("_view", F.lit(False)), "advanced_view").when(chapter & (F.col("_n") > 0), "verse_pages")
    return x.withColumns({"verse_child_count": F.when(chapter, F.coalesce("_n", F.lit(0))).otherwise(0).cast("long"), "assembly_mode": mode}).drop("_view", "_n")
