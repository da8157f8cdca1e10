"""Word files: paragraphs of every story from `binaryFile`, and comments written back at anchors."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import forms as fm
from lectern.functions import hints as hn
from lectern.functions import text as tx
from lectern.operators import runs as rn

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
NAMESPACE = W[1:-1]
#: Parts of the package, and the element that holds a note or comment in each.
STORIES = {"word/document.xml": None, "word/footnotes.xml": f"{W}footnote", "word/endnotes.xml": f"{W}endnote", "word/comments.xml": f"{W}comment"}
SCHEMA = "source_path string, part string, container_id string, paragraph_index int, block_index int, style_name string, text string, footnote_refs int, italic_ratio double, indent int, first_line int, in_table boolean, paragraph_italic boolean, has_break boolean, error string"
RUNS = "source_path string, part string, container_id string, paragraph_index int, run int, text string, note string, italic boolean, bold boolean, char_style string, style_id string, error string"
#: Character styles that are italic; paragraph styles of prose, and parts of the names of styles that hold none.
ITALIC_STYLES = ("char курсив", "emphasis")
PROSE_STYLES = ("основной текст", "normal", "normalweb", "normal web", "normal (web)", "перевод шлоки", "цитата 1", "цитата 2", "письмо")
OTHER_STYLES = ("заголовок", "heading", "шлока", "источник", "подпись", "сноска", "список", "list")


def _on(e: ET.Element | None) -> bool:
    return e is not None and (e.get(f"{W}val") or "true").lower() not in ("0", "false", "off", "none")


def _text(p: ET.Element, breaks: bool = True) -> str:
    out = []
    for e in p.iter():
        if e.tag == f"{W}t":
            out.append(e.text or "")
        elif breaks and e.tag in (f"{W}tab", f"{W}br", f"{W}cr"):
            out.append("\t" if e.tag == f"{W}tab" else "\n")
    return "".join(out)


def _styles(z: zipfile.ZipFile) -> tuple[dict[str, str], str | None]:
    if "word/styles.xml" not in z.namelist():
        return {}, None
    names, default = {}, None
    for s in ET.fromstring(z.read("word/styles.xml")).iter(f"{W}style"):
        name = s.find(f"{W}name")
        names[s.get(f"{W}styleId") or ""] = (name.get(f"{W}val") if name is not None else None) or s.get(f"{W}styleId") or ""
        if s.get(f"{W}type") == "paragraph" and s.get(f"{W}default") in ("1", "true"):
            default = names[s.get(f"{W}styleId") or ""]
    return names, default


def paragraphs(data: bytes) -> list[tuple]:
    """Rows of SCHEMA without path and error: all paragraphs, in tables too, of each story. paragraph_index counts them all from 1, block_index those with text."""
    rows = []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names, default = _styles(z)
        for part, holder in STORIES.items():
            if part not in z.namelist():
                continue
            root = ET.fromstring(z.read(part))
            cells = {id(p) for t in root.iter(f"{W}tbl") for p in t.iter(f"{W}p")}
            held = [("", root)] if holder is None else [(h.get(f"{W}id") or "", h) for h in root.iter(holder) if h.get(f"{W}type") is None]
            n = k = 0
            for container, h in held:
                for p in h.iter(f"{W}p"):
                    n += 1
                    text = _text(p)
                    k += bool(text.split())
                    style, ind = p.find(f"{W}pPr/{W}pStyle"), p.find(f"{W}pPr/{W}ind")
                    runs = [r for r in p.iter(f"{W}r") if _text(r, False)]
                    italic = sum(_on(r.find(f"{W}rPr/{W}i")) for r in runs)
                    number = lambda a: int(ind.get(f"{W}{a}") or 0) if ind is not None and re.fullmatch(r"-?\d+", ind.get(f"{W}{a}") or "0") else 0  # noqa: B023, E731
                    rows.append((part, container, n, k if text.split() else None, names.get(style.get(f"{W}val") or "", style.get(f"{W}val")) if style is not None else default, text, sum(1 for _ in p.iter(f"{W}footnoteReference")), italic / len(runs) if runs else 0.0, number("left"), number("firstLine"), id(p) in cells, any(_on(p.find(f"{W}pPr/{W}rPr/{W}{t}")) for t in ("i", "iCs")), p.find(f".//{W}br") is not None or p.find(f".//{W}cr") is not None))
    return rows


def docx_paragraphs(spark: SparkSession, path: str) -> DataFrame:
    """All paragraphs of the Word files under a folder. A file that can't be read is one row with its error; the job goes on."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.docx").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 3 + [pa.int32()] * 2 + [pa.string()] * 2 + [pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.bool_(), pa.string()]
        for batch in batches:
            rows = []
            for p, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    rows += [(p, *r, None) for r in paragraphs(data)]
                except Exception as e:  # noqa: BLE001
                    rows.append((p, *[None] * 13, f"{type(e).__name__}: {e}"))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [c.split()[0] for c in SCHEMA.split(", ")])

    return files.mapInArrow(run, SCHEMA)


def _stories(z: zipfile.ZipFile) -> Iterator[tuple[str, str, ET.Element, ET.Element]]:
    """(part, container, root, paragraph) of each paragraph of the file, in order."""
    for part, holder in STORIES.items():
        if part in z.namelist():
            root = ET.fromstring(z.read(part))
            for container, h in [("", root)] if holder is None else [(h.get(f"{W}id") or "", h) for h in root.iter(holder) if h.get(f"{W}type") is None]:
                for p in h.iter(f"{W}p"):
                    yield part, container, root, p


def runs(data: bytes) -> list[tuple]:
    """Rows of RUNS without path and error: the runs of every paragraph, with their own text and format, and the note that they mark."""
    rows, at = [], {}
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for part, container, _, p in _stories(z):
            n = at[part] = at.get(part, 0) + 1
            style = p.find(f"{W}pPr/{W}pStyle")
            for k, r in enumerate(p.findall(f"{W}r"), 1):
                note, own = r.find(f"{W}footnoteReference"), r.find(f"{W}rPr/{W}rStyle")
                char = (own.get(f"{W}val") or "").strip().lower() if own is not None else ""
                italic = any(_on(r.find(f"{W}rPr/{W}{t}")) for t in ("i", "iCs")) or char in ITALIC_STYLES
                rows.append((part, container, n, k, "".join(t.text or "" for t in r.iter(f"{W}t")), note.get(f"{W}id") if note is not None else None, italic, _on(r.find(f"{W}rPr/{W}b")), char, style.get(f"{W}val") if style is not None else None))
    return rows


def docx_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs of the Word files under a folder. A file that can't be read is one row with its error; the job goes on."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.docx").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 3 + [pa.int32()] * 2 + [pa.string()] * 2 + [pa.bool_()] * 2 + [pa.string()] * 3
        for batch in batches:
            rows = []
            for p, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                try:
                    rows += [(p, *r, None) for r in runs(data)]
                except Exception as e:  # noqa: BLE001
                    rows.append((p, *[None] * 10, f"{type(e).__name__}: {e}"))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], [c.split()[0] for c in RUNS.split(", ")])

    return files.mapInArrow(run, RUNS)


def prose_with_italics(runs_: DataFrame) -> DataFrame:
    """source_path, paragraph_index, text, italics: paragraphs of prose of the documents' bodies, with their italic fragments.

    A paragraph whose style is one of other text goes; one of a prose style stays; of any other or no style it must look
    like prose. Word-for-word lists and transliteration go in any style. Fragments are neighbouring italic runs.
    """
    keys = ["source_path", "paragraph_index"]
    own = runs_.where((F.col("part") == "word/document.xml") & F.col("error").isNull() & (F.col("text") != ""))
    parts = rn.italic_fragments(own, keys).withColumn("text", fm.candidate_text(F.col("text"))).where("text <> ''")
    parts = parts.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("fragment", "text"))), lambda x: x["text"]).alias("italics"))
    whole = own.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run", "text"))), lambda x: x["text"]), "").alias("text"), F.first("style_id", ignorenulls=True).alias("style"))
    text, style = F.col("text"), F.regexp_replace(F.lower(F.trim(F.coalesce("style", F.lit("")))), r"[\s_]+", " ")
    whole = whole.withColumns({"text": fm.candidate_text(text), "style": style})
    text, style = F.col("text"), F.col("style")
    transliterated = text.rlike(hn.MARKED) & (F.size(F.split(text, " ")) <= 24) & ~text.rlike("[.!?]")
    bad = F.greatest(*[style.contains(x) for x in OTHER_STYLES])
    keep = (text != "") & ~bad & (style.isin(*PROSE_STYLES) | tx.looks_prose(text)) & ~tx.looks_word_for_word(text) & ~transliterated
    return whole.where(keep).join(parts, keys, "left").select(*keys, "text", F.coalesce("italics", F.array().cast("array<string>")).alias("italics"))


def with_run_texts(data: bytes, texts: dict[tuple[str, int, int], str]) -> bytes:
    """The file with new texts for some runs, by (part, paragraph_index, run). All else stays, other runs' elements too."""
    ET.register_namespace("w", NAMESPACE)
    roots, at = {}, {}
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        files = {n: z.read(n) for n in z.namelist()}
        for part, _, root, p in _stories(z):
            n = at[part] = at.get(part, 0) + 1
            for k, r in enumerate(p.findall(f"{W}r"), 1):
                if (part, n, k) in texts:
                    own = list(r.iter(f"{W}t")) or [ET.SubElement(r, f"{W}t")]
                    own[0].text = texts[part, n, k]
                    own[0].set("{http://www.w3.org/XML/1998/namespace}space", "preserve")
                    for t in own[1:]:
                        t.text = ""
                    roots[part] = root
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for n, x in files.items():
            z.writestr(n, ET.tostring(roots[n], "utf-8", xml_declaration=True) if n in roots else x)
    return out.getvalue()


def with_comments(data: bytes, notes: list[tuple[int, str]], author: str, date: str) -> tuple[bytes, int]:
    """The file with a comment at each (paragraph_index, text) of its body that exists; and how many were written. Comments that are there keep their ids."""
    ET.register_namespace("w", NAMESPACE)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        files = {n: z.read(n) for n in z.namelist()}
    root = ET.fromstring(files["word/document.xml"])
    all_p = list(root.iter(f"{W}p"))
    comments = ET.fromstring(files["word/comments.xml"]) if "word/comments.xml" in files else ET.Element(f"{W}comments")
    used = [int(c.get(f"{W}id") or -1) for c in comments]
    nth, written = max(used, default=-1) + 1, 0
    for at, text in notes:
        if not 1 <= at <= len(all_p):
            continue
        p = all_p[at - 1]
        first = 1 if len(p) and p[0].tag == f"{W}pPr" else 0
        p.insert(first, ET.Element(f"{W}commentRangeStart", {f"{W}id": str(nth)}))
        p.append(ET.Element(f"{W}commentRangeEnd", {f"{W}id": str(nth)}))
        ET.SubElement(ET.SubElement(p, f"{W}r"), f"{W}commentReference", {f"{W}id": str(nth)})
        c = ET.SubElement(comments, f"{W}comment", {f"{W}id": str(nth), f"{W}author": author, f"{W}date": date})
        for line in text.split("\n"):
            ET.SubElement(ET.SubElement(ET.SubElement(c, f"{W}p"), f"{W}r"), f"{W}t").text = line
        nth, written = nth + 1, written + 1
    files["word/document.xml"], files["word/comments.xml"] = ET.tostring(root, "utf-8", xml_declaration=True), ET.tostring(comments, "utf-8", xml_declaration=True)
    _register(files)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for n, x in files.items():
            z.writestr(n, x)
    return out.getvalue(), written


def _register(files: dict[str, bytes]) -> None:
    """Names the comments part in the package's content types and relationships, once."""
    kind = "application/vnd.openxmlformats-officedocument.wordprocessingml.comments+xml"
    t = files.get("[Content_Types].xml", b"")
    if t and b"/word/comments.xml" not in t:
        files["[Content_Types].xml"] = t.replace(b"</Types>", f'<Override PartName="/word/comments.xml" ContentType="{kind}"/></Types>'.encode())
    name = "word/_rels/document.xml.rels"
    r = files.get(name, b'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"></Relationships>')
    if b'Target="comments.xml"' not in r:
        new = b'<Relationship Id="rIdComments" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/comments" Target="comments.xml"/></Relationships>'
        files[name] = r.replace(b"</Relationships>", new) if b"</Relationships>" in r else r.replace(b"/>", b">" + new, 1)


def commented_files(spark: SparkSession, path: str, issues: DataFrame, author: str, date: str) -> DataFrame:
    """source_path, content, asked, written: each Word file with its issues (source_path, paragraph_index, body) as comments. One file and its own issues a row."""
    notes = issues.groupBy("source_path").agg(F.array_sort(F.collect_list(F.struct("paragraph_index", "body"))).alias("notes"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.docx").load(path).select(F.col("path").alias("source_path"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p, data, own in zip(*(batch.column(c).to_pylist() for c in ("source_path", "content", "notes")), strict=True):
                new, n = with_comments(data, [(x["paragraph_index"], x["body"]) for x in own], author, date)
                rows.append((p, new, len(own), n))
            kinds = [pa.string(), pa.binary(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["source_path", "content", "asked", "written"])

    return files.join(notes, "source_path").mapInArrow(run, "source_path string, content binary, asked int, written int")
