"""Runs of Word files: read, rewritten and written back; prose with its italics; geometry."""

import io
import zipfile

from lectern.operators import candidates as cd
from lectern.operators import runs as rn
from lectern.sources import docx

W = f'xmlns:w="{docx.NAMESPACE}"'


def para(*runs, style=None, more=""):
    inner = "".join(f"<w:r><w:rPr>{f}</w:rPr>{''.join(f'<w:t>{t}</w:t>' for t in (text if isinstance(text, list) else [text]))}</w:r>" if not f.startswith("note") else f'<w:r><w:footnoteReference w:id="{text}"/></w:r>' for text, f in runs)
    head = (f'<w:pStyle w:val="{style}"/>' if style else "") + more
    return f"<w:p>{f'<w:pPr>{head}</w:pPr>' if head else ''}{inner}</w:p>"


def word(*paragraphs):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{''.join(paragraphs)}</w:body></w:document>")
    return out.getvalue()


PROSE = "Это обычная проза, в которой не меньше восьми слов."
FILE = word(
    para(("см. Б", ""), ("Г 2.1", "<w:i/>"), ("3 и", ""), style="Normal"),
    para(("слово.", "<w:b/>"), ("7", "note"), (" дальше", "")),
    para((PROSE + " ", ""), (["бхак", "ти"], "<w:i/>"), ("", ""), (" ашрам", '<w:rStyle w:val="Emphasis"/>'), (" и ", '<w:i w:val="0"/>'), ("веды", "<w:iCs/>")),
    para(("Заголовок, в котором тоже не меньше восьми слов, да.", "<w:i/>"), style="Заголовок_1"),
    para(("Мало слов.", "<w:i/>"), style="Normal"), para(("Мало слов.", "")), para(("кр̣шна говинда", ""), style="Normal"), para(("а — б; в — г; и так далее, слов больше восьми.", ""), style="Normal"),
)


def test_runs(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(FILE)
    (tmp_path / "b.docx").write_bytes(b"no zip")
    rows = docx.docx_runs(spark, str(tmp_path))
    got = [(r["paragraph_index"], r["run"], r["text"], r["note"], r["italic"], r["bold"]) for r in rows.where("error is null").collect()]
    assert got[:6] == [(1, 1, "см. Б", None, False, False), (1, 2, "Г 2.1", None, True, False), (1, 3, "3 и", None, False, False), (2, 1, "слово.", None, False, True), (2, 2, "", "7", False, False), (2, 3, " дальше", None, False, False)]
    assert [r["error"][:10] for r in rows.where("error is not null").collect()] == ["BadZipFile"]


def test_rewritten_and_written_back(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(FILE)
    rows = docx.docx_runs(spark, str(tmp_path)).drop("error")
    keys = ["source_path", "part", "container_id", "paragraph_index"]
    changed = rn.with_canonical_references(rows, keys).where("text <> before").collect()
    assert [(r["paragraph_index"], r["run"], r["text"], r["format"]["italic"]) for r in changed] == [(1, 2, "Г 2.1", True)]
    new = docx.with_run_texts(FILE, {(r["part"], r["paragraph_index"], r["run"]): r["text"] for r in changed})
    old_runs, new_runs = docx.runs(FILE), docx.runs(new)
    assert [n for o, n in zip(old_runs, new_runs, strict=True) if o != n] == [("word/document.xml", "", 1, 2, "Г 2.1", None, True, False, "", "Normal")]
    moved, log = rn.with_notes_before_punctuation(rows, keys)
    assert [(r["text"], r["note"], r["format"]["bold"]) for r in moved.where("paragraph_index = 2").orderBy("run").collect()] == [("слово", None, True), ("", "7", False), (".", None, True), (" дальше", None, False)]
    assert [r["action"] for r in log.collect()] == ["moved_before_punctuation"]


def test_prose_with_italics_gives_candidates(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(FILE)
    got = docx.prose_with_italics(docx.docx_runs(spark, str(tmp_path))).orderBy("paragraph_index").collect()
    assert [(r["paragraph_index"], r["italics"]) for r in got] == [(1, ["Г 2.1"]), (3, ["бхакти ашрам", "веды"]), (5, ["Мало слов"])]
    found = cd.from_blocks(docx.prose_with_italics(docx.docx_runs(spark, str(tmp_path))), cd.hint_table(spark), ["source_path", "paragraph_index"]).collect()
    assert sorted((r["paragraph_index"], r["variant"], r["category"]) for r in found) == [(3, "бхакти ашрам", "philosophical_term"), (3, "веды", "scripture_title")]


def test_geometry(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(word(para(("a", ""), more='<w:ind w:left="1200" w:firstLine="-20"/><w:rPr><w:i/></w:rPr>'), "<w:p><w:r><w:t>b</w:t><w:br/></w:r></w:p>"))
    got = docx.docx_paragraphs(spark, str(tmp_path)).orderBy("paragraph_index").collect()
    assert [(r["indent"], r["first_line"], r["paragraph_italic"], r["has_break"]) for r in got] == [(1200, -20, True, False), (0, 0, False, True)]
