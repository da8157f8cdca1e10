"""Run-level rewriting: references, marks and note marks over formatted runs, against plain strings."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from lectern.functions import diacritics as di
from lectern.operators import references as rf
from lectern.operators import runs as rn

SCHEMA = "p int, run int, text string, note string, bold boolean"


def table(spark, *paragraphs):
    return spark.createDataFrame([(p, k + 1, *(r if isinstance(r, tuple) else (r, None)), k % 2 == 0) for p, runs in enumerate(paragraphs) for k, r in enumerate(runs)], SCHEMA)


def texts(df):
    out = {}
    for r in df.orderBy("p", "run").collect():
        out.setdefault(r["p"], []).append(r["text"])
    return [out[p] for p in sorted(out)]


def test_places_are_those_of_the_grammar(spark):
    said = "xBg 1.2 and Bg 1.2 end БГ 2.13"
    got = spark.createDataFrame([(1, said)], "k int, t string").select(rf.hits(F.col("t")).alias("h")).first()["h"]
    assert [(h["start"], said[h["start"] - 1 : h["end"] - 1]) for h in got] == [(13, "Bg 1.2"), (24, "БГ 2.13")]
    fixed = spark.createDataFrame([(1, said)], "k int, t string").select(rf.rewritten(F.col("t"), rn.reference_edits(F.col("t")))["text"]).first()[0]
    assert fixed == "xBg 1.2 and БГ\u00a01.2 end БГ\u00a02.13"


def test_references_within_and_across(spark):
    df = table(
        spark,
        ["см. Bg 2 . 13 и ", "ещё"],  # within one run: any length
        ["см. Б", "Г 2.1", "3 и да"],  # across: the same length
        ["см. Bg", ". 2.1", "3"],  # across, shorter: left alone
        ["x", "Bg 1.1"],  # a run by itself begins a word
        ["ш", "б ", "1", ".", "2", ".3", None, " БГ 1.1"],
        ["", None],
    )
    got = texts(rn.with_canonical_references(df, ["p"]))
    assert got == [["см. БГ\u00a02.13 и ", "ещё"], ["см. Б", "Г\u00a02.1", "3 и да"], ["см. Bg", ". 2.1", "3"], ["x", "БГ\u00a01.1"], ["Ш", "Б\u00a0", "1", ".", "2", ".3", "", " БГ\u00a01.1"], ["", ""]]
    same = rn.with_canonical_references(df, ["p"]).where("p = 1").orderBy("run").collect()
    assert [r["before"] == r["text"] for r in same] == [True, False, True] and [r["format"]["bold"] for r in same] == [True, False, True]


def test_cut_back_any_edits(spark):
    """Edits of any length: the joined text is the edited one, and runs that no edit touches keep their text."""
    rng = random.Random(5)
    data, want = [], []
    for p in range(40):
        runs = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(6))) for _ in range(rng.randrange(1, 7))]
        whole, edits, at = "".join(runs), [], 1
        while at <= len(whole) and len(edits) < 3:
            start = rng.randrange(at, len(whole) + 1)
            end = rng.randrange(start, len(whole) + 1) + 1
            edits.append((start, end, "".join(rng.choice("XYZ") for _ in range(rng.randrange(5)))))
            at = end
        data.append((p, [(k, t) for k, t in enumerate(runs)], edits))
        new = whole
        for s, e, r in reversed(edits):
            new = new[: s - 1] + r + new[e - 1 :]
        edges, touched = 0, []
        for t in runs:
            touched.append(any(s - 1 < edges + len(t) and e - 1 > edges for s, e, _ in edits))
            edges += len(t)
        want.append((new, [None if x else t for t, x in zip(runs, touched, strict=True)]))
    df = spark.createDataFrame(data, "p int, runs array<struct<run:int,text:string>>, e array<struct<start:int,end:int,replacement:string>>")
    for r in rn.cut_back(df, "e").collect():
        got = [x["text"] for x in r["runs"]]
        new, kept = want[r["p"]]
        assert "".join(got) == new and all(k is None or k == g for k, g in zip(kept, got, strict=True))


def test_plain_text_over_divided_words(spark):
    df = table(spark, ["санн̃й", "аса ", "ачар", "йа"], ["a", "b"])
    got = texts(rn.with_plain_text(df, ["p"], lambda c: F.coalesce(di.without_marks(c), c)))
    assert got == [["саннь", "яса ", "ачар", "ья"], ["a", "b"]]


def moved(runs):
    """The rule as a loop over a list."""
    out, log = [], []
    for k, (text, note) in enumerate(runs):
        last = next((j for j in range(len(out) - 1, -1, -1) if out[j][0]), None)
        m = re.search(r"([.,;:!?…]+)(\s*)$", out[last][0]) if note is not None and last is not None else None
        if not m:
            out.append((text, note))
            continue
        behind = next((t for t, _ in runs[k + 1 :] if t), "")
        out[last] = (out[last][0][: m.start()], out[last][1])
        if not out[last][0] and out[last][1] is None:
            del out[last]
        out.append((text, note))
        if behind.lstrip().startswith(m[1]):
            log.append((note, m[0], "removed_duplicate_before_footnote"))
        else:
            out.append((m[0], None))
            log.append((note, m[0], "moved_before_punctuation"))
    return out, log


def held(spark, paragraphs):
    rows, log = rn.with_notes_before_punctuation(table(spark, *paragraphs), ["p"])
    got = {p: [] for p in range(len(paragraphs))}
    for r in rows.orderBy("p", "run").collect():
        got[r["p"]].append((r["text"], r["note"]))
    said = {p: [] for p in range(len(paragraphs))}
    for r in log.orderBy("p", "change").collect():
        said[r["p"]].append((r["note"], r["moved"], r["action"]))
    for p, runs in enumerate(paragraphs):
        assert (got[p], said[p]) == moved(runs), runs
    return got


def test_notes(spark):
    got = held(spark, [
        [("слово.", None), ("", "1"), ("дальше", None)], [("слово.", None), ("", "1"), (". дальше", None)], [("слово, ", None), ("", "1"), ("", "2"), ("конец", None)],
        [("…", None), ("", "1")], [("a", None), ("!?", None), ("", "1"), ("", None), ("", "2")], [("", "1"), ("a", None)], [("b.", None)],
    ])
    assert got[0] == [("слово", None), ("", "1"), (".", None), ("дальше", None)] and got[2] == [("слово", None), ("", "1"), ("", "2"), (", ", None), ("конец", None)] and got[3] == [("", "1"), ("…", None)]
    rows, _ = rn.with_notes_before_punctuation(table(spark, [("a.", None), ("", "1")]), ["p"])
    assert [(r["run"], r["origin"], r["format"]["bold"]) for r in rows.orderBy("run").collect()] == [(1, 1, True), (2, 2, False), (3, 1, True)]


@pytest.mark.parametrize("seed", range(2))
def test_notes_against_loop(spark, seed):
    rng = random.Random(seed)
    pick = lambda: ("", str(rng.randrange(9))) if rng.random() < 0.35 else (rng.choice(["a", "b.", ", ", "...", "", ". c", "d!? ", "e;"]), None)
    held(spark, [[pick() for _ in range(rng.randrange(1, 12))] for _ in range(60)])


@pytest.mark.parametrize("seed", range(2))
def test_notes_with_text_of_their_own(spark, seed):
    """Marks that hold text, ends that are all punctuation, and runs of which something is left."""
    rng = random.Random(seed)
    pick = lambda: (rng.choice(["", "", "x.", ".", "a"]), str(rng.randrange(9))) if rng.random() < 0.4 else (rng.choice(["a", "b. .", " .", ". ", "…, ", "", "\n", ".\n", "d!? ", "; e"]), None)
    held(spark, [[pick() for _ in range(rng.randrange(1, 25))] for _ in range(60)])


def test_long_paragraphs_of_notes(spark):
    """The work grows with the runs, not with their square: as one fold this paragraph took more than a minute."""
    rows = table(spark, [x for k in range(6000) for x in ((f"w{k}. ", None), ("", str(k)))])
    begun = time.monotonic()
    out, log = rn.with_notes_before_punctuation(rows, ["p"])
    assert (out.count(), log.count()) == (18000, 6000)
    assert time.monotonic() - begun < 30


def test_italic_fragments(spark):
    rows = [(1, 1, "a", True), (1, 2, "", False), (1, 3, "b", True), (1, 4, "c", False), (1, 5, "d", True), (1, 6, None, True), (2, 1, "x", False), (3, 1, "y", None), (3, 2, "z", True)]
    df = spark.createDataFrame(rows, "p int, run int, text string, italic boolean")
    assert sorted(map(tuple, rn.italic_fragments(df, ["p"]).collect())) == [(1, 1, "ab"), (1, 2, "d"), (3, 1, "z")]
