"""Queries that SQL cannot express, over whole tables, against plain Python."""

import os
from difflib import SequenceMatcher

import pytest

from lectern import catalog
from lectern.plans import align
from lectern.sources import html

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")


def test_page_blocks(spark):
    want = []
    for r in spark.read.parquet(f"{DIR}/pages.parquet").select("page_id", "html").collect():
        want += [(r["page_id"], k, section, len(text.split()), len(italics)) for k, (section, text, italics) in enumerate(html.parse(r["html"]), 1)]
    got = catalog.QUERIES["page_blocks"](spark, DIR).collect()
    assert sorted((r["page_id"], r["block_index"], r["section"], r["word_count"], r["italics"]) for r in got) == sorted(want)
    assert all(r["kind"] == r["section"] for r in got if r["section"] in ("devanagari", "bengali", "synonyms"))


def sides(spark, value):
    out = []
    for side in align._sides(spark, DIR):
        docs = {}
        for r in side.select("doc_id", "pos", value).orderBy("doc_id", "pos").collect():
            docs.setdefault(r["doc_id"], []).append(r[value])
        out.append(docs)
    return out


def opcodes(spark, value):
    old, new = sides(spark, value)
    return {d: SequenceMatcher(None, old.get(d, []), new.get(d, []), autojunk=False).get_opcodes() for d in old.keys() | new.keys()}


def test_align_opcodes(spark):
    got = {}
    for r in catalog.QUERIES["align_opcodes"](spark, DIR).orderBy("doc_id", "seq").collect():
        got.setdefault(r["doc_id"], []).append((r["tag"], r["i1"], r["i2"], r["j1"], r["j2"]))
    assert got == {d: ops for d, ops in opcodes(spark, "signature").items() if ops}


def test_range_projection(spark):
    """Between the matches around it: behind the last one before the range, before the first one after it."""
    got = {(r["doc_id"], r["lo"], r["hi"]): (r["target_lo"], r["target_hi"]) for r in catalog.QUERIES["range_projection"](spark, DIR).collect()}
    want = set()
    for d, ops in opcodes(spark, "key").items():
        for tag, i1, i2, _, _ in ops:
            if tag != "equal":
                want.add((d, i1 + 1, i2) if i2 > i1 else (d, max(1, i1), max(1, i1)))
    assert set(got) == want and all(lo <= hi or lo == hi + 1 for lo, hi in got.values() if lo is not None and hi is not None)


def test_update_candidates(spark):
    """One row for each changed range; what is meaningful has a priority."""
    got = catalog.QUERIES["update_candidates"](spark, DIR).collect()
    want = sum(tag != "equal" for ops in opcodes(spark, "key").values() for tag, *_ in ops)
    assert len(got) == want and all(r["tag"] in ("replace", "delete", "insert") and 0 <= r["char_ratio"] <= 1 for r in got)
    assert all(r["flags"] for r in got if r["meaningful"])


def test_aligned_suspicious(spark):
    """Pairs of equal signatures: only digits and kinds beyond the signature can differ."""
    pairs = {(d, i1 + k + 1, j1 + k + 1) for d, ops in opcodes(spark, "signature").items() for tag, i1, i2, j1, _ in ops if tag == "equal" for k in range(i2 - i1)}
    got = catalog.QUERIES["aligned_suspicious"](spark, DIR).collect()
    assert {(r["doc_id"], r["i"], r["j"]) for r in got} <= pairs and all(r["reasons"] for r in got)


def test_structural_review(spark):
    want = {d for d, ops in opcodes(spark, "signature").items() if any(tag != "equal" for tag, *_ in ops)}
    got = {r["doc_id"] for r in catalog.QUERIES["structural_review"](spark, DIR).collect()}
    assert got <= want and got
