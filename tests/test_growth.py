"""What a query moves or works out grows no faster than its input."""

import itertools

import pytest
from pyspark.sql import functions as F

from lectern import catalog
from lectern.functions import diacritics as di
from lectern.functions import text as tx
from lectern.operators import pairing as pr


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_phrases_move_no_text(spark):
    blocks = spark.createDataFrame([(1, "a b c"), (2, "b"), (3, ""), (4, None)], "d int, text string").repartition(3)
    phrases = spark.createDataFrame([("b c", 1), ("b", 2)], "phrase string, n int")
    hits = pr.phrase_hits(blocks, phrases, ["d"])
    assert sorted(tuple(r) for r in hits.select("d", "n").collect()) == [(1, 1), (1, 2), (2, 2)]
    assert "BroadcastHashJoin" in plan(hits) and "hashpartitioning" not in plan(hits)


@pytest.mark.parametrize("name", ["approved_form", "review_triage", "extraction_summary"])
def test_candidates_are_extracted_once(spark, name):
    """The query rests on stored candidates: its plan reads no documents."""
    assert "documents.parquet" not in plan(catalog.QUERIES[name](spark, "/root/testdata/sf0.001"))


@pytest.mark.parametrize("name", ["term_candidates", "preferred_sources"])
def test_terms_are_found_in_one_pass(spark, name):
    assert "documents.parquet" not in plan(catalog.QUERIES[name](spark, "/root/testdata/sf0.001"))


def test_single_spaces_are_left_alone(spark):
    """Cleaning looks for runs other than a single space, and gives what replacing every run gives."""
    odd = [" ", "  ", "\t", " ", "\x1c", "　", " ", "\x85", "\x0b", "a", "~", "é", "!", "​"]
    texts = ["".join(t) for n in (1, 2, 3) for t in itertools.product(odd, repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumns({"old": F.trim(F.regexp_replace("t", tx.SPACE + "+", " ")), "new": tx.clean(F.col("t"))})
    assert df.where("old <> new").count() == 0
    assert not spark.range(1).select(F.lit("a b é c !").rlike(tx.RUN)).first()[0]


def test_bodies_of_issues_need_no_join(spark):
    assert "Join" not in plan(catalog.QUERIES["issue_bodies"](spark, "/root/testdata/sf0.001"))


def test_lines_of_orders_stay_in_small_parts(spark):
    """Parts are not put together, by which one task would hold many of them."""
    said = plan(catalog.QUERIES["first_note_paragraphs"](spark, "/root/testdata/sf0.001"))
    assert "REPARTITION_BY_NUM" in said and said.count("Exchange") == 1


def test_texts_without_marks_are_not_taken_apart(spark):
    """The decision on a text without marks asks for marks alone; on one with marks it counts words once."""
    df = spark.createDataFrame([("a",)], "t string")
    said = plan(df.select(di.decision(F.col("t"), F.col("t"), F.lit("")).alias("d")).select("d.reason"))
    assert said.count("regexp_extract_all") <= 8


def test_marks_are_those_of_the_plain_class(spark):
    """The class that first asks for ranges has the same characters as the mere list of marks."""
    chars = [chr(k) for k in [*range(0x20, 0x500), *range(0x1E00, 0x1F00), 0x2011, 0x3042, 0x1F600]]
    df = spark.createDataFrame([(c,) for c in chars], "c string")
    word = f"[A-Za-zА-Яа-яЁё{di.MARKED}{di.MARKS}]"
    assert df.where(di.has_marks(F.col("c")) != F.col("c").rlike(f"[{di.MARKED}{di.MARKS}]")).count() == 0
    assert df.where(F.col("c").rlike(f"^{di.WORD}$") != F.col("c").rlike(f"^{word}$")).count() == 0
