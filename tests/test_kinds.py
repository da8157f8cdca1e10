"""Kinds of blocks as the queries' SQL has them."""

import duckdb
import pytest

from lectern import catalog

TEXTS = ["elleèé elleèé elleèé, und", "Erie | engeßung, | chzust | pfheitie, | einöpf |", "éabc éabc éabc, und", "abc-é def_é ghié,", "ab cd ef,", "ёabc abc abc-, d,"]


@pytest.mark.parametrize("name", ["block_features", "block_signatures"])
def test_words_that_begin_with_latin_letters(spark, tmp_path, name):
    d = f"{tmp_path}/documents.parquet"
    rows = [(k, " ".join([t] * 4), "fr", "s") for k, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(d)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/*.parquet'")
    got = catalog.QUERIES[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({catalog.ORACLE[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_a_number_right_after_a_works_name(spark, tmp_path):
    lines, name = ["Cc3;", "SB0. a niño", "xCc3", "sb_3", "Cc a3", "sbx 3", "la cc3.14 niño", "Cc9ß@Ag bg"], "style_hint_template"
    d = f"{tmp_path}/documents.parquet"
    spark.createDataFrame([(k, "\n".join([line] * 24), "fr", "s") for k, line in enumerate(lines)], "doc_id long, text string, lang string, source string").write.parquet(d)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/*.parquet'")
    got = catalog.QUERIES[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({catalog.ORACLE[name]})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
