"""Line dedup against plain Python and DuckDB, over any number of batches, and its edge cases."""

import hashlib
from collections import Counter

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.llm import line_runs, queries

DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def expected(rows, least):
    held = Counter(k for _, text in rows for k in {key(x) for x in (text or "").split("\n")} - {""})
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if held[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=repr)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DIR}/documents.parquet'")
    want = con.execute(queries.OP12_SQL).fetchall()
    rows = queries.op12_line_runs(spark, DIR)
    assert rows.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"] and sorted(map(tuple, rows.collect())) == sorted(want) and sum(r[2] for r in want)
    texts = [(r[0], r[1]) for r in spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((i, n, d, hashlib.sha256(k.encode()).hexdigest()) for i, n, d, k in expected(texts, 10)) == sorted(want)


LINES = st.lists(st.sampled_from(["", " a", "A\t", "b", "É", "é", "c\x0b", " ", "long line", "Long Line "]), max_size=6).map("\n".join)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 40)), st.one_of(st.none(), LINES)), max_size=30), st.integers(1, 5), st.integers(1, 4))
def test_any_rows(spark, rows, batches, least):
    assert got(line_runs.deduplicated(spark.createDataFrame(rows, SCHEMA), least, 1, batches)) == expected(rows, least)


def test_runs_are_levelled_and_settled(spark):
    runs = line_runs.LineRuns(spark, 4)
    sizes = []
    for k in range(7):
        runs.add(spark.createDataFrame([(0, f"all\nonly {k}\nup to {min(k, 3)}")] * 2, SCHEMA))
        sizes.append(sorted(runs.levels))
    assert sizes == [[0], [1], [0, 1], [2], [0, 2], [1, 2], [0, 1, 2]]
    settled = {r["hash"] for r in spark.table(runs.settled).collect()}
    newest = {r["hash"] for r in spark.table(runs.levels[0]).collect()}
    name = {x: r for x, r in zip(("all", "only 6", "up to 3"), spark.range(1).select(*[F.xxhash64(F.lit(x)) for x in ("all", "only 6", "up to 3")]).first(), strict=True)}
    assert settled == {name["all"], name["up to 3"]} and newest == {name["only 6"]}
    plan = runs._merged(runs.levels[1], runs.levels[2])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert {r["hash"] for r in runs.common().collect()} == {name["all"], name["up to 3"]}
    runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(runs.name)]


def test_edges(spark):
    copies = [(2, "x\nSAME")] * 3
    rows = [(1, None), (1, ""), (None, "same\ny"), (None, None), *copies, (3, "\n\n"), (4, "same"), (5, " same"), (6, "\n".join(f"line {k % 5000}" for k in range(40_000)))]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("clash") for n in ("hash", "hits", "k1", "K2", "cut", "grid", "kept", "n_lines", "line", "key", "docs")})
    out = line_runs.deduplicated(docs, 5)
    assert got(out) == expected(rows, 5) and set(docs.columns) <= set(out.columns) and out.select("k1").distinct().count() == 1
    # A third of the hits of one text: 4,000 distinct lines of it go.
    many = [(k, "\n".join(f"line {j}" for j in range(4000))) for k in range(3)] + [(9, "\n".join(f"LINE {j}" for j in range(6000)))]
    assert got(line_runs.deduplicated(spark.createDataFrame(many, SCHEMA), 3)) == expected(many, 3)
    assert line_runs.deduplicated(docs.where("false")).count() == 0
    assert got(line_runs.deduplicated(docs.where("doc_id is null"), 1)) == expected([r for r in rows if r[0] is None], 1)
    # Keys of at least three code points: shorter ones stay.
    assert [r[3] for r in got(line_runs.deduplicated(spark.createDataFrame([(1, "ab\nabc"), (2, "ab\nabc")], SCHEMA), 2, 3))] == ["ab", "ab"]


def test_main_path_is_native(spark):
    plan = line_runs.deduplicated(spark.createDataFrame([(1, "a")], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert not [w for w in ("Python", "Pandas", "Arrow") if w in plan]


@pytest.mark.parametrize("batches", [1, 3, 8])
def test_batches_do_not_matter(spark, batches):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").select("doc_id", "text")
    assert got(line_runs.deduplicated(docs, 10, 1, batches)) == expected([tuple(r) for r in docs.collect()], 10)
