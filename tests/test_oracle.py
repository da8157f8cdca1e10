"""Every query with SQL gives what DuckDB gives on the smallest tables."""

import math
import os

import duckdb
import pytest

from lectern import catalog

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    if isinstance(v, bool) or isinstance(v, str):
        return str(v)
    if hasattr(v, "__len__"):
        return str([plain(x) for x in v])
    return str(round(float(v), 6))


def rows(names, data):
    at = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(tuple(plain(r[k]) for k in at) for r in data)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_matches_sql(spark, con, name):
    df = catalog.QUERIES[name](spark, DIR)
    sql = con.execute(catalog.ORACLE[name])
    names, want = [d[0] for d in sql.description], sql.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, want)


def test_queries_without_sql():
    """These are held against plain Python in test_queries.py."""
    assert set(catalog.QUERIES) - set(catalog.ORACLE) == {"page_blocks", "align_opcodes", "structural_review", "aligned_suspicious", "range_projection", "update_candidates", "editorial_issues", "editorial_index"}
