"""Whitening against numpy over whole tables, and its edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import queries, whitening

DIR = "/root/testdata/sf0.001"


def brute(vectors, components=4):
    """(n, deviations, whitened up to sign, explained) of the vectors, all whole and of one length."""
    x = np.array([[math.floor(256 * c) for c in v] for v in vectors], np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    y = fit - s / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    deviations = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True)) for row in x]
    return n, deviations, (x - s / n) @ u / np.sqrt(e), e / np.trace(v)


def held(rows, vectors, k):
    n, deviations, w, explained = brute(vectors, k)
    got = np.array([[r["whitened"] for r in rows[i * k : i * k + k]] for i in range(len(vectors))])
    signs = np.sign((got * w).sum(axis=0))
    assert np.allclose(got, w * signs, rtol=1e-8, atol=1e-8)
    assert [r["deviation"] for r in rows[::k]] == deviations and {r["n"] for r in rows} == {n}
    assert np.allclose([r["explained"] for r in rows[:k]], explained, rtol=1e-9)
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def test_query(spark):
    rows = queries.op13_whitening(spark, DIR)
    assert rows.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = rows.orderBy("vec_id", "component").collect()
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{DIR}/embeddings.parquet").collect()}
    assert [r["vec_id"] for r in rows[::4]] == sorted(vectors) and {r["component"] for r in rows} == {1, 2, 3, 4}
    held(rows, [vectors[k] for k in sorted(vectors)], 4)


@pytest.mark.parametrize("dims,n", [(1, 5), (3, 40), (70, 300), (33, 5000)])
def test_tiles_and_blocks(spark, dims, n):
    """Dimensions that fill no tile, and more rows than a block has, with copies, which weigh nothing."""
    rng = np.random.default_rng(dims)
    vectors = (rng.normal(size=(n, dims)) * np.linspace(1, 3, dims) + 5).tolist()
    vectors += vectors[:1] * n
    df = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(3)
    rows = whitening.whitened(df).orderBy("vec_id", "component").collect()
    held(rows, vectors, min(4, dims))


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    schema = "vec_id long, embedding array<float>, label int, component string, x string, N long, block long"
    good = [[0.1 * k, -0.2 * (k % 3), 0.05 * k * k] for k in range(9)]
    rows = [(k, v, 1, "c", "x", 5, 6) for k, v in enumerate(good)] + [(None, good[1], None, None, None, None, None), (3, good[3], 1, "c", "x", 5, 6)]
    bad = [(90, None, 1, "c", "x", 5, 6), (91, [0.1, None, 0.2], 1, "c", "x", 5, 6), (92, [nan, 1.0, 1.0], 1, "c", "x", 5, 6), (93, [1.0, inf, 1.0], 1, "c", "x", 5, 6), (94, [1e38, 0.0, 0.0], 1, "c", "x", 5, 6)]
    df = spark.createDataFrame(rows + bad, schema)
    out = whitening.whitened(df)
    assert out.columns == ["vec_id", "embedding", "label", "x", "block", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = out.collect()
    assert len(got) == 3 * len(rows) and {r["n"] for r in got} == {9} and {r["x"] for r in got} == {"x", None} and max(r["vec_id"] or 0 for r in got) == 8
    assert len([r for r in got if r["vec_id"] == 3]) == 6 and all(r["whitened"] is not None for r in got)
    assert whitening.whitened(df.where("false")).collect() == [] and whitening.whitened(df.where("vec_id >= 90")).collect() == []
    one = whitening.whitened(df.where("vec_id = 3")).collect()
    assert len(one) == 6 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one} == {(1, 0, None, None, None)}
    two = whitening.whitened(df.where("vec_id in (1, 5)")).orderBy("vec_id", "component").collect()
    assert [abs(r["whitened"]) if r["whitened"] is not None else None for r in two] == [pytest.approx(1.0), None, None] * 2 and two[0]["explained"] == pytest.approx(1)


def test_lengths(spark):
    """Shorter vectors are filled up with zeros; none at all, and huge ones, do not fail."""
    df = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (3, []), (4, [0.5, 0.0])], "vec_id long, embedding array<double>")
    rows = whitening.whitened(df).orderBy("vec_id", "component").collect()
    held(rows, [[1.0, 0.0], [1.0, 2.0], [0.0, 0.0], [0.5, 0.0]], 2)
    assert whitening.whitened(df.where("vec_id = 3")).collect() == []
    big = spark.createDataFrame([(1, [1e9, 1.0]), (2, [-1e9, 0.0]), (3, [3.0, 1.0])], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["deviation"] for r in whitening.whitened(big).where(F.col("component") == 1).collect()}
    assert got[1] is None and got[2] is None and got[3] == (3 * 768 - 768) ** 2 + (3 * 256 - 512) ** 2
