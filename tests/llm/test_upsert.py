"""Copy-on-write upsert against plain Python over whole tables, and its edge cases."""

import hashlib
import math
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lectern.llm import queries, upsert
from lectern.llm.common import shared_dir

DIR = "/root/testdata/sf0.001"
SETS = ["source", "segment", "city", "balance"]


def crc(x):
    return zlib.crc32(str(x).encode())


def expected(clients, changes, names):
    """Per file, in order: ids, cents, rows_crc, rewritten. clients and changes: lists of dicts."""
    m = 1 + len(clients) // 700
    start = sorted((r for r in clients if r["client_id"] is not None and crc(r["client_id"]) % 7 > 3), key=lambda r: r["client_id"])
    files = [start[k : k + m] for k in range(0, len(start), m)]
    if not files:
        return []
    firsts = [f[0]["client_id"] for f in files]
    win = {}
    low = lambda v: (v is not None, v)
    for c in changes:
        if c["client_id"] is None:
            continue
        old = win.get(c["client_id"])
        if old is None or (low(c["seq"]), low(c["change_id"])) > (low(old["seq"]), low(old["change_id"])):
            win[c["client_id"]] = c
    now = [{r["client_id"]: r for r in f} for f in files]
    for i, c in win.items():
        home = max((k for k, f in enumerate(firsts) if f <= i), default=0)
        h = crc(firsts[home]) % 12
        if h > 7:
            continue
        if c["op"] == "D" or c["change_id"] is not None and crc(c["change_id"]) % 8 < h:
            now[home].pop(i, None)
        else:
            now[home][i] = {**dict.fromkeys(names), "client_id": i, **now[home].get(i, {}), **{s: c[s] for s in SETS}}
    out = []
    for f, rows in zip(files, now, strict=True):
        rows = [rows[i] for i in sorted(rows)]
        if rows == f:
            out.append((f, False))
            continue
        n = -(-len(rows) // m)
        at = 0
        for k in range(n):
            size = len(rows) // n + (k < len(rows) % n)
            piece = rows[at : at + size]
            at += size
            if out and out[-1][1] and len(out[-1][0]) + size <= m:
                out[-1] = (out[-1][0] + piece, True)
            else:
                out.append((piece, True))
    return out


def digest(rows, rewritten, names):
    ids = [r["client_id"] for r in rows]
    cents = sum(math.floor(100 * r["balance"] + 0.5) for r in rows if r["balance"] is not None)
    sums = sum(zlib.crc32("|".join(r[c] or "" for c in ("source", "segment", "city")).encode()) for r in rows)
    return ids[0], len(ids), cents, sums, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), ",".join(names), rewritten


FIELDS = ["first_id", "n_rows", "cents", "rows_crc", "ids_sha256", "columns", "rewritten"]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query(spark, sf):
    at = f"/root/testdata/sf{sf}"
    clients, changes = (pq.read_table(f"{at}/{t}.parquet").to_pylist() for t in ("clients", "client_changes"))
    names = spark.read.parquet(f"{at}/clients.parquet").columns
    want = sorted(digest(rows, new, names) for rows, new in expected(clients, changes, names))
    got = queries.op11_upsert(spark, at).collect()
    assert sorted(tuple(r[f] for f in FIELDS) for r in got) == want
    # The folder holds these files and no others, with these rows in this order.
    folder = got[0]["path"].rpartition("/")[0].removeprefix("file:")
    there = spark.read.parquet(folder).select(F.col("_metadata.file_path").alias("p")).distinct().collect()
    assert {r["p"] for r in there} == {r["path"] for r in got}
    for r in got[:40]:
        t = pq.ParquetFile(r["path"].removeprefix("file:")).read()
        ids = t.column("client_id").to_pylist()
        assert ids == sorted(ids) and t.column_names == names and hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() == r["ids_sha256"]


def run(spark, base, changes, per_file, action=None, schema="id long, a string, b double"):
    files = upsert.write_files(spark.createDataFrame(base, schema), "id", per_file, shared_dir(spark))
    upsert.upsert(spark, files, spark.createDataFrame(changes, "id long, seq long, op string, a string"), ["seq"], ["a"], action or (lambda c, first: F.when(c["op"] == "D", upsert.DELETE)))
    rows = upsert.described(spark, files, {"bs": F.col("b")}).orderBy("first_id").collect()
    if not rows:
        return [], []
    data = spark.read.parquet(files.folder).orderBy("id").collect()
    return [(r["first_id"], r["n_rows"], r["rewritten"]) for r in rows], [tuple(r) for r in data]


def test_cut_and_joined(spark):
    base = [(10 * k, "x", 1.0) for k in range(8)]  # homes 0-10, 20-30, 40-50, 60-70
    changes = [(20, 1, "D", None), (40, 1, "D", None), (61, 1, "I", "n"), (62, 1, "I", "n"), (63, 1, "I", "n"), (-5, 1, "I", "n"), (-5, 0, "D", None)]
    files, data = run(spark, base, changes, 2)
    # -5, 0, 10 are cut 2 and 1; 10, 30 and 50: 30 joins 10, 50 stays; of 60-70 two files and a last row of its own.
    assert files == [(-5, 2, True), (10, 2, True), (50, 1, True), (60, 2, True), (62, 2, True), (70, 1, True)]
    assert [r[0] for r in data] == [-5, 0, 10, 30, 50, 60, 61, 62, 63, 70] and data[0] == (-5, "n", None)


def test_unchanged_and_emptied(spark):
    base = [(k, "x", None) for k in range(6)]
    # 0, 1 set to what they have: not rewritten; 2, 3 go; 4 gets a null.
    files, data = run(spark, base, [(0, 1, "U", "x"), (2, 1, "D", None), (3, 1, "D", None), (4, 1, "U", None), (99, 1, "D", None)], 2)
    assert files == [(0, 2, False), (4, 2, True)] and [r[:2] for r in data] == [(0, "x"), (1, "x"), (4, None), (5, "x")]


def test_edges(spark):
    assert run(spark, [], [(1, 1, "I", "n")], 2) == ([], [])
    assert run(spark, [(None, "x", 1.0)], [(None, 1, "I", "n")], 2) == ([], [])
    base = [(1, "x", 1.0), (2, "y", 2.0)]
    assert run(spark, base, [], 5) == ([(1, 2, False)], base)
    assert run(spark, base, [(1, None, "D", None), (None, 5, "D", None), (2, 1, None, "z"), (2, 1, None, "z")], 5) == ([(2, 1, True)], [(2, "z", 2.0)])
    # A key twice in the base becomes one row; all rows gone: no files.
    assert run(spark, [(1, "x", 1.0), (1, "x", 1.0), (7, "z", None)], [], 9) == ([(1, 2, True)], [(1, "x", 1.0), (7, "z", None)])
    assert run(spark, base, [(1, 1, "D", None), (2, 1, "D", None)], 1) == ([], [])
    long = "ä" * 200_000
    files, data = run(spark, [(1, long, None)], [(1, 1, "U", long + "!"), (2, 1, "I", "n")], 1)
    assert files == [(1, 1, True), (2, 1, True)] and data[0][1] == long + "!"


def test_clashing_names(spark):
    base = spark.createDataFrame([(1, "s", "b", "h", 3), (2, "s", "b", "h", 3)], "id long, row string, base string, home string, rank int")
    files = upsert.write_files(base, "id", 1, shared_dir(spark))
    changes = spark.createDataFrame([(2, 1, "t", "x")], "id long, seq long, row string, change string")
    upsert.upsert(spark, files, changes, ["seq"], ["row"], lambda c, first: F.lit(upsert.SET))
    assert sorted(map(tuple, spark.read.parquet(files.folder).collect())) == [(1, "s", "b", "h", 3), (2, "t", "b", "h", 3)]


def test_hot_home(spark):
    """All new keys fall into the last home, which is ranked in ranges and cut evenly."""
    files, data = run(spark, [(1, "x", None), (2, "x", None)], [(k, 1, "I", "n") for k in range(3, 1000)], 100)
    assert [f[1] for f in files] == [100] * 9 + [99] and [r[0] for r in data] == list(range(1, 1000))
