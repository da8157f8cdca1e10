"""Embedding whitening by a tiled covariance.

Distinct vectors are cut into blocks of rows, and each block into columns of TILE dimensions. Two column blocks of one
row block are a tile of the product; the blocks are shuffled by row block, met pairwise, centred and multiplied, and the
products are summed per tile over all row blocks. Only the sums, one matrix of dimensions by dimensions, are put together
on the driver, where the eigenvectors are found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import array_sum, fresh, shared_dir, stored

#: Rows of a block; dimensions of a tile.
ROWS, TILE = 2048, 32
#: Integer entries from here on are beyond what is exact as a double, and count as not finite.
MOST = 1 << 52
#: A component whose variance is below this share of the largest has no direction of its own, and whitens to null.
FLAT = 1e-12


def is_whole(vector: Column) -> Column:
    """Neither null nor with an entry that is null or not finite."""
    return F.coalesce(vector.isNotNull() & ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double") * 256) >= MOST)), F.lit(False))


def integers(vector: Column, dims: int | None = None) -> Column:
    """floor(256 c) of each entry c as long; dims: with zeros behind, up to so many."""
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * 256))
    return x if dims is None else F.concat(x, F.array_repeat(F.lit(0).cast("bigint"), F.lit(dims) - F.size(x)))


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def column_blocks(fit: DataFrame, dims: int) -> DataFrame:
    """(block, col, numbers): integers of up to ROWS rows and TILE dimensions, one row for each pair of blocks of rows and columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, k, held, n = TaskContext.get().partitionId() << 32, 0, [], 0
        pack = zstandard.ZstdCompressor(level=1)

        def cut(x: np.ndarray) -> pa.RecordBatch:
            cols = range(0, dims, TILE)
            parts = [pack.compress(np.ascontiguousarray(x[:, c : c + TILE]).tobytes()) for c in cols]
            return pa.RecordBatch.from_arrays([pa.array([at + k] * len(parts), pa.int64()), pa.array([c // TILE for c in cols], pa.int32()), pa.array(parts, pa.binary())], ["block", "col", "numbers"])

        for batch in batches:
            held.append(_matrix(batch.column("x"), dims))
            n += batch.num_rows
            if n >= ROWS:
                x = np.concatenate(held)
                for a in range(0, n - ROWS + 1, ROWS):
                    yield cut(x[a : a + ROWS])
                    k += 1
                held = [x[n - n % ROWS :]]
                n %= ROWS
        if n:
            yield cut(np.concatenate(held))

    return fit.select("x").mapInArrow(run, "block long, col int, numbers binary")


def tiled_covariance(fit: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """The covariance, divisor n, of the vectors x of `fit`, whose sums per dimension are given; centred before multiplying."""
    dims = len(sums)
    cols = -(-dims // TILE)
    tiles = {(i, j): k for k, (i, j) in enumerate((i, j) for i in range(cols) for j in range(i, cols))}

    def centred(numbers: bytes, col: int) -> np.ndarray:
        s = sums[col * TILE : (col + 1) * TILE]
        return (np.frombuffer(zstandard.decompress(numbers), "<i8").reshape(-1, len(s)) * n - s) / n

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, j, a, b in zip(batch.column("i").to_pylist(), batch.column("j").to_pylist(), batch.column("a"), batch.column("b"), strict=True):
                out = np.zeros((TILE, TILE))
                left, right = centred(a.as_py(), i), centred(b.as_py(), j)
                out[: left.shape[1], : right.shape[1]] = left.T @ right
                k = tiles[i, j]
                total[k] = total[k] + out if k in total else out
        pack = zstandard.ZstdCompressor(level=1)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([pack.compress(x.tobytes()) for x in total.values()], pa.binary())], ["part", "numbers"])

    blocks = column_blocks(fit, dims)
    pairs = blocks.select("block", F.col("col").alias("i"), F.col("numbers").alias("a")).join(blocks.select("block", F.col("col").alias("j"), F.col("numbers").alias("b")).hint("shuffle_hash"), "block").where("i <= j")
    flat = array_sum(pairs.select("i", "j", "a", "b").mapInArrow(multiplied, "part int, numbers binary"), len(tiles) * TILE * TILE, TILE * TILE, "<f8").reshape(-1, TILE, TILE)
    whole = np.zeros((cols * TILE, cols * TILE))
    for (i, j), k in tiles.items():
        whole[i * TILE : (i + 1) * TILE, j * TILE : (j + 1) * TILE] = flat[k]
        whole[j * TILE : (j + 1) * TILE, i * TILE : (i + 1) * TILE] = flat[k].T
    return whole[:dims, :dims] / n


def _squares(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Exact sum of (n x - sums)^2 of each row; null where that is more than a long."""
    most = int(np.abs(x).max(initial=0)) * n + int(np.abs(sums).max(initial=0))
    if most * most * x.shape[1] < 1 << 63:
        d = x * n - sums
        return pa.array((d * d).sum(axis=1), pa.int64())
    exact = [sum((int(a) * n - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def whitened(df: DataFrame, vector: str = "embedding", components: int = 4) -> DataFrame:
    """Rows of df with a whole vector, times their first components: component, n, deviation, whitened, explained, identity_error.

    The vectors become integers x = floor(256 c); the model is fitted to each distinct x once (n of them), so that copies
    weigh nothing. whitened: x less the mean, on the component's unit eigenvector, over the root of its eigenvalue;
    deviation: the exact sum of (n x - sums)^2 (null beyond a long); explained: the eigenvalue's share of the trace;
    identity_error: how far the whitened distinct vectors' covariance, measured over them, is from the identity.

    Rows whose vector is null or has a null or non-finite entry go; so do entries of 2^44 and more, which count as not
    finite. Shorter vectors are filled up with zeros to the longest. A component without variance (fewer distinct vectors
    than components, or constant dimensions) has whitened null, and explained null if nothing varies at all. Empty
    tables, and vectors without any dimension: no rows. Repeated rows stay, each with its own result; other columns stay,
    but those with names of the result are replaced.
    """
    spark = df.sparkSession
    new = T.StructType([T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")]])
    kept = [c for c in df.columns if c.lower() not in {f.name for f in new}]
    x = fresh(df.columns, "x")
    rows = df.where(is_whole(F.col(vector)))
    schema = T.StructType([df.schema[c] for c in kept] + new.fields)
    dims = rows.agg(F.max(F.size(vector))).first()[0] or 0
    if not dims:
        return spark.createDataFrame([], schema)
    rows = rows.select(*kept, integers(F.col(vector), dims).alias(x))
    fit = stored(rows.select(F.col(x).alias("x")).distinct(), shared_dir(spark))
    found = fit.select(F.posexplode("x").alias("at", "c")).groupBy("at").agg(F.sum("c").alias("s"), F.count("*").alias("n")).collect()
    n, sums = found[0]["n"], np.array([r["s"] for r in sorted(found)], np.int64)
    v = tiled_covariance(fit, n, sums)
    values, vectors = (a[..., ::-1] for a in np.linalg.eigh(v))
    k = min(components, dims)
    values, vectors, trace = values[:k], np.ascontiguousarray(vectors[:, :k]), float(np.trace(v))
    live = values > FLAT * max(values[0], np.finfo(float).tiny)
    scale = np.where(live, 1 / np.sqrt(np.where(live, values, 1)), np.nan)

    def projected(m: np.ndarray) -> np.ndarray:
        return (m * n - sums) / n @ vectors * scale

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, projected(_matrix(batch.column("x"), dims)).T)), [f"w{c}" for c in range(k)])

    pairs = [(a, b) for a in range(k) for b in range(a, k) if live[a] and live[b]]
    error = None
    if pairs:
        got = fit.mapInArrow(checked, ", ".join(f"w{c} double" for c in range(k))).agg(*[F.covar_pop(f"w{a}", f"w{b}") for a, b in pairs]).first()
        error = max(abs(c - (a == b)) for (a, b), c in zip(pairs, got, strict=True))
    shares = [float(e) / trace if trace > 0 else None for e in values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column(x), dims)
            at = pa.array(np.repeat(np.arange(len(m)), k))
            own = [batch.column(c).take(at) for c in kept]
            w = projected(m).ravel()
            yield pa.RecordBatch.from_arrays([*own, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(m))), pa.array(np.full(len(m) * k, n, np.int64)), _squares(m, n, sums).take(at), pa.array(w, mask=np.isnan(w)), pa.array(shares * len(m), pa.float64()), pa.array([error] * (len(m) * k), pa.float64())], schema.names)

    return rows.mapInArrow(run, schema)
