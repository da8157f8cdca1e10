"""What several operators of this subpackage need: words, hashes, shared folders, ranks, components."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space, as a Java and Python pattern; what lies between are words.
SPACES = r"[\x20\x09-\x0D]+"
#: Odd 64-bit constants for hash mixing.
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder in the one that all executors share: spark.checkpoint.dir, or in local mode one set here."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        known = sc._jsc.sc().getCheckpointDir()
        if not known.isDefined() and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = known.get() if known.isDefined() else f"file://{tempfile.mkdtemp(prefix='lectern-')}"
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/lectern-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """df written under the shared folder and read again: later steps start from its files, not from its lineage."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_dir(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def fresh(columns: list[str], name: str) -> str:
    """A column name that is not among `columns` (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def tidy(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs now, not whenever the driver collects its garbage."""
    gc.collect()
    spark._jvm.System.gc()


def words_column(text: Column) -> Column:
    """Words between ASCII white space; an empty array for null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def n_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def keep_heap() -> None:
    """Lets a Python worker keep the memory of numpy's temporaries, which the C library else gives back and asks for again each time."""
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):
        libc.mallopt(-3, 32 << 20)  # larger blocks only are mapped apart
        libc.mallopt(-1, 256 << 20)  # kept at the heap's end


def give_back() -> None:
    """What a Python worker has kept and no longer uses goes back, so that it is not held while other stages run."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


# ---- words and hashes in numpy -------------------------------------------------------------------


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Random numbers by place in a word (of 32 in turn) and byte.
_BYTES = np.random.default_rng(20240607).integers(0, 1 << 64, 32 << 8, np.uint64)


def bytes_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash for each word between ASCII white space, by tabulation, without a loop over words."""
    b = np.frombuffer(text + b" ", np.uint8)
    space = _SPACE[b]
    ends = np.flatnonzero(space).astype(np.int32)
    n = np.diff(ends, prepend=np.int32(-1)) - 1
    # Places count from the white space before.
    place = np.arange(len(b), dtype=np.int32) - np.repeat(ends - n, n + 1)
    value = _BYTES.take((place & 31) << 8 | b)
    if n.max() > 32:
        far = np.flatnonzero(place > 31)
        value[far] = mix(value[far] + (place[far] >> 5).astype(np.uint64))
    value[ends] = 0
    sums = np.cumsum(value)[ends]
    return mix(np.diff(sums, prepend=np.uint64(0))[n > 0])


def slices(batch: pa.RecordBatch, column: str, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about `most` bytes of a binary column, so that Python holds few of its values at a time."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most)))
        yield batch.slice(a, b - a)
        a = b


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose results look random."""
    x = x ^ (x >> np.uint64(31))
    x = x * MIX_A
    x = x ^ (x >> np.uint64(29))
    x = x * MIX_B
    return x ^ (x >> np.uint64(32))


def shingle_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of `width` word hashes, in order; the whole as one if there are fewer; none of none."""
    if not len(h):
        return h
    w = min(width, len(h))
    out = np.full(len(h) - w + 1, np.uint64(w), np.uint64)
    for k in range(w):
        out = (out * MIX_A + h[k : len(h) - w + 1 + k]) ^ (out >> np.uint64(27))
    return mix(out)


def text_shingles(text: bytes | None, width: int) -> np.ndarray:
    """Hashes of the runs of `width` words of UTF-8 text, A-Z in lower case, as shingle_hashes."""
    return shingle_hashes(bytes_hashes(text.lower()), width) if text else np.empty(0, np.uint64)


def lower_words(text: bytes | None) -> list[bytes]:
    """Words of UTF-8 text between ASCII white space, A-Z in lower case."""
    return text.lower().split() if text else []


# ---- ranks and components ------------------------------------------------------------------------


def ranked(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """df with the 0-based rank of each row in `order` (ties by all of `order` only) and no single-partition sort.

    Rows are dealt by range, numbered within each partition, and moved on by the count of the partitions before;
    the counts are one row a partition.
    """
    spark = df.sparkSession
    at = shared_dir(spark)
    dealt = df.repartitionByRange(n_partitions(spark), *order).sortWithinPartitions(*order)
    dealt = stored(dealt.withColumn("_part", F.spark_partition_id()).withColumn("_in", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)), at)
    counts = dealt.groupBy("_part").count()
    before = counts.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"))
    return dealt.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_in")).drop("_part", "_in", "_before")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node of `edges`; component: the smallest node that it reaches.

    Star contraction: in turn, each node's larger neighbours and each node's smaller neighbours are hung on the
    smallest one, until nothing changes: O(log n) rounds, each written to the shared folder. Nodes must not be null.
    """
    spark = edges.sparkSession
    base = shared_dir(spark)
    now = stored(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{base}/0")
    figures = lambda t: t.selectExpr("count(*) n", "coalesce(sum(xxhash64(u, v) % 1000000007), 0) s").first()
    k, last = 0, figures(now)
    while last["n"]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        small = small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        k += 1
        new = stored(small, f"{base}/{k}")
        same, last = last, figures(new)
        drop_dir(spark, f"{base}/{k - 1}")
        now = new
        if same == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


# ---- sums of arrays over tasks -------------------------------------------------------------------


def array_rows(x: np.ndarray, span: int) -> pa.RecordBatch:
    """An array's bytes as rows of `span` numbers each, compressed: what one task adds to a sum."""
    flat, pack = np.ascontiguousarray(x).ravel(), zstandard.ZstdCompressor(level=1)
    parts = range(-(-len(flat) // span))
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([pack.compress(flat[k * span : (k + 1) * span].tobytes()) for k in parts], pa.binary())], ["part", "numbers"])


def array_sum(rows: DataFrame, size: int, span: int, dtype: str, into: str | None = None) -> np.ndarray:
    """The sum of all tasks' arrays of `size` numbers. Parts are added apart, one after the other: memory is one array a task.

    In two steps, the first over some of the tasks each, so that no task reads what all others have written. into: the
    sum's type, if it is not that of the arrays.
    """
    into = into or dtype

    def add(kind: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                for part, packed in zip(batch.column("part").to_pylist(), batch.column("numbers"), strict=True):
                    x = np.frombuffer(zstandard.decompress(packed.as_py()), kind)
                    total[part] = total[part] + x if part in total else x.astype(into)
            pack = zstandard.ZstdCompressor(level=1)
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([pack.compress(x.tobytes()) for x in total.values()], pa.binary())], ["part", "numbers"])

        return run

    parts = -(-size // span)
    fan = max(1, round(n_partitions(rows.sparkSession) ** 0.5))
    some = rows.withColumn("some", F.pmod(F.spark_partition_id(), F.lit(fan))).repartition(max(1, min(64, parts) * fan), "part", "some")
    some = some.select("part", "numbers").mapInArrow(add(dtype), "part int, numbers binary")
    out = np.zeros(size, into)
    for part, numbers in some.repartition(max(1, min(64, parts)), "part").mapInArrow(add(into), "part int, numbers binary").collect():
        out[part * span : (part + 1) * span] = np.frombuffer(zstandard.decompress(numbers), into)
    return out
