"""Copy-on-write keyed upsert of a folder of sorted Parquet files, by tagging without a join.

Base rows and changes are put below each other; one group-by over the key keeps the base row and the winning change as
structs and compares what was with what becomes of it. A starting file, the home of its range of keys, is rewritten only
if one of its rows differs: its rows are ranked by windows and cut evenly, and small neighbours are joined. What is known
of files (bounds, counts, cuts) is a number or two a file; rows never leave the executors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import drop_dir, n_partitions, ranked, shared_dir, stored
from .fingerprint import _rank

#: What a change does to its row.
IGNORE, DELETE, SET = "ignore", "delete", "set"
_PART = r"^part-(\d+)-([0-9a-f-]{36})"


@dataclass
class Files:
    """A keyed table as sorted files in a folder. firsts: the first key of each starting file, ascending."""

    folder: str
    key: str
    per_file: int
    schema: StructType
    firsts: list[int] = field(default_factory=list)
    names: list[str] = field(default_factory=list)

    @property
    def job(self) -> str | None:
        """The id of the write that made the starting files, which is part of their names."""
        return self.names[0][11:47] if self.names else None


def _number() -> Column:
    return F.regexp_extract(F.col("_metadata.file_name"), _PART, 1).cast("int")


def _write(rows: DataFrame, n_files: int, number: str, order: list[str], columns: list[str], folder: str) -> None:
    """Each number's rows, in order, as one file whose name begins with the number; a task streams one file."""
    rows.repartitionById(n_files, F.col(number).cast("int")).sortWithinPartitions(*order).select(*columns).write.mode("append").parquet(folder)


def write_files(rows: DataFrame, key: str, per_file: int, folder: str) -> Files:
    """rows with a key, sorted by it, as Parquet files of per_file rows each (the last: the rest) in the new `folder`.

    All columns stay in their order. Rows are placed by rank, so no task sorts more than its range of keys.
    """
    out = Files(folder, key, per_file, rows.schema)
    nested = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    at = ranked(nested, ["key"]).withColumn("file", F.floor(F.col("rank") / per_file))
    n = at.count()
    if not n:
        return out
    _write(at, -(-n // per_file), "file", ["rank"], ["row.*"], folder)
    files = rows.sparkSession.read.parquet(folder).groupBy(F.col("_metadata.file_name").alias("name")).agg(F.min(key).alias("first")).collect()
    out.names = sorted(r["name"] for r in files)
    first = {r["name"]: r["first"] for r in files}
    out.firsts = [first[x] for x in out.names]
    return out


def tagged(spark: SparkSession, files: Files, changes: DataFrame, order: list[str], sets: list[str], action: Callable[[Column, Column], Column]) -> DataFrame:
    """(key, home, row, live, differs) for each key of the files or the changes: the row after the winning change.

    One group-by and no join: a key of a third of all changes is brought down to one in each task before the shuffle.
    The winner has the highest `order`, ties by the rest of the change. action gives IGNORE, DELETE or SET from the
    change and the first key of its home; a null action is SET.
    """
    key = files.key
    base = spark.read.schema(files.schema).parquet(files.folder)
    base = base.select(F.col(key).alias("key"), _number().alias("home"), F.struct(*[F.col(f"`{c}`") for c in files.schema.names]).alias("base"))
    kept = list(dict.fromkeys([*order, *sets, *[c for c in changes.columns if c != key]]))
    new = changes.where(F.col(key).isNotNull()).select(F.col(key).cast(base.schema["key"].dataType).alias("key"), F.struct(*kept).alias("change"))
    both = base.unionByName(new, allowMissingColumns=True)
    # The greatest by a hash of all columns, should the base hold a key twice.
    one = both.groupBy("key").agg(F.max_by("base", F.when(F.col("base").isNotNull(), F.xxhash64("base"))).alias("base"), F.max("home").alias("home"), F.count("base").alias("copies"), F.max_by("change", "change").alias("change"))
    one = one.withColumn("home", F.coalesce("home", F.greatest(_rank(F.col("key"), files.firsts) - 1, F.lit(0))))
    first = F.get(F.lit(files.firsts), F.col("home"))
    act = F.when(F.col("change").isNull(), IGNORE).otherwise(F.coalesce(action(F.col("change"), first), F.lit(SET)))
    after = F.struct(*[(F.col("key") if c == key else F.when(F.col("act") == SET, F.col(f"change.{c}")).otherwise(F.col("base")[c]) if c in sets else F.col("base")[c]).alias(c) for c in files.schema.names])
    one = one.withColumn("act", act)
    one = one.withColumn("row", F.when((F.col("act") == SET) | (F.col("act") == IGNORE) & F.col("base").isNotNull(), after))
    return one.select("key", "home", "row", F.col("row").isNotNull().alias("live"), (~F.col("row").eqNullSafe(F.col("base")) | (F.col("copies") > 1)).alias("differs"))


def cuts(homes: dict[int, tuple[bool, int]], n_homes: int, per_file: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """How dirty homes are cut: for each home the rows of a short piece, the number of long ones, the place of its first
    piece; and for each piece the new file that it becomes part of.

    homes: dirty or not, and rows, of each home. A dirty home becomes the fewest pieces of at most per_file rows, sizes at
    most one apart, larger first; then, ascending, each piece joins the file left of it if that is new as well and both
    fit. One small step a file.
    """
    short, long, begins, target = [1] * n_homes, [0] * n_homes, [0] * n_homes, []
    grown = 0  # Rows of the file to the left, if that is new.
    files = 0
    for home in range(n_homes):
        dirty, rows = homes.get(home, (False, 0))
        if not dirty:
            grown = 0
            continue
        begins[home] = len(target)
        pieces = -(-rows // per_file)
        if not pieces:
            continue
        short[home], long[home] = divmod(rows, pieces)
        for piece in range(pieces):
            size = short[home] + (piece < long[home])
            if grown and grown + size <= per_file:
                grown += size
            else:
                grown, files = size, files + 1
            target.append(files - 1)
    return short, long, begins, target


def in_home_ranks(rows: DataFrame) -> DataFrame:
    """rows (key, home, row) with `rank`, from 0 within the home in order of the key.

    Rows are dealt by ranges of (home, key), so a home of a third of all rows is ranked by many tasks; a window ranks
    each home's rows in a range, and the counts of the ranges before are added: one number for each home and range.
    """
    dealt = rows.repartitionByRange(n_partitions(rows.sparkSession), "home", "key").withColumn("range", F.spark_partition_id())
    dealt = stored(dealt, shared_dir(rows.sparkSession))
    counts = dealt.groupBy("home", "range").count()
    before = counts.select("home", "range", (F.sum("count").over(Window.partitionBy("home").orderBy("range")) - F.col("count")).alias("before"))
    w = Window.partitionBy("home", "range").orderBy("key")
    return dealt.join(F.broadcast(before), ["home", "range"]).withColumn("rank", F.row_number().over(w) - 1 + F.col("before"))


def upsert(spark: SparkSession, files: Files, changes: DataFrame, order: list[str], sets: list[str], action: Callable[[Column, Column], Column]) -> None:
    """Applies the changes to the folder's files, of which only those with rows that differ are rewritten.

    New files are written beside the old ones; then the files that they replace are deleted. Changes without a key are
    nobody's; equal changes and ties are as good as each other. A null in the change is set like any value. A key that
    the files hold more than once becomes one row. Without files there is no home, so that nothing is inserted.
    """
    if not files.names:
        return
    at = shared_dir(spark)
    rows = stored(tagged(spark, files, changes, order, sets, action), at)
    homes = {r["home"]: (r["dirty"], r["n"]) for r in rows.groupBy("home").agg(F.bool_or("differs").alias("dirty"), F.count_if("live").alias("n")).collect()}
    dirty = [homes.get(k, (False, 0))[0] for k in range(len(files.names))]
    short, long, begins, target = cuts(homes, len(files.names), files.per_file)
    if target:
        of = lambda values: F.get(F.lit(values), F.col("home"))
        own = in_home_ranks(rows.where(F.col("live") & of(dirty)).select("key", "home", "row"))
        longer = of(long) * (of(short) + 1)
        piece = F.when(F.col("rank") < longer, F.floor(F.col("rank") / (of(short) + 1))).otherwise(of(long) + F.floor((F.col("rank") - longer) / of(short)))
        own = own.withColumn("file", F.get(F.lit(target), (of(begins) + piece).cast("int")))
        _write(own, target[-1] + 1, "file", ["key"], ["row.*"], files.folder)
    for name, changed in zip(files.names, dirty, strict=True):
        if changed:
            drop_dir(spark, f"{files.folder}/{name}")
    drop_dir(spark, at)


def described(spark: SparkSession, files: Files, sums: dict[str, Column]) -> DataFrame:
    """One row for each file of the folder, read back: first_id, n_rows, the sums, ids_sha256, columns, path, rewritten.

    A task reads one file in the order of its rows and keeps the running hash of its keys, not the keys. sums: named
    long expressions over the files' columns (null counts 0).
    """
    schema = f"first_id long, n_rows long, {''.join(f'{c} long, ' for c in sums)}ids_sha256 string, columns string, path string, rewritten boolean"
    if not files.names:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(files.schema).parquet(files.folder)
    if rows.isEmpty():
        return spark.createDataFrame([], schema)
    columns, own = ",".join(spark.read.parquet(files.folder).columns), list(sums)
    job, n = files.job, len(files.names)
    old = F.regexp_extract(F.col("_metadata.file_name"), _PART, 2) == job
    more = rows.where(~old).agg(F.max(_number())).first()[0]
    number = F.when(old, _number()).otherwise(n + _number())
    rows = rows.select(number.alias("number"), F.col("_metadata.row_index").alias("at"), F.col("_metadata.file_path").alias("path"), F.col(files.key).cast("long").alias("key"), *[F.coalesce(s, F.lit(0)).cast("long").alias(f"s{k}") for k, s in enumerate(sums.values())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, first, path, number, count, totals = hashlib.sha256(), None, None, 0, 0, [0] * len(own)
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_pylist()
            if path is None:
                first, path, number = keys[0], batch.column("path")[0].as_py(), batch.column("number")[0].as_py()
            running.update((("," if count else "") + ",".join(map(str, keys))).encode())
            count += len(keys)
            for k in range(len(own)):
                totals[k] += sum(batch.column(f"s{k}").to_pylist())
        if count:
            row = [[first], [count], *[[t] for t in totals], [running.hexdigest()], [columns], [path], [number >= n]]
            yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(row, [pa.int64()] * (2 + len(own)) + [pa.string()] * 3 + [pa.bool_()], strict=True)], ["first_id", "n_rows", *own, "ids_sha256", "columns", "path", "rewritten"])

    parts = n + (0 if more is None else more + 1)
    return rows.repartitionById(parts, F.col("number")).sortWithinPartitions("at").mapInArrow(run, schema)
