"""Line dedup over batches, by levelled sorted runs of line hashes, in DataFrame functions only.

A run is a table of (hash, docs), bucketed and sorted by the hash: how many documents of its batches hold the line. Runs
stand in levels, two a level at most: a second run of a level is merged with the first into one of the next, so that n
batches leave about log2(n) runs and each hash is written about as often. What a merge finds in enough documents is
settled and moves to the one run of settled hashes; each new batch is anti-joined with that run, and the rest of its
hashes becomes a run of its own. As all runs have the same buckets, anti-joins and merges read both sides in order and
only the new batch is shuffled, once, as partial counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_dir, fresh, n_partitions, shared_dir

#: ASCII white space, which is stripped at both ends of a line.
WHITE = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """The lines of a text, split at line feeds; null or empty: one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def lowered(bare: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def keyed_lines(text: Column, least_chars: int) -> Column:
    """(line, hash) of each line in order; hash: of the line's key, null for keys of fewer than least_chars code points.

    The key is the line without ASCII white space at its ends, A-Z in lower case.
    """
    bare = F.transform(lines_of(text), lambda x: F.struct(x.alias("line"), F.btrim(x, F.lit(WHITE)).alias("bare")))
    return F.transform(bare, lambda x: F.struct(x["line"].alias("line"), F.when(F.char_length(x["bare"]) >= least_chars, F.xxhash64(lowered(x["bare"]))).alias("hash")))


class LineRuns:
    """How many documents hold each line, kept in runs, over batches that come one after the other.

    Lines are named by 64-bit hashes: n different lines have about n^2 / 2^65 false equalities. Each row of a batch is a
    document, repeated rows too. The runs lie in a new folder in the shared one; close() forgets and deletes them.
    """

    def __init__(self, spark: SparkSession, least_docs: int = 10, least_chars: int = 1):
        self.spark, self.least_docs, self.least_chars = spark, least_docs, least_chars
        self.folder, self.name, self.made = shared_dir(spark), f"lectern_lines_{uuid.uuid4().hex}", 0
        self.buckets = n_partitions(spark)
        #: Name of the run of each level, and of the run of what is settled.
        self.levels: dict[int, str] = {}
        self.settled: str | None = None

    def _write(self, rows: DataFrame) -> str:
        """rows (hash, docs), each bucket's in one task already, as a sorted run."""
        self.made += 1
        name = f"{self.name}_{self.made}"
        rows.write.format("parquet").bucketBy(self.buckets, "hash").sortBy("hash").option("path", f"{self.folder}/{self.made}").option("compression", "zstd").saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        drop_dir(self.spark, f"{self.folder}/{name.rpartition('_')[2]}")

    def _merged(self, a: str, b: str) -> DataFrame:
        """The counts of two runs, added: one merge of two sorted runs without a shuffle.

        A full join, not a union under an aggregation: over bucketed tables Spark 4.1 takes the union for dealt by
        bucket and does not add up what its two sides share.
        """
        left, right = (self.spark.table(x).hint("merge") for x in (a, b))
        both = left.withColumnRenamed("docs", "a").join(right.withColumnRenamed("docs", "b"), "hash", "full")
        return both.select("hash", (F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0))).alias("docs"))

    def add(self, docs: DataFrame, text: str = "text") -> None:
        """Adds the lines of a batch: those not settled yet become a run of level 0."""
        hashes = F.array_compact(F.array_distinct(F.transform(keyed_lines(F.col(text), self.least_chars), lambda x: x["hash"])))
        rows = docs.select(F.explode(hashes).alias("hash")).groupBy("hash").agg(F.count("*").alias("docs"))
        rows = rows.repartition(self.buckets, "hash")
        if self.settled:
            rows = rows.join(self.spark.table(self.settled).hint("merge").select("hash"), "hash", "left_anti")
        new, level = self._write(rows), 0
        while level in self.levels:
            old = self.levels.pop(level)
            new = self._compacted(old, new)
            level += 1
        self.levels[level] = new

    def _compacted(self, old: str, new: str) -> str:
        """One run of two; what reaches least_docs goes to the settled run instead."""
        whole = self._write(self._merged(old, new))
        done = self.spark.table(whole).where(F.col("docs") >= self.least_docs)
        if self.settled:
            both = self.spark.table(self.settled).hint("merge").withColumnRenamed("docs", "a").join(done.withColumnRenamed("docs", "b"), "hash", "full")
            done = both.select("hash", (F.coalesce("a", F.lit(0)) + F.coalesce("b", F.lit(0))).alias("docs"))
        settled = self._write(done)
        rest = self._write(self.spark.table(whole).where(F.col("docs") < self.least_docs))
        for name in (old, new, whole, *([self.settled] if self.settled else [])):
            self._drop(name)
        self.settled = settled
        return rest

    def compact(self) -> None:
        """Merges all levels into one, so that each hash is settled or in too few documents."""
        while len(self.levels) > 1:
            low, high = sorted(self.levels)[:2]
            self.levels[high] = self._compacted(self.levels.pop(high), self.levels.pop(low))

    def common(self) -> DataFrame:
        """hash of each line that least_docs documents or more hold, of all batches so far."""
        self.compact()
        found = [self.spark.table(x).where(F.col("docs") >= self.least_docs).select("hash") for x in (*self.levels.values(), *([self.settled] if self.settled else []))]
        if not found:
            return self.spark.createDataFrame([], "hash long")
        # Rows of the two runs are apart; dealt anew, as a union of bucketed tables is not what it says.
        return found[0] if len(found) == 1 else found[0].union(found[1]).repartition(self.buckets)

    def close(self) -> None:
        for name in (*self.levels.values(), *([self.settled] if self.settled else [])):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels, self.settled = {}, None
        drop_dir(self.spark, self.folder)


def without_lines(docs: DataFrame, common: DataFrame, least_chars: int = 1, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """docs with n_lines, n_dropped and kept: the text without the lines whose hash is in `common` (hash).

    Each document's hashes meet `common` in a shuffled join, so that a line of a third of all documents is split by
    adaptive execution; what they hit comes back by two hashes of id and text, which equal rows share, and only there
    are texts shuffled. In a text, lines are looked up in as many small arrays as the square root of its hits.
    """
    taken = docs.columns
    hits, a, b, cut, grid = (fresh(taken, n) for n in ("hits", "k1", "k2", "cut", "grid"))
    n_lines, n_dropped, kept = "n_lines", "n_dropped", "kept"
    whole = F.coalesce(F.col(text), F.lit(""))
    keys = {a: F.xxhash64(F.col(id_column), whole), b: F.xxhash64(whole, F.col(id_column))}
    rows = docs.select(id_column, text).withColumns(keys)
    own = F.array_compact(F.array_distinct(F.transform(keyed_lines(F.col(text), least_chars), lambda x: x["hash"])))
    met = rows.select(a, b, F.explode(own).alias("hash")).join(common.select("hash").hint("shuffle_merge"), "hash").groupBy(a, b).agg(F.collect_set("hash").alias(hits))
    x = docs.drop(*[c for c in taken if c.lower() in {n_lines, n_dropped, kept}]).withColumns(keys).join(met, [a, b], "left")
    size = F.greatest(F.lit(1), F.floor(F.sqrt(F.size(hits)))).cast("int")
    x = x.withColumn(grid, F.when(F.col(hits).isNotNull(), F.transform(F.sequence(F.lit(0), size - 1), lambda k: F.filter(hits, lambda h: F.pmod(h, size) == k))))
    is_kept = lambda h: h.isNull() | ~F.array_contains(F.get(F.col(grid), F.pmod(h, F.size(grid)).cast("int")), h)
    x = x.withColumn(cut, F.when(F.col(grid).isNotNull(), F.transform(F.filter(keyed_lines(F.col(text), least_chars), lambda y: F.coalesce(is_kept(y["hash"]), F.lit(True))), lambda y: y["line"])))
    count = (F.char_length(whole) - F.char_length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long")
    x = x.withColumns({n_lines: count, n_dropped: F.when(F.col(cut).isNull(), F.lit(0)).otherwise(count - F.size(cut)).cast("long"), kept: F.coalesce(F.array_join(cut, "\n"), whole)})
    return x.drop(a, b, hits, grid, cut)


def deduplicated(docs: DataFrame, least_docs: int = 10, least_chars: int = 1, batches: int = 4, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row for each row of docs, with n_lines, n_dropped and kept, the text without lines of least_docs documents.

    The documents come in batches by ranges of their id, as they would over time; the result is that of all at once,
    whatever the number of batches. Every row is a document, so equal rows count twice. Null or empty text: one empty
    line, whose key is too short for least_chars of 1 or more; then kept is empty. Null ids come with the first batch.
    A text all of whose lines go is kept as an empty one. Columns named n_lines, n_dropped or kept are replaced, other
    columns stay. An empty table: no rows.
    """
    runs = LineRuns(docs.sparkSession, least_docs, least_chars)
    ends = docs.agg(F.min(id_column).alias("a"), F.max(id_column).alias("b")).first()
    low, high = (0, 0) if ends["a"] is None else (ends["a"], ends["b"])
    bounds = sorted({low + (high - low + 1) * k // batches for k in range(1, batches)} - {low})
    c = F.col(id_column)
    for k in range(len(bounds) + 1):
        of = (c >= bounds[k - 1]) if k else F.lit(True)
        of = of & (c < bounds[k]) if k < len(bounds) else of
        runs.add(docs.where(of if k else c.isNull() | of), text)
    common = runs.common().select("hash")
    at = shared_dir(docs.sparkSession)
    common.write.option("compression", "zstd").parquet(at)
    runs.close()
    return without_lines(docs, docs.sparkSession.read.schema("hash long").parquet(at), least_chars, text, id_column)
