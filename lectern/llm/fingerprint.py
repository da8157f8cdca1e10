"""Document fingerprints: a threshold-scaled sketch, in DataFrame functions only.

A text's sketch holds every hash of its word shingles that lies below a fixed fraction of the hash space. Sketches of
any two texts, however unequal in length, keep the same hashes of what the texts share; so resemblance and containment
can be estimated from them, and the sketch of a union is the union of the sketches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_partitions, words_column

#: One hash in so many is kept; words in a shingle.
SCALE, WIDTH = 4, 5


def sketch(text: Column, scale: int = SCALE, width: int = WIDTH) -> Column:
    """Sorted array of the kept shingle hashes; of fewer words than `width` the whole sequence is the only shingle."""
    top = -(1 << 63) + (1 << 64) // scale
    last = lambda w: F.greatest(F.size(w) - (width - 1), F.lit(1))
    kept = lambda w: F.filter(F.transform(F.sequence(F.lit(1), last(w)), lambda i: F.xxhash64(F.slice(w, i, width))), lambda h: h < F.lit(top))
    # The words are bound once, as the variable of a lambda.
    of = F.transform(F.array(words_column(F.lower(text))), lambda w: F.when(F.size(w) > 0, kept(w)).otherwise(F.array().cast("array<bigint>")))
    return F.array_sort(F.array_distinct(F.element_at(of, 1)))


def fingerprint(text: Column, kept: Column) -> Column:
    """The hash of the text and, as 16 hex digits each, the sketch. Equal for equal texts."""
    return F.concat(F.lower(F.hex(F.xxhash64(text))), F.lit(":"), F.array_join(F.transform(kept, lambda h: F.lower(F.hex(h))), ""))


def hashes_of(printed: Column) -> Column:
    """The sketch in a fingerprint, as 16-digit strings: what merging and comparing stored fingerprints needs."""
    digits = F.split_part(printed, F.lit(":"), F.lit(2))
    return F.when(digits == "", F.array().cast("array<string>")).otherwise(F.regexp_extract_all(digits, F.lit("([0-9a-f]{16})"), 1))


def likeness(a: Column, b: Column, equal: Column) -> Column:
    """Estimated resemblance of two sketches, 0 to 1: shared over all hashes; without any: 1 for equal texts, else 0."""
    union = F.size(F.array_union(a, b))
    return F.when(equal, F.lit(1.0)).when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; null if a has no hash."""
    return F.size(F.array_intersect(a, b)) / F.nullif(F.size(a), F.lit(0))


def merged(df: DataFrame, key: str, kept: str = "sketch") -> DataFrame:
    """The sketch of each key's union."""
    return df.select(key, F.explode(kept).alias("_h")).distinct().groupBy(key).agg(F.array_sort(F.collect_list("_h")).alias(kept))


def _rank(x: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most x; found in two steps, each over about the square root of them."""
    if not bounds:
        return F.lit(0)
    m = max(1, round(len(bounds) ** 0.5))
    parts = [bounds[k : k + m] for k in range(0, len(bounds), m)]
    longs = lambda of: F.array(*[F.lit(b).cast("long") for b in of])
    upto = lambda of: F.size(F.filter(of, lambda b: b <= x))
    part = upto(longs([p[0] for p in parts]))
    return F.when(part == 0, 0).otherwise((part - 1) * m + upto(F.element_at(F.array(*map(longs, parts)), F.greatest(part, F.lit(1)))))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, its sketch `kept`, and `next` and `next_kept` of the next document in descending doc_id (after the last: the first).

    The table is dealt by ranges of doc_id, about as many as shuffle partitions, with bounds from approximate
    quantiles; the first document of each range also goes, marked, behind the range before, so that one window over
    ranges sees every neighbour: texts are shuffled once. On the driver: two numbers a range.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = n_partitions(docs.sparkSession)
    bounds = sorted(set(rows.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], F.lit(10 * n + 1000)).alias("q")).first()["q"] or []))
    rows = rows.withColumn("block", _rank(F.col("doc_id"), bounds))
    tops = {r["block"]: r["top"] for r in rows.groupBy("block").agg(F.max("doc_id").alias("top")).collect()}
    if not tops:
        tops = {0: None}
    order = sorted(tops, reverse=True)
    before = {b: order[k - 1] for k, b in enumerate(order)}
    at = lambda of: F.element_at(F.array(*[F.lit(of.get(b)).cast("long") for b in range(order[0] + 1)]), F.col("block") + 1)
    top, to = at(tops), at(before).cast("int")
    more = rows.where(F.col("doc_id").eqNullSafe(top)).select("doc_id", "text", to.alias("block"), F.lit(True).alias("again"))
    both = rows.withColumn("again", F.lit(False)).unionByName(more)
    w = Window.partitionBy("block").orderBy("again", F.desc_nulls_last("doc_id"), F.desc("text"))
    both = both.withColumn("kept", sketch(F.col("text")))
    return both.withColumn("next", F.lead("text").over(w)).withColumn("next_kept", F.lead("kept").over(w)).where("not again").drop("block", "again")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document's, in descending doc_id. Null text: as empty. Ties of doc_id: by descending text. Null doc_id: last.
    An empty table: no rows. Other columns are ignored.
    """
    x = with_next(docs)
    half = F.floor(F.length("text") / 2).cast("int")
    x = x.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next", F.lit(1), half)))
    x = x.withColumn("edited_kept", sketch(F.col("edited")))
    same = lambda a: F.col("text") == F.col(a)
    return x.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("text"), F.col("kept")).alias("fingerprint"), fingerprint(F.col("edited"), F.col("edited_kept")).alias("edited_fingerprint"),
        likeness(F.col("kept"), F.col("edited_kept"), same("edited")).alias("near_edited"), likeness(F.col("kept"), F.col("next_kept"), same("next")).alias("near_next"),
    )
