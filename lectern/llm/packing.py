"""Conflict-constrained best-fit packing of documents into fixed-length training sequences.

Documents are dealt by hash into groups of bounded size; a group's lengths, sources and clusters (no texts) go to one
task. There, longest first, each piece goes to the open bin with the least room that still holds it and has no
conflict: bins stand ordered by residual room and carry two bitmaps, of the sources (a few bits each, one a piece that
the bin may hold of it) and of the duplicate clusters in it. From the piece's length on, the search goes from one bin
to its successor until the first compatible one, which is the tightest.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES

#: Tokens of a bin; documents of a group, about; pieces of one source in a bin.
CAPACITY, GROUP, QUOTA = 2048, 4096, 4


def best_fit(lengths: list[int], sources: list, clusters: list, capacity: int, quota: int) -> list[tuple[int, int]]:
    """(bin, offset) for each piece. Pieces of one cluster never share a bin; of one source at most `quota` do. None conflicts with nothing."""
    source_no = {s: k for k, s in enumerate(sorted({s for s in sources if s is not None}))}
    twice = Counter(c for c in clusters if c is not None)
    cluster_no = {c: k for k, c in enumerate(sorted(c for c, n in twice.items() if n > 1))}
    field = (1 << quota) - 1
    order: list[tuple[int, int]] = []  # (residual, bin)
    in_source: list[int] = []
    in_cluster: list[int] = []
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = lengths[i]
        shift = None if sources[i] is None else quota * source_no[sources[i]]
        full = 0 if shift is None else field << shift
        mine = 1 << cluster_no[clusters[i]] if clusters[i] in cluster_no else 0
        k = bisect_left(order, (need, -1))
        while k < len(order):
            b = order[k][1]
            if not in_cluster[b] & mine and (not full or in_source[b] & full != full):
                break
            k += 1
        if k < len(order):
            left, b = order.pop(k)
        else:
            left, b = capacity, len(in_source)
            in_source.append(0)
            in_cluster.append(0)
        out[i] = b, capacity - left
        in_cluster[b] |= mine
        if shift is not None:  # the next free bit of the source's field
            in_source[b] |= ((in_source[b] >> shift & field) + 1) << shift
        if left > need:
            insort(order, (left - need, b))
    return out


def packed(docs: DataFrame, capacity: int = CAPACITY, quota: int = QUOTA, group: int = GROUP, length: str | None = None, cluster: str | None = None) -> DataFrame:
    """One row for each piece of each document: doc_id, piece, start, n_tokens, bin, bin_offset.

    A document's length is that of column `length`, or its words and one end token. Longer ones than `capacity` are cut
    into pieces, of which all but the last fill a bin. A bin is `group/number`; its pieces lie one after the other from
    offset 0. cluster: a column naming duplicates, or by default equal texts but for case and white space.

    Null or empty text: one piece, the end token. Null source: no conflict. Repeated rows: all packed, in different
    bins. Null doc_id: packed like others. An empty table: no rows. Other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    plain = F.lower(F.trim(F.regexp_replace(text, SPACES, " ")))
    size = F.col(length) if length else F.when(plain == "", 1).otherwise(F.length(plain) - F.length(F.replace(plain, F.lit(" "))) + 2)
    rows = docs.select("doc_id", "source", size.cast("long").alias("size"), (F.col(cluster).cast("string") if cluster else F.hex(F.xxhash64(plain))).alias("cluster"))
    groups = max(1, -(-docs.count() // group))
    # Equal rows are counted, then numbered: copies are dealt to groups like other rows, or all would conflict in one.
    rows = rows.groupBy("doc_id", "source", "size", "cluster").agg(F.count("*").alias("copies")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    rows = rows.withColumn("grp", F.pmod(F.xxhash64("doc_id", "size", "cluster", "copy"), F.lit(groups)))  # of whole documents; pieces that fill a bin go elsewhere
    pieces = F.sequence(F.lit(0).cast("long"), F.greatest(F.floor((F.col("size") - 1) / capacity), F.lit(0).cast("long")))
    rows = rows.withColumn("piece", F.explode(pieces)).withColumn("start", F.col("piece") * capacity).withColumn("n_tokens", F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("start")))
    full = F.col("n_tokens") == capacity

    def pack(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values(["n_tokens", "doc_id", "cluster"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        none = lambda s: [None if pd.isna(v) else v for v in s]
        placed = best_fit(x.n_tokens.tolist(), none(x.source), none(x.cluster), capacity, quota)
        return x[["doc_id", "piece", "start", "n_tokens"]].assign(bin=[f"{g}/{b}" for g, (b, _) in zip(x.grp, placed, strict=True)], bin_offset=[o for _, o in placed])

    schema = "doc_id long, piece long, start long, n_tokens long, bin string, bin_offset long"
    # A piece that fills a bin needs no search and no task of its own.
    name = F.concat_ws("/", F.lit("full"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), "piece", F.hex(F.xxhash64("source", "size", "cluster")), "copy")
    own = rows.where(full).select("doc_id", "piece", "start", "n_tokens", name.alias("bin"), F.lit(0).cast("long").alias("bin_offset"))
    return rows.where(~full).select("doc_id", "source", "cluster", "grp", "piece", "start", "n_tokens").groupBy("grp").applyInPandas(pack, schema).unionByName(own)
