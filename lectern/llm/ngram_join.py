"""Similarity self-join of documents on their word n-gram sets, by token-combination prefixes.

Each document is a set of n-grams ("tokens" here). Tokens stand in one global order, rare ones first; how rare is told
by a table of hashed counts over all documents. A set of n tokens that is similar to another one lacks at most
`miss(n)` of its tokens there. Its prefix is extended, in that order, until whatever `miss(n)` tokens are taken away
something of it must remain in common: a single token of the rare class, or a pair of tokens of one of the
sub-universes into which the frequent class is dealt. A rare token is indexed as it is, a frequent one only in pairs;
so passages which many documents share bring nothing together by themselves. Sets too small to reach that with pairs
are indexed by the single tokens of their plain prefix, which is enough as both sets of such a pair are then of that
kind. Pairs that share an entry are left out if what stands before it in both sets, and cannot be in common, is too
much, or if the sets' parity marks tell that they differ in too many tokens; all others that are not yet connected are verified on their whole texts.

Equal sets are one node from the start. Entries with many nodes are not expanded into pairs at once: in each of a few
rounds every node meets one pivot of its entry; what is linked becomes one component, and only pairs of different
components are left for the rest, which is exhaustive. Where links are counted, components are dealt into blocks and
each two blocks of one are counted together: no pair is a row, and a node is sent as often as there are blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, drop_dir, fresh, keep_heap, mix, n_partitions, shared_dir, slices, stored, text_shingles, tidy

#: Hashed counters of tokens, in parts that are summed apart. 4 MB as levels, whatever the corpus.
COUNTERS, PART = 1 << 22, 1 << 18
#: Tokens of this level or more (2 ** level more than the mean counter) are of the frequent class.
FREQUENT = 6
#: Sub-universes of the frequent class.
UNIVERSES = 16
#: Rounds with one pivot an entry before the exhaustive one.
PIVOTS = 2
#: A round's nodes meet all others of entries with no more nodes than this.
SMALL = 4
#: Nodes of a block of a component whose links are counted, and tokens of all its sets, about.
BLOCK, BLOCK_TOKENS = 512, 1_000_000
#: Documents of which a task remembers that it has indexed their set; others are indexed again, to no effect.
SEEN = 500_000


def grams(text: bytes | None, width: int) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of a text; with fewer words the whole sequence is one."""
    return np.unique(text_shingles(text, width))


def node_of(g: np.ndarray) -> int:
    """A 64-bit name of a set."""
    return int((mix(g).sum(dtype=np.uint64) ^ mix(np.array([len(g)], np.uint64))[0]).view(np.int64))


def marks_of(g: np.ndarray) -> np.ndarray:
    """The set's parity in each of 256 hashed places, as four 64-bit integers: two sets differ in as many tokens as in bits, at least."""
    return np.packbits((np.bincount((mix(g) >> np.uint64(56)).astype(np.int64), minlength=256) & 1).astype(np.uint8)).view(np.int64)


def levels_of(counts: np.ndarray) -> np.ndarray:
    mean = counts.mean()
    over = counts - (mean + 6 * np.sqrt(mean) + 2)
    return np.where(over > 0, 1 + np.log2(np.maximum(over, 1)), 0).astype(np.uint8)


def entries(g: np.ndarray, levels: np.ndarray, miss: int) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of a set; and for each how many tokens of the set cannot be in common with another set of which it is the first entry in common.

    Before a single token those are the tokens before it in order. Of sets that have only a pair of frequent tokens in
    common, none of the rare ones are.
    """
    level = levels[(g & np.uint64(COUNTERS - 1)).astype(np.int64)]
    order = np.lexsort((g, level))
    g, level = g[order], level[order]
    need = miss + 1
    rare = int(np.searchsorted(level, FREQUENT))
    if rare >= need:
        return mix(g[:need]), np.arange(need)
    frequent = g[rare:]
    universe = ((frequent >> np.uint64(40)) % np.uint64(UNIVERSES)).astype(np.int64)
    # The k-th token of a universe adds one to what must be taken away, but for the first.
    by = np.argsort(universe, kind="stable")
    starts = np.searchsorted(universe[by], np.arange(UNIVERSES))
    later = np.ones(len(frequent), bool)
    later[by[starts[starts < len(frequent)]]] = False
    reach = rare + np.cumsum(later)
    out, before = [mix(g[:rare])], [np.arange(rare)]
    if not len(reach) or reach[-1] < need:
        end = len(frequent)
        out.append(mix(mix(g[:need]) ^ np.uint64(0x5BD1E995)))
        before.append(np.arange(len(out[-1])))
    else:
        end = int(np.searchsorted(reach, need)) + 1
    for u in range(UNIVERSES):
        own = np.sort(frequent[:end][universe[:end] == u])
        if len(own) > 1:
            i, j = np.triu_indices(len(own), 1)
            out.append(mix(own[i] * np.uint64(0x2545F4914F6CDD1D) ^ mix(own[j])))
            before.append(np.full(len(i), rare))
    return np.concatenate(out), np.concatenate(before)


def _columns(batch: pa.RecordBatch, *names: str):
    return zip(*(batch.column(n).to_pylist() for n in names), strict=True)


_MEASURED = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), *((f"m{k}", pa.int64()) for k in range(4)), ("part", pa.int32()), ("counts", pa.binary())])


def _measure(width: int):
    def filled(rows: int, **own: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([own.get(f.name, pa.nulls(rows, f.type)) for f in _MEASURED], schema=_MEASURED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_heap()
        counts = np.zeros(COUNTERS, np.int64)
        any_rows = False
        for batch in (x for b in batches for x in slices(b, "text")):
            sizes, nodes, marks = [], [], []
            for (text,) in _columns(batch, "text"):
                g = grams(text, width)
                np.add.at(counts, (g & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
                sizes.append(len(g)), nodes.append(node_of(g) if len(g) else None), marks.append(marks_of(g))
            if sizes:
                any_rows = True
                yield filled(len(sizes), doc_id=batch.column("doc_id"), text_hash=batch.column("text_hash"), n=pa.array(sizes, pa.int64()), node=pa.array(nodes, pa.int64()), **{f"m{k}": pa.array(x) for k, x in enumerate(np.array(marks).T.copy())})
        if any_rows:
            pack = zstandard.ZstdCompressor(level=1)
            parts = range(COUNTERS // PART)
            yield filled(len(parts), part=pa.array(parts, pa.int32()), counts=pa.array([pack.compress(counts[k * PART : (k + 1) * PART].astype(np.uint32).tobytes()) for k in parts], pa.binary()))

    return run


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, packed in _columns(batch, "part", "counts"):
            total[part] = total.get(part, 0) + np.frombuffer(zstandard.decompress(packed), np.uint32).astype(np.float32)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.astype(np.float32).tobytes() for x in total.values()], pa.binary())], ["part", "counts"])


def _index(width: int, less: int, levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_heap()
        seen: set[int] = set()
        for batch in (x for b in batches for x in slices(b, "text")):
            sigs, nodes, sizes, places = [], [], [], []
            for (text,) in _columns(batch, "text"):
                g = grams(text, width)
                if not len(g) or (node := node_of(g)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(node)
                e, before = entries(g, levels.value, less * len(g) // 100)
                sigs.append(e), places.append(before.astype(np.int32)), nodes.append(np.full(len(e), node, np.int64)), sizes.append(np.full(len(e), len(g), np.int32))
            if sigs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(nodes)), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(places))], ["sig", "node", "n", "p"])

    return run


def _verify(width: int, at_least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, left = None, None
        for batch in batches:
            a, b = [], []
            for x, y, s, t in _columns(batch, "a", "b", "text_a", "text_b"):
                if x != last:
                    last, left = x, grams(s, width)
                right = grams(t, width)
                both = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * both >= at_least * (len(left) + len(right) - both):
                    a.append(x), b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def similar_documents(docs: DataFrame, at_least: int = 85, width: int = 4, count_links: bool = True) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_shingles, component_id, n_links.

    Two documents link when 100 * |intersection| >= at_least * |union| of their sets of `width`-word shingles;
    component_id is the smallest doc_id reachable by links, itself included; n_links counts the different sets that
    the row's set links with, equal ones not among them. Without count_links: those needed to connect its component only.

    Null or blank text: an empty set, linked with nothing. Null doc_id: kept; it goes with equal
    texts, but is not compared with others and names no component. Repeated rows: a row each. Other columns are ignored. Empty input: no rows.
    """
    return _similar(docs, at_least, width, count_links).select("doc_id", "n_shingles", "component_id", "n_links")


def _similar(docs: DataFrame, at_least: int, width: int, count_links: bool) -> DataFrame:
    """What similar_documents returns, and text_hash (Spark's xxhash64) and a number of the row's component; null for empty sets."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    base = shared_dir(spark)
    hashed = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("text_hash"))
    rows = hashed.select("doc_id", "text")
    measured = stored(hashed.mapInArrow(_measure(width), "doc_id long, text_hash long, n long, node long, m0 long, m1 long, m2 long, m3 long, part int, counts binary"), f"{base}/measured")
    sums = measured.where("part is not null").select("part", "counts").repartition(COUNTERS // PART, "part").mapInArrow(_add_counts, "part int, counts binary")
    counts = np.zeros(COUNTERS, np.float32)
    for part, x in sums.collect():  # COUNTERS floats in all
        counts[part * PART : (part + 1) * PART] = np.frombuffer(x, np.float32)
    levels = sc.broadcast(levels_of(counts))
    own = measured.where("part is null").drop("part", "counts")

    # Entries that two nodes or more share.
    sigs = rows.select("text").mapInArrow(_index(width, 100 - at_least, levels), "sig long, node long, n int, p int")
    bucket = F.expr("min(node) over (partition by sig)"), F.expr("max(node) over (partition by sig)")
    shared = stored(sigs.withColumns({"lo": bucket[0], "hi": bucket[1]}).where("lo <> hi").select("sig", "node", "n", "p").distinct(), f"{base}/shared")
    tidy(spark)

    # One text and the marks of each node that has a chance.
    marks = ["m0", "m1", "m2", "m3"]
    chosen = own.where("node is not null").join(shared.select("node").distinct(), "node", "left_semi")
    chosen = stored(chosen.groupBy("node").agg(F.min(F.expr("if(doc_id is null, null, struct(doc_id, text_hash))")).alias("of"), *[F.first(m).alias(m) for m in marks]), f"{base}/chosen")
    texts = hashed.join(chosen.where("of is not null").select("node", F.col("of.doc_id").alias("doc_id"), F.col("of.text_hash").alias("text_hash")), ["doc_id", "text_hash"])
    texts = stored(texts.select("node", "text"), f"{base}/texts")
    tidy(spark)

    links = spark.createDataFrame([], "a long, b long")
    tested, named, k = [], None, 0
    for k in range(PIVOTS + 1):
        of = chosen.select("node", *marks, F.col("node").alias("c")) if named is None else chosen.join(named, "node", "left").select("node", *marks, F.coalesce("component", "node").alias("c"))
        at = shared.join(of, "node")
        whole = k == PIVOTS
        # A node with few tokens of its own is the likeliest to link with all the others.
        pivot = F.struct((F.col("p") if k < 2 else F.lit(0)).alias("q"), F.xxhash64("node", F.lit(k)).alias("h"), F.col("node").alias("a"), F.col("n").alias("na"), F.col("p").alias("pa"), F.col("c").alias("ca"), *[F.col(m).alias(f"{m}a") for m in marks])
        open_ = at.groupBy("sig").agg(F.count("*").alias("m"), F.min("c").alias("lo"), F.max("c").alias("hi"), F.min(pivot).alias("v")).where("lo <> hi")
        apart = " + ".join(f"bit_count({m} ^ {m}a)" for m in marks)
        near = f"{100 + at_least} * least(2 * (n - p), 2 * (na - pa), n + na - ({apart})) >= {2 * at_least} * (n + na)"
        met = at.join(open_.where("false" if whole else f"m > {SMALL}" if k else "true").select("sig", "v.a", "v.na", "v.pa", "v.ca", *[f"v.{m}a" for m in marks]), "sig").where(f"c <> ca and {near}")
        if k:
            few = open_.select("sig") if whole else open_.where(f"m <= {SMALL}").select("sig")
            left = at.join(few, "sig", "left_semi")
            right = left.select("sig", F.col("node").alias("a"), F.col("n").alias("na"), F.col("p").alias("pa"), F.col("c").alias("ca"), *[F.col(m).alias(f"{m}a") for m in marks])
            met = met.unionByName(left.join(right, "sig").where(f"c < ca and {near}").select(met.columns))
        pairs = met.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
        for old in tested:
            pairs = pairs.join(old, ["a", "b"], "left_anti")
        pairs = stored(pairs, f"{base}/pairs{k}")
        if pairs.isEmpty():
            if whole or k and at.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("m")).where(f"lo <> hi and m > {SMALL}").isEmpty():
                break
            continue
        tested.append(pairs)
        loaded = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        found = stored(loaded.select("a", "b", "text_a", "text_b").mapInArrow(_verify(width, at_least), "a long, b long").distinct(), f"{base}/links{k}")
        links = links.unionByName(found)
        named = stored(components(links), f"{base}/components{k}")
        tidy(spark)

    first = own.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
    if named is None:
        of = first.select("node", F.col("node").alias("component"), F.col("first").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    else:
        if count_links:
            degree = _degrees(named.join(shared.select("node", "n").distinct(), "node"), texts, width, at_least)
        else:
            degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
        named = first.join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))
        least = named.groupBy("component").agg(F.min("first").alias("component_id"))
        of = named.join(least, "component").join(degree, "node", "left").select("node", "component", "component_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    of = stored(of, f"{base}/of")
    for x in ["shared", "chosen", "texts", *(f"{x}{k}" for x in ("pairs", "links", "components") for k in range(PIVOTS + 1))]:
        drop_dir(spark, f"{base}/{x}")
    tidy(spark)
    out = own.join(of, "node", "left")
    return out.select("doc_id", "text_hash", "component", F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("n_links", F.lit(0)).cast(T.LongType()).alias("n_links"))


def _degrees(named: DataFrame, texts: DataFrame, width: int, at_least: int) -> DataFrame:
    """node, n_links: how many others of its component (node, component, n) each node links with.

    A component is dealt into blocks of nodes by hash; each two of its blocks meet in one group, which counts what all
    their pairs have in common at once. A node goes to as many groups as its component has blocks, one for most.
    """
    size = named.groupBy("component").agg(F.count("*").alias("m"), F.sum("n").alias("all"))
    size = size.select("component", "m", F.expr(f"greatest(ceil(m / {BLOCK}), ceil(all / {BLOCK_TOKENS}))").cast("int").alias("blocks"))
    sized = named.join(size, "component")
    two = sized.where("m = 2").select("node", F.lit(1).cast("long").alias("n_links"))  # a component of two is one link
    own = sized.where("m > 2").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("node", "component", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    met = met.join(texts, "node").repartition(n_partitions(named.sparkSession), "component", "i", "j").sortWithinPartitions("component", "i", "j")
    counted = met.select("component", "i", "j", "own", "node", "text").mapInArrow(_count_links(width, at_least), "node long, n_links long")
    return counted.unionByName(two).groupBy("node").agg(F.sum("n_links").alias("n_links"))


def common_counts(sets: list[np.ndarray], tile: int = 4096) -> np.ndarray:
    """How many values each two of the sets have in common, summed over tiles of the values that two or more have."""
    values, of, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.cumsum(times > 1) - 1
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    often = times[of] > 1
    row, column = row[often], place[of[often]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, tile):
        a, b = np.searchsorted(column, [at, at + tile])
        x = np.zeros((len(sets), tile), np.float32)  # sums up to a tile's width are exact
        x[row[a:b], column[a:b] - at] = 1
        out += x @ x.T
    return out.astype(np.int64)


def _count_links(width: int, at_least: int):
    def counted(group: tuple, nodes: dict[int, tuple[int, np.ndarray]]) -> pa.RecordBatch:
        _, i, j = group
        block, sets = np.array([b for b, _ in nodes.values()]), [g for _, g in nodes.values()]
        both, n = common_counts(sets), np.array([len(g) for g in sets])
        near = 100 * both >= at_least * (n[:, None] + n[None, :] - both)
        near &= block[:, None] != block[None, :] if i != j else ~np.eye(len(n), dtype=bool)
        return pa.RecordBatch.from_arrays([pa.array(list(nodes), pa.int64()), pa.array(near.sum(axis=1).astype(np.int64))], ["node", "n_links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, nodes = None, {}
        for batch in (x for b in batches for x in slices(b, "text")):
            for component, i, j, own, node, text in _columns(batch, "component", "i", "j", "own", "node", "text"):
                if (component, i, j) != last:
                    if nodes:
                        yield counted(last, nodes)
                    last, nodes = (component, i, j), {}
                if node not in nodes:  # equal rows have one node
                    nodes[node] = own, grams(text, width)
        if nodes:
            yield counted(last, nodes)

    return run


def keep_one(docs: DataFrame, at_least: int = 80, width: int = 5) -> DataFrame:
    """docs without the near duplicates: of each component one row stays, that of the smallest doc_id (then hash of the text).

    Rows of one doc_id with different texts are judged apart. Texts without words and rows without doc_id stay.
    """
    found = _similar(docs, at_least, width, False).where("doc_id is not null and n_shingles > 0")
    keys = found.groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    best = keys.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("best"))
    of, hashed, stays = (fresh(docs.columns, x) for x in ("_id", "_hash", "_stays"))
    marks = keys.join(best, "component").select(F.col("doc_id").alias(of), F.col("text_hash").alias(hashed), (F.struct("doc_id", "text_hash") == F.col("best")).alias(stays), "n").where(f"not {stays} or n > 1").drop("n")
    marks = stored(marks, shared_dir(docs.sparkSession))
    joined = docs.join(marks, (F.col("doc_id") == F.col(of)) & (F.xxhash64("text") == F.col(hashed)), "left")
    # Rows that are equal in id and text, of which one stays, are few or else aggregated before they are dealt.
    again = joined.where(stays).dropDuplicates([of, hashed])
    return joined.where(F.col(stays).isNull()).select(docs.columns).unionByName(again.select(docs.columns))
