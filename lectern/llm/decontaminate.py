"""Benchmark decontamination by latent semantic retrieval.

Words of the benchmark have a feature each, all others share hashed ones. Documents are read as overlapping passages
with TF-IDF weights counted over the whole table. A randomised SVD of the passage matrix (a random projection, one
power step, and the small Gram matrix of the passages projected on what that finds and on mixtures of the items; each a pass
over all passages, of which tasks return sums only) gives a latent space with equal variance on each axis. There every passage is compared with every benchmark
item, at the passage length that suits the item. What comes near is checked on the words themselves: longest common
subsequence with the item, weight of what is in common, and the item's answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import array_rows, array_sum, keep_heap, shared_dir, tidy

#: Words of a segment; passages are 2, 4, 8 ... segments, one beginning at each segment. Hashed features of other words.
SEGMENT, OTHERS = 16, 4096
#: Random directions that start the projection; random mixtures of the items that are added to what it finds; seed.
RANK, MIXTURES, SEED = 16, 64, 20240501
#: Cosine from which a passage is checked. Share of an item's words that the common subsequence must have, without
#: and with its answer; share of its weight; share of the answer's words.
COSINE, COMMON, COMMON_ANSWER, HEAVY, ANSWER = 0.5, 0.8, 0.6, 0.6, 0.75
#: The benchmark is the query set, which each task holds, in blocks of about as many items at most.
MOST_ITEMS = 200_000
#: Numbers of an array in one row.
SPAN = 1 << 16

_PUNCTUATION = bytes.maketrans(bytes(c for c in range(128) if not chr(c).isalnum()), b" " * sum(not chr(c).isalnum() for c in range(128)))


def plain_words(text: bytes | None) -> list[bytes]:
    """Words in lower case without ASCII punctuation."""
    return text.lower().translate(_PUNCTUATION).split() if text else []


class _Features(dict):
    def __missing__(self, word: bytes) -> int:
        return len(self) + xxh3_64_intdigest(word) % OTHERS


class Benchmark:
    """Items as features, answers and passage lengths."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        words = [(i, plain_words(t), t) for i, t in rows if i is not None]
        words = [x for x in words if x[1]]
        self.features = _Features({w: k for k, w in enumerate(sorted({w for _, ws, _ in words for w in ws}))})
        self.size = len(self.features) + OTHERS
        self.ids = [i for i, _, _ in words]
        self.items = [np.array([self.features[w] for w in ws], np.int64) for _, ws, _ in words]
        self.answers = [self._answer(len(ws), t) for _, ws, t in words]
        self.spans = [max(2, 1 << max(0, int(np.ceil(np.log2(len(ws) * 4 / 3 / SEGMENT))))) for _, ws, _ in words]

    @staticmethod
    def _answer(n: int, text: bytes) -> int:
        """How many of an item's last words are its answer: the last sentence, at most half of it, one word at least."""
        tail = [x for x in text.replace(b"?", b".").replace(b"!", b".").split(b".") if plain_words(x)]
        return max(1, min(len(plain_words(tail[-1])), n // 2))

    def ids_of(self, text: bytes | None) -> np.ndarray:
        words = plain_words(text)
        return np.fromiter(map(self.features.__getitem__, words), np.uint32, len(words))


def _sums(x: np.ndarray, ids: np.ndarray, width: int = SEGMENT) -> np.ndarray:
    """Sums of the rows x[ids] by `width` ids, of which there are a multiple; larger ids are the last row."""
    return np.take(x, ids.astype(np.int64), axis=0, mode="clip").reshape(-1, width, x.shape[1]).sum(axis=1)


def _blocks(batches: Iterator[pa.RecordBatch], most: int = 1 << 18) -> Iterator[np.ndarray]:
    """Features of documents one after the other, each filled up to whole pairs of segments with a feature of no weight (the last)."""
    own, n = [], 0
    for batch in batches:
        for x in batch.column("features").to_pylist():
            ids = np.frombuffer(x, np.uint32)
            for k in range(0, len(ids), most):
                own.append(ids[k : k + most])
                own.append(np.full(-len(own[-1]) % (2 * SEGMENT), 0x7FFFFFFF, np.uint32))
                n += len(own[-1]) + len(own[-2])
            if n >= most:
                yield np.concatenate(own)
                own, n = [], 0
    if n:
        yield np.concatenate(own)


def common_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, with the table's rows as bits of one integer."""
    at: dict[int, int] = {}
    for k, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        if m := at.get(x):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def common_positions(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Positions in a and b of one longest common subsequence."""
    t = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    y = np.array(b)
    for i, x in enumerate(a):
        t[i + 1, 1:] = np.maximum.accumulate(np.maximum(t[i, 1:], t[i, :-1] + (y == x)))
    i, j, out = len(a), len(b), []
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.append((i, j))
        elif t[i - 1, j] >= t[i, j - 1]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


class Search:
    """What a task needs: latent axes by feature and the items' places there."""

    def __init__(self, bench: Benchmark, idf: np.ndarray, axes: np.ndarray):
        self.bench, self.idf = bench, idf
        self.axes = np.vstack([axes * idf[:, None], np.zeros((1, axes.shape[1]))]).astype(np.float32)
        at = np.array([(axes[x] * idf[x, None]).sum(axis=0) for x in bench.items])
        self.at = (at / np.maximum(np.linalg.norm(at, axis=1, keepdims=True), 1e-12)).astype(np.float32)
        self.by_span = {s: np.array([k for k, x in enumerate(bench.spans) if x == s]) for s in sorted(set(bench.spans))}

    def near(self, ids: np.ndarray) -> dict[int, set[int]]:
        """Segments at which a passage near an item begins, by item number."""
        out: dict[int, set[int]] = {}
        parts = _sums(self.axes, np.append(ids, np.full(-len(ids) % SEGMENT, 0x7FFFFFFF, np.uint32)))
        run = np.vstack([np.zeros((1, parts.shape[1]), np.float64), np.cumsum(parts, axis=0, dtype=np.float64)])
        for span, items in self.by_span.items():
            w = min(span, len(parts))
            x = (run[w:] - run[:-w]).astype(np.float32)
            x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
            for s, k in zip(*np.nonzero(x @ self.at[items].T >= COSINE), strict=True):
                out.setdefault(int(items[k]), set()).add(int(s))
        return out

    def checked(self, ids: np.ndarray, item: int, starts: set[int]) -> tuple | None:
        """(first word, last word + 1, share in common, weight in common, share of the answer) of the best passage, if it is a leak."""
        own = self.bench.items[item].tolist()
        n, best = len(own), None
        reach = self.bench.spans[item] * SEGMENT
        weight = self.idf[self.bench.items[item]]
        done = -1
        for s in sorted(starts):
            if s * SEGMENT < done:
                continue
            lo, hi = max(0, s * SEGMENT - n // 2), min(len(ids), s * SEGMENT + reach + SEGMENT + n // 2)
            done = hi - reach - n // 2
            there = ids[lo:hi].tolist()
            if common_length(own, there) < COMMON_ANSWER * n:
                continue
            pairs = common_positions(own, there)
            share = len(pairs) / n
            heavy = float(weight[[i for i, _ in pairs]].sum() / max(weight.sum(), 1e-12))
            tail = self.bench.answers[item]
            answer = sum(i >= n - tail for i, _ in pairs) / tail
            close = pairs[-1][1] - pairs[0][1] + 1 <= 2 * n
            if close and heavy >= HEAVY and (share >= COMMON or answer >= ANSWER) and (n >= 8 or share == 1) and (best is None or share > best[2]):
                best = lo + pairs[0][1], lo + pairs[-1][1] + 1, share, heavy, answer
        return best


def _mixtures(bench: Benchmark, idf: np.ndarray) -> np.ndarray:
    """Random sums of the items' unit vectors."""
    rng, out = np.random.default_rng(SEED + 1), np.zeros((MIXTURES, bench.size))
    for x in bench.items:
        features, n = np.unique(x, return_counts=True)
        v = n * idf[features]
        out[:, features] += rng.standard_normal((MIXTURES, 1)) * (v / max(np.linalg.norm(v), 1e-12))
    return out


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, first_word, end_word, common, weight, answer: a row for each document and item that leaks into it.

    Words count without ASCII punctuation and case. Null or empty texts, of documents or items: no rows. Null item_id:
    left out. Repeated rows: rows for each. An item of fewer than eight words must be found whole. Very long texts:
    whole. More items than MOST_ITEMS are searched for in blocks, one after the other. Only sums whose size a block's
    vocabulary gives reach the driver.
    """
    items = benchmark.select("item_id", F.col("text").cast("binary").alias("text")).where("item_id is not null and text is not null")
    if (blocks := -(-items.count() // MOST_ITEMS)) <= 1:
        return _leaks(docs, items)
    return reduce(DataFrame.unionByName, [_leaks(docs, items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * blocks)) == k)) for k in range(2 * blocks)])


def _leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, first_word long, end_word long, common double, weight double, answer double"
    rows = items.collect()  # a block
    bench = Benchmark([(i, bytes(t)) for i, t in rows])
    if not bench.items:
        return spark.createDataFrame([], schema)
    held = spark.sparkContext.broadcast(bench)
    size = bench.size

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [held.value.ids_of(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "features"])

    at = shared_dir(spark)
    docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(read, "doc_id long, features binary").write.option("compression", "zstd").parquet(at)
    stored = spark.read.schema("doc_id long, features binary").parquet(at)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_heap()
        n, total = np.zeros(size + 1, np.float64), 0
        for ids in _blocks(batches):
            own = np.sort(np.minimum(ids, size).reshape(-1, 2 * SEGMENT), axis=1)
            n += np.bincount(own[np.hstack([np.ones((len(own), 1), bool), own[:, 1:] != own[:, :-1]])], minlength=size + 1)
            total += len(own)
        n[size] = total
        yield array_rows(n, SPAN)

    numbers = "part int, numbers binary"
    n = array_sum(stored.select("features").mapInArrow(count, numbers), size + 1, SPAN, "float64")
    idf = np.log((1 + n[size]) / (1 + n[:size])) + 1e-3
    rank = min(RANK, size)
    start = np.random.default_rng(SEED).standard_normal((size, rank))
    weights = np.append(idf, 0.0)

    first = spark.sparkContext.broadcast((np.vstack([start, np.zeros((1, rank))]) * weights[:, None]).astype(np.float32))

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_heap()
        z = np.zeros((size + 1, rank))
        for ids in _blocks(batches):
            y = _sums(first.value, ids, 2 * SEGMENT)
            of = np.minimum(ids, size)
            order = np.argsort(of.astype(np.uint16) if size < 65535 else of, kind="stable")
            of = of[order]
            heads = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            z[of[heads]] += np.add.reduceat(np.take(y, order // (2 * SEGMENT), axis=0), heads, axis=0)
        yield array_rows(z[:size], SPAN)

    z = array_sum(stored.select("features").mapInArrow(back, numbers), size * rank, SPAN, "float64").reshape(size, rank) * idf[:, None]
    # Items are rare among the passages, so that the largest directions alone hardly tell them apart.
    items = _mixtures(bench, idf)
    basis = np.linalg.qr(np.hstack([z, items.T / np.maximum(np.linalg.norm(items, axis=1), 1e-12)]))[0]
    rank = basis.shape[1]
    second = spark.sparkContext.broadcast((np.vstack([basis, np.zeros((1, rank))]) * weights[:, None]).astype(np.float32))

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_heap()
        g = np.zeros((rank, rank))
        for ids in _blocks(batches):
            y = _sums(second.value, ids, 2 * SEGMENT)
            g += y.T @ y
        yield array_rows(g, SPAN)

    g = array_sum(stored.select("features").mapInArrow(gram, numbers), rank * rank, SPAN, "float64").reshape(rank, rank)
    values, vectors = np.linalg.eigh(g)
    keep = np.argsort(values)[::-1]
    keep = keep[values[keep] > max(values[keep[0]], 1e-12) * 1e-9]
    axes = basis @ vectors[:, keep] / np.sqrt(np.maximum(values[keep], 1e-12))
    search = spark.sparkContext.broadcast(Search(bench, idf, axes))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, x in zip(batch.column("doc_id").to_pylist(), batch.column("features").to_pylist(), strict=True):
                ids = np.frombuffer(x, np.uint32)
                if len(ids):
                    for item, starts in search.value.near(ids).items():
                        if found := search.value.checked(ids, item, starts):
                            out.append((doc_id, search.value.bench.ids[item], *found))
            types = [pa.int64()] * 4 + [pa.float64()] * 3
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], ["doc_id", "item_id", "first_word", "end_word", "common", "weight", "answer"])

    tidy(spark)
    return stored.mapInArrow(find, schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without those into which an item leaks. Rows without doc_id stay."""
    gone = leaks(docs.where("doc_id is not null"), benchmark).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
