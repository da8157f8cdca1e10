"""Token ids in binary shards, with a minimal perfect hash index from document keys to places.

Files of a store, all numbers little-endian:
- `shard-N.ids`: the ids of the shard's documents one after the other (two bytes each for vocabularies up to 65536,
  else four), then an int64 offset in ids for each document and one for the end, then int64 counts of documents and
  bytes per id. Documents stand in ascending doc_id, over all shards; null first; ties by text.
- `index-B.mph`: for the keys that hash to bucket B: levels of a bit array each with counts of the bits before every
  block, which give every key its own number below the count of keys; and at that number a 32-bit fingerprint of the
  key, the shard, the first document's place in the shard, and how many documents with that key follow each other there.
- `null.key`: the same of documents without a key, if there are any.

A key costs a few reads of some bytes each at places that are computed, and one of its raw ids, however large the store
is: `get` reads no file whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, n_partitions, shared_dir, slices, stored
from .tokens import word_ids

#: Bits of a level for each key that is left; keys of an index bucket, about; id after each document.
GAMMA, BUCKET, END = 2, 200_000, 2
#: Bits of a block whose bits are counted by reading it.
BLOCK = 512
_SEEDS = mix(np.arange(1, 101, dtype=np.uint64) * np.uint64(0x8EBC6AF09C88C6E3))
_SLOT = np.dtype([("fingerprint", "<u4"), ("shard", "<u4"), ("first", "<u4"), ("count", "<u4")])


# ---- files ---------------------------------------------------------------------------------------


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, parts: Iterator[bytes]) -> None:
    """Written under another name first: a task that is tried again never leaves half a file."""
    fs, path = _open(uri)
    c = TaskContext.get()
    other = f"{path}.{c.taskAttemptId() if c else 0}.tmp"
    with fs.open_output_stream(other) as f:
        for x in parts:
            f.write(x)
    fs.move(other, path)


def read_file(uri: str) -> bytes:
    fs, path = _open(uri)
    with fs.open_input_stream(path) as f:
        return f.read()


# ---- minimal perfect hash ------------------------------------------------------------------------


def keys_of(ids: list) -> np.ndarray:
    return np.array([i & 0xFFFFFFFFFFFFFFFF for i in ids], np.uint64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ _SEEDS[-1]) >> np.uint64(32)).astype(np.uint32)


def build_levels(keys: np.ndarray) -> list[np.ndarray]:
    """Bit arrays: a key is at the first level where its bit is set; of those that collide the next level decides."""
    levels, left = [], keys
    while len(left):
        h = (mix(left ^ _SEEDS[len(levels)]) % np.uint64(max(64, GAMMA * len(left)))).astype(np.int64)
        alone = np.bincount(h, minlength=max(64, GAMMA * len(left))) == 1
        levels.append(alone)
        left = left[~alone[h]]
    return levels


class Levels:
    def __init__(self, levels: list[np.ndarray]):
        self.levels, base, self.ranks = levels, 0, []
        for x in levels:
            self.ranks.append(base + np.cumsum(x) - x)
            base += int(x.sum())

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 where no level has its bit (never for a key that was built in)."""
        out = np.full(len(keys), -1, np.int64)
        for k, x in enumerate(self.levels):
            left = np.flatnonzero(out < 0)
            if not len(left):
                break
            h = (mix(keys[left] ^ _SEEDS[k]) % np.uint64(len(x))).astype(np.int64)
            out[left] = np.where(x[h], self.ranks[k][h], -1)
        return out


def index_bytes(keys: np.ndarray, shard: np.ndarray, first: np.ndarray, count: np.ndarray) -> bytes:
    levels = build_levels(keys)
    slots = np.zeros(len(keys), _SLOT)
    at = Levels(levels)(keys)
    slots["fingerprint"][at], slots["shard"][at], slots["first"][at], slots["count"][at] = fingerprints(keys), shard, first, count
    head = np.array([len(keys), len(levels), *map(len, levels)], "<i8").tobytes()
    bits, before, n = [], [], 0
    for x in levels:
        whole = np.append(x, np.zeros(-len(x) % BLOCK, bool))
        of = whole.reshape(-1, BLOCK).sum(axis=1)
        bits.append(np.packbits(whole).tobytes())
        before.append(n + np.cumsum(of) - of)
        n += int(of.sum())
    return head + b"".join(bits) + np.concatenate([*before, np.empty(0, np.int64)]).astype("<u4").tobytes() + slots.tobytes()


class Index:
    """A bucket's index, read whole: for many keys."""

    def __init__(self, data: bytes):
        n, k = np.frombuffer(data, "<i8", 2)
        sizes = np.frombuffer(data, "<i8", int(k), 16)
        at, levels, blocks = 16 + 8 * int(k), [], 0
        for s in sizes.tolist():
            whole = -(-s // BLOCK) * BLOCK // 8
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, whole, at), count=s).astype(bool))
            at += whole
            blocks += whole * 8 // BLOCK
        self.levels, self.slots = Levels(levels), np.frombuffer(data, _SLOT, int(n), at + 4 * blocks)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the keys, and which of them are in the index, as their fingerprint tells (an error in 2 ** 32)."""
        at = self.levels(keys)
        found = at >= 0
        slots = self.slots[np.where(found, at, 0)] if len(self.slots) else np.zeros(len(keys), _SLOT)
        return slots, found & (slots["fingerprint"] == fingerprints(keys))


def slot_of(uri: str, key: np.ndarray) -> np.ndarray | None:
    """The slot of one key (an array of one), from the few bytes of the index that tell it."""
    fs, path = _open(uri)
    with fs.open_input_file(path) as f:
        n, k = np.frombuffer(f.read_at(16, 0), "<i8").tolist()
        sizes = np.frombuffer(f.read_at(8 * k, 16), "<i8").tolist()
        blocks = [-(-s // BLOCK) for s in sizes]
        bits, counts = 16 + 8 * k, 16 + 8 * k + sum(blocks) * BLOCK // 8
        done = 0
        for level, (s, of) in enumerate(zip(sizes, blocks, strict=True)):
            place = int(mix(key ^ _SEEDS[level])[0] % np.uint64(s))
            block, inside = divmod(place, BLOCK)
            own = np.unpackbits(np.frombuffer(f.read_at(BLOCK // 8, bits + (done + block) * BLOCK // 8), np.uint8))
            if own[inside]:
                before = int(np.frombuffer(f.read_at(4, counts + 4 * (done + block)), "<u4")[0])
                slot = np.frombuffer(f.read_at(_SLOT.itemsize, counts + 4 * sum(blocks) + _SLOT.itemsize * (before + int(own[:inside].sum()))), _SLOT)
                return slot if slot["fingerprint"][0] == fingerprints(key)[0] else None
            done += of
    return None


class Shard:
    """Documents of one shard; reads only what is asked for."""

    def __init__(self, uri: str):
        fs, path = _open(uri)
        self.f = fs.open_input_file(path)
        size = self.f.size()
        self.n, self.width = np.frombuffer(self.f.read_at(16, size - 16), "<i8").tolist()
        self.offsets = size - 16 - 8 * (self.n + 1)

    def bounds(self, k: int, count: int = 1) -> list[int]:
        """Where documents k, k + 1 ... begin, and where the last of `count` ends."""
        return np.frombuffer(self.f.read_at(8 * (count + 1), self.offsets + 8 * k), "<i8").tolist()

    def every_bound(self) -> list[int]:
        return self.bounds(0, self.n)

    def ids(self, a: int, b: int) -> np.ndarray:
        return np.frombuffer(self.f.read_at((b - a) * self.width, a * self.width), f"<u{self.width}")


# ---- the store -----------------------------------------------------------------------------------


class TokenStore:
    """A written store: where it is, its buckets, how many ids lie before each shard, and the slots of documents without a key."""

    def __init__(self, spark: SparkSession, at: str, buckets: int, before: dict[int, int], nulls: np.ndarray):
        self.spark, self.at, self.buckets, self.before, self.nulls = spark, at, buckets, before, nulls

    def shard(self, n: int) -> str:
        return f"{self.at}/shard-{n}.ids"

    def bucket_of(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) % np.uint64(self.buckets)).astype(np.int64)

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of each document with that key, from the files alone; none if there is no such key."""
        if doc_id is None:
            fs, path = _open(f"{self.at}/null.key")
            slots = np.frombuffer(read_file(f"{self.at}/null.key"), _SLOT) if fs.get_file_info(path).type != pafs.FileType.NotFound else []
        else:
            key = keys_of([doc_id])
            slot = slot_of(f"{self.at}/index-{int(self.bucket_of(key)[0])}.mph", key)
            slots = [] if slot is None else slot
        out = []
        for s in slots:
            shard = Shard(self.shard(int(s["shard"])))
            at = shard.bounds(int(s["first"]), int(s["count"]))
            out += [shard.ids(a, b) for a, b in zip(at, at[1:])]
        return out

    def placed(self, keys: DataFrame) -> DataFrame:
        """doc_id, shard, first, count of the keys (a column doc_id, without repeats) that the index has."""
        at, buckets = self.at, self.buckets

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, index = None, None
            for batch in batches:
                of, ids = np.array(batch.column("bucket").to_pylist(), np.int64), batch.column("doc_id")
                for b in np.unique(of).tolist():
                    own = np.flatnonzero(of == b)
                    if b != last:
                        last, index = b, Index(read_file(f"{at}/index-{b}.mph"))
                    asked = ids.take(pa.array(own))
                    slots, found = index(keys_of(asked.to_pylist()))
                    yield pa.RecordBatch.from_arrays([asked, *(pa.array(slots[c].astype(np.int64)) for c in ("shard", "first", "count"))], ["doc_id", "shard", "first", "count"]).filter(pa.array(found))

        schema = "doc_id long, shard long, first long, count long"
        found = _with_bucket(keys.where("doc_id is not null").select("doc_id"), buckets).sortWithinPartitions("bucket").mapInArrow(look_up, schema)
        none = keys.where("doc_id is null")
        for s in self.nulls:
            found = found.unionByName(none.select("doc_id", *(F.lit(int(s[c])).cast("long").alias(c) for c in ("shard", "first", "count"))))
        return found

    def read(self, keys: DataFrame) -> DataFrame:
        """doc_id, start, n_tokens, ids_crc32 and ids of each document of the keys, from the files: through the index to its shard."""
        at, before = self.at, self.before

        def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, shard, at_ids = None, None, []
            for batch in batches:
                out: list[list] = [[], [], [], [], []]
                for doc_id, s, first, count in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "shard", "first", "count")), strict=True):
                    if s != last:
                        last, shard = s, Shard(f"{at}/shard-{s}.ids")
                        at_ids = shard.every_bound()
                    for k in range(first, first + count):
                        ids = shard.ids(at_ids[k], at_ids[k + 1])
                        for col, x in zip(out, (doc_id, before[s] + at_ids[k], len(ids), zlib.crc32(ids.astype("<u4").tobytes()), ids.tobytes()), strict=True):
                            col.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (*[pa.int64()] * 4, pa.binary()), strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

        dealt = self.placed(keys).repartition(n_partitions(self.spark), "shard").sortWithinPartitions("shard", "first")
        return dealt.mapInArrow(load, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def _with_bucket(keys: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = keys_of(batch.column("doc_id").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((mix(k) % np.uint64(buckets)).astype(np.int64))], [*batch.schema.names, "bucket"])

    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in keys.schema.fields)}, bucket long"
    return keys.mapInArrow(run, schema).repartition(max(1, min(buckets, 4 * n_partitions(keys.sparkSession))), "bucket")


def write_store(docs: DataFrame, tokenizer: str, end: int = END) -> TokenStore:
    """Encodes the whole texts of `docs` with the tokenizer file of that path and writes a store in the shared folder.

    Null text: empty, which is the end id alone. Null doc_id: a key of its own. Repeated doc_ids: next to each other
    under one key. An empty table: no shards. Other columns are ignored. Of each shard the driver gets its number and
    its count of ids.
    """
    spark = docs.sparkSession
    at = shared_dir(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n = word_ids(tokenizer), TaskContext.get().partitionId()
        ids, offsets = [], [np.zeros(1, np.int64)]

        def payload() -> Iterator[bytes]:
            for part in (x for b in batches for x in slices(b, "text", 1 << 18)):
                ids.extend(part.column("doc_id").to_pylist())
                own, sizes = words.texts(part.column("text").to_pylist())
                ends = np.cumsum(sizes)
                offsets.append(offsets[-1][-1] + ends + np.arange(1, len(ends) + 1))
                yield np.insert(own, ends, end).tobytes()
            yield np.concatenate(offsets).astype("<i8").tobytes()
            yield np.array([len(ids), np.dtype(words.dtype).itemsize], "<i8").tobytes()

        parts = payload()
        if (head := next(parts, None)) is not None and ids:
            write_file(f"{at}/shard-{n}.ids", (x for y in ([head], parts) for x in y))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([n] * len(ids), pa.int32()), pa.array(range(len(ids)), pa.int64()), pa.array(np.diff(np.concatenate(offsets)), pa.int64())], ["doc_id", "shard", "place", "n"])

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    _open(at)[0].create_dir(_open(at)[1], recursive=True)
    dealt = rows.repartitionByRange(n_partitions(spark), F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    manifest = stored(dealt.mapInArrow(write, "doc_id long, shard int, place long, n long"), f"{at}/manifest")
    before, total, n_docs = {}, 0, 0
    for shard, n, rows_ in manifest.groupBy("shard").agg(F.sum("n"), F.count("*")).orderBy("shard").collect():
        before[shard], total, n_docs = total, total + n, n_docs + rows_
    buckets = max(1, -(-n_docs // BUCKET))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, list] = {}
        for batch in batches:
            of = np.array(batch.column("bucket").to_pylist(), np.int64)
            for b in np.unique(of).tolist():
                own.setdefault(b, []).append(batch.filter(pa.array(of == b)))
        for b, parts in own.items():
            t = pa.Table.from_batches(parts)
            write_file(f"{at}/index-{b}.mph", iter([index_bytes(keys_of(t["doc_id"].to_pylist()), *(t[c].to_numpy() for c in ("shard", "first", "count")))]))
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int64())], ["bucket"])

    keys = manifest.groupBy("doc_id", "shard").agg(F.min("place").alias("first"), F.count("*").alias("count"))
    nulls = np.array([(0, r["shard"], r["first"], r["count"]) for r in keys.where("doc_id is null").collect()], _SLOT)  # one at most: all nulls lie in one shard
    if len(nulls):
        write_file(f"{at}/null.key", iter([nulls.tobytes()]))
    _with_bucket(keys.where("doc_id is not null"), buckets).mapInArrow(index, "bucket long").count()
    return TokenStore(spark, at, buckets, before, nulls)
