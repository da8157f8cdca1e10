"""A causal self-attention language model in numpy, over subword ids.

Every subword that training has seen has a source row (key and value) and a target row (query and residual); one
attention layer over a window of LENGTH positions, masked to what stands before, gives a state h for each position. The
next subword v follows with probability

    q(v) ((1 - FLOOR) (u_v . h)^2 / Z + FLOOR),   Z = h' G h,   G = sum of q(v) u_v u_v' over the whole vocabulary

where q are the smoothed counts of all training texts: the spherical kin of a softmax, whose sum over all subwords is
one small matrix, so that nothing is sampled, grouped or left out. Attention weights are squares of q . k plus a number
for the distance, over their sum, for the same reason: there is no exponential in the hot path.

Counts cover all training texts, and so do the windows that the model is fitted to, in parallel: texts are dealt into
shares, rounds take a part of the shares each, every share goes on from the common weights over all its windows, and the
results are averaged by windows. Scoring uses windows of LENGTH positions that overlap by half, of which the last STRIDE
are scored: every token once, with at least LENGTH - STRIDE before it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import array_rows, array_sum, bytes_hashes, keep_heap, shared_dir, slices, stored, tidy
from .tokens import word_ids

#: Positions of a window, of which scoring takes the last STRIDE; width of keys; width of values, states and outputs.
LENGTH, STRIDE, KEYS, WIDTH = 32, 16, 8, 24
#: Share of q alone in a probability; added to each subword's count.
FLOOR, ADDED = 2e-3, 0.5
#: Windows of a step; first step size; tokens of a share, about; parts of the shares, one a round.
BATCH, STEP, SHARE, ROUNDS = 128, 0.3, 4_000_000, 4
#: Tables with fewer training tokens are gone through again until so many have been read, at most PASSES times.
FITTED, PASSES = 8_000_000, 8
#: Words whose counts each task holds; others are joined. Windows whose order is mixed at a time.
KNOWN, MIXED = 500_000, 2048
SPAN = 1 << 15


def held_out(doc_id: int | None) -> bool:
    """Whether crc32 of the id as text leaves remainder 2 by 7; no id: held out."""
    return doc_id is None or crc32(str(doc_id).encode()) % 7 == 2


# ---- the model -----------------------------------------------------------------------------------

#: Columns of a row of the weights: key, value, one, then query, residual.
SOURCE, TARGET = KEYS + WIDTH + 1, KEYS + WIDTH
_FAR = np.abs(np.arange(LENGTH)[:, None] - np.arange(LENGTH)[None, :])
_BEFORE = np.tril(np.ones((LENGTH, LENGTH), np.float32))


class Vocabulary:
    """Which subword is which symbol: those that training has seen, the end of a text, and one symbol for all others."""

    def __init__(self, counts: np.ndarray, ends: int):
        """counts: of each subword; ends: how many training texts."""
        seen = np.flatnonzero(counts)
        self.n = len(seen) + 2
        self.end, self.unseen = len(seen), len(seen) + 1
        self.symbol = np.full(len(counts) + 1, self.unseen, np.int64)
        self.symbol[seen], self.symbol[-1] = np.arange(len(seen)), self.end  # an id of -1 is the end
        q = np.append(counts, ends) + ADDED
        self.log_q = np.log(q / q.sum())  # of each subword, the end last
        q = np.exp(self.log_q)
        rest = q[:-1][counts == 0].sum()
        self.q = np.concatenate([q[seen], q[-1:], [rest]]).astype(np.float32)


def size_of(n: int) -> int:
    return n * (SOURCE + TARGET + WIDTH) + LENGTH


def unpack(flat: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the symbols, their outputs u, and the numbers for distances."""
    a, b = n * (SOURCE + TARGET), n * (SOURCE + TARGET + WIDTH)
    return flat[:a].reshape(n, -1), flat[a:b].reshape(n, WIDTH), flat[b:]


def started(n: int, seed: int = 7) -> np.ndarray:
    """Small random weights around a state and outputs that predict by q alone."""
    rng = np.random.default_rng(seed)
    flat = np.zeros(size_of(n), np.float32)
    rows, u, near = unpack(flat, n)
    rows[:] = 0.3 * rng.standard_normal(rows.shape)
    rows[:, KEYS : SOURCE - 1] /= 3
    rows[:, SOURCE - 1] = 1
    rows[:, SOURCE + KEYS] = 1
    u[:] = 0.3 * rng.standard_normal(u.shape)
    u[:, 0] = 1
    near[:] = 1 + 0.5 / (1 + np.arange(LENGTH))
    return flat


def gram(u: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (u * q[:, None]).T @ u


def attended(source: np.ndarray, target: np.ndarray, near: np.ndarray):
    """States of the last positions of each window, as many as `target` has; and what the gradient needs."""
    n = target.shape[1]
    k, v, q, r = source[..., :KEYS], source[..., KEYS:], target[..., :KEYS], target[..., KEYS:]
    s = np.matmul(q, k.transpose(0, 2, 1))
    s += near[_FAR[-n:]]
    s *= _BEFORE[-n:]
    w = s * s
    o = np.matmul(w, v)
    total = o[..., -1:] + np.float32(1e-6)
    o = o[..., :-1] / total
    return r + o, (k, v, q, s, w, o, total)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a, b)


def log_probabilities(rows: np.ndarray, u: np.ndarray, near: np.ndarray, g: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Natural logs of p / q for the next symbols y (windows x STRIDE) after the last positions of x (windows x LENGTH)."""
    h, _ = attended(rows[:, :SOURCE].take(x, axis=0), rows[:, SOURCE:].take(x[:, -STRIDE:], axis=0), near)
    h = h.reshape(-1, WIDTH)
    z = _dot(h @ g, h)
    r = _dot(u.take(y.ravel(), axis=0), h)
    return np.log((1 - FLOOR) * r * r / np.maximum(z, 1e-20) + FLOOR).reshape(y.shape)


def _by_symbol(x: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of g with equal x."""
    order = np.argsort(x.astype(np.uint16) if x.max() < 1 << 16 else x, kind="stable")
    x = x[order]
    heads = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
    return x[heads], np.add.reduceat(g[order], heads, axis=0)


def gradient(rows, u, near, q, x, y, use):
    """Mean loss over the positions of `use`; touched symbols and their rows' gradient; the outputs' and the distances' one."""
    t = rows.take(x, axis=0)
    source, target = t[..., :SOURCE], t[..., SOURCE:]
    h, (k, v, query, s, w, o, total) = attended(source, target, near)
    states, g = h.reshape(-1, WIDTH), gram(u, q)
    hg = states @ g
    z = np.maximum(_dot(hg, states), 1e-20)
    out = u.take(y.ravel(), axis=0)
    r = _dot(out, states)
    m = r * r / z
    f = (1 - FLOOR) * m + FLOOR
    on = use.ravel().astype(np.float32)
    n = max(float(on.sum()), 1.0)
    dm = on * (-(1 - FLOOR) / n) / f
    dr, dz = (2 * dm * r / z)[:, None], (-dm * m / z)[:, None]
    dh = dr * out
    dh += (2 * dz) * hg
    du = (2 * q[:, None]) * (u @ (states.T @ (dz * states)))
    own, sums = _by_symbol(y.ravel(), dr * states)
    du[own] += sums
    dh = dh.reshape(h.shape)
    dt = np.empty_like(t)
    dt[..., SOURCE + KEYS :] = dh
    do = np.empty_like(v)
    np.divide(dh, total, out=do[..., :-1])
    do[..., -1] = -np.einsum("ijk,ijk->ij", do[..., :-1], o)
    ds = np.matmul(do, v.transpose(0, 2, 1))
    ds *= s
    ds *= 2
    dt[..., KEYS:SOURCE] = np.matmul(w.transpose(0, 2, 1), do)
    dt[..., SOURCE - 1] = 0
    dt[..., SOURCE : SOURCE + KEYS] = np.matmul(ds, k)
    dt[..., :KEYS] = np.matmul(ds.transpose(0, 2, 1), query)
    far = np.bincount(_FAR.ravel(), weights=ds.sum(axis=0).ravel(), minlength=LENGTH).astype(np.float32)
    touched, drows = _by_symbol(x.ravel(), dt.reshape(len(x) * x.shape[1], -1))
    return -float((np.log(f) * on).sum()) / n, touched, drows, du, far


class Fit:
    """Weights that go on by Adagrad; the sums of squares go along with them."""

    def __init__(self, flat: np.ndarray, squares: np.ndarray, q: np.ndarray):
        self.flat, self.squares, self.q = flat.copy(), squares.copy(), q
        self.now, self.past = unpack(self.flat, len(q)), unpack(self.squares, len(q))

    def step(self, x: np.ndarray, y: np.ndarray, use: np.ndarray, rate: float) -> float:
        loss, touched, drows, du, far = gradient(*self.now, self.q, x, y, use)
        past = self.past[0][touched] + drows * drows
        self.past[0][touched] = past
        self.now[0][touched] -= rate * drows / (np.sqrt(past) + 1e-8)
        for w, p, d in zip(self.now[1:], self.past[1:], (du, far), strict=True):
            p += d * d
            w -= rate * d / (np.sqrt(p) + 1e-8)
        return loss


def windows_of(symbols: np.ndarray, stride: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of LENGTH + 1 symbols of a text that ends with `end`, and which of the last `stride` are the text's.

    Before the text stand ends, so that its first token has LENGTH - STRIDE of them before it, or one if all positions count.
    """
    n, before = len(symbols), LENGTH - STRIDE + 1
    length = max(n + before, LENGTH + 1)
    blocks = -(-(length - LENGTH - 1) // stride) + 1
    padded = np.full((blocks - 1) * stride + LENGTH + 1, end, symbols.dtype)
    padded[before : before + n] = symbols
    view = np.lib.stride_tricks.sliding_window_view(padded, LENGTH + 1)[::stride]
    real = np.zeros(len(padded), bool)
    real[before : before + n] = True
    return view, np.lib.stride_tricks.sliding_window_view(real, LENGTH + 1)[::stride, -stride:]


# ---- over a table --------------------------------------------------------------------------------


def scores(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row for each row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows that are not held out. Words: between ASCII white space, A-Z in lower case, then one end.
    base_score: their log10 probabilities by counts plus one; score: the log10 probability, by the model, of the
    text's subwords and its end. Null or empty text: the end alone. Null doc_id: held out. Repeated rows: counted and
    scored each; copies of one row with one id are fitted to by one task. Very long texts: whole. A table without
    training rows: counts are none and the model is even. An empty table: no rows.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    base = shared_dir(spark)
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kinds = pa.schema([("hash", pa.int64()), ("n", pa.int64()), ("part", pa.int32()), ("numbers", pa.binary()), ("doc_id", pa.int64()), ("text", pa.binary()), ("ids", pa.binary())])

    def filled(k: int, **own: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([own.get(f.name, pa.nulls(k, f.type)) for f in kinds], schema=kinds)

    # Every text with its subwords; and what is counted over the training texts: words by hash, subwords.
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_heap()
        words, n_docs = word_ids(tokenizer), 0
        sub, counts = np.zeros(words.size, np.int64), np.zeros(0, np.int64)

        def counted() -> pa.RecordBatch:
            of = np.flatnonzero(counts)
            return filled(len(of), hash=pa.array(words.hashes()[of].view(np.int64)), n=pa.array(counts[of]))

        for batch in batches:
            for part in slices(batch, "text"):
                if words.full():
                    yield counted()
                    words.anew()
                    counts = np.zeros(0, np.int64)
                doc_ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
                own = [t.lower().split() if t else [] for t in texts]
                ends = np.cumsum([len(w) for w in own])
                numbers = words.numbers([w for x in own for w in x])
                ids, n = words.ids_of(numbers)
                at = np.append(0, np.cumsum(n))[np.append(0, ends)].tolist()
                train = [not held_out(i) for i in doc_ids]
                n_docs += sum(train)
                used = np.repeat(train, np.diff(ends, prepend=0))
                more = np.bincount(numbers[used], minlength=len(counts))
                more[: len(counts)] += counts
                counts = more
                sub += np.bincount(ids[np.repeat(used, n)], minlength=words.size)
                yield filled(part.num_rows, doc_id=part.column("doc_id"), text=part.column("text"), ids=pa.array([ids[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)], pa.binary()))
        if counts.any():
            yield counted()
        numbers = array_rows(np.append(sub, n_docs), SPAN)
        yield filled(len(numbers), part=numbers.column("part"), numbers=numbers.column("numbers"))

    gathered = stored(rows.mapInArrow(gather, "hash long, n long, part int, numbers binary, doc_id long, text binary, ids binary"), f"{base}/gathered")
    size, dtype = word_ids(tokenizer).size, word_ids(tokenizer).dtype
    sub = array_sum(gathered.where("part is not null").select("part", "numbers"), size + 1, SPAN, "int64")
    sub, n_docs = sub[:-1], int(sub[-1])
    counts = stored(gathered.where("hash is not null").groupBy("hash").agg(F.sum("n").alias("c")), f"{base}/counts")
    n_words, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n_train, v_train = n_words + n_docs, distinct + (n_docs > 0)
    tidy(spark)

    vocabulary = Vocabulary(sub, n_docs)
    n_tokens = int(sub.sum()) + n_docs
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2
    flat = fitted(gathered.where(F.col("ids").isNotNull() & F.col("doc_id").isNotNull() & ~out).select("doc_id", "ids"), vocabulary, n_tokens, dtype)

    # Scores of whole texts; counts of words that not every task holds come by a join.
    steps = counts.groupBy(F.floor(F.log2("c") * 16).alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect()
    held, least = 0, None
    for x in steps:
        if (held := held + x["n"]) > KNOWN:
            break
        least = x["step"]
    top = counts.where(F.floor(F.log2("c") * 16) >= (least if least is not None else 1 << 20)).toPandas().sort_values("hash")
    whole = distinct <= len(top)
    known = sc.broadcast((top["hash"].to_numpy(np.int64), top["c"].to_numpy(np.int64), flat, vocabulary))

    def log_base(c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (n_train + v_train + 1))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_heap()
        hashes, numbers, flat, words = known.value
        weights, key = unpack(flat, words.n), TaskContext.get().partitionId() << 40
        g = gram(weights[1], words.q)
        schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("hash", pa.int64())])
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                texts = [t.lower() if t else b"" for t in part.column("text").to_pylist()]
                own = [bytes_hashes(t).view(np.int64) for t in texts]
                ends = np.cumsum([len(x) for x in own])
                h = np.concatenate(own)
                at = np.minimum(np.searchsorted(hashes, h), max(0, len(hashes) - 1))
                near = hashes[at] == h if len(hashes) else np.zeros(len(h), bool)
                each = log_base(np.where(near, numbers[at], 0) if len(hashes) else np.zeros(len(h)))
                if not whole:
                    each[~near] = 0
                before = lambda x, ends=ends: np.diff(np.append(0, np.cumsum(x))[np.append(0, ends)])
                keys = key + np.arange(len(texts))
                key += len(texts)
                model = scored([np.frombuffer(x, dtype) for x in part.column("ids").to_pylist()], weights, g, words)
                yield pa.RecordBatch.from_arrays([
                    pa.array(keys), part.column("doc_id"), pa.array(np.diff(ends, prepend=0) + 1), pa.array(before(near).astype(np.int64) + (n_docs > 0)),
                    pa.array(before(each) + log_base(np.array(n_docs))), pa.array(model / np.log(10)), pa.nulls(len(texts), pa.int64()),
                ], schema=schema)
                if not whole and not near.all():
                    k = int((~near).sum())
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(keys, np.diff(ends, prepend=0))[~near]), *(pa.nulls(k, t) for t in schema.types[1:6]), pa.array(h[~near])], schema=schema)

    texts = gathered.where("ids is not null").select("doc_id", "text", "ids")
    found = stored(texts.mapInArrow(score, "key long, doc_id long, n_tokens long, n_known long, base double, score double, hash long"), f"{base}/scored")
    tidy(spark)
    more = found.where("hash is not null").groupBy("key", "hash").agg(F.count("*").alias("m")).join(counts, "hash", "left")
    more = more.groupBy("key").agg(F.sum(F.when(F.col("c").isNotNull(), F.col("m"))).alias("k"), F.sum(F.col("m") * F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(n_train + v_train + 1)))).alias("b"))
    own = found.where("n_tokens is not null").join(more, "key", "left")
    return own.select(
        "doc_id", F.coalesce(out, F.lit(True)).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("b", F.lit(0.0))).alias("base_score"), "score",
    )


def fitted(texts: DataFrame, words: Vocabulary, n_tokens: int, dtype: str) -> np.ndarray:
    """Weights fitted to all windows of the texts (doc_id, ids)."""
    sc = texts.sparkSession.sparkContext
    state = np.concatenate([started(words.n), np.full(size_of(words.n), 1e-6, np.float32)])
    if not n_tokens:
        return state[: size_of(words.n)]
    shares = max(1, round(n_tokens / SHARE))
    rounds = min(ROUNDS, shares)
    passes = min(PASSES, max(1, -(-FITTED // n_tokens)))
    each = n_tokens * passes / shares  # tokens of a share
    size = size_of(words.n)
    # Dealt and ordered by what the rows hold, so that files and partitions make no difference.
    place = F.xxhash64("doc_id", "ids")
    texts = texts.select("ids", place.alias("place"), F.pmod(place, F.lit(shares)).alias("share"))
    for round_ in range(rounds):
        now = sc.broadcast((state, words))

        def fit(batches: Iterator[pa.RecordBatch], now=now, round_=round_) -> Iterator[pa.RecordBatch]:
            keep_heap()
            state, words = now.value

            def shared() -> Iterator[tuple[int, list[np.ndarray]]]:
                for batch in batches:
                    for part in slices(batch, "ids", 1 << 18):
                        of = part.column("share").to_pylist()
                        ids = [np.frombuffer(t, dtype) for t in part.column("ids").to_pylist()]
                        for share, own in groupby(range(len(of)), of.__getitem__):
                            yield share, [ids[k] for k in own]

            for _, blocks in groupby(shared(), lambda x: x[0]):
                blocks = (x for _, x in blocks)
                model, windows = Fit(state[:size], state[size:], words.q), 0
                if passes > 1:  # fewer than FITTED tokens in all
                    blocks = list(blocks) * passes
                done = 0
                for x, use in _mixed(blocks, words, round_):
                    rate = STEP * (1 - 0.9 * (round_ + min(1.0, done / each)) / rounds)
                    model.step(x[:, :-1], x[:, 1:], use, rate)
                    done += int(use.sum())
                    windows += len(x)
                yield array_rows(np.append(np.concatenate([model.flat, model.squares]) * np.float32(windows), np.float32(windows)), SPAN)

        n = max(1, -(-(shares - round_) // rounds))
        dealt = texts.where(F.col("share") % rounds == round_).repartition(4 * n, "share").sortWithinPartitions("share", "place")
        total = array_sum(dealt.select("share", "ids").mapInArrow(fit, "part int, numbers binary"), 2 * size + 1, SPAN, "float32", "float64")
        if total[-1]:
            state = (total[:-1] / total[-1]).astype(np.float32)
        tidy(texts.sparkSession)
    return state[:size]


def _mixed(blocks: Iterator[list[np.ndarray]], words: Vocabulary, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows for one step after the other, in random order among MIXED or more."""
    rng, own = np.random.default_rng(seed), []

    def steps() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        x, use = np.concatenate([x for x, _ in own]), np.concatenate([u for _, u in own])
        order = rng.permutation(len(x))
        for a in range(0, len(x), BATCH):
            yield x[order[a : a + BATCH]], use[order[a : a + BATCH]]

    for texts in blocks:
        own += [windows_of(words.symbol[np.append(ids.astype(np.int64), -1)].astype(np.int32), LENGTH, words.end) for ids in texts]
        if sum(len(x) for x, _ in own) >= MIXED:
            yield from steps()
            own = []
    if own:
        yield from steps()


def scored(texts: list[np.ndarray], weights: tuple, g: np.ndarray, words: Vocabulary) -> np.ndarray:
    """Natural log probability of each text (ids) and its end."""
    out, group, n = np.zeros(len(texts)), [], 0

    def done() -> None:
        views = [windows_of(words.symbol[x].astype(np.int32), STRIDE, words.end) for _, x in group]
        x, use = np.concatenate([v for v, _ in views]), np.concatenate([u for _, u in views])
        p = np.concatenate([log_probabilities(*weights, g, x[a : a + 256, :-1], x[a : a + 256, -STRIDE:]) for a in range(0, len(x), 256)])
        each = (p * use).sum(axis=1, dtype=np.float64)
        sums = np.add.reduceat(each, np.cumsum([0, *(len(v) for v, _ in views[:-1])]))
        for (k, ids), s in zip(group, sums.tolist(), strict=True):
            out[k] = s + words.log_q[ids].sum()

    for k, ids in enumerate(texts):
        group.append((k, np.append(ids.astype(np.int64), -1)))
        n += len(ids)
        if n > 1 << 16:
            done()
            group, n = [], 0
    if group:
        done()
    return out
