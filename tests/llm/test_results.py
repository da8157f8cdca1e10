"""Operators and registered queries against plain Python on the smallest tables and on planted rows."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lectern.llm import attention_lm, decontaminate, language, ngram_join, packing, passages, queries, token_store, url_rules
from lectern.llm.common import components, table

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables here")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in table(spark, DIR, "documents").select("doc_id", "text").collect()}


def words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def grams(text, n):
    w = words(text)
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def linked(sets, at_least):
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    held = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for g in sets[i] for j in held[g])
        for j, n in shared.items():
            if 100 * n >= at_least * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
        for g in sets[i]:
            held[g].append(i)
    return {i: find(i) for i in sets}


def near_copies(seed=3, groups=12, size=9):
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{rng.randrange(400 if g % 2 else 9000)}" for _ in range(rng.choice([6, 12, 40, 150]))]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(5)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            out.append(" ".join(w))
    rng.shuffle(out)
    return dict(enumerate(out))


def test_ngram_join_is_exact(spark, texts):
    own = texts | {100_000 + i: t for i, t in near_copies().items()}
    df = spark.createDataFrame(list(own.items()), "doc_id long, text string")
    sets = {i: grams(t, 4) for i, t in own.items()}
    want = linked(sets, 85)
    got = ngram_join.similar_documents(df).collect()
    assert len(got) == len(own) and all(r["n_shingles"] == len(sets[r["doc_id"]]) and r["component_id"] == want[r["doc_id"]] for r in got)


def test_entries_meet():
    """Any two sets that are similar enough share an entry, whatever is frequent, and pass both bounds."""
    rng = np.random.default_rng(5)
    for trial in range(300):
        levels = np.where(rng.random(1 << 16) < rng.choice([0.0, 0.5, 1.0]), 9, 0).astype(np.uint8)
        levels = np.resize(levels, ngram_join.COUNTERS)
        n = int(rng.integers(1, 120))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.append(a[rng.random(len(a)) > 0.08], rng.integers(0, 1 << 63, int(rng.integers(0, 1 + n // 9))).astype(np.uint64)))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 85 * (len(a) + len(b) - both):
            continue
        (ea, pa), (eb, pb) = (ngram_join.entries(x, levels, 15 * len(x) // 100) for x in (a, b))
        apart = int(np.bitwise_count((ngram_join.marks_of(a) ^ ngram_join.marks_of(b)).view(np.uint64)).sum())
        first = {e: (p, pb[k]) for e, p in zip(ea.tolist(), pa.tolist(), strict=True) for k in np.flatnonzero(eb == np.uint64(e))}
        assert any(185 * min(2 * (len(a) - p), 2 * (len(b) - q), len(a) + len(b) - apart) >= 170 * (len(a) + len(b)) for p, q in first.values()), trial


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + k, 101 + k) for k in range(30)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    best = {n: n for e in edges for n in e}
    for _ in best:
        for a, b in edges:
            best[a] = best[b] = min(best[a], best[b])
    assert got == {n: c for n, c in best.items() if any(n in e and e[0] != e[1] for e in edges)}


def test_passages_cover_every_repeat(spark, texts):
    rng = random.Random(2)
    shared = [" ".join(f"p{k}n{rng.randrange(10**6)}" for _ in range(n)) for k, n in enumerate((50, 60, 90))]
    own = dict(list(texts.items())[:60])
    for k, i in enumerate(list(own)[:30]):
        w = own[i].split(" ")
        at = rng.randrange(len(w) + 1)
        own[i] = " ".join([*w[:at], shared[k % 3], *w[at:]])
    edited = shared[2].split(" ")
    edited.insert(45, "new")
    own[10**6] = " ".join(["before", *edited, "after"])
    found = passages.repeated_passages(spark.createDataFrame(list(own.items()), "doc_id long, text string")).collect()
    cover = defaultdict(set)
    for r in found:
        cover[r["doc_id"]].update(range(r["first_word"], r["end_word"]))
        assert r["source_id"] <= r["doc_id"]
    seen = set()
    for i in sorted(own):
        w = words(own[i])
        runs = {tuple(w[k : k + 50]): k for k in range(len(w) - 49)}
        for run, k in runs.items():
            # What two documents share beyond the first one's passage, here a word by chance, may stay.
            assert run not in seen or len(set(range(k, k + 50)) - cover[i]) <= 2
        seen |= set(runs)
    assert len(cover[10**6]) >= 85
    assert not cover[min(own)]


def test_cut_words():
    assert passages.cut_words(b" a b\n c  d e ", [(1, 3)]) == b" a d e " and passages.cut_words(b"a b", [(0, 2)]) == b""


def test_leaks(spark, texts):
    items = [(r["item_id"], r["text"]) for r in table(spark, DIR, "benchmark").select("item_id", "text").collect()]
    rng = random.Random(4)
    own, want = dict(texts), set()
    for k, (i, t) in enumerate(items[:20]):
        w = t.split()
        if k % 2:  # a paraphrase: some words go, some are new
            w = [x for x in w if rng.random() > 0.08]
            w.insert(len(w) // 2, "indeed")
        host = own[list(texts)[k]].split()
        own[10**6 + k] = " ".join([*host[:70], *w, *host[70:]])
        want.add((10**6 + k, i))
    flat = {i: " ".join(words(t)) for i, t in own.items()}
    for i, t in items:
        want |= {(d, i) for d, s in flat.items() if f" {' '.join(words(t))} " in f" {s} "}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(spark.createDataFrame(list(own.items()), "doc_id long, text string"), table(spark, DIR, "benchmark")).collect()}
    assert len(want - got) <= 1 and all(any(g in flat[d] for g in [" ".join(words(dict(items)[i])[k : k + 4]) for k in range(9)]) for d, i in got - want)


def test_common_subsequence():
    rng = random.Random(0)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(1, 12))] for _ in "ab")
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        pairs = decontaminate.common_positions(a, b)
        assert decontaminate.common_length(a, b) == t[-1][-1] == len(pairs) and all(a[i] == b[j] for i, j in pairs) and pairs == sorted(pairs)


def test_best_fit():
    rng = random.Random(6)
    n = 300
    lengths, sources = [rng.randrange(1, 101) for _ in range(n)], ["hot" if rng.random() < 0.4 else f"s{rng.randrange(9)}" for _ in range(n)]
    clusters = [rng.choice(["c1", "c2", None, f"u{k}"]) for k in range(n)]
    got = packing.best_fit(lengths, sources, clusters, 100, 2)
    open_, where = {}, {}
    for i in sorted(range(n), key=lambda i: (-lengths[i], i)):
        fits = [(100 - sum(lengths[j] for j in own), b) for b, own in open_.items() if sum(lengths[j] for j in own) + lengths[i] <= 100 and sum(sources[j] == sources[i] for j in own) < 2 and (clusters[i] is None or all(clusters[j] != clusters[i] for j in own)) and sum(lengths[j] for j in own) < 100]
        b = min(fits)[1] if fits else len(open_)
        where[i] = (b, sum(lengths[j] for j in open_.get(b, [])))
        open_.setdefault(b, []).append(i)
    assert got == [where[i] for i in range(n)]


def test_token_store(spark, texts):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    odd = {10**6: "a<|endoftext|>B <|STARTOFTEXT|> don't É é 12 ﬁ\x1c\x85x", 10**6 + 1: "It's 3.5% (of) ÀB\tc\x0bd"}
    own = texts | odd
    df = spark.createDataFrame(list(own.items()), "doc_id long, text string")
    store = token_store.write_store(df, public_tokenizers.path("word_bpe_49k.json"))
    rows = {r["doc_id"]: r for r in store.read(df.select("doc_id")).collect()}
    at = 0
    for i in sorted(own):
        ids = np.array([*t.encode(own[i], add_special_tokens=False).ids, 2], "<u4")
        r = rows[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes())), i
        at += len(ids)
    assert store.get(10**6)[0].tolist()[-1] == 2


def test_minimal_perfect_hash():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64))
    index = token_store.Index(token_store.index_bytes(keys, np.arange(len(keys)), np.arange(len(keys)), np.ones(len(keys))))
    slots, found = index(keys)
    assert found.all() and slots["shard"].tolist() == list(range(len(keys))) and sorted(index.levels(keys).tolist()) == list(range(len(keys)))
    assert not index(keys + np.uint64(1))[1][~np.isin(keys + np.uint64(1), keys)].any()


def test_url_filter(spark):
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    for r in queries.op5_url_filter(spark, DIR).join(table(spark, DIR, "pages").select("page_id", "url"), "page_id").collect():
        rest = r["url"].split("://", 1)[1] if "://" in (r["url"] or "") else ""
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0] if rest else ""
        host = host.lower()
        fit = [(len(h + p), a, h + p) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert (r["host"], r["path"], r["rule"]) == (host, path, max(fit)[2] if fit else None)
        if fit:
            assert r["verdict"] == max(fit)[1]
    index, always = url_rules.index_of([url_rules.pattern_rule("block", "a.*b", "a", "b"), url_rules.pattern_rule("block", "x")], {"a": 9, "b": 2})
    assert index == {"b": [0]} and always == [1]


def test_language_held_out(spark):
    docs = table(spark, DIR, "documents")
    model = language.fit(docs.where("doc_id < 120"))
    got = language.documents_identified(docs.where("doc_id >= 120"), model).join(docs.select("doc_id", "lang", "text"), "doc_id").select("doc_id", "text", language.F.col("keep"), docs["lang"].alias("true"), "text_lang").collect()
    long_ = [r for r in got if len(r["text"]) > 100]
    assert sum(r["true"] == r["text_lang"] for r in long_) >= 0.97 * len(long_) and all(r["keep"] for r in long_)


def test_language_evidence(spark):
    """A text that says nothing follows what is declared and the host."""
    docs = spark.createDataFrame([(1, "the cat and the dog in the house " * 5, "en"), (2, "le chat et le chien dans la maison " * 5, "fr")], "doc_id long, text string, lang string")
    model = language.fit(docs)
    pages = [(k, "http://a.b.fr/x", '<html lang="fr"><p>le chat et le chien dans la maison</p>') for k in range(40)] + [(k, "http://c.d.com/x", '<html lang="en"><p>the dog and the cat in the house</p>') for k in range(40, 80)] + [(100, "http://a.b.fr/y", '<html lang="fr"><p>at</p>'), (101, "http://z.b.fr/y", "<html><p>at</p>"), (102, "http://c.d.com/y", '<html lang="en"><p>at</p>')]
    got = {r["page_id"]: r["lang"] for r in language.pages_identified(spark.createDataFrame(pages, "page_id long, url string, html string"), model).collect()}
    assert got[100] == "fr" and got[101] == "fr" and got[102] == "en"


def test_fingerprints(spark, texts):
    order = sorted(texts, reverse=True)
    after = {i: order[(k + 1) % len(order)] for k, i in enumerate(order)}
    rows = {r["doc_id"]: r for r in queries.op9_fingerprint(spark, DIR).collect()}
    error = []
    for i, t in texts.items():
        h = len(t) // 2
        edited = t[: len(t) - h] + texts[after[i]][:h]
        assert rows[i]["n_chars"] == len(t) and rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b = ({tuple(x[k : k + 5]) for k in range(max(1, len(x) - 4))} for x in (t.lower().split(), edited.lower().split()))
        if len(a | b) > 300:
            error.append(abs(rows[i]["near_edited"] - len(a & b) / len(a | b)))
    assert np.mean(error) < 0.05


def test_language_model(spark, texts):
    rows = {r["doc_id"]: r for r in queries.op10_attention_lm(spark, DIR).collect()}
    c = Counter()
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    for i, t in texts.items():
        w, r = [*words(t), None], rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (zlib.crc32(str(i).encode()) % 7 == 2, len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)


def small_model(seed=0, size=60):
    rng = np.random.default_rng(seed)
    counts = rng.integers(1, 30, size)
    counts[-12:] = 0
    words = attention_lm.Vocabulary(counts, 5)
    flat = attention_lm.started(words.n).astype(np.float64)
    rows, u, near = attention_lm.unpack(flat, words.n)
    rows += 0.1 * rng.standard_normal(rows.shape)
    u += 0.1 * rng.standard_normal(u.shape)
    rows[:, attention_lm.SOURCE - 1] = 1
    return rng, words, flat


def test_model_is_a_distribution_and_causal():
    rng, words, flat = small_model()
    rows, u, near = attention_lm.unpack(flat, words.n)
    g = attention_lm.gram(u, words.q.astype(np.float64))
    x = rng.integers(0, words.n, (1, attention_lm.LENGTH))
    y = rng.integers(0, words.n, (1, attention_lm.STRIDE))
    p = lambda x, y: attention_lm.log_probabilities(rows, u, near, g, x, y)
    # Over all subwords, each with its own share of q, and the end.
    total = sum(np.exp(p(x, np.full_like(y, words.symbol[k]))) * math.exp(words.log_q[k]) for k in range(len(words.log_q)))
    assert np.allclose(total, 1, atol=1e-5)
    later = x.copy()
    later[0, -1] = (later[0, -1] + 1) % words.n
    assert np.allclose(p(x, y)[0, :-1], p(later, y)[0, :-1], atol=1e-9) and not np.allclose(p(x, y)[0, -1], p(later, y)[0, -1])


def test_gradient_by_differences():
    rng, words, flat = small_model()
    x, y = (rng.integers(0, words.n, (3, attention_lm.LENGTH)) for _ in range(2))
    use, q = rng.random(x.shape) < 0.8, words.q.astype(np.float64)
    loss = lambda f: attention_lm.gradient(*attention_lm.unpack(f, words.n), q, x, y, use)
    _, touched, drows, du, far = loss(flat)
    g = np.zeros_like(flat)
    own = attention_lm.unpack(g, words.n)
    own[0][touched] += drows
    own[1][:], own[2][:] = du, far
    for k in [*np.argsort(-np.abs(g))[:20], *rng.integers(0, len(g), 20)]:
        if k < own[0].size and k % own[0].shape[1] == attention_lm.SOURCE - 1:
            continue  # the column of ones stays
        step = np.zeros_like(flat)
        step[k] = 1e-4
        assert math.isclose((loss(flat + step)[0] - loss(flat - step)[0]) / 2e-4, g[k], rel_tol=1e-3, abs_tol=1e-6)


def test_whole_texts_against_one_position_at_a_time():
    """Scores of texts against a plain loop over positions and the positions that each may see."""
    rng, words, flat = small_model()
    rows, u, near = attention_lm.unpack(flat, words.n)
    texts = [rng.integers(0, 60, n) for n in (0, 1, 15, 16, 17, 40, 100)]
    q = np.exp(words.log_q)
    g = sum(q[k] * np.outer(u[words.symbol[k]], u[words.symbol[k]]) for k in range(len(q)))
    d, e = attention_lm.KEYS, attention_lm.SOURCE
    want = []
    for ids in texts:
        y = [*words.symbol[ids], words.end]
        x = [words.end] * (attention_lm.LENGTH - attention_lm.STRIDE + 1) + y[:-1]
        total = 0.0
        for t, (symbol, k) in enumerate(zip(y, [*ids, len(q) - 1])):
            at = t + attention_lm.LENGTH - attention_lm.STRIDE
            first = t // attention_lm.STRIDE * attention_lm.STRIDE
            a = [(rows[x[at], e : e + d] @ rows[x[j], :d] + near[at - j]) ** 2 for j in range(first, at + 1)]
            o = sum(w * rows[x[j], d : e - 1] for w, j in zip(a, range(first, at + 1))) / (sum(a) + 1e-6)
            h = rows[x[at], e + d :] + o
            m = (u[symbol] @ h) ** 2 / (h @ g @ h)
            total += math.log(q[k] * ((1 - attention_lm.FLOOR) * m + attention_lm.FLOOR))
        want.append(total)
    got = attention_lm.scored(texts, (rows, u, near), attention_lm.gram(u, words.q.astype(np.float64)), words)
    assert np.allclose(got, want, rtol=1e-5)


def test_pipeline(spark, texts):
    x = table(spark, DIR, "documents")
    columns, kept = x.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        x = stage(spark, x, DIR)
        if name != "best_fit_packing":
            assert x.columns == columns
            kept[name] = {r["doc_id"]: r["text"] for r in x.select("doc_id", "text").collect()}
            x = spark.createDataFrame(x.collect(), x.schema)
    assert set(kept["language_id"]) == set(texts)
    want = linked({i: grams(t, 5) for i, t in texts.items()}, 80)
    assert set(kept["ngram_jaccard"]) == {i for i, c in want.items() if i == c}
    seen = set()
    for i in sorted(kept["substring_dedup"]):
        w = words(kept["substring_dedup"][i])
        runs = {tuple(w[k : k + 55]) for k in range(len(w) - 54)}
        assert not runs & seen
        seen |= runs
    assert set(kept["decontamination"]) == {r["doc_id"] for r in x.select("doc_id").collect()}
