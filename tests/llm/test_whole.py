"""Cases in which an operator once did less than its whole job."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from lectern.llm import attention_lm, ngram_join, passages
from lectern.llm.common import bytes_hashes
from lectern.llm.tokens import WordIds, word_ids


def made(rng, n):
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


@pytest.mark.parametrize("kind", ["inserted", "deleted", "changed"])
def test_passages_with_an_edit_anywhere(kind):
    """One word's edit at each place, with the shift of only one side of it known."""
    rng = random.Random(1)
    for n in (50, 55, 60):
        for at in range(n):
            p = made(rng, n)
            q = {"inserted": [*p[:at], "new", *p[at:]], "deleted": [*p[:at], *p[at + 1 :]], "changed": [*p[:at], "new", *p[at + 1 :]]}[kind]
            a, b = (passages._hashes(" ".join([*made(rng, 70), *x, *made(rng, 70)]).encode()) for x in (p, q))
            for shift in {0, len(p) - len(q)}:
                spans = passages.repeated(b, a, 0, [shift], 20, 180, 46)
                assert sum(e - s for s, e in spans) >= 41, (n, at, shift)
                assert all(65 <= s and e <= 70 + len(q) for s, e in spans)


def test_a_line_of_one_side_is_not_many():
    rng = random.Random(2)
    line = made(rng, 12)
    a, b = (passages._hashes(" ".join(x).encode()) for x in ([*made(rng, 90), *line, *made(rng, 90)], [*made(rng, 40), *line * 8, *made(rng, 40)]))
    assert passages.repeated(b, a, 0, [50, 38, 26, 14], 0, 170, 46) == []


def test_passages_behind_documents_that_share_a_half(spark):
    """Passages of two lines, each line in 25 earlier documents; copied with one changed word."""
    rng, texts, last = random.Random(3), [], []
    for _ in range(40):
        one, two = made(rng, 30), made(rng, 30)
        texts += [[*made(rng, 60), *line, *made(rng, 60)] for line in [one, two] * 25]
        copy = [*one, *two]
        copy[rng.randrange(60)] = "new"
        last.append(([*made(rng, 60), *one, *two, *made(rng, 60)], [*made(rng, 60), *copy, *made(rng, 60)]))
    rng.shuffle(texts)
    texts += [x for x, _ in last] + [y for _, y in last]
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "doc_id long, text string")
    found = {(r["source_id"], r["doc_id"]) for r in passages.repeated_passages(df).collect() if r["end_word"] - r["first_word"] >= 50}
    assert found == {(2000 + k, 2040 + k) for k in range(40)}


TOKENS = public_tokenizers.path("word_bpe_49k.json")


def test_model_is_fitted_to_all_windows(spark, monkeypatch):
    """All tokens of all shares of all rounds count once, however the rows lie."""
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choice(["the", "of", f"name{rng.randrange(40)}", "Überzug"]) for _ in range(rng.randrange(300)))) for k in range(150)]
    train = [t for k, t in rows if not attention_lm.held_out(k)]
    words, want = word_ids(TOKENS), 0
    for t in train:
        n = len(words.text(t.encode())) // np.dtype(words.dtype).itemsize + 1
        want += -(-max(n + 17 - 33, 0) // attention_lm.LENGTH) + 1
    monkeypatch.setattr(attention_lm, "SHARE", 1_000)
    monkeypatch.setattr(attention_lm, "FITTED", 0)
    add, windows, states = attention_lm.array_sum, [], []

    def seen(rows, size, span, dtype, into=None):
        out = add(rows, size, span, dtype, into)
        if into:
            windows.append(int(out[-1]))
            states.append(out)
        return out

    monkeypatch.setattr(attention_lm, "array_sum", seen)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one = {r["doc_id"]: r["score"] for r in attention_lm.scores(df.coalesce(1), TOKENS).collect()}
    assert len(windows) == attention_lm.ROUNDS and sum(windows) == want
    two = {r["doc_id"]: r["score"] for r in attention_lm.scores(df.repartition(7).sortWithinPartitions("text"), TOKENS).collect()}
    assert all(np.isclose(one[k], two[k], rtol=1e-4) for k in one)


def test_model_learns_what_words_alone_do_not_tell(spark):
    """Texts in which each word fixes the next one, in two languages: held-out texts are likelier than by their words' counts."""
    rng, rows = random.Random(8), []
    for k in range(300):
        names = [f"{'abcdefgh'[j]}{'xy'[k % 2]}" for j in range(8)]
        at = rng.randrange(8)
        rows.append((k, " ".join(names[(at + j * (1 + k % 2 * 2)) % 8] for j in range(60))))
    got = [r for r in attention_lm.scores(spark.createDataFrame(rows, "doc_id long, text string"), TOKENS).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > 0.5 * sum(r["base_score"] for r in got)


def test_counts_by_the_join_are_the_same(spark, monkeypatch):
    """The base score is the same whether a word's count stands with each task or comes by the join."""
    rng = random.Random(5)
    df = spark.createDataFrame([(k, " ".join(rng.choice(["the", "of", f"name{rng.randrange(40)}", "Überzug", f"odd{k}"]) for _ in range(60))) for k in range(40)] + [(99, None), (98, "")], "doc_id long, text string")
    monkeypatch.setattr(attention_lm, "PASSES", 1)
    rows = [attention_lm.scores(df, TOKENS).collect()]
    monkeypatch.setattr(attention_lm, "KNOWN", 3)
    rows.append(attention_lm.scores(df, TOKENS).collect())
    one, two = ({r["doc_id"]: r for r in x} for x in rows)
    for k in one:
        assert one[k]["n_known"] == two[k]["n_known"] and np.isclose(one[k]["base_score"], two[k]["base_score"]) and np.isclose(one[k]["score"], two[k]["score"])


def test_hashes_of_words():
    """Tabulated hashes tell words apart, long ones too, and do not depend on what stands around them."""
    words = [f"w{k}".encode() for k in range(3000)] + [b"x" * k for k in range(1, 200)] + [b"y" * 32 + b"x" * k for k in range(1, 50)]
    one = bytes_hashes(b"  " + b" \t".join(words) + b"\n")
    assert len(one) == len(words) == len(set(one.tolist())) and not len(bytes_hashes(b"")) and not len(bytes_hashes(b" \n"))
    assert (bytes_hashes(b" ".join(words[::-1]))[::-1] == one).all()


def test_ids_are_the_tokenizers():
    rng, t = random.Random(9), Tokenizer.from_file(TOKENS)
    alphabet = [*map(chr, [*range(32, 127), *range(0xA0, 0x250), *range(0x300, 0x330), *range(0x370, 0x400), 0x1F600, 0x4E00, 0xAC00]), " ", " ", "\n"]
    words = word_ids(TOKENS)
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(30)))
        assert np.frombuffer(words.text(text.encode()), words.dtype).tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_all_links_are_counted(spark):
    """Groups in which every text is near every other one, and chains."""
    rng, own = random.Random(6), []
    for _ in range(6):
        base = made(rng, 120)
        for _ in range(7):
            w = list(base)
            for _ in range(rng.randrange(1, 4)):
                w[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
            own.append(w)
    own += [own[0], own[3]]
    sets = [frozenset(tuple(w[k : k + 4]) for k in range(117)) for w in own]
    near = lambda a, b: a != b and 100 * len(a & b) >= 85 * len(a | b)
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(own)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_links"] for r in ngram_join.similar_documents(df).collect()}
    assert got == {k: sum(near(a, b) for b in set(sets)) for k, a in enumerate(sets)}


def test_texts_are_encoded_together():
    """Many texts in one call: each as by the tokenizer, new words learnt once, pieces of words kept for later calls."""
    words, whole = WordIds(TOKENS), Tokenizer.from_file(TOKENS)
    texts = [None, "", " \n", "Ein Wort, ein wort; Éa'll <unk> x", "éa ein", "ein wort, 12 ein", "wort."] * 40
    learn, calls = words._learn, []
    words._learn = lambda: (calls.append(len(words.asked)), learn())
    ids, n = words.texts([t.encode() if t is not None else None for t in texts])
    ends = [0, *n.cumsum().tolist()]
    for t, a, b in zip(texts, ends, ends[1:], strict=False):
        assert ids[a:b].tolist() == (whole.encode(t, add_special_tokens=False).ids if t else []), t
    assert len(calls) == 1
    kept = len(words.pieces)
    words.texts([b"wort, wort! wort"])
    assert len(words.pieces) == kept + 2  # the two marks alone are new


def test_surroundings_tell_neighbourhoods():
    """Equal for equal values around a stretch, wherever it stands; other values, another order or an end of the text differ."""
    rng, t = np.random.default_rng(4), 46
    reach = t + passages.SLACK
    core = rng.integers(1, 1 << 63, 2 * reach + passages.STRETCH).astype(np.uint64)
    at = np.array([reach])
    own = passages.surroundings(core, at, t)
    assert (passages.surroundings(np.concatenate([core[:300], core, core[:7]]), at + min(300, len(core)), t) == own).all()
    changed = [core[1:], core[:-1], np.r_[core[1], core[0], core[2:]]]
    for k in range(len(core)):
        x = core.copy()
        x[k] += np.uint64(1)
        changed.append(x)
    names = [int(own[0]), *(int(passages.surroundings(x, at - (k == 0), t)[0]) for k, x in enumerate(changed))]
    assert len(set(names)) == len(names)


def test_links_are_counted_by_blocks(spark, monkeypatch):
    """Components of many blocks; what is sent grows with the blocks, and no pair of a component is a row."""
    monkeypatch.setattr(ngram_join, "BLOCK", 5)
    rng, own = random.Random(12), []
    for size in (2, 3, 40):
        base = made(rng, 90)
        for _ in range(size):
            w = list(base)
            w[rng.randrange(90)] = f"x{rng.randrange(10**6)}"
            if rng.random() < 0.5:
                w[rng.randrange(90)] = f"x{rng.randrange(10**6)}"
            own.append(w)
    own += [own[0], own[20]]
    sets = [frozenset(tuple(w[k : k + 4]) for k in range(87)) for w in own]
    near = lambda a, b: a != b and 100 * len(a & b) >= 85 * len(a | b)
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(own)], "doc_id long, text string")
    got = {r["doc_id"]: r["n_links"] for r in ngram_join.similar_documents(df).collect()}
    assert got == {k: sum(near(a, b) for b in set(sets)) for k, a in enumerate(sets)}


def test_common_counts():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 900, rng.integers(1, 400)).astype(np.uint64)) for _ in range(30)]
    for tile in (7, 4096):
        got = ngram_join.common_counts(sets, tile)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                assert i == j or got[i, j] == len(np.intersect1d(a, b))


def test_a_word_over_and_over_is_indexed_once():
    """A run of one word is a few rows, however long; no stretch of it stands for each of its places."""
    rng = random.Random(13)
    text = " ".join([*made(rng, 40), *["the"] * 400, *made(rng, 40)]).encode()
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([text], pa.binary())], ["doc_id", "text"])
    sigs = Counter(x for part in passages._stretches(46)([batch]) for x in part.column("sig").to_pylist())
    assert max(sigs.values()) <= 9 and sum(sigs.values()) < 70


def test_similar_runs_of_one_word_share_a_key():
    """Passages made up of runs and other words, with one edit anywhere."""
    rng = random.Random(14)
    for _ in range(1500):
        p = []
        while len(p) < 50:
            p += [rng.choice("abc")] * rng.choice([1, 12, 18, 20, 25, 40, 60]) if rng.random() < 0.7 else made(rng, rng.randrange(1, 9))
        p = p[:50]
        at = rng.randrange(50)
        q = rng.choice([[*p[:at], "new", *p[at:]], [*p[:at], *p[at + 1 :]], [*p[:at], "new", *p[at + 1 :]]])
        a, b = (passages._hashes(" ".join([*made(rng, 70), *[x[0]] * rng.choice([0, 5]), *x, *made(rng, 70)]).encode()) for x in (p, q))
        keys = [set(passages.indexed(g, 46)[0].tolist()) for g in (a, b)]
        assert keys[0] & keys[1], (p, q)


def test_runs_of_one_word_meet_those_alike(spark):
    """Thousands of pairs share a run of one word and nothing else; runs and what is next to them repeat, with an edit, in a few."""
    rng, texts = random.Random(15), []
    for k in range(120):
        texts.append([*made(rng, 50), *["the"] * (20 + k % 9), *made(rng, 50)])
    mixed = [*made(rng, 12), *["the"] * 25, *made(rng, 15)]
    copy = list(mixed)
    copy[40] = "new"
    texts += [[*made(rng, 30), *x, *made(rng, 30)] for x in (mixed, copy, ["the"] * 300, ["the"] * 70, [*["the"] * 24, "new", *["the"] * 25])]
    df = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "doc_id long, text string")
    rows = passages.merged_spans(passages.repeated_passages(df).drop("text_hash")).collect()
    got = {r["doc_id"]: (r["source_id"], r["first_word"], r["end_word"]) for r in rows}
    assert set(got) == {121, 122, 123, 124}
    assert got[121] == (120, 30, 82) and got[123] == (122, 30, 100) and got[124][0] in (122, 123) and got[124][1:] == (30, 80)
    assert got[122][0] == 122 and got[122][2] == 330


def test_runs_of_one_word_are_not_paired_by_it(spark, monkeypatch):
    """The pairs to check do not grow with the square of the texts that repeat a word."""
    rng, n = random.Random(16), []
    plain = passages._rest
    monkeypatch.setattr(passages, "_rest", lambda *a: n.append((out := plain(*a)).count()) or out)
    texts = [[*made(rng, 50), *["the"] * (20 + k % 19), *made(rng, 50)] for k in range(150)]
    passages.repeated_passages(spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "doc_id long, text string")).count()
    assert n[0] < 150
