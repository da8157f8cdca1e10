"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, clashing column names, and empty tables."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lectern.llm import attention_lm, chat, decontaminate, fingerprint, language, ngram_join, packing, passages, token_store, url_rules

TOKENS = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{k % 977}x{k % 31}" for k in range(30_000))
SAME = " ".join(f"alpha{k}" for k in range(80))
ROWS = [
    (1, SAME, "en", "s", 5), (2, SAME, "en", "s", 5), (2, SAME, "en", "s", 5), (3, None, None, None, None), (4, "", "fr", "s", 0), (5, " \n\t ", "de", None, 3),
    (None, SAME, "en", "s", 5), (None, None, None, None, None), (6, LONG, "en", "s", 9), (7, "zwei drei", "de", "t", 9), (8, "@@ ## 123", None, "t", 9), (9, "éa ퟿ \U0001f600 x", "fr", "t", 9),
]


@pytest.fixture(scope="module")
def docs(spark):
    x = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    names = ["node", "n", "sig", "c", "p", "hash", "key", "block", "again", "kept", "next", "bin", "piece", "grp", "size", "cluster", "host", "declared", "d", "e", "a", "b", "part", "_text", "_spans", "_id", "shard", "window"]
    return x.withColumns({n: F.lit("clash") for n in names})


@pytest.fixture(scope="module")
def bench(spark):
    item = " ".join(f"alpha{k}" for k in range(20, 55))
    return spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (None, item), (4, "zwei drei")], "item_id long, text string").withColumn("doc_id", F.lit(7))


def none(df):
    return df.where("false")


def test_ngram_join(docs):
    rows = ngram_join.similar_documents(docs).collect()
    assert len(rows) == len(ROWS)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None}
    assert got[1] == got[2] == (77, 1) and got[3] == (0, 3) and got[4] == (0, 4) and got[7] == (1, 7)
    assert ngram_join.similar_documents(none(docs)).count() == 0
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.select("doc_id").collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8, 9]
    assert ngram_join.keep_one(none(docs)).count() == 0


def test_passages(docs):
    rows = passages.repeated_passages(docs).collect()
    assert {(r["doc_id"], r["first_word"], r["end_word"], r["source_id"]) for r in rows if r["doc_id"] == 2} == {(2, 0, 80, 1)}
    assert passages.merged_spans(passages.repeated_passages(none(docs))).count() == 0
    kept = passages.without_repeats(docs)
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert kept.columns == docs.columns and 2 not in ids and {1, 3, 4, 5, 7}.issubset(ids) and ids.count(None) == 2
    assert passages.without_repeats(none(docs)).count() == 0


def test_decontaminate(docs, bench):
    rows = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()}
    assert {(1, 1), (2, 1), (None, 1), (7, 4)} == rows
    assert decontaminate.leaks(none(docs), bench).count() == 0 and decontaminate.leaks(docs, none(bench)).count() == 0
    whole, decontaminate.MOST_ITEMS = decontaminate.MOST_ITEMS, 1
    try:
        assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()} == rows
    finally:
        decontaminate.MOST_ITEMS = whole
    kept = decontaminate.without_leaks(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.select("doc_id").collect()} == {None, 3, 4, 5, 6, 8, 9}


def test_packing(docs):
    rows = packing.packed(docs, capacity=64, group=100).collect()
    assert sum(r["start"] == 0 for r in rows) == len(ROWS)
    bins = {}
    for r in rows:
        bins.setdefault(r["bin"], []).append((r["bin_offset"], r["n_tokens"]))
    for own in bins.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 64
    assert packing.packed(none(docs)).count() == 0


def test_language(docs):
    model = language.fit(docs)
    rows = language.documents_identified(docs, model).collect()
    assert len(rows) == len(ROWS) and all(not r["keep"] for r in rows if r["doc_id"] in (3, 4, 5, 8))
    assert language.documents_identified(none(docs), model).count() == 0
    assert language.documents_identified(docs, language.fit(none(docs))).where("keep").count() == 0
    kept = language.identified_only(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id in (1, 2)").count() == 3 and kept.where("doc_id in (3, 4, 5, 8)").count() == 0


def test_fingerprints(docs):
    rows = fingerprint.fingerprints(docs).collect()
    assert len(rows) == len(ROWS) and len({r["fingerprint"] for r in rows if r["n_chars"] == len(SAME)}) == 1
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    assert fingerprint.fingerprints(none(docs)).count() == 0
    assert len(fingerprint.fingerprints(docs.where("doc_id = 7")).collect()) == 1
    assert fingerprint.fingerprints(docs.where("doc_id is null")).count() == 2


def test_token_store(docs):
    store = token_store.write_store(docs, TOKENS)
    rows = store.read(docs.select("doc_id").distinct()).collect()
    assert len(rows) == len(ROWS) and len(store.get(2)) == 2 and len(store.get(None)) == 2 and store.get(123456) == []
    rows.sort(key=lambda r: r["start"])
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    assert token_store.write_store(none(docs), TOKENS).read(none(docs).select("doc_id")).count() == 0


def test_token_store_key_like_null(spark):
    """No id is taken for a missing one; keys and their ids come from single reads."""
    ids = [None, None, 7959387129412676716, -1, 0, *range(5, 3000, 7)]
    df = spark.createDataFrame([(i, f"text {k} of many") for k, i in enumerate(ids)], "doc_id long, text string")
    store = token_store.write_store(df, TOKENS)
    assert store.read(df.select("doc_id").distinct()).count() == len(ids) and len(store.get(None)) == 2
    rows = {r["doc_id"]: r["ids"] for r in store.read(df.select("doc_id").distinct()).collect() if r["doc_id"] is not None}
    for i in ids[2:40]:
        assert [x.tobytes() for x in store.get(i)] == [bytes(rows[i])]
    assert store.get(4) == []


def test_texts_of_one_id(spark):
    """Rows of one doc_id are judged by their own texts."""
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "pq")
    one = spark.createDataFrame([(1, a), (5, a), (5, b), (1, a)], "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.keep_one(one).collect())) == [(1, a), (5, b)]
    own = " ".join(f"own{k}" for k in range(10))
    two = spark.createDataFrame([(1, a), (5, f"{own} {a}"), (5, b), (5, f"{own} {a}")], "doc_id long, text string")
    assert sorted(map(tuple, passages.without_repeats(two).collect())) == [(1, a), (5, f"{own} "), (5, f"{own} "), (5, b)]
    spans = passages.repeated_passages(two).select("doc_id", "first_word", "end_word", "source_id").distinct().collect()
    assert set(map(tuple, spans)) == {(5, 10, 70, 1)}


def test_attention_lm(docs):
    rows = attention_lm.scores(docs, TOKENS).collect()
    assert len(rows) == len(ROWS) and all(r["score"] <= 0 and r["score"] == r["score"] for r in rows)
    assert attention_lm.scores(none(docs), TOKENS).count() == 0
    assert attention_lm.scores(docs.where("doc_id is null"), TOKENS).count() == 2


def test_url_rules(spark):
    pages = spark.createDataFrame([(1, None), (1, ""), (2, "x"), (3, "http://"), (None, "http://A.Example.NET/en/1?x"), (4, "http://net/"), (5, "://net#/")], "page_id long, url string").withColumn("rule", F.lit("clash"))
    rows = url_rules.judged(pages, [url_rules.host_rule("block", "net/"), url_rules.host_rule("allow", "example.net/en/")]).collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}
    assert len(rows) == 7 and got[None] == ("a.example.net", "/en/1", "example.net/en/", "allow") and got[4] == ("net", "/", "net/", "block") and got[5] == ("net", "", None, "allow") and got[3] == ("", "", None, "allow")
    assert url_rules.judged(none(pages), []).count() == 0


def test_chat(spark):
    m = [(1, 0, "user", "One whole sentence here.\n\nAnother one follows."), (1, 1, "assistant", "> another  ONE follows.\nIndeed."), (1, 1, "assistant", "> another  ONE follows.\nIndeed."), (1, 2, None, ">> one whole sentence here.\n> nothing known at all\nok"), (None, None, None, None), (2, None, "user", ""), (2, 5, "user", "hm")]
    df = spark.createDataFrame(m, "conv_id long, turn long, role string, text string").withColumns({"c": F.lit("x"), "at": F.lit("x"), "part": F.lit("x")})
    rows = chat.linked(df).collect()
    assert len(rows) == len(m)
    got = {(r["conv_id"], r["turn"]): (r["text"], r["parent_turn"], r["quoted"]) for r in rows}
    assert got[1, 1] == ("Indeed.", 0, True) and got[1, 2] == ("ok", 0, True) and got[2, 5][1] is None
    assert sum(r["n_messages"] for r in chat.rendered(df, part=2).collect()) == len(m)
    assert chat.rendered(none(df)).count() == 0
    short = spark.createDataFrame([(1, 0, "user", "Yes"), (1, 1, "assistant", "And this?"), (1, 2, "user", "> yes\nWhy?")], "conv_id long, turn long, role string, text string")
    assert {(r["turn"], r["parent_turn"], r["quoted"]) for r in chat.linked(short).collect()} == {(0, None, False), (1, 0, False), (2, 0, True)}


def test_stages_on_empty_table(spark, docs, bench, tmp_path):
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    x = none(docs)
    for _, stage in corpus_pipeline.STAGES:
        x = stage(spark, x, str(tmp_path))
        assert x.count() == 0
