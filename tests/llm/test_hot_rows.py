"""Cases that once stalled a task or mixed rows up: messages of one turn, broken markup, equal rows."""

import random
import re
import time

from pyspark.sql import functions as F

from lectern.llm import chat, language, packing


def test_messages_of_one_turn_keep_their_links(spark):
    said = [(1, 0, "user", "the first thing that was said"), (1, 1, "assistant", "an answer to that"), (1, 2, "user", "> the first thing that was said\nindeed"), (1, 2, "assistant", "quotes nothing at all")]
    rows = chat.linked(spark.createDataFrame(said, "conv_id long, turn long, role string, text string")).collect()
    got = {(r["turn"], r["role"]): (r["quoted"], r["parent_turn"]) for r in rows}
    assert got[2, "user"] == (True, 0) and not got[2, "assistant"][0] and len(rows) == 4


def test_lines_end_at_line_feeds():
    own, quotes = chat.parse("> a\x0cb\n> c d\n\nown\x85words")
    assert quotes == [(1, ["a\x0cb", "c d"])] and own == "own\x85words"


OLD_MARKUP = re.compile(rb"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
OLD_LANG = re.compile(rb"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})""")


def test_markup_as_the_pattern_says():
    rng = random.Random(3)
    parts = [b"<", b">", b"<!--", b"-->", b"<script", b"</script >", b"<STYLE a>", b"</style>", b"text", b" ", b"<html lang='de'", b"<html", b"lang=fr", b"<p>", b"--", b"</Script\n>", b"<scripts>"]
    for _ in range(3000):
        page = b"".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert language.without_markup(page) == OLD_MARKUP.sub(b" ", page), page
        m = OLD_LANG.search(page)
        assert language.declared_language(page) == (m[1].decode().lower() if m else None), page


def test_broken_markup_is_read_once():
    for unclosed in (b"<script ", b"<!--", b"<style>", b"<html ", b"<html>", b"<!-- <script>", b"<"):
        page = unclosed * (2_000_000 // len(unclosed))
        began = time.process_time()
        language.page_text(page), language.declared_language(page)
        assert time.process_time() - began < 5, unclosed


def test_equal_rows_are_packed_apart(spark):
    one = spark.range(30_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    began = time.time()
    rows = packing.packed(one.unionByName(one.limit(3).withColumn("text", F.repeat(F.lit("x "), 5000)))).collect()
    assert time.time() - began < 60
    short = [r for r in rows if r["n_tokens"] == 4]
    assert len(short) == 30_000 == len({r["bin"] for r in short}) and sum(r["n_tokens"] for r in rows) == 30_000 * 4 + 3 * 5001
    assert len({(r["bin"], r["bin_offset"]) for r in rows}) == len(rows)
