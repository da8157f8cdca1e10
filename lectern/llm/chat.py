"""Conversations from messages that quote each other.

Nested quote levels (`>`, `> >` ...) are parsed from each message. Quoted passages, and the messages' own words as a
whole, by paragraph and by line, are normalised and hashed; a quotation is joined to the latest earlier message of its
conversation that holds it. A message replies to what it quotes at the outermost level, else to the message before it.
Conversations are put in reply order, without the quotes, and rendered for training.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import ranked, shared_dir, stored

#: Messages of a rendered part; longer conversations come in several.
PART = 256
#: Characters that a paragraph or line needs to be looked for; whole messages and quotations need none.
SHORTEST = 8
_QUOTED = re.compile(r"((?:[ \t]*>)+)[ \t]?(.*)", re.S)
_SAYS = re.compile(r"[^\n]{0,200}\b(?:wrote|schrieb|écrit|escribió)\s*:\s*")


def parse(text: str | None) -> tuple[str, list[tuple[int, list[str]]]]:
    """A message's own words, without the line that introduces a quotation; and quoted passages as (level, lines)."""
    own, quotes, last = [], [], 0
    for line in (text or "").split("\n"):
        if m := _QUOTED.match(line):
            level = m[1].count(">")
            if level == last:
                quotes[-1][1].append(m[2])
            else:
                if not last and own and _SAYS.fullmatch(own[-1]):
                    own.pop()
                quotes.append((level, [m[2]]))
            last = level
        else:
            own.append(line)
            last = 0
    return "\n".join(own).strip(), quotes


def normal(passage: str) -> str:
    return " ".join(passage.casefold().split())


def _hash(passage: str, least: int = SHORTEST) -> int | None:
    x = normal(passage)
    return int(np.uint64(xxh3_64_intdigest(x)).view(np.int64)) if len(x) >= least else None


def passages(text: str) -> list[tuple[int, int]]:
    """(rank, hash) of a passage as a whole, 0, of its paragraphs, 1, and of its lines, 2; each hash once."""
    found: dict[int, int] = {}
    for rank, parts in enumerate(([text], re.split(r"\n\s*\n", text), text.split("\n"))):
        for x in parts:
            if (h := _hash(x, SHORTEST if rank else 1)) is not None:
                found.setdefault(h, rank)
    return [(r, h) for h, r in found.items()]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own, held, asked = [], [], []
        for text in batch.column("text").to_pylist():
            words, quotes = parse(text)
            own.append(words)
            held.append([h for _, h in passages(words)])
            asked.append([{"level": level, "rank": r, "h": h} for level, lines in quotes for r, h in passages("\n".join(lines))])
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("c", "t", "role")), pa.array(own, pa.string()), pa.array(held, pa.list_(pa.int64())), pa.array(asked, pa.list_(pa.struct([("level", pa.int32()), ("rank", pa.int32()), ("h", pa.int64())])))], ["c", "t", "role", "own", "held", "asked"])


def linked(messages: DataFrame) -> DataFrame:
    """A row for each message: conv_id, turn, role, text (without quotes), parent_turn, quoted, position.

    quoted: whether the parent comes from a quotation, else it is the turn before. position: from 0, by (turn of the
    parent, turn), which puts every message after its parent and replies to one message next to each other. Ties by
    role and text. Null conv_id: one conversation of its own. Null turn: before all others. Null role: user. Null
    text: empty. A quotation that nothing earlier holds: dropped, without a link; so is a part of one, paragraph or
    line, of fewer than SHORTEST characters, while a whole message that is quoted as a whole may have any length.
    Repeated rows: kept, each with its own links. Lines end at line feeds only. Very long texts: whole. Other columns are ignored.

    No step needs a conversation in one task: neighbours and positions come from ranks over the whole table, and
    quotations are joined to originals by conversation and hash.
    """
    base = shared_dir(messages.sparkSession)
    lowest = -(1 << 63)
    rows = messages.select(F.coalesce("conv_id", F.lit(lowest)).alias("c"), F.coalesce("turn", F.lit(lowest)).alias("t"), F.coalesce("role", F.lit("user")).alias("role"), "text")
    rows = ranked(rows.mapInArrow(_parsed, "c long, t long, role string, own string, held array<long>, asked array<struct<level:int,rank:int,h:long>>"), ["c", "t", "role", "own"], "r")
    rows = stored(rows, f"{base}/rows")
    # Of several messages of one turn each has its own quotations: r tells them apart.
    asked = rows.select("c", "t", "r", F.explode("asked").alias("q")).select("c", "t", "r", "q.level", "q.rank", "q.h")
    wanted = asked.select("c", "h").distinct()
    held = rows.select("c", "t", F.explode("held").alias("h")).distinct().join(wanted, ["c", "h"], "left_semi")
    both = asked.withColumn("source", F.lit(None).cast("long")).unionByName(held.withColumns({"r": F.lit(None).cast("long"), "level": F.lit(None).cast("int"), "rank": F.lit(None).cast("int"), "source": F.col("t")}))
    # A question of a turn stands before what the same turn holds.
    before = Window.partitionBy("c", "h").orderBy("t", F.col("source").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    found = both.withColumn("target", F.last("source", ignorenulls=True).over(before)).where("level is not null and target is not null")
    links = found.groupBy("c", "r").agg(F.min(F.struct("level", "rank", (-F.col("target")).alias("late"))).alias("best")).select("c", "r", (-F.col("best.late")).alias("target"))
    previous = rows.select("c", (F.col("r") + 1).alias("r"), F.col("t").alias("previous"))
    x = rows.drop("held", "asked").join(previous, ["c", "r"], "left").join(links, ["c", "r"], "left")
    x = x.withColumn("parent", F.coalesce("target", "previous"))
    x = ranked(x.withColumn("key", F.coalesce("parent", F.lit(lowest))), ["c", "key", "t", "r"], "at")
    x = stored(x, f"{base}/ordered")
    first = x.groupBy("c").agg(F.min("at").alias("start"))
    null = lambda c: F.when(F.col(c) != lowest, F.col(c))
    return x.join(first, "c").select(null("c").alias("conv_id"), null("t").alias("turn"), "role", F.col("own").alias("text"), null("parent").alias("parent_turn"), F.col("target").isNotNull().alias("quoted"), (F.col("at") - F.col("start")).alias("position"))


def rendered(messages: DataFrame, template: str = "<|im_start|>%s\n%s<|im_end|>\n", part: int = PART) -> DataFrame:
    """conv_id, part, n_messages, n_linked, turns, parents, text: conversations in reply order, at most `part` messages a row. All else as in `linked`."""
    x = linked(messages).withColumn("part", F.floor(F.col("position") / part))
    one = F.struct("position", "turn", "parent_turn", "quoted", F.format_string(template, "role", "text").alias("text"))
    g = x.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(one)).alias("m"))
    return g.select("conv_id", "part", F.size("m").alias("n_messages"), F.size(F.filter("m", lambda v: v["quoted"])).alias("n_linked"), F.col("m.turn").alias("turns"), F.col("m.parent_turn").alias("parents"), F.array_join(F.col("m.text"), "").alias("text"))
