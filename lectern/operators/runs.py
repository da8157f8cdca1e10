"""Rewriting a paragraph that lies in formatted runs: the joined text is rewritten and cut back over the runs.

A run table has keys, `run` (its order), `text`, `note` (the id of the note whose mark the run holds, else null) and any
columns that describe its format. A paragraph's runs are an array; each run is an interval of characters of the joined
text, and edits of that text move the borders of the intervals. Runs without an edit keep their text to the byte.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators import references as rf

NO_BREAK = "\u00a0"
#: Punctuation, with white space behind it, at the end of a run.
_BLANK = r"\s\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
TRAILING = rf"([.,;:!?…]+)[{_BLANK}]*$"
#: Texts of which something is left however often such an end is taken away.
SOLID = rf"^[^.,;:!?…]|[^.,;:!?…{_BLANK}]"


def paragraphs(runs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, runs: an ordered array of (run, text, note, format) for each paragraph."""
    more = [c for c in runs.columns if c not in {*keys, "run", "text", "note"}]
    one = F.struct("run", F.coalesce("text", F.lit("")).alias("text"), "note", F.struct(*more, F.lit(None).cast("string").alias("_")).alias("format"))
    return runs.groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("runs"))


def joined(runs: Column) -> Column:
    return F.array_join(F.transform(runs, lambda r: r["text"]), "")


def borders(runs: Column) -> Column:
    """How many characters of the joined text stand before each run, and in all."""
    start = F.struct(F.lit(0).alias("n"), F.array(F.lit(0)).alias("out"))
    step = lambda a, r: F.struct((a["n"] + F.length(r["text"])).alias("n"), F.array_append(a["out"], a["n"] + F.length(r["text"])).alias("out"))
    return F.aggregate(runs, start, step)["out"]


def moved(border: Column, edits: Column) -> Column:
    """Where a border of the old text lies in the new one.

    Edits (start from 1, end exclusive, replacement) before it move it by what they add; inside an edit it keeps its
    distance from the edit's beginning, so that an edit of equal length stays where it was, character by character, and
    of another the last run takes what is longer, or lacks what is shorter.
    """

    def by(e: Column) -> Column:
        first, new = e["start"] - 1, F.length(e["replacement"])
        return F.when(e["end"] - 1 <= border, new - (e["end"] - e["start"])).when(first < border, F.least(border - first, new) - (border - first)).otherwise(0)

    return border + F.aggregate(edits, F.lit(0), lambda a, e: a + by(e))


def cut_back(paras: DataFrame, edits: str) -> DataFrame:
    """paras with the texts of `runs` after the edits of the joined text; `edits` is an array column, in order and apart."""
    texts = rf.rewritten(joined(F.col("runs")), F.col(edits))["text"]
    x = paras.withColumns({"_new": texts, "_borders": F.transform(borders(F.col("runs")), lambda b: moved(b, F.col(edits)))})
    part = lambda i: F.substring("_new", F.get("_borders", i) + 1, F.get("_borders", i + 1) - F.get("_borders", i))
    cut = F.transform("runs", lambda r, i: r.withField("text", part(i)))
    return x.withColumn("runs", F.when(F.size(edits) > 0, cut).otherwise(F.col("runs"))).drop("_new", "_borders")


def _spans_runs(edit: Column, edges: Column) -> Column:
    """Whether an edit lies in more than one run: a border is inside it."""
    return F.exists(edges, lambda b: (b >= edit["start"]) & (b < edit["end"] - 1))


def reference_edits(text: Column) -> Column:
    """(start, end, replacement) of each reference that is not in canonical form with no-break spaces."""
    edit = lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end"), rf.displayed(h["work"], h["path"], NO_BREAK).alias("replacement"), h["raw"].alias("raw"))
    return F.filter(F.transform(rf.hits(text), edit), lambda e: e["raw"] != e["replacement"])


# Below, arrays are taken apart by posexplode_outer: the inner form makes the optimiser ask for the arrays' size first, and so
# work out a rewrite many times over. Rows without an element are left out by hand.


def _changed(paras: DataFrame, keys: list[str]) -> DataFrame:
    """keys, run, before, text, note and format of each run; `_old` has the texts before."""
    x = paras.select(*keys, F.posexplode_outer("runs").alias("_at", "r"), "_old")
    return x.select(*keys, F.col("r.run").alias("run"), F.get("_old", "_at").alias("before"), F.col("r.text").alias("text"), F.col("r.note").alias("note"), F.col("r.format").alias("format"))


def with_canonical_references(runs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, run, before, text, note, format: references rewritten, first inside each run, then across runs.

    A reference that lies in several runs is rewritten only if it keeps its length, so that no format moves over another
    character; a longer or shorter one is left alone.
    """
    p = paragraphs(runs, keys)
    named = F.exists("runs", lambda r: r["text"].rlike(rf.BEGINS)) | joined(F.col("runs")).rlike(rf.BEGINS)
    own = F.transform("runs", lambda r: r.withField("text", F.when(r["text"].rlike(rf.BEGINS), rf.rewritten(r["text"], reference_edits(r["text"]))["text"]).otherwise(r["text"])))
    p = p.withColumn("_old", F.transform("runs", lambda r: r["text"])).withColumn("runs", F.when(named, own).otherwise(F.col("runs")))
    p = p.withColumns({"_joined": joined(F.col("runs")), "_edges": borders(F.col("runs"))})
    across = F.filter(reference_edits(F.col("_joined")), lambda e: (F.length(e["raw"]) == F.length(e["replacement"])) & _spans_runs(e, F.col("_edges")))
    p = p.withColumn("_edits", F.when(F.col("_joined").rlike(rf.BEGINS), across).otherwise(F.array().cast("array<struct<start:int,end:int,replacement:string,raw:string>>")))
    return _changed(cut_back(p, "_edits"), keys)


def with_plain_text(runs: DataFrame, keys: list[str], rewrite: Callable[[Column], Column]) -> DataFrame:
    """keys, run, before, text, note, format after a rewrite of each run's text and then of the paragraph's.

    What the paragraph's own rewrite changes beyond that of its runs (a word that runs divide) is cut back over them if
    the length stays; if not, the runs' own rewrites stand. rewrite may be a Python UDF: it sees columns, not elements.
    """
    p = paragraphs(runs.withColumns({"_before": F.coalesce("text", F.lit("")), "text": F.coalesce(rewrite(F.col("text")), F.lit(""))}), keys)
    p = p.withColumn("_old", F.transform("runs", lambda r: r["format"]["_before"])).withColumn("_joined", joined(F.col("runs")))
    p = p.withColumn("_whole", F.coalesce(rewrite(F.col("_joined")), F.lit(""))).withColumn("_edges", borders(F.col("runs")))
    part = lambda i: F.substring("_whole", F.get("_edges", i) + 1, F.get("_edges", i + 1) - F.get("_edges", i))
    even = (F.col("_whole") != F.col("_joined")) & (F.length("_whole") == F.length("_joined"))
    p = p.withColumn("runs", F.when(even, F.transform("runs", lambda r, i: r.withField("text", part(i)))).otherwise(F.col("runs")))
    return _changed(p, keys).withColumn("format", F.col("format").dropFields("_before"))


def _bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def with_notes_before_punctuation(runs: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The run table with note marks before punctuation, and what was moved: keys, change, note, moved, action.

    The punctuation (and white space) at the end of the last run with text before a mark goes behind the mark, into a run
    of the same format, unless the text behind begins with the same punctuation: then it was there twice and goes. A run
    that is left without text goes too. Marks in a row pass it on. Runs are numbered anew from 1; origin is the old number.
    """
    item = lambda text, note, form, run: F.struct(text.alias("text"), note.alias("note"), form.alias("format"), run.alias("origin"))
    p = paragraphs(runs, keys)
    kind = p.schema["runs"].dataType.elementType
    form, run = kind["format"].dataType.simpleString(), kind["run"].dataType.simpleString()
    start = F.struct(F.array().cast(f"array<struct<text:string,note:string,format:{form},origin:{run}>>").alias("out"), F.array().cast("array<struct<note:string,moved:string,action:string>>").alias("log"))

    none = F.lit(None).cast("string")

    def step(a: Column, x: Column) -> Column:
        own = item(x["r"]["text"], x["r"]["note"].cast("string"), x["r"]["format"], x["r"]["run"])
        as_is = F.struct(F.array_append(a["out"], own).alias("out"), a["log"].alias("log"))

        def put(p: Column) -> Column:
            prev, tail, last = p["prev"], p["tail"], p["last"]
            cut = item(F.substring(prev["text"], F.lit(1), F.length(prev["text"]) - F.length(tail)), prev["note"], prev["format"], prev["origin"])
            kept = F.filter(F.array(cut), lambda o: (o["text"] != "") | o["note"].isNotNull())
            twice = F.regexp_replace(x["behind"], f"^{tx.SPACE}+", "").startswith(p["punctuation"])
            more = F.filter(F.array(item(tail, none, prev["format"], prev["origin"])), lambda o: ~twice)
            out = F.concat(F.slice(a["out"], F.lit(1), last), kept, F.slice(a["out"], last + 2, F.size(a["out"])), F.array(own), more)
            said = F.struct(own["note"].alias("note"), tail.alias("moved"), F.when(twice, "removed_duplicate_before_footnote").otherwise("moved_before_punctuation").alias("action"))
            return F.struct(out.alias("out"), F.array_append(a["log"], said).alias("log"))

        parts = lambda p: F.struct(p["last"].alias("last"), p["prev"].alias("prev"), F.regexp_extract(p["prev"]["text"], TRAILING, 1).alias("punctuation"), F.regexp_extract(p["prev"]["text"], TRAILING, 0).alias("tail"))
        last = F.array_max(F.transform(a["out"], lambda o, i: F.when(o["text"] != "", i)))
        # Each step of this is bound to a lambda's variable, or it would be worked out wherever it is used.
        marked = _bound(last, lambda at: _bound(F.struct(at.alias("last"), F.get(a["out"], at).alias("prev")), lambda p: _bound(parts(p), lambda q: F.when(q["punctuation"] != "", put(q)).otherwise(as_is))))
        return F.when(x["r"]["note"].isNull(), as_is).otherwise(marked)

    # No mark reaches before the last solid run without one, so each such run begins a stretch that is folded by itself: few
    # runs, however long the paragraph. Slices copy whole arrays; elements are fetched by place.
    begins = F.transform("runs", lambda r, i: F.when((i == 0) | r["note"].isNull() & r["text"].rlike(SOLID), i))
    p = p.withColumn("_starts", F.filter(begins, lambda i: i.isNotNull()))
    until = lambda j: F.get("_starts", j + 1)
    own = lambda s, e: F.transform(F.sequence(s, F.coalesce(e, F.size("runs")) - 1), lambda k: F.get("runs", k))
    p = p.withColumn("_parts", F.transform("_starts", lambda s, j: F.struct(own(s, until(j)).alias("runs"), F.coalesce(F.get("runs", until(j))["text"], F.lit("")).alias("next"))))

    def folded(part: Column) -> Column:
        runs, texts = part["runs"], lambda i: F.get(F.filter(part["runs"], lambda r, k: (k > i) & (r["text"] != "")), F.lit(0))["text"]
        seen = F.transform(runs, lambda r, i: F.struct(r.alias("r"), F.when(r["note"].isNotNull(), F.coalesce(texts(i), part["next"])).otherwise("").alias("behind")))
        plain = F.struct(F.transform(runs, lambda r: item(r["text"], r["note"].cast("string"), r["format"], r["run"])).alias("out"), start["log"].alias("log"))
        return F.when(F.exists(runs, lambda r: r["note"].isNotNull()), F.aggregate(seen, start, step)).otherwise(plain)

    p = p.select(*keys, F.transform("_parts", folded).alias("done"))
    p = p.select(*keys, F.struct(F.flatten("done.out").alias("out"), F.flatten("done.log").alias("log")).alias("done"))
    out = p.select(*keys, F.posexplode_outer("done.out").alias("at", "r")).where("at is not null").select(*keys, (F.col("at") + 1).alias("run"), "r.text", "r.note", "r.format", "r.origin")
    log = p.select(*keys, F.posexplode_outer("done.log").alias("at", "c")).where("at is not null").select(*keys, (F.col("at") + 1).alias("change"), "c.note", "c.moved", "c.action")
    return out, log


def italic_fragments(runs: DataFrame, keys: list[str], italic: str = "italic") -> DataFrame:
    """keys, fragment (from 1), text: texts of neighbouring italic runs put together; runs without text are passed over.

    Gaps and islands: an italic run begins a fragment if the run with text before it is upright, and the fragments of a
    paragraph are numbered by a running count of such beginnings.
    """
    w = Window.partitionBy(*keys).orderBy("run")
    x = runs.where(F.coalesce("text", F.lit("")) != "").withColumn("_i", F.coalesce(F.col(italic), F.lit(False)))
    x = x.withColumn("_new", F.col("_i") & ~F.coalesce(F.lag("_i").over(w), F.lit(False)))
    x = x.withColumn("fragment", F.sum(F.col("_new").cast("int")).over(w)).where("_i")
    return x.groupBy(*keys, F.col("fragment").cast("int").alias("fragment")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("run", "text"))), lambda r: r["text"]), "").alias("text"))
