"""Run-level rewriting: messages cut into runs of seven characters, and into words with note marks between."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import diacritics as di
from lectern.operators import runs as rn
from lectern.sources.tables import table

from .registry import registry
from .rules import _plain_sql

QUERIES, ORACLE, query = registry()

_SAID = "text || ' БГ 2.' || (turn + 11) || ', Bg. 3.' || turn || ' и шб 1.1.' || conv_id || ' (Bg 4.' || conv_id || ')'"
_KEYS = ["conv_id", "turn"]


def _cut(text: str):
    """Runs of seven characters of a text."""
    return F.expr(f"transform(sequence(0, cast(greatest(length({text}) - 1, 0) div 7 as int)), k -> substring({text}, 7 * k + 1, 7))")


def message_runs(spark, sf_dir, said: str = _SAID):
    m = table(spark, sf_dir, "conversations").where("text is not null").selectExpr("conv_id", "turn", f"{said} AS said")
    return m.select(*_KEYS, F.posexplode(_cut("said")).alias("at", "text")).select(*_KEYS, (F.col("at") + 1).alias("run"), "text", F.lit(None).cast("string").alias("note"), (F.col("at") % 3 == 0).alias("bold"))


# In SQL: both rewrites over the runs, then over the joined text where the length stays.
_BEFORE, _NB = r"(^|[^\p{L}\p{N}_])", "' || chr(160) || '"


def _node_sql(c: str) -> str:
    bg = rf"regexp_replace({c}, '(?i){_BEFORE}(?:бг|bg)\.?\s*(\d+)\s*\.\s*(\d+)', '\1БГ{_NB}\2.\3', 'g')"
    return rf"regexp_replace({bg}, '(?i){_BEFORE}(?:шб|sb)\.?\s*(\d+)\s*\.\s*(\d+)\s*\.\s*(\d+)', '\1ШБ{_NB}\2.\3.\4', 'g')"


_EVEN = rf"regexp_replace(regexp_replace(j, '(?i){_BEFORE}(?:бг|bg)\s(\d+\.\d+)', '\1БГ{_NB}\2', 'g'), '(?i){_BEFORE}(?:шб|sb)\s(\d+\.\d+\.\d+)', '\1ШБ{_NB}\2', 'g')"
_RUNS_SQL = f"m AS (SELECT conv_id, turn, SAID AS said FROM conversations WHERE text IS NOT NULL), r AS (SELECT conv_id, turn, unnest(range(1, (greatest(length(said) - 1, 0) // 7) + 2)) AS run, unnest(list_transform(range(0, (greatest(length(said) - 1, 0) // 7) + 1), lambda k: substr(said, 7 * k + 1, 7))) AS before FROM m)"


def _cut_sql(node: str, whole: str, said: str) -> str:
    return f"""WITH {_RUNS_SQL.replace('SAID', said)}, o AS (SELECT *, {node} AS own FROM r),
p AS (SELECT *, string_agg(own, '' ORDER BY run) OVER (PARTITION BY conv_id, turn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS j, coalesce(sum(length(own)) OVER (PARTITION BY conv_id, turn ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins FROM o),
w AS (SELECT *, {whole} AS whole FROM p), c AS (SELECT conv_id, turn, run, before, CASE WHEN length(whole) = length(j) THEN substr(whole, begins + 1, length(own)) ELSE own END AS after FROM w)
SELECT conv_id, turn, run, before, after FROM c WHERE after <> before"""


@query(_cut_sql(_node_sql("before"), _EVEN, _SAID))
def run_references(spark, sf_dir):
    """Runs whose text changes as references become canonical, within runs and across them."""
    x = rn.with_canonical_references(message_runs(spark, sf_dir), _KEYS)
    return x.where("text <> before").select(*_KEYS, "run", "before", F.col("text").alias("after"))


_MARKED = "text || ' Говинда̄ ачāрйа и санн̃йаси Мāйāпура ' || turn || ' гопāлы'"


@query(_cut_sql(_plain_sql("before"), _plain_sql("j"), _MARKED))
def run_dediacritized(spark, sf_dir):
    """Runs whose text loses its marks, words that runs divide included."""

    def plain(c):
        # Plain ASCII stays as it is; only other texts go to Python.
        return F.coalesce(di.without_marks(F.when(c.rlike("[^\\x00-\\x7F]"), c)), c)

    x = rn.with_plain_text(message_runs(spark, sf_dir, _MARKED), _KEYS, plain)
    return x.where("text <> before").select(*_KEYS, "run", "before", F.col("text").alias("after"))


# ---- note marks: every word of a message is a run, some with punctuation, some with one or two marks behind ----------

_WORDS = "list_filter(list_transform(string_split(coalesce(text, ''), ' '), lambda x: regexp_replace(x, '[^A-Za-z]', '', 'g')), lambda x: x <> '')"
_WORD_SQL = f"""WITH w AS (SELECT conv_id, turn, unnest({_WORDS}) AS word, unnest(range(1, len({_WORDS}) + 1)) AS i FROM conversations),
t AS (SELECT conv_id, turn, i, CASE WHEN i % 5 = 0 THEN '.' ELSE '' END || word || CASE (3 * i + conv_id) % 4 WHEN 0 THEN '.' WHEN 1 THEN ', ' ELSE ' ' END AS text, CASE WHEN (i + turn) % 6 = 0 THEN 2 WHEN (i + turn) % 3 = 0 THEN 1 ELSE 0 END AS marks FROM w),
n AS (SELECT *, regexp_extract(text, '([.,;:!?…]+)\\s*$', 1) AS p, regexp_extract(text, '[.,;:!?…]+\\s*$') AS tail, coalesce(lead(text) OVER (PARTITION BY conv_id, turn ORDER BY i), '') AS behind FROM t),
h AS (SELECT *, marks > 0 AND p <> '' AS hit, starts_with(ltrim(behind), p) AS twice FROM n)
"""
_LETTERS = "[^A-Za-z]"


def word_runs(spark, sf_dir):
    """Words of messages as runs, with empty runs that hold note marks behind some of them."""
    m = table(spark, sf_dir, "conversations")
    words = F.filter(F.transform(F.split(F.coalesce("text", F.lit("")), " "), lambda x: F.regexp_replace(x, _LETTERS, "")), lambda x: x != "")
    w = m.select(*_KEYS, F.posexplode(words).alias("i", "word")).withColumn("i", F.col("i") + 1)
    i = F.col("i")
    end = F.when((3 * i + F.col("conv_id")) % 4 == 0, ".").when((3 * i + F.col("conv_id")) % 4 == 1, ", ").otherwise(" ")
    text = F.concat(F.when(i % 5 == 0, ".").otherwise(""), "word", end)
    marks = F.when((i + F.col("turn")) % 6 == 0, 2).when((i + F.col("turn")) % 3 == 0, 1).otherwise(0)
    mark = lambda k: F.struct((3 * i + k).alias("run"), F.lit("").alias("text"), F.concat_ws(".", i.cast("string"), F.lit(str(k))).alias("note"))
    own = F.struct((3 * i).alias("run"), text.alias("text"), F.lit(None).cast("string").alias("note"))
    return w.select(*_KEYS, F.explode(F.slice(F.array(own, mark(1), mark(2)), F.lit(1), marks + 1)).alias("r")).select(*_KEYS, "r.run", "r.text", "r.note", F.lit("plain").alias("font"))


@query(_WORD_SQL + "SELECT conv_id, turn, i || '.1' AS note, tail AS moved, CASE WHEN twice THEN 'removed_duplicate_before_footnote' ELSE 'moved_before_punctuation' END AS action FROM h WHERE hit UNION ALL SELECT conv_id, turn, i || '.2', tail, 'moved_before_punctuation' FROM h WHERE hit AND marks = 2 AND NOT twice")
def note_moves(spark, sf_dir):
    """What goes from before a note's mark to behind it, or goes altogether."""
    return rn.with_notes_before_punctuation(word_runs(spark, sf_dir), _KEYS)[1].select(*_KEYS, "note", "moved", "action")


@query(
    _WORD_SQL
    + """, o AS (SELECT conv_id, turn, i, 0 AS k, CASE WHEN hit THEN text[1 : length(text) - length(tail)] ELSE text END AS text, NULL AS note FROM h UNION ALL SELECT conv_id, turn, i, 1, '', i || '.1' FROM h WHERE marks > 0
UNION ALL SELECT conv_id, turn, i, 2, '', i || '.2' FROM h WHERE marks = 2 UNION ALL SELECT conv_id, turn, i, 3, tail, NULL FROM h WHERE hit AND NOT twice)
SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id, turn ORDER BY i, k) AS run, text, note FROM o"""
)
def note_runs(spark, sf_dir):
    """The runs of every message with note marks before punctuation."""
    x = rn.with_notes_before_punctuation(word_runs(spark, sf_dir), _KEYS)[0]
    return x.select(*_KEYS, F.col("run").cast("long").alias("run"), "text", "note")


@query(
    _WORD_SQL
    + """, r AS (SELECT *, (i + conv_id) % 3 = 0 OR i % 7 < 2 AS italic FROM t), s AS (SELECT *, italic AND NOT coalesce(lag(italic) OVER o, false) AS new FROM r WINDOW o AS (PARTITION BY conv_id, turn ORDER BY i)),
f AS (SELECT *, sum(new::INT) OVER (PARTITION BY conv_id, turn ORDER BY i) AS fragment FROM s) SELECT conv_id, turn, fragment::INT AS fragment, string_agg(text, '' ORDER BY i) AS text FROM f WHERE italic GROUP BY conv_id, turn, fragment"""
)
def italic_runs(spark, sf_dir):
    """Fragments of italic runs that stand together; runs that hold only a mark do not part them."""
    i = F.floor(F.col("run") / 3)
    x = word_runs(spark, sf_dir).withColumn("italic", ((i + F.col("conv_id")) % 3 == 0) | (i % 7 < 2))
    return rn.italic_fragments(x, _KEYS)
