"""Term candidates: what hints say of a term by an index of prefixes, and candidates from entries and italics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import forms as fm
from lectern.functions import hints as hn
from lectern.operators.folders import new_folder, stored

OTHER = "other"


def hint_table(spark: SparkSession, hints: dict[str, tuple[str, ...]] = hn.HINTS, no_base: tuple[str, ...] = hn.NO_BASE) -> DataFrame:
    """category, category_rank, rank, hint, norm, base: hints in order; base: whether longer words may be reduced to it."""
    rows, skip = [], {hn.plain_key(h) for h in no_base}
    for k, (category, stems) in enumerate(hints.items()):
        rows += [(category, k, len(rows) + i, h, hn.plain_key(h), hn.plain_key(h) not in skip) for i, h in enumerate(stems)]
    return spark.createDataFrame([r for r in rows if r[4]], "category string, category_rank int, rank int, hint string, norm string, base boolean")


def _prefixes(word: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(word)), lambda n: F.substring(word, F.lit(1), n))


def described(terms: DataFrame, hints: DataFrame, term: str = "term") -> DataFrame:
    """Each different term with key, category and base: the hint that stands for it, empty if none does.

    Terms are met with hints by an equi-join: each word of a key, and each part between hyphens, is put down under all its
    prefixes, a hint under itself; so a word meets the hints that begin it and no others, however many there are. Hints of
    several words are met by their first one and then looked for as a whole. The category is that of the first list of
    hints that has one. The base is the first hint, in order, that is the whole key, or begins it (with five letters; with
    six, less its last vowel), unless the key has a hyphen and the hint has none.
    """
    t = terms.select(F.col(term).alias("term")).where("term is not null").distinct().withColumn("key", hn.normal_key(F.col("term")))
    stems, phrases = hints.where(~F.col("norm").contains(" ")), hints.where(F.col("norm").contains(" "))
    words = t.select("term", F.explode(F.array_distinct(F.flatten(F.transform(hn.tokens(F.col("key")), _prefixes)))).alias("norm"))
    by_stem = words.join(stems, "norm").select("term", "category_rank", "category")
    runs = t.select("term", "key", F.explode(F.array_distinct(F.regexp_extract_all("key", F.lit("([a-zа-яё]+)"), 1))).alias("first"))
    whole = F.concat(F.lit(r"(?<![a-zа-яё])\Q"), "norm", F.lit(r"\E(?![a-zа-яё])"))
    by_phrase = runs.join(phrases.withColumn("first", F.regexp_extract("norm", "([a-zа-яё]+)", 1)), "first").where(F.regexp_count("key", whole) > 0).select("term", "category_rank", "category")
    category = by_stem.unionByName(by_phrase).groupBy("term").agg(F.min_by("category", "category_rank").alias("category"))
    # Bases: a hint stands in the index as a whole and, from six letters on, without its last vowel.
    short = stems.where((F.length("norm") >= 6) & F.col("norm").rlike(f"[{hn.VOWELS}]$")).withColumn("norm", F.expr("substring(norm, 1, length(norm) - 1)")).withColumn("cut", F.lit(True))
    index = stems.withColumn("cut", F.lit(False)).unionByName(short).withColumn("hyphen", F.col("norm").contains("-"))
    single = t.where((F.col("key") != "") & ~F.col("key").contains(" ")).select("term", "key", F.explode(_prefixes(F.col("key"))).alias("norm"))
    same = (F.col("key") == F.col("norm")) & ~F.col("cut")
    fits = same | (~F.col("key").contains("-") | F.col("hyphen")) & F.col("base") & (F.col("cut") | (F.length("norm") >= 5))
    base = single.join(index, "norm").where(fits).groupBy("term").agg(F.min_by("hint", "rank").alias("base"))
    x = t.join(category, "term", "left").join(base, "term", "left")
    return x.select("term", "key", F.coalesce("category", F.lit(OTHER)).alias("category"), F.coalesce("base", F.lit("")).alias("base"))


def from_blocks(blocks: DataFrame, hints: DataFrame, keys: list[str], text: str = "text", italics: str = "italics") -> DataFrame:
    """keys, kind, italic, pos, variant, context, key, category: candidates of each block, headwords before italic fragments.

    Headwords come from blocks of the form `Word — meaning`; both kinds go through the guards, and what no hint knows
    goes. key: that of the term's base, else its own. Terms are described once each, whatever number of blocks has them.
    """
    spark = blocks.sparkSession
    # Only a block with a dash, or an entity that may be one, explains a term; others are not cleaned.
    b = blocks.withColumn("_clean", fm.candidate_text(F.when(F.col(text).rlike("[—–&-]"), F.col(text))))
    one = lambda kind, italic: lambda v, i: F.struct(F.lit(kind).alias("kind"), F.lit(italic).alias("italic"), i.alias("pos"), v.alias("variant"))
    found = F.concat(F.transform(hn.headwords(F.col("_clean")), one("glossary_headword", False)), F.transform(F.coalesce(italics, F.array().cast("array<string>")), one("italic", True)))
    # The outer form, as the inner one makes the optimiser ask for the array's size first, and work it out twice.
    x = b.select(*keys, F.substring("_clean", 1, 120).alias("context"), F.explode_outer(found).alias("x")).select(*keys, "context", "x.*")
    x = x.withColumn("variant", F.when(F.col("italic"), fm.candidate_text(F.when(F.col("italic"), F.col("variant")))).otherwise(F.col("variant")))
    x = x.withColumn("context", F.when(F.col("italic"), F.substring("variant", 1, 120)).otherwise(F.col("context")))
    # Written once: what describes the terms, and what is then joined with it, would each read all blocks anew.
    x = stored(x.where(hn.may_be_term(F.col("variant"), F.col("kind"))), new_folder(spark, "found"))
    known = described(x, hints, "variant").where(F.col("category") != OTHER)
    known = known.withColumn("key", F.when(F.col("base") != "", hn.normal_key(F.col("base"))).otherwise(F.col("key"))).where("key <> ''")
    return x.join(known.select(F.col("term").alias("variant"), "key", "category"), "variant").select(*keys, "kind", "italic", "pos", "variant", "context", "key", "category")
