"""Block tables from what a table or file holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions import text as tx


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_features(df: DataFrame, style: Column | None = None, notes: Column | None = None) -> DataFrame:
    """Adds what is derived from a block's cleaned `text`."""
    t = F.col("text")
    df = df.withColumns({"kind": tx.kind(t, style), "word_count": tx.word_count(t), "char_count": F.length(t), "digit_signature": tx.digit_signature(t), "has_quote_marks": tx.has_quote_marks(t), "translit_score": tx.translit_score(t), "footnote_refs": notes if notes is not None else F.lit(0)})
    return df.withColumn("signature", tx.signature(F.col("kind"), F.col("word_count"), F.col("footnote_refs"), F.col("digit_signature"), tx.translit_score_to_three(t)))


def text_blocks(df: DataFrame, keys: list[str], delimiter: str = r"\n", text: str = "text", drop_page_numbers: bool = False) -> DataFrame:
    """A row for each non-empty block of a text column.

    paragraph_index is the block's raw place, from 1; block_index counts non-empty blocks only. drop_page_numbers
    leaves out blocks of at most three digits, as form-feed separated text has.
    """
    parts = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), delimiter), lambda p, i: F.struct((i + 1).alias("paragraph_index"), p.alias("raw_text"), tx.clean(p).alias("text")))
    keep = F.filter(parts, lambda b: (b["text"] != "") & (~b["text"].rlike(r"^\d{1,3}$") if drop_page_numbers else F.lit(True)))
    return df.select(*keys, F.posexplode(keep).alias("block_index", "b")).select(*keys, (F.col("block_index") + 1).alias("block_index"), "b.*")


def text_files(spark: SparkSession, path: str, glob: str = "*.{txt,md}", recursive: bool = True, delimiter: str = r"\n[ \t]*\n") -> DataFrame:
    """Blocks of plain text files: separated by blank lines. chapter_key is the file name's leading number or all of it."""
    df = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", glob).text(path, wholetext=True).withColumn("source_path", F.col("_metadata.file_path"))
    stem = F.regexp_replace(F.element_at(F.split("source_path", "/"), -1), r"\.[^.]*$", "")
    return with_features(text_blocks(df.withColumn("chapter_key", tx.numbered_stem(stem)), ["source_path", "chapter_key"], delimiter, "value"))


BLOCK_JSON = "version int, source_path string, source_format string, blocks array<struct<index:int,part:string,section:string,text:string,style_name:string,kind:string,word_count:int,char_count:int,footnote_refs:int,digit_signature:string,has_quote_marks:boolean,translit_score:int,verse_id:string,source_locator:string>>"


def json_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of normalised documents in JSON; what is missing, empty or zero is derived anew from the text."""
    df = spark.read.schema(BLOCK_JSON).option("multiLine", True).json(path)
    df = df.select("source_path", F.posexplode("blocks").alias("pos", "b")).select("source_path", "pos", "b.*")
    t = tx.clean(F.col("text"))
    given = lambda c, new: F.coalesce(F.when(F.col(c).cast("string").isin("", "0", "false"), None).otherwise(F.col(c)), new)
    return df.select("source_path", given("index", F.col("pos") + 1).alias("block_index"), "part", "section", t.alias("text"), "style_name", given("kind", tx.kind(t, F.col("style_name"))).alias("kind"), given("word_count", tx.word_count(t)).alias("word_count"), given("char_count", F.length(t)).alias("char_count"), F.coalesce("footnote_refs", F.lit(0)).alias("footnote_refs"), given("digit_signature", tx.digit_signature(t)).alias("digit_signature"), given("has_quote_marks", tx.has_quote_marks(t)).alias("has_quote_marks"), given("translit_score", tx.translit_score(t)).alias("translit_score"), "verse_id", "source_locator")


def csv_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).na.fill("")


def glossary_policy(spark: SparkSession, path: str) -> DataFrame:
    """Approved terms: list columns split at pipes, automation in lower case and `skip` by default; rows without a form go."""
    df = csv_rows(spark, path)
    split = lambda c: F.filter(F.transform(F.split(F.col(c), r"\|"), lambda x: F.trim(x)), lambda x: x != "") if c in df.columns else F.array().cast("array<string>")
    lists = {c: split(c) for c in ("lemma_en", "allowed_forms", "discouraged_forms")}
    automation = F.lower(F.trim(F.col("italic_automation"))) if "italic_automation" in df.columns else F.lit("")
    return df.withColumns(lists).withColumn("italic_automation", F.when(automation == "", "skip").otherwise(automation)).where(F.trim("approved_form") != "")


def hint_rules(spark: SparkSession, path: str) -> DataFrame:
    """Hint rules in file order; those without type or value go."""
    schema = "input string, rules array<struct<match:struct<type:string,value:string>,action:string,style:string,note:string>>"
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    df = df.select(F.posexplode("rules").alias("rule_pos", "r"))
    return df.select("rule_pos", F.col("r.match.type").alias("match_type"), F.col("r.match.value").alias("value"), F.coalesce("r.action", F.lit("set_style")).alias("action"), F.col("r.style").alias("style"), F.coalesce("r.note", F.lit("")).alias("note")).where("match_type is not null and value is not null")


def labelled_union(sources: dict[str, DataFrame]) -> DataFrame:
    """Sources below each other with their label and place in the given order."""
    out = None
    for pos, (label, df) in enumerate(sources.items()):
        df = df.withColumns({"source_label": F.lit(label), "source_pos": F.lit(pos)})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def first_of(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in an explicit order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
