"""Formatting as maps of properties: differences from what is wanted, and what is kept, mapped or taken away, with counters.

Paragraphs, runs and styles have `props`, a map from a property's name to its value (empty for one that is just there).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Character styles, properties that can be switched off, and wanted properties by style: left indent in cm, centred, italic.
ITALIC, BOLD = "Char Курсив", "Char Полужирный"
KEPT_STYLES = (ITALIC, BOLD, "footnote reference", "endnote reference")
SYSTEM_STYLES = ("Endnote Reference", "Footnote Reference")
SWITCHES = ("b", "bCs", "i", "iCs", "u", "strike", "dstrike", "caps", "smallCaps", "vanish")
STYLE_RULES = {"Шлока": (2.0, True, True), "Шлока в цитате": (3.0, True, True), "Перевод шлоки": (2.0, False, False), "Цитата 1": (2.0, False, False), "Цитата 2": (3.0, False, False)}


def _names() -> Column:
    return F.array().cast("array<string>")


def is_on(props: Column, *names: str) -> Column:
    """Whether one of the properties is there and not switched off."""
    one = lambda n: F.coalesce(~F.lower(F.try_element_at(props, F.lit(n))).isin("0", "false", "off"), F.lit(False))
    out = one(names[0])
    for n in names[1:]:
        out = out | one(n)
    return out


def overrides(props: Column, own: Sequence[str]) -> Column:
    """Sorted names of direct properties but for `own`, the ones that are no overrides; switches only if they are on."""
    off = lambda k, v: k.isin(*SWITCHES) & F.lower(v).isin("0", "false", "off")
    return F.coalesce(F.array_sort(F.map_keys(F.map_filter(props, lambda k, v: ~k.isin(*own) & ~off(k, F.coalesce(v, F.lit("")))))), _names())


def differences(have: Column, want: Column) -> Column:
    """A map from each property whose value differs to (have, want); null stands for none."""
    both = F.map_zip_with(have, want, lambda k, a, b: F.struct(a.alias("have"), b.alias("want")))
    return F.map_filter(both, lambda k, v: ~v["have"].eqNullSafe(v["want"]))


def wanted(style: Column) -> Column:
    """The properties that a paragraph style should have, by its name; null if no rule speaks of it. Numbered quotations are indented by level."""

    def props(cm: Column, centred: Column | bool, italic: Column | bool) -> Column:
        always = [F.struct(F.lit("left").alias("k"), F.bround(cm / 2.54 * 1440).cast("int").cast("string").alias("v")), F.struct(F.lit("firstLine").alias("k"), F.lit("0").alias("v"))]
        more = [F.when(F.lit(centred), F.struct(F.lit("jc").alias("k"), F.lit("center").alias("v"))), *[F.when(F.lit(italic), F.struct(F.lit(n).alias("k"), F.lit("").alias("v"))) for n in ("i", "iCs")]]
        return F.map_from_entries(F.array_compact(F.array(*always, *more)))

    level = lambda pattern: F.regexp_extract(style, pattern, 1).try_cast("double")
    quote, verse = level(r"^Цитата\s+(\d+)$"), level(r"^Шлока в цитате\s+(\d+)$")
    out = F.when(quote.isNotNull(), props(quote + 1, False, False)).when(verse.isNotNull(), props(verse + 1, True, True))
    for name, (cm, centred, italic) in STYLE_RULES.items():
        out = out.when(style == name, props(F.lit(cm), centred, italic))
    return out


def configured_styles(styles: DataFrame, file: str = "source_path") -> DataFrame:
    """file, style_name, props, changed, is_new: each file's styles as the rules want them; styles that a file lacks are new.

    Only the properties that rules speak of (indents, alignment, slant) are replaced; others stay.
    """
    spoken = ("left", "firstLine", "jc", "i", "iCs")
    files = styles.select(file).distinct()
    # A row for each file and rule: five a file.
    missing = files.withColumn("style_name", F.explode(F.array(*map(F.lit, STYLE_RULES)))).join(styles.select(file, "style_name"), [file, "style_name"], "left_anti")
    x = styles.select(file, "style_name", "props", F.lit(False).alias("is_new")).unionByName(missing.withColumns({"props": F.expr("cast(map() as map<string,string>)"), "is_new": F.lit(True)}))
    want = wanted(F.col("style_name"))
    x = x.withColumn("want", want)
    changed = differences(F.map_filter("props", lambda k, v: k.isin(*spoken)), F.col("want"))
    after = F.map_concat(F.map_filter("props", lambda k, v: ~k.isin(*spoken)), F.col("want"))
    none = F.expr("cast(map() as map<string,struct<have:string,want:string>>)")
    return x.select(file, "style_name", F.coalesce(F.when(F.col("want").isNotNull(), after), F.col("props")).alias("props"), F.coalesce(F.when(F.col("want").isNotNull(), changed), none).alias("changed"), "is_new")


def enforced_paragraphs(paragraphs: DataFrame, kept: Sequence[str] = ("pStyle", "sectPr")) -> DataFrame:
    """paragraphs with their style and section only, and `removed`: the names of direct properties that went."""
    x = paragraphs.withColumn("removed", F.coalesce(F.map_keys(F.map_filter("props", lambda k, v: ~k.isin(*kept))), _names()))
    return x.withColumn("props", F.map_filter("props", lambda k, v: k.isin(*kept)))


def enforced_runs(runs: DataFrame, styles: DataFrame, file: str = "source_path", italic_id: str = ITALIC, bold_id: str = BOLD) -> DataFrame:
    """runs with a character style only, `removed` (names of direct properties), `mapped` (old->new) and `removed_style`.

    A style of the house stays; one that is italic and not bold, or bold and not italic, becomes the house's; any other
    goes. styles: file, style_id, style_name, props; an unknown id counts as its own name, without properties.
    """
    s = styles.select(F.col(file).alias("_f"), F.col("style_id").alias("_id"), F.coalesce("style_name", "style_id").alias("_name"), is_on(F.col("props"), "i", "iCs").alias("_i"), is_on(F.col("props"), "b", "bCs").alias("_b"))
    x = runs.withColumn("_style", F.try_element_at("props", F.lit("rStyle")))
    x = x.join(s, (F.col(file) == F.col("_f")) & (F.col("_style") == F.col("_id")), "left")
    name, i, b = F.coalesce("_name", "_style"), F.coalesce("_i", F.lit(False)), F.coalesce("_b", F.lit(False))
    to = F.when(F.col("_style").isNull(), None).when(name.isin(*KEPT_STYLES), F.col("_style")).when(i & ~b, italic_id).when(b & ~i, bold_id)
    house = F.when(i & ~b, ITALIC).when(b & ~i, BOLD)
    x = x.withColumns({
        "removed": F.coalesce(F.map_keys(F.map_filter("props", lambda k, v: k != "rStyle")), _names()),
        "mapped": F.when(F.col("_style").isNotNull() & ~name.isin(*KEPT_STYLES) & house.isNotNull(), F.concat(name, F.lit("->"), house)),
        "removed_style": F.when(F.col("_style").isNotNull() & to.isNull(), name), "_to": to,
    })
    return x.withColumn("props", F.when(F.col("_to").isNotNull(), F.create_map(F.lit("rStyle"), F.col("_to"))).otherwise(F.expr("cast(map() as map<string,string>)"))).drop("_f", "_id", "_name", "_i", "_b", "_style", "_to")


def normalized_runs(runs: DataFrame, names: dict[str, str], plain: Sequence[str] = ("", "Default Paragraph Font")) -> DataFrame:
    """runs (char_style: a name; props) with `outcome`: named emphasis for manual one.

    A character style that `names` maps becomes that one; a run in a plain style that is italic, or bold, gets the
    house's style and loses the properties; both at once are left to an editor (skipped_combined_emphasis).
    """
    i, b = is_on(F.col("props"), "i", "iCs"), is_on(F.col("props"), "b", "bCs")
    style = F.coalesce("char_style", F.lit(""))
    mapped = F.try_element_at(F.create_map(*[F.lit(v) for kv in names.items() for v in kv]), style) if names else F.lit(None).cast("string")
    free = mapped.isNull() & style.isin(*plain)
    to = F.coalesce(mapped, F.when(free & i & ~b, ITALIC).when(free & b & ~i, BOLD))
    gone = F.when(to == ITALIC, F.array(F.lit("i"), F.lit("iCs"))).when(to == BOLD, F.array(F.lit("b"), F.lit("bCs"))).otherwise(_names())
    outcome = F.when(to == ITALIC, "converted_manual_italic").when(to == BOLD, "converted_manual_bold").when(to.isNotNull(), "remapped").when(free & i & b, "skipped_combined_emphasis")
    x = runs.withColumns({"_to": to, "_gone": gone, "outcome": outcome})
    return x.withColumns({"props": F.map_filter("props", lambda k, v: ~F.array_contains(F.col("_gone"), k)), "char_style": F.coalesce("_to", "char_style")}).drop("_to", "_gone")


def counters(df: DataFrame, buckets: dict[str, Column]) -> DataFrame:
    """bucket, name, n over arrays of names; counted in each task before the shuffle."""
    named = lambda b: lambda v: F.struct(F.lit(b).alias("bucket"), v.alias("name"))
    every = F.flatten(F.array(*[F.transform(F.coalesce(c, _names()), named(b)) for b, c in buckets.items()]))
    return df.select(F.explode_outer(every).alias("x")).where("x is not null").groupBy("x.bucket", "x.name").agg(F.count("*").alias("n"))


def _tally(names: Column) -> Column:
    """Names and how often each is in an array, as a map in order."""
    return F.map_from_entries(F.transform(F.array_sort(F.array_distinct(names)), lambda k: F.struct(k.alias("k"), F.size(F.filter(names, lambda v: v == k)).alias("n"))))


def audit(paragraphs: DataFrame, runs: DataFrame, keys: list[str], foreign_font: str, paragraph_styles: Sequence[str] = (), run_styles: Sequence[str] = (ITALIC, BOLD)) -> DataFrame:
    """keys, kind, counts: findings of a document's formatting, one of a kind for each paragraph, with counters by name.

    paragraph_override: direct properties. run_override, manual_emphasis_without_char_style, gaura_times_run: over the
    runs with text. noncanonical_paragraph_style, noncanonical_character_style: styles that the house does not have.
    paragraphs: keys, style_name, props; runs: keys, text, char_style, fonts, props.
    """
    whole = overrides(F.col("props"), ("pStyle", "sectPr"))
    style = F.coalesce("style_name", F.lit(""))
    odd = F.when((style != "") & ~style.isin(*paragraph_styles), F.array(style)).otherwise(_names())
    by_paragraph = paragraphs.select(*keys, F.explode_outer(F.array(F.struct(F.lit("paragraph_override").alias("kind"), whole.alias("names")), F.struct(F.lit("noncanonical_paragraph_style").alias("kind"), odd.alias("names")))).alias("x")).select(*keys, "x.kind", "x.names")
    r = runs.where(F.trim(F.coalesce("text", F.lit(""))) != "")
    own, char = overrides(F.col("props"), ("rStyle",)), F.coalesce("char_style", F.lit(""))
    manual = F.array_compact(F.array(F.when(F.arrays_overlap(own, F.array(F.lit("i"), F.lit("iCs"))) & (char != ITALIC), F.lit("italic")), F.when(F.arrays_overlap(own, F.array(F.lit("b"), F.lit("bCs"))) & (char != BOLD), F.lit("bold"))))
    font = F.when(F.array_contains(F.coalesce("fonts", _names()), foreign_font), F.array(F.lit(foreign_font))).otherwise(_names())
    strange = F.when((char != "") & ~char.isin(*run_styles, *SYSTEM_STYLES), F.array(char)).otherwise(_names())
    kinds = {"run_override": own, "manual_emphasis_without_char_style": manual, "gaura_times_run": font, "noncanonical_character_style": strange}
    by_run = r.select(*keys, F.explode_outer(F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("names")) for k, c in kinds.items()])).alias("x")).select(*keys, "x.kind", "x.names").where(F.size("names") > 0)
    by_run = by_run.groupBy(*keys, "kind").agg(F.flatten(F.collect_list("names")).alias("names"))
    return by_paragraph.where(F.size("names") > 0).unionByName(by_run).select(*keys, "kind", _tally(F.col("names")).alias("counts"))
