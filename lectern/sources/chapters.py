"""Chapters put together from the pages of a mirror: from one page that shows all verses, or from the verses' own pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import forms as fm
from lectern.functions import text as tx
from lectern.sources import html as h
from lectern.sources.tables import with_features

# Works and the number of path parts of their chapters; the page that shows a whole chapter.
CHAPTER_DEPTH = {"bg": 2, "sb": 3, "cc": 3}
PARTED_WORK, VIEW = "cc", "advanced-view"
LABEL = r"(?iu)^(?:тексты?|texts?|verses?)\s+(.+)$"


def page_place(path: Column) -> Column:
    """Where a page stands: locale, root_id, work_id, page_type, chapter_number, chapter_key, chapter_path, view_path, verse_id, path_depth.

    path: a normalised web path (`/locale/library/work/...`). A chapter has as many parts below the library as its work
    demands; one part more is a verse, fewer are works and their parts; the page of a whole chapter ends in the view's name.
    """
    parts = F.filter(F.split(F.coalesce(path, F.lit("")), "/"), lambda x: x != "")

    def of(p: Column) -> Column:
        lib = F.when(F.get(p, F.lit(1)) == "library", F.slice(p, 3, F.greatest(F.size(p) - 2, F.lit(0)))).otherwise(F.array().cast("array<string>"))
        return F.struct(p.alias("p"), lib.alias("lib"), F.try_element_at(F.create_map(*[F.lit(x) for kv in CHAPTER_DEPTH.items() for x in kv]), F.coalesce(F.get(lib, F.lit(0)), F.lit(""))).alias("depth"))

    def place(x: Column) -> Column:
        p, lib, depth = x["p"], x["lib"], x["depth"]
        n, root, last = F.size(lib), F.get(lib, F.lit(0)), F.try_element_at(lib, F.lit(-1))
        kind = (
            F.when(F.coalesce(F.get(p, F.lit(1)) != "library", F.lit(True)), "other").when(n == 0, "library_index").when(last == VIEW, "advanced_view").when(depth.isNull(), F.when(n == 1, "work").otherwise("other"))
            .when(n == 1, "work").when(n < depth, "subwork").when(n == depth, "chapter").when(n == depth + 1, "verse").otherwise("other")
        )
        chapter = F.when((last == VIEW) & (n - 1 != depth), None).when(n >= depth, F.slice(lib, F.lit(1), depth))
        above = F.concat(F.lit("/"), F.array_join(F.slice(p, 1, 2), "/"), F.lit("/"), F.array_join(chapter, "/"), F.lit("/"))
        return F.struct(
            F.coalesce(F.get(p, F.lit(0)), F.lit("")).alias("locale"), F.coalesce(root, F.lit("")).alias("root_id"), F.when(root == PARTED_WORK, F.concat_ws("/", root, F.get(lib, F.lit(1)))).otherwise(F.coalesce(root, F.lit(""))).alias("work_id"), kind.alias("page_type"),
            F.try_element_at(chapter, F.lit(-1)).alias("chapter_number"), F.when(F.size(chapter) > 1, F.array_join(F.slice(chapter, 2, 9), "/")).alias("chapter_key"), above.alias("chapter_path"), F.concat(above, F.lit(f"{VIEW}/")).alias("view_path"),
            F.when(kind == "verse", last).alias("verse_id"), n.alias("path_depth"),
        )

    # Each step is bound to a lambda's variable, so that the path is taken apart once.
    return F.get(F.transform(F.transform(F.array(parts), of), place), F.lit(0))


def label_id(label: Column) -> Column:
    """A verse's id by its label: what follows the word for text, else the label."""
    plain = F.regexp_replace(tx.clean(label), ":+$", "")
    found = F.regexp_extract(plain, LABEL, 1)
    return F.when(found != "", F.regexp_replace(F.trim(found), ":+$", "")).otherwise(plain)


def view_verses(views: DataFrame, keys: list[str], html: str = "html") -> DataFrame:
    """keys, verse_index, verse_label, heading_id, verse_path, verse_id, fragment: the verses of whole-chapter pages, each from its heading to the next."""
    body = F.when(F.col(html).rlike(r"""(?i)class=["'][^"']*\bav-verses\b"""), F.slice(F.split(html, r"(?i)(?=<h2\b)"), 2, 1 << 20)).otherwise(F.array().cast("array<string>"))
    x = views.select(*keys, F.posexplode_outer(body).alias("at", "fragment")).where("fragment is not null")
    head = F.regexp_extract("fragment", r"(?is)^<h2\b[^>]*>(.*?)</h2>", 1)
    x = x.withColumns({"verse_index": F.col("at") + 1, "verse_label": tx.clean(F.regexp_replace(head, "<[^>]*>", " ")), "heading_id": F.regexp_extract("fragment", r"(?i)^<h2\b[^>]*\bid=\"([^\"]*)\"", 1), "verse_path": fm.web_path(F.regexp_extract(head, r"(?i)href=\"([^\"]*)\"", 1))})
    return x.withColumn("verse_id", F.coalesce(page_place(F.col("verse_path"))["verse_id"], label_id(F.col("verse_label")))).drop("at")


def assembled(pages: DataFrame, path: str = "web_path", html: str = "html") -> tuple[DataFrame, DataFrame]:
    """The chapters of a table of pages, and their blocks, numbered over all verses.

    Every page of a chapter, its own, the whole view or a verse, leads to the chapter by its path alone. A chapter that
    has the view is cut at the view's headings; else its verse pages are taken in natural order; a chapter without
    either is a row with an error. It is partial if its own page links to another number of verses than were found.
    Of pages of one path the first by text counts.

    chapters: chapter_path, work_id, chapter_number, chapter_key, source_mode, title, chapter_title, lang, verse_count,
    linked_verse_count, is_partial, block_count, section_counts, kind_counts, error. blocks: chapter_path, verse_index,
    verse_id, part, source_locator, block_index and the features of blocks. Numbers come from counts by verse: a window
    sees a chapter's verses, not its blocks.
    """
    p = pages.groupBy(F.col(path).alias("path")).agg(F.min(html).alias("html")).withColumn("place", page_place(F.col("path")))
    p = p.where(F.col("place.chapter_path").isNotNull() & F.col("place.page_type").isin("chapter", "advanced_view", "verse")).select("path", "html", "place.*")
    has = p.groupBy("chapter_path").agg(F.max(F.col("page_type") == "advanced_view").alias("has_view"))
    p = p.join(has, "chapter_path")
    view = p.where("page_type = 'advanced_view'")
    own = view_verses(view, ["chapter_path", "path"]).withColumn("source_mode", F.lit("advanced_view")).withColumn("source_locator", F.when(F.col("verse_path") != "", F.col("verse_path")).otherwise(F.col("path")))
    apart = p.where("page_type = 'verse' and not has_view")
    number = F.row_number().over(Window.partitionBy("chapter_path").orderBy(fm.verse_key(F.col("verse_id"))))
    apart = apart.select("chapter_path", number.alias("verse_index"), F.concat(F.lit("TEXT "), "verse_id").alias("verse_label"), "verse_id", F.col("path").alias("source_locator"), F.col("html").alias("fragment"), F.lit("verse_pages").alias("source_mode"))
    columns = ["chapter_path", "verse_index", "verse_label", "verse_id", "source_locator", "source_mode", "fragment"]
    verses = own.select(*columns).unionByName(apart.select(*columns)).withColumn("key", F.concat_ws(" ", "chapter_path", F.col("verse_index").cast("string")))
    # Only what stands in a section is the verse's; titles and links around it are not.
    found = h.html_blocks(verses.select("key", "fragment"), "key", "fragment").where("error is null and section <> 'body'")
    found = with_features(found.withColumn("block_index", F.row_number().over(Window.partitionBy("key").orderBy("block_index"))))
    found = found.withColumn("kind", tx.section_kind(F.col("section"), F.col("text"), F.col("kind")))
    counts = found.groupBy("key").agg(F.count("*").alias("n"))
    before = F.sum(F.coalesce("n", F.lit(0))).over(Window.partitionBy("chapter_path").orderBy("verse_index").rowsBetween(Window.unboundedPreceding, -1))
    verses = verses.drop("fragment").join(counts, "key", "left").withColumn("before", F.coalesce(before, F.lit(0)))
    blocks = found.withColumnRenamed("block_index", "own_index").join(verses, "key").withColumn("block_index", F.col("before") + F.col("own_index"))
    blocks = blocks.withColumn("part", F.concat(F.lit("verse:"), "verse_id")).drop("key", "own_index", "before", "n", "error")
    tally = lambda c: blocks.groupBy("chapter_path", c).agg(F.count("*").alias("n")).groupBy("chapter_path").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(c, "n")))).alias(f"{c}_counts"))
    size = verses.groupBy("chapter_path").agg(F.count("*").alias("verse_count"), F.sum(F.coalesce("n", F.lit(0))).alias("block_count"))
    # What a chapter says of itself stands on its own page, or on the view; both are one row a chapter.
    said = p.where((F.col("page_type") == "advanced_view") | (F.col("page_type") == "chapter") & ~F.col("has_view"))
    links = F.array_distinct(F.transform(h.absolute_links(F.col("html")), fm.web_path))
    mine = F.size(F.filter(F.transform(links, page_place), lambda x: F.coalesce((x["page_type"] == "verse") & (x["chapter_path"] == F.col("chapter_path")), F.lit(False))))
    said = said.select("chapter_path", F.nullif(h.first_tag(F.col("html"), "title"), F.lit("")).alias("title"), F.nullif(h.first_tag(F.col("html"), "h1"), F.lit("")).alias("h1"), F.nullif(h.language(F.col("html")), F.lit("")).alias("lang"), mine.alias("links"))
    heads = p.groupBy("chapter_path").agg(*[F.first(c).alias(c) for c in ("work_id", "chapter_number", "chapter_key", "locale")], F.max("has_view").alias("has_view"))
    x = heads.join(size, "chapter_path", "left").join(said, "chapter_path", "left").join(tally("section"), "chapter_path", "left").join(tally("kind"), "chapter_path", "left")
    n = F.coalesce("verse_count", F.lit(0))
    linked = F.when(F.col("has_view"), n).otherwise(F.coalesce("links", F.lit(0)))
    return x.select(
        "chapter_path", "work_id", "chapter_number", "chapter_key", F.when(F.col("has_view"), "advanced_view").otherwise("verse_pages").alias("source_mode"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("h1", "title", F.lit("")).alias("chapter_title"), F.coalesce("lang", "locale").alias("lang"),
        n.alias("verse_count"), linked.cast("long").alias("linked_verse_count"), (~F.col("has_view") & (linked > 0) & (linked != n)).alias("is_partial"), F.coalesce("block_count", F.lit(0)).alias("block_count"), "section_counts", "kind_counts",
        F.when(n == 0, F.when(F.col("has_view"), "the view has no verses").otherwise("no verse pages")).alias("error"),
    ), blocks
