"""Paragraph styles by rules that look at the styles given before, and hints that overrule them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import diacritics as di
from lectern.functions import styles as st
from lectern.functions import text as tx
from lectern.operators import scan

#: The styles that are given, by rule.
CAPTION, SOURCE, LETTER, TRANSLATION = "Подпись к иллюстрации", "Источник", "Письмо", "Перевод шлоки"
#: The states of the automaton: the style given to the paragraph before; 0 for none and all others.
STATE_STYLES = ("", "Шлока", "Шлока в цитате", "Цитата 1", "Цитата 2")
N = len(STATE_STYLES)
#: Rule: style (None: that of the state), confidence, reason.
RULES = {
    "c": (CAPTION, "high", "caption-pattern"), "s": (SOURCE, "high", "scripture-reference-pattern"), "l": (LETTER, "medium", "letter-pattern"),
    "t": (TRANSLATION, "high", "after-shloka-quoted-russian"), "v": (STATE_STYLES[1], "high", "visual-or-transliteration-shloka"), "q": (STATE_STYLES[2], "high", "visual-or-transliteration-shloka"),
    "b": (STATE_STYLES[3], "medium", "standalone-or-visual-quote"), "3": (STATE_STYLES[3], "medium", "continued-quote-block"), "4": (STATE_STYLES[4], "medium", "continued-quote-block"), "n": (STATE_STYLES[3], "medium", "quoted-block-near-source"),
}
#: No style, but a reviewer should look: marks or quotation, indent or slant.
REVIEWS = {"m": "possible-semantic-style-needs-review", "i": "visual-block-or-paragraph-italic-needs-review"}


def _state(style: str | None) -> int:
    return STATE_STYLES.index(style) if style in STATE_STYLES else 0


def hint_of(rules: list[dict], index: str, text: str) -> Column:
    """(action, style, reason) of the first hint that fits; null if none does. A hint without an action sets its style.

    rules: match (type index, text or regex; value), action, style, note; those without type or value are left out. They
    are a hand-written list, so they are an expression.
    """
    out = F.lit(None).cast("struct<action:string,style:string,reason:string>")
    for r in reversed(rules):
        match = r.get("match") or {}
        kind, value = match.get("type"), match.get("value")
        if kind not in ("index", "text", "regex") or value is None:
            continue
        test = {"index": F.col(index).cast("string") == str(value), "text": st.match_key(F.col(text)) == st.match_key(F.lit(str(value))), "regex": F.col(text).rlike(str(value)) if kind == "regex" else None}[kind]
        said = F.struct(F.lit(r.get("action", "set_style")).alias("action"), F.lit(r.get("style")).cast("string").alias("style"), F.lit(f"hint:{r.get('note') or kind}").alias("reason"))
        out = F.when(test, said).otherwise(out)
    return out


def _looks(paragraphs: DataFrame, rules: list[dict], order: str) -> DataFrame:
    """What the rules ask about each paragraph by itself, as one row of flags: no text goes any further."""
    p = paragraphs.withColumns({"_raw": F.coalesce("text", F.lit("")), "_clean": tx.clean(F.col("text")), "_block": st.is_block(F.col("left_indent"), F.col("first_line_indent"))})
    # Normal forms need Python: only texts with marks go there, nulls are passed by.
    marked = F.when(di.has_marks(F.col("_raw")), F.col("_raw"))
    p = p.withColumns({"_plain": F.coalesce(di.without_marks(marked), F.col("_raw")), "_hint": hint_of(rules, order, "_raw")})
    raw, clean, block = F.col("_raw"), F.col("_clean"), F.col("_block")
    # Columns of their own, so that what several rules ask is worked out once.
    p = p.withColumns({"_source": st.looks_source(clean), "_caption": st.looks_caption(clean), "_quote": st.looks_quote(clean), "_stats": F.when(di.has_marks(raw), di.stats(raw, F.col("_plain")))})
    source, caption, quote = F.col("_source"), F.col("_caption"), F.col("_quote")
    open_ = F.coalesce(F.col("style_name").isin(*st.BODY_STYLES), F.lit(False)) & (clean != "")
    flags = {
        "open": open_, "caption": caption, "source": source, "letter": st.looks_letter(clean), "translation": st.looks_translation(clean),
        "verse": st.looks_verse_paragraph(raw, clean, F.col("_stats"), block, source, caption), "quote": quote, "block_quote": st.looks_block_quote(clean, block, source, quote),
        "alone": block | tx.word_count(clean).between(8, 180), "marks": st.marks_score(raw) >= 2, "slanted": block | F.coalesce("paragraph_italic", F.lit(False)),
    }
    hinted = F.when(F.col("_hint.action").isin("ignore", "review_only"), F.col("_hint.action")).when((F.col("_hint.action") == "set_style") & (F.coalesce("_hint.style", F.lit("")) != ""), "set_style")
    flags["hinted"] = F.when(open_, hinted)
    flags["gives_source"] = open_ & F.when(flags["hinted"].isNotNull(), (flags["hinted"] == "set_style") & (F.col("_hint.style") == SOURCE)).otherwise(~flags["caption"] & flags["source"])
    return p.withColumn("looks", F.struct(*[c.alias(n) for n, c in flags.items()], F.col("_hint.style").alias("hint_style"), F.col("_hint.reason").alias("hint_reason")))


def _rule(x: Column, near: Column, state: int) -> Column:
    """The rule that is used on a paragraph after `state`, as a character; a space for none."""
    verse_before, quote_before = state in (1, 2), state in (3, 4)
    out = F.when(~x["open"] | x["hinted"].isin("ignore", "review_only"), " ").when(x["hinted"] == "set_style", "h")
    out = out.when(x["caption"], "c").when(x["source"], "s").when(x["letter"], "l")
    if verse_before:
        out = out.when(x["translation"], "t")
    out = out.when(x["verse"], "q" if state == 3 else "v").when(x["block_quote"] & x["alone"], "b")
    if quote_before:
        out = out.when(x["block_quote"], str(state))
    return out.when(x["quote"] & near, "n").otherwise(" ")


def semantic_styles(paragraphs: DataFrame, keys: list[str], order: str, rules: list[dict] = ()) -> DataFrame:
    """keys, order, old_style, new_style, confidence, reason, applied of each paragraph that a rule or hint says something of.

    paragraphs: text, style_name, left_indent, first_line_indent, paragraph_italic; `order` counts all of a document's
    paragraphs from 1, empty ones too. Only body text is looked at. Whether a paragraph continues a verse or a quotation
    depends on the style just given to the one before, so the rules are an automaton; it is run as a scan over blocks of
    places, and the neighbours that a rule looks at (two ahead, two back) are put into both blocks at a border. No size
    of a document is a limit. Paragraphs of one document that claim one place are taken in the order of their looks.
    """
    at = F.col(order).cast("long")
    own = _looks(paragraphs, list(rules), order).select(*keys, at.alias("at"), "looks", F.col("style_name").alias("old"))
    # A place belongs to one block and, as `halo`, to those that look at it from two places off.
    block = lambda c: F.floor((c - 1) / scan.BLOCK)
    home = own.select(*keys, F.explode(F.array_distinct(F.array(block(F.col("at")), block(F.col("at") - 2), block(F.col("at") + 2)))).alias("block"), "at", "looks", "old")
    blocks = home.groupBy(*keys, "block").agg(F.array_sort(F.collect_list(F.struct("at", "looks", "old"))).alias("all"))
    look = lambda i, k, what: F.coalesce((F.get("all", i + k)["at"] == F.get("all", i)["at"] + k) & F.get("all", i + k)["looks"][what], F.lit(False))
    near = lambda i: look(i, 1, "source") | look(i, 2, "source") | look(i, -2, "gives_source")
    seen = F.transform("all", lambda x, i: F.struct(x["at"].alias("at"), x["looks"].alias("looks"), x["old"].alias("old"), near(i).alias("near")))
    seen = F.filter(seen, lambda x: block(x["at"]) == F.col("block"))
    rows = F.transform(seen, lambda x: F.struct(x["at"].alias("at"), x["looks"].alias("looks"), x["old"].alias("old"), F.concat(*[_rule(x["looks"], x["near"], s) for s in range(N)]).alias("rules")))
    names = "".join(RULES)
    step = lambda x: F.when(x["looks"]["hinted"] == "set_style", F.repeat(F.coalesce(*[F.when(x["looks"]["hint_style"] == s, F.lit(str(k))) for k, s in enumerate(STATE_STYLES) if k], F.lit("0")), N)).otherwise(F.call_function("translate", x["rules"], F.lit(names + " h"), F.lit("".join(str(_state(RULES[c][0])) for c in names) + "00")))
    blocks = blocks.select(*keys, "block", F.transform(rows, lambda x: F.struct(x["at"].alias("at"), x["looks"].alias("looks"), x["old"].alias("old"), x["rules"].alias("rules"), step(x).alias("step"))).alias("rows")).where(F.size("rows") > 0)
    steps = F.transform("rows", lambda x: x["step"])
    entered = scan.with_entries(blocks, keys, steps, N).withColumn("seen", scan.before_each(steps, F.col("entry")))
    x = entered.select(*keys, F.posexplode_outer("rows").alias("i", "x"), "seen").select(*keys, F.col("x.at").alias(order), F.col("x.looks").alias("looks"), F.col("x.old").alias("old_style"), F.substring("x.rules", F.substring("seen", F.col("i") + 1, F.lit(1)).cast("int") + 1, F.lit(1)).alias("rule"))
    hint = F.col("looks.hinted")
    looked = F.when(F.col("looks.open") & hint.isNull() & (F.col("rule") == " "), F.when(F.col("looks.marks") | F.col("looks.quote"), "m").when(F.col("looks.slanted"), "i"))
    x = x.withColumn("rule", F.coalesce(looked, F.col("rule"))).where((F.col("rule") != " ") | (hint == "review_only"))
    said_by = RULES | {c: ("", "low", reason) for c, reason in REVIEWS.items()}
    of = lambda k: F.try_element_at(F.create_map(*[F.lit(v) for c, r in said_by.items() for v in (c, r[k])]), F.col("rule"))
    by_hint = hint.isin("set_style", "review_only")
    return x.select(
        *keys, order, "old_style",
        F.when(by_hint, F.col("looks.hint_style")).otherwise(F.nullif(of(0), F.lit(""))).alias("new_style"),
        F.when(by_hint, "hint").otherwise(of(1)).alias("confidence"),
        F.when(by_hint, F.col("looks.hint_reason")).otherwise(of(2)).alias("reason"),
        (~F.col("rule").isin("m", "i") & F.coalesce(hint != "review_only", F.lit(True))).alias("applied"),
    )


def styles(paragraphs: DataFrame, keys: list[str], order: str, rules: list[dict] = ()) -> DataFrame:
    """paragraphs with `new_style`: the style that semantic_styles applies, else their own."""
    given = semantic_styles(paragraphs, keys, order, rules).where("applied").select(*keys, order, F.col("new_style").alias("_given"))
    return paragraphs.join(given, [*keys, order], "left").withColumn("new_style", F.coalesce("_given", "style_name")).drop("_given")


def hint_template(decisions: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Each decision as a hint to be edited: match, action review_only, style, note."""
    match = F.struct(F.lit("index").alias("type"), F.col(order).alias("value"))
    return decisions.select(*keys, match.alias("match"), F.lit("review_only").alias("action"), F.col("new_style").alias("style"), F.concat(F.lit("current:"), F.col("reason")).alias("note"), "old_style", F.col("confidence").alias("current_confidence"))
