"""Language identification by Bayesian evidence fusion.

For each row the likelihoods of its text under every language (byte trigrams, counted over all labelled rows) are
combined with what else is known: the language that the markup declares, the suffix of its address, and a prior of its
host, smoothed towards the host's domain, the suffix and the whole by grouped counts. One more class, of uniformly
random bytes, takes what is no language. Counts of declared languages and hosts come from the text's own best guess,
over all rows of the same table.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, shared_dir, stored

#: Hashed trigram features; added to each count; weight of a trigram's likelihood, as trigrams overlap.
FEATURES, ADDED, WEIGHT = 1 << 16, 0.1, 1 / 3
#: Rows of the level above that smooth each level of the host prior; share of declarations taken as random.
STRENGTH, DECLARED = 5.0, 4.0
UNKNOWN, UNKNOWN_PRIOR = "und", 0.01

_HIDDEN = re.compile(rb"(?i)<(script|style)\b")
_ENDS = {name: re.compile(rb"(?i)</" + name + rb"\s*>") for name in (b"script", b"style")}
_HTML = re.compile(rb"(?i)<html\b")
_LANG = re.compile(rb"""(?i)\blang\s*=\s*["']?([a-z]{2,3})""")


def without_markup(page: bytes) -> bytes:
    """The page with a space for each script, style, comment and tag. One pass: an end that is missing is looked for once."""
    out, at, missing = [], 0, set()
    while (i := page.find(b"<", at)) >= 0:
        end = -1
        if (m := _HIDDEN.match(page, i)) and (name := m[1].lower()) not in missing:
            found = _ENDS[name].search(page, m.end())
            end = found.end() if found else -1
            if not found:
                missing.add(name)
        elif page.startswith(b"<!--", i) and b"--" not in missing:
            end = page.find(b"-->", i + 4) + 3
            if end < 3:
                missing.add(b"--")
                end = -1
        if end < 0:
            end = page.find(b">", i) + 1
        if not end:
            break
        out += [page[at:i], b" "]
        at = end
    return b"".join([*out, page[at:]])


def page_text(page: bytes | None) -> bytes:
    """What a reader sees of a page: without markup, scripts and comments; entities resolved."""
    return html.unescape(without_markup(page or b"").decode("utf-8", "replace")).encode()


def declared_language(page: bytes | None) -> str | None:
    """The language that the page's html tag declares. Each tag is read once, to its end."""
    page, at = page or b"", 0
    while m := _HTML.search(page, at):
        end = page.find(b">", m.end())
        end = len(page) if end < 0 else end
        if lang := _LANG.search(page, m.end(), end):
            return lang[1].decode().lower()
        at = end
    return None


def trigrams(text: bytes | None) -> np.ndarray:
    """Hashed byte trigrams of a text in lower case, runs of what is no letter as one space."""
    if not text:
        return np.empty(0, np.int64)
    plain = re.sub(r"[\W\d_]+", " ", text.decode("utf-8", "replace").lower()).strip()
    if not plain:
        return np.empty(0, np.int64)
    b = np.frombuffer(f" {plain} ".encode(), np.uint8).astype(np.uint32)
    return (((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


class TextModel:
    """Log likelihoods of trigrams by language. `languages` in order; `logs`: features x languages."""

    def __init__(self, counts: dict[str, np.ndarray]):
        self.languages = sorted(counts)
        n = np.array([counts[k] for k in self.languages], np.float64).reshape(len(self.languages), FEATURES).T + ADDED
        self.logs = np.log(n / n.sum(axis=0)).astype(np.float32)

    def likelihoods(self, text: bytes | None) -> tuple[list[float], int]:
        """Of each language, then of the unknown class: weighted log likelihoods of the whole text; and its trigrams."""
        t = trigrams(text)
        if not len(t):
            return [0.0] * (len(self.languages) + 1), 0
        n = np.bincount(t, minlength=FEATURES).astype(np.float32)
        return [*(float(x) * WEIGHT for x in n @ self.logs), -float(np.log(FEATURES)) * len(t) * WEIGHT], len(t)


def fit(docs: DataFrame) -> TextModel:
    """A model of all rows of `docs` with a `lang`. Each task counts its own rows; counts are added by language and part."""
    parts = 16
    span = FEATURES // parts

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(FEATURES, np.int64))
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own[lang] += np.bincount(trigrams(text), minlength=FEATURES)
        rows = [(k, p, x[p * span : (p + 1) * span].tobytes()) for k, x in own.items() for p in range(parts)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], ["lang", "part", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for lang, part, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "part", "n")), strict=True):
                own[lang, part] = own.get((lang, part), 0) + np.frombuffer(n, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in own], pa.string()), pa.array([k[1] for k in own], pa.int32()), pa.array([x.tobytes() for x in own.values()], pa.binary())], ["lang", "part", "n"])

    schema = "lang string, part int, n binary"
    rows = docs.where("lang is not null and text is not null").select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(count, schema)
    total: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(FEATURES, np.int64))
    for lang, part, n in rows.repartition(parts, "lang", "part").mapInArrow(add, schema).collect():  # FEATURES numbers a language
        total[lang][part * span : (part + 1) * span] = np.frombuffer(n, np.int64)
    return TextModel(dict(total))


def suffix_of(host: Column) -> Column:
    """The last label of a host name; null without a dot."""
    return F.when(F.instr(host, ".") > 0, F.element_at(F.split(host, r"\."), -1))


def domain_of(host: Column) -> Column:
    """The last two labels."""
    return F.array_join(F.slice(F.split(host, r"\."), F.greatest(-F.size(F.split(host, r"\.")), F.lit(-2)), 2), ".")


def scored(rows: DataFrame, model: TextModel, keys: list[str], markup: bool = False) -> DataFrame:
    """keys, declared, host and the text's likelihoods. rows: keys, host, declared and text, or with markup=True a page in `text` that also declares."""
    fields = {f.name: f for f in rows.schema.fields}
    schema = f"{', '.join(f'{k} {fields[k].dataType.simpleString()}' for k in keys)}, host string, declared string, likelihoods array<double>, n int"
    broadcast = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, declared, found, n = batch.column("text").to_pylist(), batch.column("declared").to_pylist(), [], []
            if markup:
                declared = [declared_language(t) for t in texts]
            for t in texts:
                a, b = broadcast.value.likelihoods(page_text(t) if markup else t)
                found.append(a), n.append(b)
            own = [batch.column(k) for k in [*keys, "host"]]
            yield pa.RecordBatch.from_arrays([*own, pa.array(declared, pa.string()), pa.array(found, pa.list_(pa.float64())), pa.array(n, pa.int32())], [*keys, "host", "declared", "likelihoods", "n"])

    return rows.select(*keys, F.col("host").cast("string").alias("host"), F.col("declared").cast("string").alias("declared"), F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def _best(values: Column, names: list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), F.array_position(values, F.array_max(values)).cast("int"))


def fused(rows: DataFrame, languages: list[str], keys: list[str]) -> DataFrame:
    """keys, declared, text_lang, lang, confidence, keep of what `scored` returns.

    Evidence is added in logarithms. Each level of the host prior (all, suffix, domain, host) is the level's counts
    plus STRENGTH rows that are spread like the level above. A declared language counts by how often texts of a
    language declare it, over the whole table; null or unseen: no evidence. keep: the unknown class does not win and
    the text has letters. A host with a third of the rows is one row of the counts, which are aggregated before they
    are shuffled.
    """
    spark = rows.sparkSession
    names = [*languages, UNKNOWN]
    rows = stored(rows, shared_dir(spark))
    rows = rows.withColumn("text_lang", F.when(F.col("n") == 0, UNKNOWN).otherwise(_best(F.col("likelihoods"), names)))
    rows = rows.withColumns({"suffix": suffix_of(F.col("host")), "domain": domain_of(F.col("host"))})
    counts = lambda by: rows.groupBy(*by).agg(*[F.sum(F.when(F.col("text_lang") == k, 1.0).otherwise(0.0)).alias(f"n{i}") for i, k in enumerate(languages)])
    shares = lambda d, up: d.withColumn("p", F.array(*[(F.col(f"n{i}") + STRENGTH * F.element_at(up, i + 1)) / (sum(F.col(f"n{j}") for j in range(len(languages))) + STRENGTH) for i in range(len(languages))]))
    if not languages:
        return rows.select(*keys, "declared", "text_lang", F.lit(UNKNOWN).alias("lang"), F.lit(1.0).alias("confidence"), F.lit(False).alias("keep"))
    hosts = stored(counts(["host", "domain", "suffix"]).where("host is not null"), shared_dir(spark))
    sums = [F.sum(f"n{i}").alias(f"n{i}") for i in range(len(languages))]
    tables = hosts.agg(*sums).first()  # a number a language
    n0 = [float(v or 0.0) for v in tables]
    p0 = [(n + STRENGTH / len(languages)) / (sum(n0) + STRENGTH) for n in n0]
    whole = F.array(*map(F.lit, p0))
    suffixes = shares(hosts.where("suffix is not null").groupBy("suffix").agg(*sums), whole).select("suffix", F.col("p").alias("p1"))
    domains = shares(hosts.groupBy("domain", "suffix").agg(*sums).join(suffixes, "suffix", "left"), F.coalesce(F.col("p1"), whole)).select("domain", F.col("p").alias("p2"))
    priors = shares(hosts.join(domains, "domain"), F.col("p2")).select("host", F.col("p").alias("p3"))
    # As many rows as languages: declarations of other codes are no evidence.
    declared = {r["declared"]: [r[f"n{i}"] for i in range(len(languages))] for r in counts(["declared"]).where(F.col("declared").isin(languages)).collect()}
    totals = [sum(n[i] for n in declared.values()) for i in range(len(languages))]
    d = F.lit(None).cast("array<double>")
    for code, n in declared.items():
        d = F.when(F.col("declared") == code, F.array(*[F.lit(float(np.log((v + DECLARED / len(languages)) / (t + DECLARED)))) for v, t in zip(n, totals, strict=True)])).otherwise(d)
    x = rows.withColumn("d", d).join(priors, "host", "left")
    prior = F.coalesce(F.col("p3"), whole)
    evidence = F.array(*[F.element_at("likelihoods", i + 1) + F.log(F.element_at(prior, i + 1) * (1 - UNKNOWN_PRIOR) + 1e-300) + F.coalesce(F.element_at("d", i + 1), F.lit(0.0)) for i in range(len(languages))], F.element_at("likelihoods", len(names)) + float(np.log(UNKNOWN_PRIOR)) + F.when(F.col("d").isNotNull(), -float(np.log(len(languages)))).otherwise(0.0))
    x = x.withColumn("e", evidence).withColumn("lang", F.when(F.col("n") == 0, UNKNOWN).otherwise(_best(F.col("e"), names)))
    top = F.array_max("e")
    sure = F.lit(1.0) / F.aggregate(F.transform("e", lambda v: F.exp(v - top)), F.lit(0.0), lambda a, v: a + v)
    return x.select(*keys, "declared", "text_lang", "lang", F.when(F.col("n") == 0, 1.0).otherwise(sure).alias("confidence"), (F.col("lang") != UNKNOWN).alias("keep"))


def documents_identified(docs: DataFrame, model: TextModel) -> DataFrame:
    """doc_id, text_hash, declared, text_lang, lang, confidence, keep: one row for each row of `docs`, its source taken as host.

    Null, empty or letterless text: `und`, not kept. Null source or doc_id: kept as it is, without that evidence.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("source").alias("host"), F.lit(None).cast("string").alias("declared"), "text")
    return fused(scored(rows, model, ["doc_id", "text_hash"]), model.languages, ["doc_id", "text_hash"])


def pages_identified(pages: DataFrame, model: TextModel) -> DataFrame:
    """page_id, declared, text_lang, lang, confidence, keep: one row for each row of `pages`."""
    host = F.lower(F.regexp_extract("url", r"://([^/?#:]*)", 1))
    rows = pages.select("page_id", F.when(host != "", host).alias("host"), F.lit(None).cast("string").alias("declared"), F.col("html").alias("text"))
    return fused(scored(rows, model, ["page_id"], markup=True), model.languages, ["page_id"])


def identified_only(docs: DataFrame, model: TextModel) -> DataFrame:
    """docs without the rows that are no language of the model."""
    of, hashed = fresh(docs.columns, "_id"), fresh(docs.columns, "_hash")
    gone = documents_identified(docs, model).where("not keep").select(F.col("doc_id").alias(of), F.col("text_hash").alias(hashed)).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(F.col(of)) & (F.xxhash64(docs["text"]) == F.col(hashed)), "left_anti")
