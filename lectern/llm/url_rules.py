"""URL rules indexed by their rarest literal token.

Each rule is a regular expression over the address with literal tokens that every match must hold whole. How often each
literal occurs in the table's addresses is counted first; a rule is filed under its rarest one. An address's own tokens
then fetch the few rules that may match, and only those run.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[A-Za-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """name; action: block or allow; pattern: searched in host + path; literals: tokens of each match; rank: the highest wins."""

    name: str
    action: str
    pattern: str
    literals: tuple[str, ...] = field(default=())
    rank: tuple[int, int] = (0, 0)


def host_rule(action: str, name: str) -> Rule:
    """A rule `host/path`: fits the host and its subdomains where the path starts with the rule's. The longest wins, over patterns too."""
    host, slash, path = name.partition("/")
    path = slash + path
    whole = TOKEN.findall(host) + [m[0] for m in TOKEN.finditer(path) if m.end() < len(path)]
    return Rule(name, action, rf"^(?:[^/]*\.)?{re.escape(host.lower())}{re.escape(path)}", tuple(whole), (1, len(name)))


def pattern_rule(action: str, pattern: str, *literals: str) -> Rule:
    return Rule(pattern, action, pattern, literals)


#: Patterns of junk addresses that hold without any host rule.
PATTERNS = tuple(
    pattern_rule("block", rf"(?:^|[./-]){word}(?:[./-]|$)", word)
    for word in ("ads", "adserver", "affiliate", "casino", "cheap", "clickbait", "loans", "pills", "poker", "porn", "replica", "spam", "torrent", "tracker", "viagra", "warez", "xxx")
)


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path: then up to `?`, `#` or the end."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url[at + 3 :], re.S)
    return re.sub("[A-Z]+", lambda x: x[0].lower(), m[1]), m[2]


def token_counts(urls: DataFrame, tokens: set[str]) -> dict[str, int]:
    """How many addresses hold each of `tokens`, over the whole table; as many numbers as there are literals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[str, int] = defaultdict(int)
        for batch in batches:
            for url in batch.column(0).to_pylist():
                for t in tokens.intersection(TOKEN.findall("".join(host_and_path(url)))):
                    n[t] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["token", "n"])

    return {r["token"]: r["n"] for r in urls.select("url").mapInArrow(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()}


def index_of(rules: list[Rule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Rule numbers by rarest literal, and those without literals, which every address runs."""
    by: dict[str, list[int]] = defaultdict(list)
    always = []
    for k, r in enumerate(rules):
        if r.literals:
            by[min(r.literals, key=lambda t: (counts.get(t, 0), t))].append(k)
        else:
            always.append(k)
    return dict(by), always


def judged(pages: DataFrame, rules: list[Rule], patterns: tuple[Rule, ...] = PATTERNS, default: str = "allow") -> DataFrame:
    """One row for each row of `pages`: page_id, host, path, rule, verdict, pattern, n_candidates.

    rule: the longest host rule that fits, else null; verdict: its action, else that of the first pattern that is
    found (`pattern`), else `default`. Null address or one without `://`: empty host and path, no rule. Ties of length:
    the first of `rules`. Rules travel to the tasks with the code: their number is the caller's, not the data's.
    """
    every = [*rules, *patterns]
    counts = token_counts(pages, {t for r in every for t in r.literals})
    by, always = index_of(every, counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [re.compile(r.pattern) for r in every]
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for page_id, url in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), strict=True):
                host, path = host_and_path(url)
                subject = host + path
                candidates = [*always, *(k for t in set(TOKEN.findall(subject)) for k in by.get(t, ()))] if subject else []
                fit = [k for k in candidates if compiled[k].search(subject)]
                best = max((k for k in fit if k < len(rules)), key=lambda k: (every[k].rank, -k), default=None)
                other = min((k for k in fit if k >= len(rules)), default=None)
                won = best if best is not None else other
                for column, x in zip(out, (page_id, host, path, None if best is None else every[best].name, default if won is None else every[won].action, None if other is None else every[other].name, len(candidates)), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), *[pa.string()] * 5, pa.int32()), strict=True)], ["page_id", "host", "path", "rule", "verdict", "pattern", "n_candidates"])

    return pages.select("page_id", "url").mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, pattern string, n_candidates int")
