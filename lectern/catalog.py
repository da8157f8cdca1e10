"""All queries of the library by name, with their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.plans import align, blocks, chapters, editorial, pages, review, rules, runs, styles, terms

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
for plan in (blocks, pages, terms, align, review, rules, styles, runs, chapters, editorial):
    QUERIES |= plan.QUERIES
    ORACLE |= plan.ORACLE
FLAGSHIP = "review_issue_rollup"
