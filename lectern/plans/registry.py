"""How a plan module registers its queries."""

from __future__ import annotations

from collections.abc import Callable


def registry() -> tuple[dict, dict, Callable]:
    """QUERIES, ORACLE and the decorator that puts a function, with its SQL if there is any, into them."""
    queries, oracle = {}, {}

    def query(sql: str | None = None):
        def put(f):
            queries[f.__name__] = f
            if sql:
                oracle[f.__name__] = sql
            return f

        return put

    return queries, oracle, query
