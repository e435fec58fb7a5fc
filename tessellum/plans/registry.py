"""Queries by name with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable


class Registry:
    """The queries and SQL of one module; views are SQL fragments that the SQL uses by name in braces."""

    def __init__(self, **views: str):
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}
        self.views = views

    def __call__(self, sql: str | None = None) -> Callable:
        def add(f: Callable) -> Callable:
            self.queries[f.__name__] = f
            if sql:
                text = sql
                for k, v in self.views.items():
                    text = text.replace("{" + k + "}", v)
                self.sql[f.__name__] = text
            return f

        return add
