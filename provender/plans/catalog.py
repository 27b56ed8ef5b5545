"""How a query module registers its queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable


class Catalog:
    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None):
        def add(fn: Callable) -> Callable:
            self.queries[fn.__name__] = fn
            if sql is not None:
                self.sql[fn.__name__] = sql
            return fn
        return add
