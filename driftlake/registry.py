"""Where queries are gathered with their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, query: Query, oracle: str | None) -> None:
        if name in self.queries:
            raise ValueError(f"{name} is there already")
        self.queries[name] = query
        if oracle:
            self.oracles[name] = oracle
