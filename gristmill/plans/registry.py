"""A small register: each plan module has its own ``query`` decorator, QUERIES and SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Register:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Register the function below under ``name``, with the SQL that gives the same result."""

        def add(function: Query) -> Query:
            self.queries[name] = function
            if sql is not None:
                self.sql[name] = sql
            return function

        return add
