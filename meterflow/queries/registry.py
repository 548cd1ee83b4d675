"""A module's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterflow.fixtures import Site, oracle


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def query(self, sql: str | None = None, name: str | None = None):
        """Register f(site) under its name, or `name`, with SQL over fixtures for the same rows."""

        def add(f):
            key = name or f.__name__
            self.queries[key] = lambda spark, sf_dir: f(Site(spark, sf_dir))
            if sql:
                self.oracles[key] = oracle(sql)
            return f

        return add
