"""Registered queries: each operator over the given tables, with its SQL twin."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.session import configure
from larder.sources.files import spread

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table about to meet heavy per-row work: small files are shared out to all cores."""
    return spread(table(spark, sf_dir, name))


@dataclass
class Catalog:
    """Queries by name; ``sql`` holds the equivalent DuckDB text where there is one."""

    queries: dict[str, Query] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def query(self, sql: str | None = None):
        def register(fn: Query) -> Query:
            self.queries[fn.__name__] = fn
            if sql is not None:
                self.sql[fn.__name__] = sql
            return fn

        return register
