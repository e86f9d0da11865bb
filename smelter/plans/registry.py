"""Registry of named queries and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` and reads the Parquet
tables of ``sf_dir`` (through the role views).  The oracle, when given, is an
independently written DuckDB query over the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from smelter.sources.tables import TableSet

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
OPERATORS: dict[str, tuple[str, ...]] = {}


def register(name: str, operators: tuple[str, ...] = (), oracle: str | None = None):
    """Decorator: ``fn(tables: TableSet) -> DataFrame`` becomes a query."""

    def wrap(fn: Callable[[TableSet], DataFrame]) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(TableSet.shared(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        OPERATORS[name] = operators
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return run

    return wrap
