"""Single place that assembles the registered queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure


def registered_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from .catalog import QUERIES
    from .catalog_io import IO_QUERIES

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run

    return {name: wrap(fn) for name, fn in {**QUERIES, **IO_QUERIES}.items()}


def oracle_queries() -> dict[str, str]:
    from .oracle import ORACLE_SQL
    names = registered_queries()
    return {k: v for k, v in ORACLE_SQL.items() if k in names}
