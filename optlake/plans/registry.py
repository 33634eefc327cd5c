"""Registry of driver queries: name -> (Spark builder, DuckDB oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from optlake.plans.oracle_sql import with_views
from optlake.session import prepare_session

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: list[str] | None = None, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` and, when given, its oracle.

    ``sql=None`` marks a query without a SQL twin (rows-only check).
    """

    def wrap(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare_session(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(views or [], sql)
        return run

    return wrap


def load_all() -> None:
    """Import every query module so its registrations run."""
    from optlake.plans import (  # noqa: F401
        coverage_queries,
        filter_queries,
        ingest_queries,
        merge_queries,
        ops_queries,
        strategy_queries,
        streaming_queries,
    )
