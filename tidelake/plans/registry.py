"""Queries by name and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelake.plans import archives, calendar, canonical, catalogs, checks, evidence, experiments, inventory, learned, ledgers, market, pools, sources, streams
from tidelake.session import shared_folder


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.flagship(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def ready(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            shared_folder(spark)
            return f(spark, sf_dir)

        run.__name__ = f.__name__
        return run

    return {n: ready(f) for n, f in (market.QUERIES | checks.QUERIES | streams.QUERIES | sources.QUERIES | inventory.QUERIES | calendar.QUERIES | pools.QUERIES | canonical.QUERIES | learned.QUERIES | archives.QUERIES | ledgers.QUERIES | experiments.QUERIES | catalogs.QUERIES | evidence.QUERIES).items()}


def oracle_sql() -> dict[str, str]:
    return market.SQL | checks.SQL | streams.SQL | sources.SQL | inventory.SQL | calendar.SQL | pools.SQL | canonical.SQL | learned.SQL | archives.SQL | ledgers.SQL | experiments.SQL | catalogs.SQL | evidence.SQL
