"""Queries over the given tables, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.session import ensure_shared_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is left out where SQL cannot say it."""
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the tables hold times without a zone, which are meant as UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ensure_shared_dir(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = dedent(sql).strip()
        return function
    return add
