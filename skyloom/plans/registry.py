"""Queries by name, each with SQL that says the same for DuckDB where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function of (spark, sf_dir) under its own name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def separation_sql(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    """The haversine distance in arcseconds as SQL text."""
    half = lambda a, b: f"sin(radians({b} - {a}) / 2e0)"
    d, r = half(dec1, dec2), half(ra1, ra2)
    return f"(2e0 * degrees(asin(sqrt(least(1e0, {d} * {d} + cos(radians({dec1})) * cos(radians({dec2})) * {r} * {r})))) * 3.6e3)"
