"""Registered queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must agree."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def digits(column: str) -> int:
    """Decimals compared: deviations of large amounts carry fewer exact ones."""
    return 2 if "_STD" in column else 6


def rounded(df: DataFrame) -> DataFrame:
    """Doubles cut to the compared decimals; ``+ 0.0`` turns -0.0 into 0.0."""
    return df.select(*[
        (F.round(c, digits(c)) + F.lit(0.0)).alias(c) if t in ("double", "float") else F.col(c)
        for c, t in df.dtypes
    ])


def rounded_sql(expr: str, column: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits(column)}) + 0.0 AS \"{column}\""


def with_ctes(ctes: Sequence[tuple[str, str]], body: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({s})" for n, s in ctes) + " " + body
