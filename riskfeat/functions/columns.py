"""Column selection from the schema: driver-side metadata, no job."""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType, StringType


def numeric_columns(df: DataFrame, exclude: Collection[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, NumericType) and f.name not in exclude
    ]


def string_columns(df: DataFrame, exclude: Collection[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, StringType) and f.name not in exclude
    ]


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [n for n in names if n in have]


def with_prefix(df: DataFrame, prefix: str, exclude: Collection[str] = ()) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix) and c not in exclude]


def key_first(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, *[c for c in df.columns if c != key])
