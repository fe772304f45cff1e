"""Dictionary joins whose cost does not depend on how the keys are spread.

A dictionary is broadcast only after its row count has been checked. Beyond
the bound, its most frequent keys - a fixed number of them - are still
broadcast, and everything else goes through an ordinary shuffle join in which
the rows already answered are scattered over all partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
HOT_KEYS = 1_000


def collect_bounded(df: DataFrame, max_rows: int) -> list[Row] | None:
    """All rows when there are at most ``max_rows``, else None."""
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def as_small_table(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame | None:
    """``df`` as a local relation of proven size, or None when it is larger."""
    rows = collect_bounded(df, max_rows)
    if rows is None:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def _match(left: DataFrame, right: DataFrame, on: Sequence[str], safe: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in on:
        a, b = left[k], right[f"_of_{k}"]
        condition = condition & (a.eqNullSafe(b) if k in safe else a == b)
    return condition


def _prefixed(table: DataFrame, on: Sequence[str]) -> DataFrame:
    return table.withColumnsRenamed({k: f"_of_{k}" for k in on})


def attach(
    rows: DataFrame,
    table: DataFrame,
    on: str | Sequence[str],
    weight: str | None = None,
    null_safe: bool | Sequence[str] = False,
    max_rows: int = BROADCAST_ROWS,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Left join of ``rows`` to ``table``, which holds each key once.

    ``weight`` names the column of ``table`` that tells how many rows carry a
    key; it decides which keys count as hot when ``table`` is too large to
    broadcast. With ``max_rows=0`` the table is taken to be large unchecked.
    ``null_safe`` says whether NULL keys match each other, or for which keys.
    """
    on = [on] if isinstance(on, str) else list(on)
    safe = (on if null_safe else []) if isinstance(null_safe, bool) else list(null_safe)
    values = [c for c in table.columns if c not in on]
    small = as_small_table(table, max_rows) if max_rows > 0 else None
    if small is not None:
        side = F.broadcast(_prefixed(small, on))
        return rows.join(side, _match(rows, side, on, safe), "left").drop(
            *[f"_of_{k}" for k in on]
        )
    if weight is None:
        side = _prefixed(table, on)
        return rows.join(side, _match(rows, side, on, safe), "left").drop(
            *[f"_of_{k}" for k in on]
        )

    hot = table.orderBy(F.col(weight).desc()).limit(hot_keys)
    hot = _prefixed(hot.select(*on, F.struct(*values).alias("_hot")), on)
    step = rows.join(F.broadcast(hot), _match(rows, hot, on, safe), "left").drop(
        *[f"_of_{k}" for k in on]
    )
    answered = F.col("_hot").isNotNull()
    for k in on:
        if k not in safe:
            answered = answered | F.col(k).isNull()
    # a salt other than 0 matches nothing: it only spreads the answered rows
    step = step.withColumn(
        "_salt", F.when(answered, 1 + F.pmod(F.monotonically_increasing_id(), F.lit(1_000_003)))
        .otherwise(F.lit(0).cast("bigint")),
    )
    # always 0, but no literal: the optimizer would put a literal into the condition, and the join
    # would then be dealt by the key alone
    cold = _prefixed(table.select(*on, F.struct(*values).alias("_cold"), F.pmod(F.xxhash64(*on), F.lit(1)).alias("_side")), on)
    joined = step.join(
        cold, _match(step, cold, on, safe) & (step["_salt"] == cold["_side"]), "left"
    )
    return joined.select(
        *rows.columns, *[F.coalesce(F.col("_hot")[v], F.col("_cold")[v]).alias(v) for v in values]
    )
