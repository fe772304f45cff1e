"""Payment-history features: lifetime and recency windows of due days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.functions.rows import clipped_diff, flag, ratio
from riskfeat.operators.aggspec import (
    ROWS, Block, aggregate_blocks, distinct_counts, flag_stats, join_on_key, stats_of,
)
from riskfeat.plans import columns as names
from riskfeat.sources.tables import ENTITY


def payment_rows(payments: DataFrame) -> DataFrame:
    """Days late and early, paid share, under-payment and a late flag."""
    late = clipped_diff("DAYS_ENTRY_PAYMENT", "DAYS_INSTALMENT")
    return payments.withColumns({
        "DPD": late,
        "DBD": clipped_diff("DAYS_INSTALMENT", "DAYS_ENTRY_PAYMENT"),
        "PAYMENT_PERC": ratio("AMT_PAYMENT", "AMT_INSTALMENT"),
        "PAYMENT_DIFF": F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT"),
        "LATE": flag(late > 0),
    })


PAYMENT_STATS = (
    ROWS,
    *stats_of("DPD", ("mean", "max", "sum", "std")),
    *stats_of("DBD", ("mean", "max")),
    *stats_of("PAYMENT_PERC", ("mean", "min", "max")),
    *stats_of("PAYMENT_DIFF", ("mean", "sum", "max")),
    *flag_stats("LATE", "LATE", "COUNT"),
    *stats_of("AMT_INSTALMENT", ("mean", "sum")),
    *stats_of("AMT_PAYMENT", ("mean", "sum")),
)


def payment_blocks() -> list[Block]:
    life = (*PAYMENT_STATS, *stats_of("DAYS_INSTALMENT", ("min", "max")))
    return [Block("INS", life)] + [
        Block.of_recent(f"INS_{w}", PAYMENT_STATS, "DAYS_INSTALMENT", after, inclusive=False)
        for w, after in names.PAYMENT_WINDOWS.items()
    ]


def installments_features(payments: DataFrame) -> DataFrame:
    rows = payment_rows(payments)
    return join_on_key([
        aggregate_blocks(rows, ENTITY, payment_blocks()),
        distinct_counts(payments, ENTITY, {"INS_NUM_VERSION_NUNIQUE": "NUM_INSTALMENT_VERSION"}),
    ], ENTITY)
