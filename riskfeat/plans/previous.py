"""Features of earlier applications."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.functions.columns import present
from riskfeat.functions.rows import flag, ratio
from riskfeat.operators.aggspec import (
    ROWS, SHORT, Block, Stat, aggregate_blocks, distinct_counts, join_on_key, numeric_block,
    stats_of,
)
from riskfeat.plans import columns as names
from riskfeat.sources.tables import ENTITY


def previous_rows(prior: DataFrame) -> DataFrame:
    """Granted share, down-payment share and status flags; a missing status stays NULL."""
    return prior.withColumns({
        "applied_to_credit": ratio("AMT_APPLICATION", "AMT_CREDIT"),
        "down_to_credit": ratio("AMT_DOWN_PAYMENT", "AMT_CREDIT"),
        "is_refused": flag(F.col("NAME_CONTRACT_STATUS") == "Refused"),
        "is_approved": flag(F.col("NAME_CONTRACT_STATUS") == "Approved"),
    })


def previous_blocks(prior: DataFrame) -> list[Block]:
    numerics = present(prior, names.PREVIOUS_NUMERICS)
    typed = present(prior, names.CONTRACT_TYPE_NUMERICS)
    life = [
        ROWS, *numeric_block(numerics),
        *stats_of("applied_to_credit", ("mean", "max", "min"), "APP_CREDIT_PERC"),
        *stats_of("down_to_credit", ("mean", "max"), "DOWNPAYMENT_RATIO"),
        Stat("REFUSAL_RATE", "mean", "is_refused"), Stat("APPROVAL_RATE", "mean", "is_approved"),
    ]
    strata = (ROWS, *numeric_block(numerics, SHORT))
    return [
        Block("PREV", tuple(life)),
        Block("PREV_APPROVED", strata, F.col("NAME_CONTRACT_STATUS") == "Approved"),
        Block("PREV_REFUSED", strata, F.col("NAME_CONTRACT_STATUS") == "Refused"),
        *[
            Block(prefix, (ROWS, *numeric_block(typed, ("mean", "max"))),
                  F.col("NAME_CONTRACT_TYPE") == value)
            for value, prefix in names.CONTRACT_TYPES.items()
        ],
    ]


def previous_features(prior: DataFrame) -> DataFrame:
    rows = previous_rows(prior)
    kinds = {f"PREV_CAT_{c}_NUNIQUE": c for c in present(prior, names.PREVIOUS_CATEGORIES)}
    out = join_on_key([
        aggregate_blocks(rows, ENTITY, previous_blocks(rows)),
        distinct_counts(prior, ENTITY, kinds),
    ], ENTITY)
    return out.withColumn(
        "PREV_APPROVED_TO_REFUSED_RATIO",
        ratio("PREV_APPROVED_COUNT", F.col("PREV_REFUSED_COUNT") + 1),
    )
