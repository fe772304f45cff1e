"""Monthly-balance features: point-of-sale loans and credit cards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.functions.columns import present
from riskfeat.functions.rows import flag, ratio
from riskfeat.operators.aggspec import (
    ROWS, Block, Stat, aggregate_blocks, distinct_counts, flag_stats, join_on_key,
    numeric_block, stats_of,
)
from riskfeat.plans import columns as names
from riskfeat.sources.tables import ENTITY


def month_blocks(prefix: str, stats: tuple[Stat, ...], life_only: tuple[Stat, ...] = ()) -> list[Block]:
    return [Block(prefix, stats + life_only)] + [
        Block.of_recent(f"{prefix}_{w}", stats, "MONTHS_BALANCE", since)
        for w, since in names.MONTH_WINDOWS.items()
    ]


def pos_features(balances: DataFrame) -> DataFrame:
    status_flags = {s: f"is_{names.tag(s)}" for s in names.POS_STATUSES}
    rows = balances.withColumns({
        "late": flag(F.col("SK_DPD") > 0),
        "late_def": flag(F.col("SK_DPD_DEF") > 0),
        **{c: flag(F.col("NAME_CONTRACT_STATUS") == s) for s, c in status_flags.items()},
    })
    stats = (
        ROWS, *numeric_block(present(balances, names.POS_NUMERICS)),
        *flag_stats("late", "DPD_FLAG"), *flag_stats("late_def", "DPD_DEF_FLAG"),
    )
    shares = tuple(
        s for value, c in status_flags.items()
        for s in flag_stats(c, f"STATUS_{names.tag(value)}", "CNT", "RATE")
    )
    return join_on_key([
        aggregate_blocks(rows, ENTITY, month_blocks("POS", stats, shares)),
        distinct_counts(balances, ENTITY, {"POS_STATUS_NUNIQUE": "NAME_CONTRACT_STATUS"}),
    ], ENTITY)


def card_rows(balances: DataFrame) -> DataFrame:
    """Utilisation plus over-limit, drawing and days-past-due flags, where the inputs exist."""
    have = set(balances.columns)
    wanted = {
        "utilisation": (("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"), lambda: ratio("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL")),
        "over_limit": (("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL"), lambda: flag(F.col("AMT_BALANCE") > F.col("AMT_CREDIT_LIMIT_ACTUAL"))),
        "drawing": (("CNT_DRAWINGS_CURRENT",), lambda: flag(F.col("CNT_DRAWINGS_CURRENT") > 0)),
        "late": (("SK_DPD",), lambda: flag(F.col("SK_DPD") > 0)),
        "late_def": (("SK_DPD_DEF",), lambda: flag(F.col("SK_DPD_DEF") > 0)),
    }
    return balances.withColumns({n: make() for n, (needs, make) in wanted.items() if have.issuperset(needs)})


def card_features(balances: DataFrame) -> DataFrame:
    rows = card_rows(balances)
    stats = [ROWS, *numeric_block(present(balances, names.CARD_NUMERICS))]
    if "utilisation" in rows.columns:
        stats += stats_of("utilisation", ("mean", "max", "min"), "UTILIZATION")
    for column, label in (("over_limit", "OVERLIMIT"), ("drawing", "DRAWING"),
                          ("late", "DPD"), ("late_def", "DPD_DEF")):
        if column in rows.columns:
            stats += flag_stats(column, label)
    return aggregate_blocks(rows, ENTITY, month_blocks("CC", tuple(stats)))


def recency_weighted_lateness(balances: DataFrame, key: str = ENTITY, prefix: str = "POS") -> DataFrame:
    """Mean days past due with weight ``1 / (1 - month)``: the current month counts most."""
    weight = 1.0 / (1.0 - F.col("MONTHS_BALANCE"))
    known = F.when(F.col("SK_DPD").isNotNull(), weight)
    return balances.groupBy(key).agg(
        F.try_divide(F.sum(F.col("SK_DPD") * weight), F.sum(known)).alias(f"{prefix}_SK_DPD_RECENCY_WEIGHTED")
    )
