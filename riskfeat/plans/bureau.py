"""Credit-bureau features: monthly status per loan, then loans per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskfeat.functions.columns import present, with_prefix
from riskfeat.functions.rows import flag, ratio
from riskfeat.operators.aggspec import (
    FULL, ROWS, SHORT, Block, Stat, aggregate_blocks, conditional_blocks, distinct_counts,
    join_on_key, numeric_block, stats_of,
)
from riskfeat.plans import columns as names
from riskfeat.sources.tables import ENTITY, LOAN


def balance_per_loan(balance: DataFrame, key: str = LOAN) -> DataFrame:
    """Row count, month range and the count and share of every status code."""
    codes = {s: f"is_{s}" for s in names.BALANCE_STATUSES}
    rows = balance.select(
        key, "MONTHS_BALANCE", *[flag(F.col("STATUS") == s).alias(c) for s, c in codes.items()]
    )
    stats = [ROWS, *stats_of("MONTHS_BALANCE", ("min", "max", "mean"), "MONTHS")]
    for s, c in codes.items():
        stats += [Stat(f"STATUS_{s}_CNT", "sum", c), Stat(f"STATUS_{s}_PCT", "mean", c)]
    return aggregate_blocks(rows, key, [Block("BUR_BB", tuple(stats))])


def recency_gaps(loans: DataFrame, key: str = ENTITY, day: str = "DAYS_CREDIT",
                 prefix: str = "BUR_RECENCY") -> DataFrame:
    """Newest and oldest day, their range, mean and deviation of the day gaps.

    Loans of one day have no gap between them, so the ordered pass runs over
    the distinct days of an entity with their counts: its size is bounded by
    the calendar, not by the number of loans.
    """
    days = loans.groupBy(key, day).agg(F.count(F.lit(1)).alias("n"))
    newest_first = Window.partitionBy(key).orderBy(F.col(day).desc_nulls_last())
    gaps = days.withColumn("gap", F.col(day) - F.lag(day).over(newest_first))
    per_key = gaps.groupBy(key).agg(
        F.max(day).alias("newest"), F.min(day).alias("oldest"),
        (F.sum(F.when(F.col(day).isNotNull(), F.col("n"))) - 1).cast("double").alias("m"),
        F.coalesce(F.sum("gap"), F.lit(0)).cast("double").alias("total"),
        F.coalesce(F.sum(F.col("gap") * F.col("gap")), F.lit(0)).cast("double").alias("squares"),
    )
    mean = F.try_divide(F.col("total"), F.col("m"))
    spread = F.greatest(F.col("squares") - F.col("total") * mean, F.lit(0.0))
    return per_key.select(
        key,
        F.col("newest").alias(f"{prefix}_{day}_MAX"),
        F.col("oldest").alias(f"{prefix}_{day}_MIN"),
        (F.col("newest") - F.col("oldest")).alias(f"{prefix}_{day}_RANGE"),
        mean.alias(f"{prefix}_AVG_CREDIT_GAP"),
        F.when(F.col("m") > 1, F.sqrt(F.try_divide(spread, F.col("m") - 1)))
        .alias(f"{prefix}_STD_CREDIT_GAP"),
    )


def lifetime_block(loans: DataFrame) -> Block:
    """Every numeric column in full, every status column of the loan rolled up again."""
    numerics = present(loans, names.BUREAU_NUMERICS)
    rollup = [
        Stat(f"{c.removeprefix('BUR_')}_{fn.upper()}", fn, c)
        for c in with_prefix(loans, "BUR_BB_") for fn in SHORT
    ]
    return Block("BUR", (ROWS, *numeric_block(numerics, FULL), *rollup))


def strata_blocks(loans: DataFrame) -> list[Block]:
    numerics = present(loans, names.BUREAU_NUMERICS)
    by_status = (ROWS, *numeric_block(numerics, SHORT))
    by_type = (ROWS, *numeric_block(present(loans, names.CREDIT_TYPE_NUMERICS), ("mean", "max")))
    return [
        Block("BUR_ACTIVE", by_status, F.col("CREDIT_ACTIVE") == "Active"),
        Block("BUR_CLOSED", by_status, F.col("CREDIT_ACTIVE") == "Closed"),
        *[Block(f"BUR_TYPE_{names.tag(t)}", by_type, F.col("CREDIT_TYPE") == t) for t in names.CREDIT_TYPES],
    ]


def cross_ratios(features: DataFrame) -> DataFrame:
    return features.withColumns({
        "BUR_DEBT_TO_CREDIT_RATIO": ratio("BUR_AMT_CREDIT_SUM_DEBT_SUM", "BUR_AMT_CREDIT_SUM_SUM"),
        "BUR_ACTIVE_RATIO": ratio("BUR_ACTIVE_COUNT", "BUR_COUNT"),
        "BUR_OVERDUE_TO_DEBT_RATIO": ratio("BUR_AMT_CREDIT_SUM_OVERDUE_SUM", "BUR_AMT_CREDIT_SUM_DEBT_SUM"),
    })


def bureau_features(loans: DataFrame, balance: DataFrame) -> DataFrame:
    # strata need no balance columns: only the lifetime block pays for that join
    enriched = loans.join(balance_per_loan(balance), LOAN, "left")
    kinds = {f"BUR_CAT_{c}_NUNIQUE": c for c in present(loans, names.BUREAU_CATEGORIES)}
    return cross_ratios(join_on_key([
        aggregate_blocks(enriched, ENTITY, [lifetime_block(enriched)]),
        conditional_blocks(loans, ENTITY, strata_blocks(loans)),
        distinct_counts(loans, ENTITY, kinds),
        recency_gaps(loans),
    ], ENTITY))
