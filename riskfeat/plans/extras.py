"""Feature groups beyond the six builders: category shares, cross-table terms, drift by rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.functions.rows import literal, quoted, ratio
from riskfeat.operators import profile
from riskfeat.operators.rank import rank_normalize
from riskfeat.sources.tables import ENTITY

# Fixed value: AUC above which a column tells score rows from labelled rows.
DRIFT_AUC = 0.60

# Cross-table terms by name: the columns they need, and what is made of them.
CROSS_TERMS: dict[str, tuple[tuple[str, str], str]] = {
    "X_INS_PAYMENT_TO_ANNUITY": (("INS_AMT_PAYMENT_MEAN", "AMT_ANNUITY"), "ratio"),
    "X_INS_PAYMENT_TO_INCOME": (("INS_AMT_PAYMENT_SUM", "AMT_INCOME_TOTAL"), "ratio"),
    "X_INS_LATE_BY_EXT_MEAN": (("INS_LATE_RATE", "APP_EXT_MEAN"), "ratio"),
    "X_INS_DPD_BY_CREDIT_TERM": (("INS_DPD_MEAN", "APP_CREDIT_TERM"), "ratio"),
    "X_INS_DPD_POS_DPD": (("INS_DPD_MEAN", "POS_SK_DPD_MEAN"), "product"),
    "X_POS_DPD_BY_EXT_MEAN": (("POS_SK_DPD_MEAN", "APP_EXT_MEAN"), "ratio"),
    "X_POS_COUNT_TO_INS_COUNT": (("POS_COUNT", "INS_COUNT"), "ratio"),
}


def category_shares(rows: DataFrame, column: str, levels: Sequence[str], prefix: str, key: str = ENTITY) -> DataFrame:
    """Per key the share of its rows in each level; a missing category counts in the denominator."""
    return rows.groupBy(key).agg(*[
        F.expr(f"avg(cast({quoted(column)} <=> {literal(v)} AS double))").alias(f"{prefix}_{column}_{v}_RATE") for v in levels])


def cross_terms(df: DataFrame) -> dict[str, Column]:
    """Terms of columns of different tables, those whose columns ``df`` has."""
    have, out = set(df.columns), {}
    for name, ((a, b), kind) in CROSS_TERMS.items():
        if {a, b} <= have:
            out[name] = ratio(a, b) if kind == "ratio" else F.col(a).cast("double") * F.col(b)
    return out


def drifting_columns(df: DataFrame, columns: Sequence[str], is_new: str, threshold: float = DRIFT_AUC) -> list[str]:
    """Columns whose values alone tell new rows from old ones."""
    table = profile.univariate_auc(df, columns, is_new)
    return [r["column"] for r in table.filter(F.col("auc") > threshold).collect()]


def rank_transform(df: DataFrame, columns: Sequence[str], is_new: str) -> DataFrame:
    """``columns`` as ranks in [0, 1] among the rows of their own side, so a shift between sides is gone."""
    out = df
    for c in columns:
        out = rank_normalize(out, c, by=is_new, out=f"{c}__rank").drop(c)
    return out.withColumnsRenamed({f"{c}__rank": c for c in columns})
