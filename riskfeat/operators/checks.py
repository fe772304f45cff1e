"""Contracts and leakage checks between the stages of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.operators.folds import duplicate_keys

GATE_AUC = 0.792
MAX_FOLD_STD = 0.005
MAX_OOF_GAP = 0.001
IDENTICAL_SHARE = 0.01


def check_features(df: DataFrame, key: str, prefix: str) -> list[str]:
    """Raise unless ``df`` has one row per key; return columns without the prefix."""
    if key not in df.columns:
        raise ValueError(f"no key column {key!r}")
    if not duplicate_keys(df, key).isEmpty():
        raise ValueError(f"more than one row per {key}")
    return [c for c in df.columns if c != key and not c.startswith(prefix)]


def fold_metrics(scores: DataFrame, auc: str = "auc") -> DataFrame:
    """Mean and population deviation of the per-fold metric."""
    return scores.agg(F.avg(auc).alias("fold_mean"), F.stddev_pop(auc).alias("fold_std"))


def guard_rails(oof_auc: float, fold_aucs: Sequence[float]) -> list[str]:
    """What looks wrong about a validated model."""
    mean = sum(fold_aucs) / len(fold_aucs)
    std = (sum((a - mean) ** 2 for a in fold_aucs) / len(fold_aucs)) ** 0.5
    warnings = []
    if std > MAX_FOLD_STD:
        warnings.append(f"fold deviation {std:.5f} above {MAX_FOLD_STD}")
    if abs(oof_auc - mean) > MAX_OOF_GAP:
        warnings.append(f"out-of-fold AUC {abs(oof_auc - mean):.5f} away from the fold mean")
    return warnings


def encoding_varies(encodings: DataFrame, category: str, fold: str, value: str) -> DataFrame:
    """Per category: in how many folds it is seen, how many different encodings it gets."""
    return encodings.groupBy(category).agg(
        F.count_distinct(fold).alias("folds"), F.count_distinct(value).alias("encodings")
    ).withColumn("varies", (F.col("encodings") > 1).cast("int"))


def distinct_per_row(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many different values each row has in ``columns``."""
    return df.withColumn("n_distinct", F.size(F.array_distinct(F.array(*columns))))


def identical_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of rows whose fold values are all the same, and whether that is too many."""
    same = F.avg((F.col("n_distinct") == 1).cast("int"))
    return distinct_per_row(df, columns).agg(
        same.alias("identical_share"), (same >= IDENTICAL_SHARE).cast("int").alias("leaks")
    )


def gate(ledger: DataFrame, threshold: float = GATE_AUC) -> DataFrame:
    """Best AUC of the latest logged run and whether it passes.

    A run logs several rows at once, the best not last, so the run is judged
    by its best row.
    """
    latest = ledger.groupBy("timestamp").agg(F.max("oof_auc").alias("oof_auc")).agg(
        F.max_by("oof_auc", "timestamp").alias("oof_auc")
    )
    return latest.withColumn("passed", (F.coalesce("oof_auc", F.lit(0.0)) >= threshold).cast("int"))


def alignment(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys on one side only, both ways: zero and zero when the stages line up."""
    a = left.select(key).distinct().withColumn("_l", F.lit(1))
    b = right.select(key).distinct().withColumn("_r", F.lit(1))
    return a.join(b, key, "full").agg(
        F.count_if(F.col("_r").isNull()).alias("only_left"),
        F.count_if(F.col("_l").isNull()).alias("only_right"),
    )
