"""Seeded fold assignment, its checks, and seeded row samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeat.functions.rows import seeded_hash
from riskfeat.operators.lookup import attach
from riskfeat.operators.rank import ordinals

SEED = 42
FOLDS = 5


def stratified_folds(
    df: DataFrame, key: str, label: str, folds: int = FOLDS, seed: int = SEED, out: str = "fold_main"
) -> DataFrame:
    """``(key, fold)``: every label class is dealt round-robin in seeded order.

    Fold sizes differ by at most one row per class, whatever the partitioning.
    """
    if label not in df.columns:
        raise KeyError(f"no label column {label!r}")
    hashed = df.select(key, label, seeded_hash(key, seed).alias("_hash"))
    dealt = ordinals(hashed, "_hash", F.substring("_hash", 1, 3), by=label)
    return dealt.select(key, F.pmod("ordinal", F.lit(folds)).cast("int").alias(out))


def _snake(position: Column, folds: int) -> Column:
    """0, 1, .., k-1, k-1, .., 1, 0, 0, 1, ..: evens out what a plain deal would skew."""
    step = F.pmod(position, F.lit(2 * folds))
    return F.when(step < folds, step).otherwise(2 * folds - 1 - step).cast("int")


def group_folds(
    df: DataFrame, key: str, folds: int = FOLDS, seed: int = SEED, out: str = "fold_group"
) -> DataFrame:
    """``(key, fold)`` with all rows of a key in one fold, folds balanced by rows.

    Keys are laid out from largest to smallest (equal sizes in seeded order)
    and dealt in a snake.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_size"))
    hashed = sizes.withColumn("_hash", seeded_hash(key, seed))
    local = ordinals(hashed, "_hash", F.substring("_hash", 1, 3), by="_size")
    # there can be no more than sqrt(2 * rows) different sizes
    per_size = sizes.groupBy("_size").agg(F.count(F.lit(1)).alias("_keys"))
    larger = Window.partitionBy(F.lit(0)).orderBy(F.col("_size").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = per_size.select("_size", F.coalesce(F.sum("_keys").over(larger), F.lit(0)).alias("_start"))
    placed = attach(local, offsets, "_size")
    return placed.select(key, _snake(F.col("ordinal") + F.col("_start"), folds).alias(out))


def fold_balance(df: DataFrame, fold: str, label: str) -> DataFrame:
    """Rows, positives' share and its distance from the overall share, per fold."""
    per_fold = df.groupBy(fold).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("positives")
    )
    everything = Window.partitionBy(F.lit(0))  # one row per fold
    overall = F.try_divide(F.sum("positives").over(everything), F.sum("n").over(everything).cast("double"))
    rate = F.try_divide(F.col("positives"), F.col("n").cast("double"))
    return per_fold.select(
        fold, "n", "positives", rate.alias("pos_rate"), F.abs(rate - overall).alias("drift")
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once; empty when the key is unique."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys present on both sides."""
    return left.select(key).intersect(right.select(key))


def fold_overlap(df: DataFrame, key: str, fold: str) -> DataFrame:
    """Keys whose rows fall into more than one fold; empty for a sound group split."""
    return df.groupBy(key).agg(
        F.min(fold).alias("first_fold"), F.max(fold).alias("last_fold")
    ).filter("first_fold <> last_fold")


def check_folds(
    folds: DataFrame, labelled: DataFrame, key: str, label: str, fold: str = "fold_main",
    n_folds: int = FOLDS, tolerance: float = 0.005,
) -> list[str]:
    """Names of the failed checks: unique keys, fold range, class balance."""
    failed = []
    if not duplicate_keys(folds, key).isEmpty():
        failed.append("duplicate keys")
    balance = fold_balance(folds.join(labelled.select(key, label), key), fold, label).collect()
    if sorted(r[fold] for r in balance) != list(range(n_folds)):
        failed.append("fold range")
    if any(r["drift"] >= tolerance for r in balance):
        failed.append("class balance")
    return failed


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """Exactly ``min(n, rows)`` rows by unique key, the same on every run and layout.

    The keys are thinned by hash before the smallest ``n`` hashes are picked,
    so the pick sees little more than ``n`` keys and never a wide row.
    """
    total = df.count()
    if total <= n:
        return df
    share = (1.1 * n + 1_000) / total
    keys = df.select(key)
    thinned = seeded_fraction(keys, key, share, seed) if share < 1 else keys
    if thinned.limit(n).count() < n:
        thinned = keys
    picked = thinned.orderBy(seeded_hash(key, seed), key).limit(n)
    return df.join(picked, key, "left_semi")


def seeded_fraction(df: DataFrame, key: str, share: float, seed: int = SEED) -> DataFrame:
    """About ``share`` of the rows by hash, without any shuffle."""
    spot = F.conv(F.substring(seeded_hash(key, seed), 1, 8), 16, 10).cast("bigint")
    return df.filter(spot < F.lit(int(share * 2**32)))


def split_by_label(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Labelled rows and the rows to score."""
    return df.filter(F.col(label).isNotNull()), df.filter(F.col(label).isNull())
