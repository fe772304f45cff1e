"""What a run leaves behind: predictions, ledgers and the scored file."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.operators.folds import duplicate_keys
from riskfeat.sources.tables import ENTITY, LABEL

RUN = "run_id"

# Ledger columns.
SUBMISSION_LEDGER = (
    "timestamp string, filename string, label string, source string, oof_auc double, "
    "public_lb double, private_lb double, notes string"
)
TUNING_LEDGER = (
    "timestamp string, model string, trial int, oof_auc double, fold_aucs_csv string, params_json string, "
    "rung int, rounds int"
)
ENSEMBLE_LEDGER = (
    "timestamp string, models_csv string, weights_csv string, oof_auc double, public_lb double, "
    "private_lb double"
)


def now() -> str:
    return datetime.now(UTC).replace(tzinfo=None).isoformat(timespec="seconds")


# ------------------------------------------------------------- predictions


def prediction_rows(scored: DataFrame, key: str, model: str, fold: int, split: str, pred: Column) -> DataFrame:
    """The shape every prediction is kept in: one row per key, model, fold and split."""
    return scored.select(
        F.col(key), F.lit(model).alias("model"), F.lit(fold).alias("fold"),
        F.lit(split).alias("split"), pred.alias("pred"),
    )


def save_predictions(predictions: DataFrame, path: str) -> None:
    """One folder per model, split and fold; a rerun replaces just those it writes."""
    (
        predictions.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("model", "split", "fold").parquet(path)
    )


def load_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def known_models(predictions: DataFrame) -> list[str]:
    return sorted(r["model"] for r in predictions.select("model").distinct().collect())


def mean_over_folds(predictions: DataFrame, key: str = ENTITY) -> DataFrame:
    """Score rows are predicted by every fold's model; their mean counts."""
    return predictions.groupBy(key, "model").agg(F.avg("pred").alias("pred"))


def fold_table(values: DataFrame, key: str, fold: str, value: str, folds: int) -> DataFrame:
    """One column per fold, for looking at an encoder's output across folds."""
    return values.groupBy(key).agg(*[
        F.max(F.when(F.col(fold) == f, F.col(value))).alias(f"fold_{f}") for f in range(folds)
    ])


# ----------------------------------------------------------------- ledgers


def append_ledger(spark: SparkSession, path: str, schema: str, rows: Sequence[tuple], run: str | None = None) -> None:
    """Add lines under the id of a run.

    A run is one partition and overwrites only its own, so a job that is
    repeated with its id, by hand or after a lost driver, leaves its lines once.
    Without an id every call is a run of its own.
    """
    lines = spark.createDataFrame(list(rows), schema).withColumn(RUN, F.lit(run or uuid4().hex))
    lines.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN).parquet(path)


def read_ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All lines, with the run that wrote them in ``run_id``."""
    return spark.read.schema(f"{schema}, {RUN} string").parquet(path)


# -------------------------------------------------------------- scored file


def scored_rows(ids: DataFrame, predictions: DataFrame, key: str = ENTITY, label: str = LABEL) -> DataFrame:
    """Every id with exactly one score; raises when the two sides do not line up."""
    if not duplicate_keys(predictions, key).isEmpty():
        raise ValueError("a key is predicted more than once: average the folds first")
    if not predictions.join(ids, key, "left_anti").isEmpty():
        raise ValueError("predictions for keys that are not to be scored: run the stages again")
    if not ids.join(predictions.filter("pred IS NOT NULL"), key, "left_anti").isEmpty():
        raise ValueError("keys without a prediction: run the stages again")
    return ids.select(key).join(predictions.select(key, F.col("pred").alias(label)), key)


def write_scored(
    ids: DataFrame, predictions: DataFrame, folder: str, source: str, label: str = "blend",
    oof_auc: float | None = None, ledger: str | None = None, key: str = ENTITY, run: str | None = None,
) -> str:
    """CSV with a header under a name that tells time, label and AUC; noted in the ledger."""
    stamp = datetime.now().strftime("%Y%m%d_%H%M%S")
    tag = "" if oof_auc is None else f"_oof{oof_auc:.4f}"
    name = f"submission_{stamp}_{label}{tag}.csv"
    scored_rows(ids, predictions, key).write.option("header", True).csv(f"{folder}/{name}")
    if ledger is not None:
        append_ledger(ids.sparkSession, ledger, SUBMISSION_LEDGER,
                      [(now(), name, label, source, oof_auc, None, None, "")], run)
    return f"{folder}/{name}"


def constant_scores(ids: DataFrame, rate: float, key: str = ENTITY, label: str = LABEL) -> DataFrame:
    """The same score for everyone: a dry run of the output format."""
    return ids.select(key, F.lit(rate).alias(label))
