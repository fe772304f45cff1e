"""The jobs between stored tables: folds, training, blending, the scored file.

Each job reads what the jobs before it have written under one folder, checks
it, and writes its own result there:

    folds            key and fold of every labelled entity
    folds_group      key and fold of every labelled entity with events, balanced by events
    auxiliary_*      event-level features of one child table, where the gate has let them through
    predictions      (key, model, fold, split, pred), partitioned by model, split and fold
    fold_values      target encodings by fold, one table per model
    summary          one row per trained model
    stack_folds_*    predictions of the stack by fold: key and one column per fold, one table per split
    tuning_ledger, ensemble_ledger, submission_ledger
    scored/          the scored files
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.functions.columns import present
from riskfeat.operators.aggspec import join_on_key
from riskfeat.operators.checks import GATE_AUC, alignment, gate
from riskfeat.operators.encode import fit_target_encoder
from riskfeat.operators.folds import (
    FOLDS, SEED, check_folds, duplicate_keys, group_folds, split_by_label, stratified_folds,
)
from riskfeat.plans.auxiliary import event_level_features
from riskfeat.plans.ensemble import run_ensemble, stack_logistic
from riskfeat.plans.training import FoldColumns, Learner, learner, run_oof
from riskfeat.sources.sinks import (
    ENSEMBLE_LEDGER, append_ledger, fold_table, known_models, load_predictions, now, read_ledger, save_predictions, write_scored,
)
from riskfeat.sources.tables import ENTITY, LABEL, read_table, write_table

SUMMARY = (
    "timestamp string, model string, matrix string, oof_auc double, fold_aucs_csv string, warnings string, "
    "best_rounds_csv string"
)


def aligned(left: DataFrame, right: DataFrame, key: str, what: str) -> None:
    """Raise unless both sides hold the same keys."""
    found = alignment(left, right, key).first()
    if found["only_left"] or found["only_right"]:
        raise ValueError(f"{what}: {found['only_left']} keys only on the left, {found['only_right']} only on the right")


def fold_job(
    base: DataFrame, out: str, key: str = ENTITY, label: str = LABEL, folds: int = FOLDS, seed: int = SEED,
    tolerance: float = 0.005,
) -> DataFrame:
    """Stratified folds of the labelled rows: built, checked, stored."""
    labelled, _ = split_by_label(base.select(key, label), label)
    write_table(stratified_folds(labelled, key, label, folds, seed), out, "folds")
    stored = read_table(base.sparkSession, out, "folds")
    failed = check_folds(stored, labelled, key, label, n_folds=folds, tolerance=tolerance)
    if failed:
        raise ValueError(f"folds fail: {', '.join(failed)}")
    aligned(stored, labelled, key, "folds and labelled rows")
    return stored


def group_fold_job(
    events: DataFrame, labels: DataFrame, out: str, key: str = ENTITY, label: str = LABEL, folds: int = FOLDS,
    seed: int = SEED, name: str = "folds_group",
) -> DataFrame:
    """Folds of labelled entities for models of single events: balanced by events, an entity in one fold only."""
    labelled, _ = split_by_label(labels.select(key, label), label)
    mine = events.join(labelled.select(key), key, "left_semi")
    write_table(group_folds(mine, key, folds, seed), out, name)
    stored = read_table(events.sparkSession, out, name)
    if not duplicate_keys(stored, key).isEmpty():
        raise ValueError(f"{name}: an entity falls into more than one fold")
    aligned(stored, mine, key, "group folds and entities with events")
    return stored


# Child tables that get an event-level model: prefix of its features, column that tells recent events.
AUXILIARY: dict[str, tuple[str, str | None]] = {
    "installments_payments": ("INS", "DAYS_INSTALMENT"), "previous_application": ("PREV", None),
}


def gate_passed(spark: SparkSession, out: str, threshold: float = GATE_AUC) -> bool:
    """Whether the latest blend reaches the threshold; not where none has been logged."""
    try:
        ledger = read_ledger(spark, f"{out}/ensemble_ledger", ENSEMBLE_LEDGER)
        return bool(gate(ledger, threshold).first()["passed"])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def auxiliary_job(
    spark: SparkSession, processed: str, out: str, labels: DataFrame, key: str = ENTITY, label: str = LABEL,
    folds: int = FOLDS, threshold: float = GATE_AUC, model: Learner | None = None,
    tables: Mapping[str, tuple[str, str | None]] = AUXILIARY,
) -> list[str]:
    """Event-level features of the child tables, stored if the gate passes; the names of what was stored.

    Nothing is trained otherwise, and nothing is left of an earlier run that did pass.
    """
    passed = gate_passed(spark, out, threshold)
    for name, (prefix, when) in tables.items() if passed else ():
        events = read_table(spark, processed, name)
        stored = group_fold_job(events, labels, out, key, label, folds, name=f"folds_group_{name}")
        features = event_level_features(events, labels, prefix, when, key=key, label=label, folds=folds, model=model,
                                        group=stored)
        write_table(features, out, f"auxiliary_{name}")
    made = [f"auxiliary_{name}" for name in tables] if passed else []
    write_table(spark.createDataFrame([(n,) for n in made], "name string"), out, "auxiliary")
    return made


def gated_matrix(
    spark: SparkSession, features: str, out: str, matrix: str = "main", key: str = ENTITY,
) -> DataFrame:
    """A stored matrix, with the columns of ``auxiliary_job`` where the gate has let them through."""
    rows = read_table(spark, features, matrix)
    made = [r["name"] for r in read_table(spark, out, "auxiliary").collect()]
    return join_on_key([rows, *[read_table(spark, out, n) for n in sorted(made)]], key)


def train_job(
    spark: SparkSession, features: str, out: str, model: str | Learner, spec: FoldColumns = FoldColumns(),
    key: str = ENTITY, label: str = LABEL, folds: int = FOLDS, run: str | None = None, **options: object,
) -> float:
    """Train one model on the matrix that it names and on the stored folds; returns its AUC.

    Its line in the summary tells the AUC and the boosting rounds of each fold.
    A job repeated with the same ``run`` replaces its own line.
    """
    made = learner(model) if isinstance(model, str) else model
    matrix, stored = read_table(spark, features, made.matrix), read_table(spark, out, "folds")
    aligned(stored, split_by_label(matrix, label)[0], key, "folds and labelled rows of the matrix")
    rows = matrix.join(stored, key, "left")
    result = run_oof(rows, made, spec, key=key, label=label, folds=folds, **options)
    save_predictions(result.predictions, f"{out}/predictions")
    encoded = present(rows, spec.target_encode)
    if encoded:
        encoder = fit_target_encoder(rows, encoded, label, "fold_main", folds)
        values = [encoder.apply(rows.select(key, label, "fold_main", *encoded), f).withColumn("fold", F.lit(f)) for f in range(folds)]
        long = values[0]
        for v in values[1:]:
            long = long.unionByName(v)
        made_columns = [c for c in long.columns if c not in (key, label, "fold_main", "fold", *encoded)]
        write_table(fold_table(long, key, "fold", made_columns[0], folds), out, f"fold_values_{made.name}")
    append_ledger(spark, f"{out}/summary", SUMMARY, [(
        now(), made.name, made.matrix, result.oof_auc,
        ",".join("" if a is None else f"{a:.6f}" for a in result.fold_aucs), "; ".join(result.warnings),
        ",".join("" if n is None else str(n) for n in result.best_rounds))], run=run and f"{run}-{made.name}")
    return result.oof_auc


def ensemble_job(
    spark: SparkSession, out: str, labels: DataFrame, models: Sequence[str] | None = None, key: str = ENTITY,
    label: str = LABEL, **options: object,
) -> dict[str, object]:
    """Blend every stored model; the blend is stored next to them as model ``ensemble``.

    Raises where a model lacks a key or predicts one that is not its own.
    """
    stored = load_predictions(spark, f"{out}/predictions")
    chosen = list(models or [m for m in known_models(stored) if m not in BLENDS])
    result = run_ensemble(stored.filter(F.col("model").isin(chosen)), labels.filter(F.col(label).isNotNull()), chosen, key,
                          label, ledger=f"{out}/ensemble_ledger", **options)
    save_predictions(result["oof"].unionByName(result["score"]), f"{out}/predictions")
    return result


BLENDS = ("ensemble", "stack")


def stack_job(
    spark: SparkSession, features: str, out: str, models: Sequence[str] | None = None, raw: Sequence[str] = (),
    matrix: str = "main", key: str = ENTITY, label: str = LABEL, folds: int = FOLDS, run: str | None = None,
    c: float = 1.0,
) -> float:
    """Stack the stored models on the stored folds, with ``raw`` columns of a matrix; returns the AUC.

    Predictions are stored as model ``stack``, with a table of one column per
    fold for each split, and a line goes to the summary. Raises where folds
    and matrix, or a model and the folds, do not hold the same keys. Blends
    are no inputs unless named.
    """
    rows, known = read_table(spark, features, matrix), read_table(spark, out, "folds")
    aligned(known, split_by_label(rows, label)[0], key, "folds and labelled rows of the matrix")
    stored = load_predictions(spark, f"{out}/predictions")
    chosen = list(models or [m for m in known_models(stored) if m not in BLENDS])
    mine = stored.filter(F.col("model").isin(chosen))
    for m in chosen:
        aligned(mine.filter((F.col("model") == m) & (F.col("split") == "oof")), known, key, f"predictions of {m} and folds")
    table = rows.select(key, label, *raw).join(known, key, "left")
    made, auc, per_fold, warnings = stack_logistic(mine, table, chosen, raw, key, label, folds=folds, c=c)
    save_predictions(made, f"{out}/predictions")
    for split in ("oof", "score"):
        write_table(fold_table(made.filter(F.col("split") == split), key, "fold", "pred", folds), out, f"stack_folds_{split}")
    append_ledger(spark, f"{out}/summary", SUMMARY, [(
        now(), "stack", matrix, auc, ",".join("" if a is None else f"{a:.6f}" for a in per_fold), "; ".join(warnings), "")],
        run=run and f"{run}-stack")
    return auc


def submit_job(
    spark: SparkSession, out: str, ids: DataFrame, model: str = "ensemble", oof_auc: float | None = None, key: str = ENTITY,
    run: str | None = None,
) -> str:
    """The scored file of one stored model, noted in the ledger; returns its path."""
    stored = load_predictions(spark, f"{out}/predictions")
    mine = stored.filter((F.col("model") == model) & (F.col("split") == "score"))
    scores = mine.groupBy(key).agg(F.avg("pred").alias("pred"))
    aligned(scores, ids, key, "predictions and rows to score")
    return write_scored(ids, scores, f"{out}/scored", model, model, oof_auc, f"{out}/submission_ledger", key, run)


def best_model(spark: SparkSession, out: str) -> str:
    """The trained model with the highest AUC so far, the latest of equals."""
    best = read_ledger(spark, f"{out}/summary", SUMMARY).agg(
        F.max_by("model", F.struct("oof_auc", "timestamp")).alias("model")).first()
    return best["model"]
