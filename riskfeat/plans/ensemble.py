"""Blending and stacking of model predictions.

Predictions are kept long, ``(key, model, pred)``; models are lined up by key.
A weight search never looks at single rows on the driver: one pass over the
ranks scores a whole batch of weight vectors, and what comes back is a
histogram per vector.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from riskfeat.functions.rows import logit
from riskfeat.operators.checks import alignment, guard_rails
from riskfeat.operators.encode import median_impute, standardize
from riskfeat.operators.folds import FOLDS, SEED
from riskfeat.operators.rank import rank_normalize, roc_auc
from riskfeat.plans.training import class_weights
from riskfeat.session import cut_lineage
from riskfeat.sources.sinks import (
    ENSEMBLE_LEDGER, append_ledger, known_models, mean_over_folds, now, prediction_rows,
)
from riskfeat.sources.tables import ENTITY, LABEL

BINS = 2_048
DRAWS = 1_000
EXACT_AT_ONCE = 100
LEADERS = 25
STARTS = 5
STACKING_HINT = 0.795


def wide_predictions(predictions: DataFrame, models: Sequence[str], key: str = ENTITY, value: str = "pred") -> DataFrame:
    """One column per model; NULL where a model has not predicted a key."""
    return predictions.groupBy(key).agg(*[
        F.max(F.when(F.col("model") == m, F.col(value))).alias(m) for m in models
    ])


def complete(wide: DataFrame, models: Sequence[str], what: str) -> DataFrame:
    """``wide``, written once; raises unless every model has predicted every key."""
    table = cut_lineage(wide)
    gaps = table.agg(*[F.count_if(F.col(m).isNull()).alias(m) for m in models]).first().asDict()
    if any(gaps.values()):
        raise ValueError(f"{what}: keys without a prediction by model: { {m: n for m, n in gaps.items() if n} }")
    return table


def model_ranks(predictions: DataFrame, models: Sequence[str], key: str = ENTITY) -> DataFrame:
    """Each model's predictions as ranks in [0, 1], one column per model.

    They are written once: a prediction meets its rank by its value, and a mean
    over folds that is computed twice may differ in its last digit.
    """
    written = cut_lineage(predictions.select(key, "model", "pred"))
    ranked = rank_normalize(written, "pred", by="model", out="rank")
    return wide_predictions(ranked, models, key, "rank")


def weighted(models: Sequence[str], weights: Sequence[float]) -> Column:
    total: Column = F.lit(0.0)
    for m, w in zip(models, weights):
        total = total + F.col(m) * F.lit(float(w))
    return total


def rank_blend(predictions: DataFrame, models: Sequence[str], weights: Sequence[float], key: str = ENTITY) -> DataFrame:
    return model_ranks(predictions, models, key).select(key, weighted(models, weights).alias("blend"))


# ----------------------------------------------------------- scoring weights


def binned_auc(ranks: DataFrame, models: Sequence[str], label: str, batch: np.ndarray, bins: int = BINS) -> np.ndarray:
    """AUC of every weight vector of ``batch`` in one pass, scores cut into bins.

    Rows of one bin count as tied. Tasks combine their rows to one count per
    vector and bin before anything is shuffled.
    """
    weights = F.array(*[F.array(*[F.lit(float(x)) for x in w]) for w in np.asarray(batch, dtype=float)])
    scores = F.array(*[F.col(m) for m in models])
    cut = F.transform(weights, lambda w, i: F.struct(i.alias("i"), F.least(F.greatest(F.floor(F.aggregate(
        F.zip_with(w, scores, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b) * bins), F.lit(0)), F.lit(bins - 1)
    ).cast("int").alias("bin")))
    counts = ranks.select(F.col(label).cast("bigint").alias("_y"), F.explode(cut).alias("c")).groupBy("c.i", "c.bin").agg(
        F.sum("_y").alias("pos"), F.count_if(F.col("_y") == 0).alias("neg"))
    below = F.sum("neg").over(Window.partitionBy("i").orderBy("bin")) - F.col("neg") / 2  # at most ``bins`` rows
    scored = counts.withColumn("_wins", F.col("pos") * below).groupBy("i").agg(F.try_divide(
        F.sum("_wins"), F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))
    out = np.full(len(batch), np.nan)
    for row in scored.collect():
        out[row["i"]] = np.nan if row["auc"] is None else row["auc"]
    return out


def exact_auc(ranks: DataFrame, models: Sequence[str], label: str, batch: Sequence[Sequence[float]]) -> np.ndarray:
    """Tie-aware AUC of a few weight vectors."""
    blends = F.array(*[
        F.struct(F.lit(i).alias("i"), weighted(models, w).alias("blend")) for i, w in enumerate(batch)
    ])
    long = ranks.select(label, F.explode(blends).alias("b")).select(label, "b.i", "b.blend")
    found = {r["i"]: r["auc"] for r in roc_auc(long, "blend", label, by="i").collect()}
    return np.array([found[i] for i in range(len(batch))])


Scored = list[tuple[float, np.ndarray]]


def dirichlet_search(
    ranks: DataFrame, models: Sequence[str], label: str, draws: int = DRAWS, seed: int = SEED, exact: int | None = None
) -> Scored:
    """Uniform draws from the weight simplex with their exact AUC, best first.

    With ``exact`` all draws are ranked on bins and only that many leaders are
    scored exactly and returned.
    """
    batch = np.random.default_rng(seed).dirichlet(np.ones(len(models)), size=draws)
    if exact is not None and exact < draws:
        batch = batch[np.argsort(-binned_auc(ranks, models, label, batch), kind="stable")[:exact]]
    scores = np.concatenate([
        exact_auc(ranks, models, label, batch[i:i + EXACT_AT_ONCE]) for i in range(0, len(batch), EXACT_AT_ONCE)])
    return sorted(zip(map(float, scores), batch), key=lambda p: -p[0])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Simplex:
    """A moving simplex that asks for several points at a time.

    Each round proposes all the moves it might make, so that one pass over the
    data can score the proposals of many simplices together.
    """

    def __init__(self, start: np.ndarray, step: float = 0.25):
        self.points = np.vstack([start, start + step * np.eye(len(start))])
        self.values = np.full(len(self.points), np.nan)
        self.fresh = True

    def proposals(self) -> np.ndarray:
        if self.fresh:
            return self.points
        order = np.argsort(-self.values, kind="stable")
        self.points, self.values = self.points[order], self.values[order]
        centre = self.points[:-1].mean(axis=0)
        away = centre - self.points[-1]
        return np.vstack([centre + t * away for t in (1.0, 2.0, 0.5, -0.5)])

    def accept(self, asked: np.ndarray, scores: np.ndarray) -> None:
        if self.fresh:
            self.values, self.fresh = scores, False
            return
        i = int(np.nanargmax(scores))
        if scores[i] > self.values[-1]:
            self.points[-1], self.values[-1] = asked[i], scores[i]
        else:
            self.points = self.points[0] + 0.5 * (self.points - self.points[0])
            self.fresh = True

    def small(self, tolerance: float) -> bool:
        return not self.fresh and bool(np.ptp(self.points, axis=0).max() < tolerance)


def refine_weights(
    starts: Sequence[np.ndarray], ranks: DataFrame, models: Sequence[str], label: str,
    rounds: int = 30, tolerance: float = 1e-4,
    score: Callable[[DataFrame, Sequence[str], str, np.ndarray], np.ndarray] = binned_auc,
) -> tuple[float, np.ndarray]:
    """Local search from every start in softmax space; never worse than the best start."""
    simplices = [Simplex(np.log(np.clip(np.asarray(w, dtype=float), 1e-9, None))) for w in starts]
    for _ in range(rounds):
        moving = [s for s in simplices if not s.small(tolerance)]
        if not moving:
            break
        asked = [s.proposals() for s in moving]
        scores = score(ranks, models, label, softmax(np.vstack(asked)))
        for s, a, values in zip(moving, asked, np.split(scores, np.cumsum([len(a) for a in asked])[:-1])):
            s.accept(a, values)
    ends = [softmax(s.points[int(np.nanargmax(s.values))]) for s in simplices if not np.isnan(s.values).all()]
    candidates = [np.asarray(w, dtype=float) for w in starts] + ends
    sharp = exact_auc(ranks, models, label, candidates)
    best = int(np.argmax(sharp))
    return float(sharp[best]), candidates[best]


def log_blends(
    spark, path: str, models: Sequence[str], scored: Scored, top: int = 10, run: str | None = None,
) -> None:
    stamp = now()
    append_ledger(spark, path, ENSEMBLE_LEDGER, [
        (stamp, ",".join(models), ",".join(f"{x:.6f}" for x in w), float(auc), None, None)
        for auc, w in scored[:top]
    ], run)


def run_ensemble(
    predictions: DataFrame, labels: DataFrame, models: Sequence[str] | None = None, key: str = ENTITY,
    label: str = LABEL, draws: int = DRAWS, rounds: int = 30, ledger: str | None = None, seed: int = SEED,
    run: str | None = None,
) -> dict[str, object]:
    """Search, refine, log, and blend both splits with the refined weights."""
    models = list(models or known_models(predictions))
    oof = predictions.filter(F.col("split") == "oof")
    score = mean_over_folds(predictions.filter(F.col("split") == "score"), key)
    oof_ranks = complete(model_ranks(oof, models, key), models, "out-of-fold predictions")
    score_ranks = complete(model_ranks(score, models, key), models, "score predictions")
    labelled = cut_lineage(oof_ranks.join(labels.select(key, label), key))
    apart = alignment(oof_ranks, labels.filter(F.col(label).isNotNull()), key).first()
    if apart["only_left"] or apart["only_right"]:
        raise ValueError(f"out-of-fold keys and labelled keys differ: {apart.asDict()}")
    grid = dirichlet_search(labelled, models, label, draws, seed, LEADERS)
    auc, weights = refine_weights([w for _, w in grid[:STARTS]], labelled, models, label, rounds)
    ranking = sorted([*grid, (auc, weights)], key=lambda p: -p[0])
    if ledger is not None:
        log_blends(predictions.sparkSession, ledger, models, ranking, run=run)
    blend = weighted(models, weights)
    return {
        "models": models, "weights": [float(w) for w in weights], "oof_auc": auc,
        "oof": prediction_rows(labelled, key, "ensemble", -1, "oof", blend),
        "score": prediction_rows(score_ranks, key, "ensemble", -1, "score", blend),
        "consider_stacking": auc < STACKING_HINT,
    }


# ----------------------------------------------------------------- stacking


def stack_logistic(
    predictions: DataFrame, rows: DataFrame, models: Sequence[str], raw: Sequence[str], key: str = ENTITY,
    label: str = LABEL, fold: str = "fold_main", folds: int = FOLDS, c: float = 1.0,
) -> tuple[DataFrame, float, list[float], list[str]]:
    """Per fold a logistic model on the models' logits and standardised raw columns.

    ``rows`` carries key, label, fold and the raw columns of labelled and score
    rows. Returns predictions, AUC over all folds, fold AUCs and warnings.
    """
    oof = complete(wide_predictions(predictions.filter(F.col("split") == "oof"), models, key), models,
                   "out-of-fold predictions")
    score = complete(wide_predictions(mean_over_folds(predictions.filter(F.col("split") == "score"), key), models, key),
                     models, "score predictions")
    logits = oof.unionByName(score).select(key, *[logit(m).alias(m) for m in models])
    table = cut_lineage(rows.select(key, label, fold, *raw).join(logits, key))
    parts = []
    for f in range(folds):
        train = F.col(label).isNotNull() & (F.col(fold) != f)
        frame = standardize(median_impute(table, raw, train), raw, train) if raw else table
        vectors = VectorAssembler(inputCols=[*models, *raw], outputCol="v").transform(frame)
        vectors = vectors.select(key, fold, F.col(label).cast("double").alias(label), "v").persist(
            StorageLevel.MEMORY_AND_DISK
        )
        training = class_weights(vectors.filter(train), label, positive=None)
        size = training.count()
        model = LogisticRegression(
            featuresCol="v", labelCol=label, weightCol="_weight", regParam=1.0 / (c * size),
            elasticNetParam=0.0, standardization=False, maxIter=2000,
        ).fit(training)
        pred = vector_to_array("probability")[1]
        held = model.transform(vectors.filter(F.col(fold) == f))
        rest = model.transform(vectors.filter(F.col(label).isNull()))
        parts.append(cut_lineage(
            prediction_rows(held, key, "stack", f, "oof", pred)
            .unionByName(prediction_rows(rest, key, "stack", f, "score", pred))
        ))
        vectors.unpersist()
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    labelled = out.filter(F.col("split") == "oof").join(rows.select(key, label), key)
    per_fold = [r["auc"] for r in roc_auc(labelled, "pred", label, by="fold").orderBy("fold").collect()]
    auc = roc_auc(labelled, "pred", label).first()["auc"]
    return out, auc, per_fold, guard_rails(auc, per_fold)


def model_aucs(predictions: DataFrame, labels: DataFrame, key: str = ENTITY, label: str = LABEL) -> DataFrame:
    """Out-of-fold AUC of every stored model."""
    joined = predictions.filter(F.col("split") == "oof").join(labels.select(key, label), key)
    return roc_auc(joined, "pred", label, by="model")


def lift_over_best(aucs: DataFrame, challenger: str) -> DataFrame:
    """The challenger against the best of the other models."""
    mine = F.max(F.when(F.col("model") == challenger, F.col("auc")))
    others = F.when(F.col("model") != challenger, F.col("auc"))
    return aucs.agg(
        mine.alias("auc"), F.max_by("model", others).alias("best_model"), F.max(others).alias("best_auc"),
        (mine - F.max(others)).alias("lift"),
    )
