from threading import Barrier

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfeat.operators.folds import split_by_label, stratified_folds
from riskfeat.plans import auxiliary, ensemble, training
from riskfeat.sources import sinks

QUICK = dict(maxIter=6, maxDepth=3)


@pytest.fixture(scope="module")
def matrix(spark):
    """A planted signal, a fold-dependent trap, categories, holes; 100 rows to score."""
    rng = np.random.default_rng(5)
    n = 900
    y = (rng.random(n) < 0.25).astype(int)
    data = [
        (i, int(y[i]) if i < 800 else None, float(1.2 * y[i] + rng.normal()), None if i % 7 == 0 else float(rng.normal()),
         "abc"[int(rng.integers(3))] if i % 11 else None) for i in range(n)
    ]
    df = spark.createDataFrame(data, "SK_ID_CURR long, TARGET int, signal double, noise double, cat string")
    train, _ = split_by_label(df, "TARGET")
    return df.join(stratified_folds(train, "SK_ID_CURR", "TARGET", folds=3), "SK_ID_CURR", "left").cache()


@pytest.fixture(scope="module")
def trees(matrix):
    spec = training.FoldColumns(target_encode=("cat",), neighbours=("signal", "noise"), k=40)
    return training.run_oof(matrix, training.learner("lgbm", **{**QUICK, "minInstancesPerNode": 5}), spec, folds=3)


def check_predictions(result, matrix):
    oof = result.predictions.filter("split = 'oof'")
    assert oof.count() == 800 == oof.select("SK_ID_CURR").distinct().count()
    assert oof.join(matrix, "SK_ID_CURR").filter("fold <> fold_main").count() == 0
    score = result.predictions.filter("split = 'score'")
    assert score.count() == 300 and score.select("SK_ID_CURR").distinct().count() == 100
    assert result.predictions.filter("pred IS NULL OR pred < 0 OR pred > 1").count() == 0


def test_out_of_fold_trees(trees, matrix):
    check_predictions(trees, matrix)
    assert trees.oof_auc > 0.7 and len(trees.fold_aucs) == 3
    top = training.mean_importances(trees.importances).first()["feature"]
    assert top in ("signal", "TARGET_NEIGHBORS_500_MEAN")


def test_fold_columns_do_not_see_their_own_fold(matrix):
    """Flipping the labels of a fold leaves that fold's encodings unchanged."""
    spec = training.FoldColumns(target_encode=("cat",))
    flipped = matrix.withColumn("TARGET", F.when(F.col("fold_main") == 1, 1 - F.col("TARGET")).otherwise(F.col("TARGET")))
    one, two = (
        training.fold_frame(m, 1, spec, folds=3).filter("fold_main = 1").orderBy("SK_ID_CURR").select("cat_TE").collect()
        for m in (matrix, flipped)
    )
    assert one == two
    other = training.fold_frame(flipped, 0, spec, folds=3).filter("fold_main = 1").orderBy("SK_ID_CURR").select("cat_TE").collect()
    assert other != training.fold_frame(matrix, 0, spec, folds=3).filter("fold_main = 1").orderBy("SK_ID_CURR").select("cat_TE").collect()


def test_perceptron(matrix):
    model = training.learner("nn_b", hidden=(4,), maxIter=25, select=2)
    result = training.run_oof(matrix.drop("cat"), model, training.FoldColumns(rank_gauss=True), folds=3)
    check_predictions(result, matrix)
    assert result.oof_auc > 0.7


@pytest.mark.parametrize("losses,patience,limit,best", [
    ([3, 2, 1, 2, 2], 2, 9, 3), ([3, 2, 1, 2], 2, 9, None), ([3, 2, 1, 2], 2, 4, 3), ([3, 4, 4, 1], 2, 9, 1), ([1], 5, 1, 1),
    ([2, 2, 2, 2], 3, 9, 1), ([3, 2, 1], 1, 9, None), ([2, 3, 1, 3, 0], 2, 9, None)])
def test_where_patience_ends(losses, patience, limit, best):
    assert training.stopped_at(losses, patience, limit) == best


def prefix_losses(model, held):
    """Log loss of every prefix, tree by tree from the trees' own predictions."""
    rows = held.orderBy("SK_ID_CURR").collect()
    sign, weight = np.array([2 * r["TARGET"] - 1 for r in rows]), np.array([r[training.WEIGHT] for r in rows])
    margin, out = np.zeros(len(rows)), []
    for tree, share in zip(model.trees, model.treeWeights):
        margin += share * np.array([r["prediction"] for r in tree.setPredictionCol("prediction").transform(
            held.drop("prediction")).orderBy("SK_ID_CURR").collect()])
        out.append(float((weight * 2 * np.log1p(np.exp(-2 * sign * margin))).sum() / weight.sum()))
    return out


def test_boosting_stops_at_the_best_prefix(matrix, monkeypatch):
    monkeypatch.setattr(training, "FIRST_ROUNDS", 1)
    model = training.learner("xgb", maxDepth=4, stepSize=0.4, minInstancesPerNode=1, featureSubsetStrategy="all", maxIter=16)
    store = training.fold_store(matrix.drop("cat"), model, folds=3)
    vectors = training.class_weights(store.frames[0], "TARGET", 2.0)
    fit, held = vectors.filter("TARGET IS NOT NULL AND fold_main <> 0"), vectors.filter("fold_main = 0").cache()
    estimator = model.estimator(2)
    cut, best = training.fit_with_patience(estimator, fit, held, 3)
    whole = estimator.fit(fit)
    losses = prefix_losses(whole, held)
    assert best == training.stopped_at(losses, 3, 16) and best < 13  # it overfits within the rounds
    assert losses[best - 1] == min(losses[:best + 3]) and cut.getNumTrees == best
    again = model.estimator(2).setMaxIter(best).fit(fit)  # boosting is deterministic: the prefix is the shorter model
    assert [r["probability"] for r in cut.transform(held).orderBy("SK_ID_CURR").collect()] == \
        [r["probability"] for r in again.transform(held).orderBy("SK_ID_CURR").collect()]
    none, rounds = training.fit_with_patience(estimator, fit, held.limit(0), 3)
    assert rounds == 16 == none.getNumTrees


def test_rounds_of_each_fold_and_unknown_names(matrix):
    model = training.learner("xgb", maxIter=5000, patience=2, stepSize=0.5, maxDepth=4)
    result = training.run_oof(matrix.select("SK_ID_CURR", "TARGET", "signal", "fold_main"), model, folds=3)
    check_predictions(result, matrix)
    assert result.oof_auc > 0.75 and all(1 <= n < 60 for n in result.best_rounds)
    with pytest.raises(ValueError):
        training.learner("nope")


def test_presets_stop_by_patience():
    trees = {n: p for n, (_, kind, p) in training.PRESETS.items() if kind == "gbt"}
    assert set(trees) == {"lgbm", "xgb", "catboost"}
    assert all(p["maxIter"] == 5000 and p["patience"] == 200 for p in trees.values())


@pytest.mark.parametrize("trials,rounds", [(50, 900), (9, 9), (1, 100), (7, 3), (80, 5000)])
def test_rungs_of_halving(trials, rounds):
    steps = training.rungs(trials, rounds, 3, 1)
    assert steps[0][0] == trials and steps[-1][1] == rounds
    assert all(a[0] >= b[0] >= 1 and a[1] <= b[1] for a, b in zip(steps, steps[1:]))


def test_search_fits_the_folds_once(spark, matrix, tmp_path, monkeypatch):
    made, plain = [], training.fold_frame
    monkeypatch.setattr(training, "fold_frame", lambda *a, **k: made.append(1) or plain(*a, **k))
    ledger = str(tmp_path / "tuning")
    small = matrix.select("SK_ID_CURR", "TARGET", "signal", "fold_main")
    ask = dict(trials=4, ledger=ledger, fixed=dict(maxIter=4, maxDepth=2, minInstancesPerNode=5), folds=3, least=1, run="r1")
    found = training.halving_search(small, "xgb", **ask)
    assert len(made) == 3  # however many trials
    assert sorted(t.number for t in found) == list(range(4)) and all(t.oof_auc is not None for t in found)
    assert found[0].rounds == 4 and found[0].rung == max(t.rung for t in found) and found[-1].rung == 0
    log = sinks.read_ledger(spark, ledger, sinks.TUNING_LEDGER)
    n = log.count()
    assert n > 4 and log.filter("rung = 0").count() == 4
    row = training.best_trial(log).first()
    assert row["oof_auc"] == pytest.approx(found[0].oof_auc) and row["model"] == "xgb" and row["trial"] == found[0].number
    again = training.halving_search(small, "xgb", **ask)
    assert [(t.number, t.oof_auc) for t in again] == [(t.number, t.oof_auc) for t in found]
    assert sinks.read_ledger(spark, ledger, sinks.TUNING_LEDGER).count() == n  # the run replaced its own lines
    alone = training.run_oof(small, training.learner("xgb", **{**found[0].params, **ask["fixed"]}), folds=3)
    assert alone.oof_auc == pytest.approx(found[0].oof_auc)
    assert training.sample_params(training.SPACES["xgb"], 3) == training.sample_params(training.SPACES["xgb"], 3)
    for name, (low, high, scale) in training.SPACES["lgbm"].items():
        value = float(training.sample_params(training.SPACES["lgbm"], 1)[name])
        assert low <= value <= high


def test_null_importance_keeps_the_signal(matrix):
    df = matrix.drop("fold_main", "cat").withColumn("constant", F.lit(2.0))
    found = {c: (real, bar) for c, real, bar in training.null_importances(df, runs=3, sample=None, params=QUICK)}
    assert set(found) == {"signal", "noise", "constant"}
    assert found["signal"][0] > found["noise"][0] and found["signal"][0] > found["signal"][1]
    assert found["constant"] == (0.0, 0.0) and sum(r for r, _ in found.values()) == pytest.approx(1)
    dropped = training.null_importance_columns(df, runs=3, sample=None, params=QUICK)
    assert dropped == [c for c, (real, bar) in found.items() if real <= bar]
    assert "signal" not in dropped and "constant" in dropped


def test_adversarial_validation_sees_a_shift(matrix):
    df = matrix.drop("fold_main", "cat").withColumn("shifted", F.when(F.col("TARGET").isNull(), 5.0).otherwise(0.0) + F.rand(1))
    model = training.Learner("adversarial", "gbt", params=QUICK)
    auc, verdict, importances = training.adversarial_validation(df, folds=3, model=model)
    assert auc > 0.95 and verdict == "high drift" and importances.first()["feature"] == "shifted"


def test_event_level_features(spark):
    rng = np.random.default_rng(6)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(80)], "SK_ID_CURR long, TARGET int")
    events = spark.createDataFrame(
        [(i, i * 100 + j, float((i % 4 == 0) + 0.5 * rng.normal()), float(-j * 40)) for i in range(90) for j in range(6)],
        "SK_ID_CURR long, SK_ID_PREV long, late double, day double")
    model = training.Learner("auxiliary", "gbt", params=QUICK)
    out = auxiliary.event_level_features(events, labels, "INS", "day", folds=3, model=model)
    assert out.count() == 80
    assert out.columns[1:] == [f"INS_AUX_OOF_{s}" for s in ("MEAN", "MAX", "MIN", "LAST3M_MEAN")]
    rows = out.join(labels, "SK_ID_CURR").groupBy("TARGET").agg(F.avg("INS_AUX_OOF_MEAN")).orderBy("TARGET").collect()
    assert rows[1][1] > rows[0][1] + 0.2


def test_events_meet_their_folds_once(spark):
    used = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            used.add(len(b))
            yield b

    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "SK_ID_CURR long, TARGET int")
    events = spark.range(90).select((F.col("id") % 30).alias("SK_ID_CURR"), (F.col("id") % 7).cast("double").alias("x"))
    group = labels.select("SK_ID_CURR", (F.col("SK_ID_CURR") % 3).cast("int").alias("fold_group"))
    model = training.Learner("auxiliary", "gbt", params=dict(maxIter=1, maxDepth=1))
    out = auxiliary.event_level_features(
        events, labels, "X", folds=3, model=model, group=group.mapInPandas(counted, group.schema))
    assert out.count() == 30 and used.value == 30


def test_folds_run_side_by_side_and_keep_their_order(spark):
    together = Barrier(3, timeout=30)  # breaks unless three folds are at work at the same time

    def work(f):
        together.wait()
        return spark.range(f + 1).count()

    assert training.of_every_fold(spark, 3, work) == [1, 2, 3]
    with pytest.raises(KeyError):
        training.of_every_fold(spark, 3, lambda f: {}[f])


def test_rollup_threshold_by_unit(spark):
    months = spark.createDataFrame([(1, -3, 0.2), (1, -4, 0.9)], "SK_ID_CURR long, t int, pred double")
    days = spark.createDataFrame([(1, -90, 0.2), (1, -91, 0.9), (1, -101, 0.9)], "SK_ID_CURR long, t int, pred double")
    for rows in (months, days):
        assert auxiliary.rollup_predictions(rows, "P", "t").first()["P_AUX_OOF_LAST3M_MEAN"] == pytest.approx(0.2)


# ---------------------------------------------------------------------- ensembles


@pytest.fixture(scope="module")
def scored(spark):
    """Two complementary models and a useless one, with labels."""
    rng = np.random.default_rng(7)
    n = 1500
    y = (rng.random(n) < 0.3).astype(int)
    preds = {
        "good": y + rng.normal(size=n), "other": y + rng.normal(size=n), "useless": rng.normal(size=n).round(1)}
    rows = [(i, m, 0, "oof" if i < 1300 else "score", float(1 / (1 + np.exp(-p[i])))) for m, p in preds.items() for i in range(n)]
    predictions = spark.createDataFrame(rows, "SK_ID_CURR long, model string, fold int, split string, pred double").cache()
    labels = spark.createDataFrame(
        [(i, int(y[i]) if i < 1300 else None, i % 3 if i < 1300 else None, float(rng.normal())) for i in range(n)],
        "SK_ID_CURR long, TARGET int, fold_main int, raw double").cache()
    return predictions, labels, np.column_stack([preds[m] for m in ("good", "other", "useless")])[:1300], y[:1300]


MODELS = ["good", "other", "useless"]


def ranks_of(scored):
    predictions, labels, _, _ = scored
    ranks = ensemble.model_ranks(predictions.filter("split = 'oof'"), MODELS)
    return ranks.join(labels.select("SK_ID_CURR", "TARGET"), "SK_ID_CURR").cache()


def test_binned_auc_is_close_to_exact(scored):
    ranks = ranks_of(scored)
    batch = np.random.default_rng(1).dirichlet(np.ones(3), size=6)
    rough, sharp = ensemble.binned_auc(ranks, MODELS, "TARGET", batch), ensemble.exact_auc(ranks, MODELS, "TARGET", batch)
    assert rough == pytest.approx(sharp, abs=2e-3)
    _, _, raw, y = scored
    import pandas as pd
    order = np.column_stack([(pd.Series(raw[:, i].round(12)).rank() - 1) / 1299 for i in range(3)])
    blend = order @ batch[0]
    pos, neg = blend[y == 1], blend[y == 0]
    brute = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert sharp[0] == pytest.approx(brute, abs=1e-9)


def test_refined_is_never_worse_than_the_best_start(scored):
    ranks = ranks_of(scored)
    found = ensemble.dirichlet_search(ranks, MODELS, "TARGET", draws=60)
    assert len(found) == 60
    assert [a for a, _ in found[:10]] == sorted((a for a, _ in found[:10]), reverse=True)
    assert all(w.min() >= 0 and w.sum() == pytest.approx(1) for _, w in found)
    auc, weights = ensemble.refine_weights([w for _, w in found[:3]], ranks, MODELS, "TARGET", rounds=6)
    assert auc >= found[0][0] and weights.sum() == pytest.approx(1) and weights[2] < 0.4


def test_run_ensemble(spark, scored, tmp_path):
    predictions, labels, _, _ = scored
    ledger = str(tmp_path / "ensemble")
    result = ensemble.run_ensemble(predictions, labels.filter("TARGET IS NOT NULL"), draws=40, rounds=3, ledger=ledger)
    assert result["models"] == MODELS and sum(result["weights"]) == pytest.approx(1)
    assert result["oof"].count() == 1300 and result["score"].count() == 200
    log = sinks.read_ledger(spark, ledger, sinks.ENSEMBLE_LEDGER)
    assert log.count() == 10 and log.agg(F.max("oof_auc")).first()[0] == pytest.approx(result["oof_auc"])
    with pytest.raises(ValueError, match="good"):
        ensemble.run_ensemble(predictions.filter("NOT (model = 'good' AND SK_ID_CURR < 300)"), labels.filter("TARGET IS NOT NULL"),
                              draws=5, rounds=1)
    with pytest.raises(ValueError, match="keys differ"):
        ensemble.run_ensemble(predictions, labels.filter("TARGET IS NOT NULL AND SK_ID_CURR < 900"), draws=5, rounds=1)
    aucs = ensemble.model_aucs(predictions, labels)
    best_single = aucs.agg(F.max("auc")).first()[0]
    assert result["oof_auc"] > best_single


def test_ranks_of_predictions_that_differ_when_computed_again(spark):
    """A mean of doubles may end in another digit each time; every key has its rank all the same."""
    def noisy(batches):
        for b in batches:
            yield b.assign(pred=b["pred"] + np.random.default_rng().random(len(b)) * 1e-13)

    rows = spark.range(400).select(F.col("id").alias("SK_ID_CURR"), F.lit("a").alias("model"), (F.col("id") / 400).alias("pred"))
    ranks = ensemble.model_ranks(rows.mapInPandas(noisy, rows.schema), ["a"]).collect()
    assert sorted((r["SK_ID_CURR"], r["a"]) for r in ranks) == [(i, pytest.approx(i / 399)) for i in range(400)]


def test_stacking(scored):
    predictions, labels, _, _ = scored
    out, auc, fold_aucs, _ = ensemble.stack_logistic(predictions, labels, MODELS, ["raw"], folds=3)
    assert out.filter("split = 'oof'").count() == 1300 and out.filter("split = 'score'").count() == 600
    both = predictions.unionByName(out)
    lift = ensemble.lift_over_best(ensemble.model_aucs(both, labels.filter("TARGET IS NOT NULL")), "stack").first()
    assert lift["auc"] == pytest.approx(auc) and lift["lift"] > 0 and lift["best_model"] in ("good", "other")
    assert len(fold_aucs) == 3


def test_weights_become_repeats(spark):
    df = spark.range(3000).withColumn(training.WEIGHT, F.when(F.col("id") % 2 == 0, 2.5).otherwise(1.0))
    counts = training.resampled(df, "id").groupBy((F.col("id") % 2).alias("odd")).count().collect()
    got = {r["odd"]: r["count"] for r in counts}
    assert got[1] == 1500 and got[0] == pytest.approx(2.5 * 1500, rel=0.05)
    assert training.resampled(df, "id").exceptAll(training.resampled(df.repartition(7), "id")).isEmpty()
