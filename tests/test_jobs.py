import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfeat.plans import jobs
from riskfeat.plans.training import Learner
from riskfeat.sources import sinks
from riskfeat.sources.tables import read_table, write_table

MODEL = Learner("auxiliary", "gbt", params=dict(maxDepth=2, maxIter=3))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("jobs"))
    rng = np.random.default_rng(3)
    labels = spark.createDataFrame([(i, int(i % 3 == 0) if i < 60 else None) for i in range(70)], "SK_ID_CURR long, TARGET int")
    payments = [(i, i * 10 + j, float(i % 3 == 0) + float(rng.normal()) / 2, float(-30 * j)) for i in range(70) for j in range(i % 5)]
    previous = [(i, i * 10, float(rng.normal())) for i in range(0, 70, 2)]
    write_table(spark.createDataFrame(payments, "SK_ID_CURR long, SK_ID_PREV long, late double, DAYS_INSTALMENT double"), root, "installments_payments")
    write_table(spark.createDataFrame(previous, "SK_ID_CURR long, SK_ID_PREV long, amount double"), root, "previous_application")
    write_table(labels.withColumn("x", F.col("SK_ID_CURR") * 2.0), root, "main")
    return root, labels


def logged(spark, out, *aucs):
    for k, auc in enumerate(aucs):
        sinks.append_ledger(spark, f"{out}/ensemble_ledger", sinks.ENSEMBLE_LEDGER, [(f"2020-01-0{k + 1}", "a", "1", a, None, None) for a in auc], f"run{k}")


@pytest.mark.parametrize("aucs,passed", [([], False), ([(0.9,), (0.7, 0.6)], False), ([(0.7,), (0.75, 0.8)], True)])
def test_columns_follow_the_gate(spark, stored, tmp_path, aucs, passed):
    root, labels = stored
    out = str(tmp_path)
    logged(spark, out, *aucs)
    assert jobs.gate_passed(spark, out) is passed
    made = jobs.auxiliary_job(spark, root, out, labels, folds=3, model=MODEL)
    matrix = jobs.gated_matrix(spark, root, out)
    assert matrix.count() == 70
    added = [c for c in matrix.columns if "_AUX_" in c]
    if not passed:
        assert made == [] and added == []
        return
    assert made == ["auxiliary_installments_payments", "auxiliary_previous_application"]
    assert added == [f"INS_AUX_OOF_{s}" for s in ("MEAN", "MAX", "MIN", "LAST3M_MEAN")] + [f"PREV_AUX_OOF_{s}" for s in ("MEAN", "MAX", "MIN")]
    known = matrix.filter("INS_AUX_OOF_MEAN IS NOT NULL")
    assert known.count() == known.filter("SK_ID_CURR < 60 AND SK_ID_CURR % 5 <> 0").count() == 48
    assert matrix.filter("PREV_AUX_OOF_MEAN IS NOT NULL").count() == 30
    by_label = {r["TARGET"]: r["m"] for r in known.groupBy("TARGET").agg(F.avg("INS_AUX_OOF_MEAN").alias("m")).collect()}
    assert by_label[1] > by_label[0] + 0.1
    logged(spark, out, (0.1,), (0.2,), (0.3,))
    jobs.auxiliary_job(spark, root, out, labels, folds=3, model=MODEL)  # the gate has closed since
    assert jobs.gated_matrix(spark, root, out).columns == ["SK_ID_CURR", "TARGET", "x"]


def test_group_folds_are_stored(spark, stored, tmp_path):
    root, labels = stored
    events = read_table(spark, root, "installments_payments")
    folds = jobs.group_fold_job(events, labels, str(tmp_path), folds=3)
    assert folds.count() == 48 and folds.select("fold_group").distinct().count() == 3
    rows = events.join(folds, "SK_ID_CURR").groupBy("fold_group").count().collect()
    assert max(r["count"] for r in rows) - min(r["count"] for r in rows) <= 8
    assert read_table(spark, str(tmp_path), "folds_group").count() == 48


def test_stack_is_stored_by_fold(spark, tmp_path):
    root, out = str(tmp_path / "features"), str(tmp_path / "run")
    rng = np.random.default_rng(9)
    truth = [(i, int(i % 3 == 0) if i < 240 else None, float(rng.normal()) if i % 7 else None) for i in range(300)]
    matrix = spark.createDataFrame(truth, "SK_ID_CURR long, TARGET int, x double")
    write_table(matrix, root, "main")
    folds = jobs.fold_job(matrix, out, folds=3, tolerance=0.05)
    fold_of = {r["SK_ID_CURR"]: r["fold_main"] for r in folds.collect()}
    rows = []
    for model, noise in (("a", 0.25), ("b", 0.4)):
        for i, _, _ in truth:
            for f in [fold_of[i]] if i < 240 else range(3):
                pred = 1 / (1 + np.exp(-(2 * (i % 3 == 0) - 1 + noise * 4 * rng.normal())))
                rows.append((i, model, f, "oof" if i < 240 else "score", float(pred)))
    schema = "SK_ID_CURR long, model string, fold int, split string, pred double"
    sinks.save_predictions(spark.createDataFrame(rows, schema), f"{out}/predictions")
    auc = jobs.stack_job(spark, root, out, raw=["x"], folds=3, run="r")
    assert jobs.stack_job(spark, root, out, raw=["x"], folds=3, run="r") == pytest.approx(auc)  # a blend is no input
    assert auc > 0.8
    stored = sinks.load_predictions(spark, f"{out}/predictions").filter("model = 'stack'")
    assert stored.filter("split = 'oof'").count() == 240 and stored.filter("split = 'score'").count() == 180
    oof, score = (read_table(spark, out, f"stack_folds_{s}").collect() for s in ("oof", "score"))
    assert all([r[f"fold_{f}"] is not None for f in range(3)] == [f == fold_of[r["SK_ID_CURR"]] for f in range(3)] for r in oof)
    assert len(score) == 60 and all(r[f"fold_{f}"] is not None for r in score for f in range(3))
    lines = sinks.read_ledger(spark, f"{out}/summary", jobs.SUMMARY).filter("model = 'stack'").collect()
    assert len(lines) == 1 and lines[0]["oof_auc"] == pytest.approx(auc)
    sinks.save_predictions(spark.createDataFrame([(999, "a", 0, "oof", 0.5)], schema), f"{out}/predictions")
    with pytest.raises(ValueError, match="predictions of a"):
        jobs.stack_job(spark, root, out, folds=3)
