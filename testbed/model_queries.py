"""Training, search, blending and stacking on the given tables.

Iterative fits have no SQL counterpart, so most of these queries return reports
of what must hold of every fit: who is predicted, how often and in which fold,
that predictions are probabilities, and that the model has learnt. For that
the matrix holds a planted column: the label and a uniform number, the AUC of
which is 0.92, so a model that has learnt nothing fails. Steps are larger and
patience is shorter here than in the presets, and there are fewer folds.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import or_
from uuid import uuid4

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.operators.folds import SEED, split_by_label, stratified_folds
from riskfeat.operators.rank import roc_auc
from riskfeat.plans import columns as names
from riskfeat.plans import ensemble, jobs
from riskfeat.plans.application import application_rows
from riskfeat.plans.auxiliary import event_level_features
from riskfeat.plans.installments import installments_features
from riskfeat.plans.training import (
    FoldColumns, Learner, adversarial_validation, halving_search, learner, mean_importances, null_importances, run_oof,
)
from riskfeat.session import cut_lineage
from riskfeat.sources.sinks import ENSEMBLE_LEDGER, append_ledger, prediction_rows
from riskfeat.sources.tables import read_csv, write_table
from testbed.feature_queries import cleaned_sql
from testbed.operator_queries import fold_sql
from testbed.registry import query, rounded, with_ctes
from testbed.roles import load, role, role_sql
from testbed.row_queries import ID, application

_QUICK = dict(stepSize=0.3, patience=2, maxDepth=3)  # up to the presets' 5,000 rounds
_LEARNT = 0.8
_FOLDS = 3
_APP = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_CREDIT", "AMT_ANNUITY", "DAYS_BIRTH", "DAYS_EMPLOYED"]
_INS = ["INS_COUNT", "INS_DPD_MEAN", "INS_DPD_MAX", "INS_PAYMENT_PERC_MEAN", "INS_LATE_RATE", "INS_12M_COUNT"]


def training_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Application and payment columns with folds for the labelled rows."""
    app = application_rows(application(spark, sf_dir)).select(
        ID, "TARGET", *_APP, "APP_CREDIT_TERM", "ORGANIZATION_TYPE")
    ins = installments_features(role(spark, sf_dir, "installments_payments")).select(ID, *_INS)
    train, _ = split_by_label(app, "TARGET")
    folds = stratified_folds(train, ID, "TARGET", folds=_FOLDS)
    joined = app.join(ins, ID, "left").join(folds, ID, "left")
    uniform = F.pmod(F.xxhash64(ID), F.lit(10_000)) / 10_000
    signal = F.when(F.col("TARGET") == 1, 0.6).otherwise(0.0) + uniform
    return cut_lineage(joined.withColumn("PLANTED", signal))


_APP_SQL = cleaned_sql("application_train")
_FOLD_CTES = [("app", _APP_SQL), ("train", f"SELECT {ID}, TARGET FROM app WHERE TARGET IS NOT NULL"), ("f", fold_sql("train", ID, "TARGET", _FOLDS))]
_OOF_SQL = with_ctes(
    _FOLD_CTES, "SELECT 'oof' AS split, fold_main AS fold, count(*) AS n, count(*) AS ids, 0 :: BIGINT AS outside, 0 :: BIGINT AS misplaced, true AS learnt FROM f "
    "GROUP BY fold_main UNION ALL SELECT 'score', CAST(g AS INT), count(*), count(*), 0, 0, true FROM app, "
    f"(SELECT unnest(range({_FOLDS})) AS g) WHERE TARGET IS NULL GROUP BY g")
_NO_PROBABILITY = "pred IS NULL OR pred NOT BETWEEN 0 AND 1"


def oof_report(predictions: DataFrame, rows: DataFrame, key: str = ID) -> DataFrame:
    """Per split and fold: predictions, keys, what is no probability, what is in a fold it was trained on."""
    stored = rows.select(key, F.col("fold_main").alias("_stored"))
    return predictions.join(stored, key, "left").groupBy("split", "fold").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("ids"), F.count_if(F.expr(_NO_PROBABILITY)).alias("outside"),
        F.count_if((F.col("split") == "oof") & ~F.col("fold").eqNullSafe(F.col("_stored"))).alias("misplaced"))


def trained(df: DataFrame, *args: object, **kwargs: object) -> DataFrame:
    result = run_oof(df, *args, folds=_FOLDS, **kwargs)
    return oof_report(result.predictions, df).withColumn("learnt", F.lit(min(result.oof_auc, *result.fold_aucs) > _LEARNT))


def names_sql(columns: list[str], **constants: str) -> str:
    values = ", ".join(f"('{c}')" for c in columns)
    return f"SELECT * FROM (VALUES {values}) t(feature)" if not constants else (
        f"SELECT feature, {', '.join(f'{v} AS {k}' for k, v in constants.items())} FROM (VALUES {values}) t(feature)")


_NUMBERS = [*_APP, "APP_CREDIT_TERM", *_INS, "PLANTED"]
_ENCODED = FoldColumns(target_encode=("ORGANIZATION_TYPE",), neighbours=names.NEIGHBOUR_COLUMNS)


@query(_OOF_SQL)
def out_of_fold_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preset A with target encoding and neighbour means fitted per fold."""
    return trained(training_matrix(spark, sf_dir), learner("lgbm", **_QUICK), _ENCODED)


@query(_OOF_SQL)
def out_of_fold_preset_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trained(training_matrix(spark, sf_dir), learner("xgb", **_QUICK))


@query(_OOF_SQL)
def out_of_fold_categorical_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preset C: raw categories enter through their fold-aware encoding."""
    spec = FoldColumns(target_encode=("ORGANIZATION_TYPE",))
    return trained(training_matrix(spark, sf_dir), learner("catboost", **_QUICK), spec, weight=None)


@query(_OOF_SQL)
def out_of_fold_perceptron(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = learner("nn_a", hidden=(16,), maxIter=15)
    return trained(training_matrix(spark, sf_dir), model, FoldColumns(rank_gauss=True))


@query(_OOF_SQL)
def out_of_fold_selected_perceptron(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = learner("nn_b", hidden=(8,), maxIter=15, select=6)
    return trained(training_matrix(spark, sf_dir), model, FoldColumns(rank_gauss=True))


@query(names_sql(_NUMBERS, is_share="true", strongest="feature = 'PLANTED'"))
def feature_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every number of the matrix with a share of the importance; the planted one leads."""
    df = training_matrix(spark, sf_dir)
    table = mean_importances(run_oof(df, learner("xgb", **_QUICK), folds=_FOLDS).importances)
    first = table.first()["feature"]
    return table.select("feature", F.col("importance").between(0, 1).alias("is_share"), (F.col("feature") == first).alias("strongest"))


@query()
def hyper_parameter_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trial of a halving search with its parameters, rounds and AUC, best first."""
    df = training_matrix(spark, sf_dir)
    found = halving_search(df, "xgb", trials=6, fixed=dict(maxIter=12, patience=3), folds=_FOLDS, least=2)
    rows = [(k, t.number, t.rung, t.rounds, t.oof_auc, json.dumps(t.params, sort_keys=True)) for k, t in enumerate(found, 1)]
    return spark.createDataFrame(rows, "place int, trial int, rung int, rounds int, oof_auc double, params_json string")


@query(names_sql([*_NUMBERS, "SHIFTED"], verdict="'high drift'", strongest="feature = 'SHIFTED'"))
def adversarial_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that differs between labelled and score rows is found, and the verdict follows from it."""
    df = training_matrix(spark, sf_dir).drop("fold_main")
    shift = F.when(F.col("TARGET").isNull(), 0.9).otherwise(0.0) + F.pmod(F.xxhash64(F.lit(7), ID), F.lit(1000)) / 1000
    model = Learner("adversarial", "gbt", params=dict(maxIter=5000, **_QUICK))
    _, verdict, importances = adversarial_validation(df.withColumn("SHIFTED", shift), folds=_FOLDS, model=model)
    first = importances.first()["feature"]
    return importances.select("feature", F.lit(verdict).alias("verdict"), (F.col("feature") == first).alias("strongest"))


@query()
def null_importance_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance of every number, what chance gives it, and whether it goes; constants always go."""
    df = training_matrix(spark, sf_dir).drop("fold_main").withColumn("CONSTANT", F.lit(1.0))
    found = null_importances(df, sample=None, params=dict(maxDepth=3, maxIter=5))
    return spark.createDataFrame([(c, real, bar, real <= bar) for c, real, bar in found],
                                 "feature string, importance double, by_chance double, dropped boolean")


@query(with_ctes([("pay", role_sql("installments_payments")), ("app", _APP_SQL)],
                 f"SELECT count(DISTINCT {ID}) AS n, count(DISTINCT {ID}) AS ids, 0 :: BIGINT AS outside, true AS learnt FROM pay JOIN app USING ({ID}) WHERE TARGET IS NOT NULL"))
def event_level_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments with a planted column that knows a little of the label; the roll-up tells the labels apart."""
    labels = application(spark, sf_dir).select(ID, "TARGET")
    payments = role(spark, sf_dir, "installments_payments").join(labels, ID, "left").withColumn(
        "PLANTED", F.coalesce("TARGET", F.lit(0)) * 0.3 + F.pmod(F.xxhash64(ID, "DAYS_INSTALMENT", "AMT_PAYMENT"), F.lit(1000)) / 1000).drop("TARGET")
    model = Learner("auxiliary", "gbt", params=dict(maxIter=2000, **_QUICK))
    table = event_level_features(payments, labels, "INS", "DAYS_INSTALMENT", folds=_FOLDS, model=model)
    strange = [~F.coalesce(F.col(c).between(0, 1), F.lit(True)) for c in table.columns if c != ID]
    learnt = roc_auc(table.join(labels, ID), "INS_AUX_OOF_MEAN", "TARGET").first()["auc"] > _LEARNT
    return table.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(ID).alias("ids"),
                     F.count_if(reduce(or_, strange)).alias("outside"), F.lit(learnt).alias("learnt"))


# ------------------------------------------------------ ensembles of two stand-in models


def document_predictions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two models over all documents: text length and distinct-word share.

    Documents with a label play the labelled rows, the rest is to be scored.
    """
    words = F.split("text", r"\s+")
    docs = load(spark, sf_dir, "documents").select(
        "doc_id", F.col("n_chars").cast("double").alias("length"),
        (F.size(F.array_distinct(words)) / F.size(words)).alias("variety"))
    labels = load(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("TARGET"))
    rows = docs.join(labels, "doc_id", "left")
    train, _ = split_by_label(rows, "TARGET")
    rows = cut_lineage(rows.join(stratified_folds(train, "doc_id", "TARGET", folds=_FOLDS), "doc_id", "left"))
    parts = []
    for model, pred in (("length", 1 / (1 + F.exp(-F.col("length") / 1000))), ("variety", F.col("variety"))):
        for split, where in (("oof", F.col("TARGET").isNotNull()), ("score", F.col("TARGET").isNull())):
            parts.append(prediction_rows(rows.filter(where), "doc_id", model, 0, split, pred))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, rows


_DOC_SPLITS = "SELECT d.doc_id, l.quality AS TARGET FROM documents d LEFT JOIN labels l USING (doc_id)"


@query(f"SELECT CASE WHEN TARGET IS NULL THEN 'score' ELSE 'oof' END AS split, count(*) AS n, count(DISTINCT doc_id) AS ids, 0 :: BIGINT AS outside "
       f"FROM ({_DOC_SPLITS}) GROUP BY 1")
def blended_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight search, refinement and the blend of both splits."""
    predictions, rows = document_predictions(spark, sf_dir)
    result = ensemble.run_ensemble(predictions, rows.filter("TARGET IS NOT NULL"), key="doc_id", draws=200, rounds=4)
    return result["oof"].unionByName(result["score"]).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids"), F.count_if(F.expr(_NO_PROBABILITY)).alias("outside"))


@query(with_ctes([("d", _DOC_SPLITS), ("t", "SELECT * FROM d WHERE TARGET IS NOT NULL"), ("f", fold_sql("t", "doc_id", "TARGET", _FOLDS))],
                 "SELECT 'oof' AS split, fold_main AS fold, count(*) AS n, count(*) AS ids, 0 :: BIGINT AS outside, 0 :: BIGINT AS misplaced FROM f GROUP BY fold_main "
                 f"UNION ALL SELECT 'score', CAST(g AS INT), count(*), count(*), 0, 0 FROM d, (SELECT unnest(range({_FOLDS})) AS g) WHERE TARGET IS NULL GROUP BY g"))
def stacked_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions, rows = document_predictions(spark, sf_dir)
    rows = rows.withColumn("chars", F.col("length"))
    stacked = ensemble.stack_logistic(predictions, rows, ["length", "variety"], ["chars"], "doc_id", folds=_FOLDS)[0]
    return oof_report(stacked, rows, "doc_id")


_DOC_RANK = ("(rank() OVER (ORDER BY {c}) - 1 + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0) / (count(*) OVER () - 1)")
_DOC_SCORES = ("SELECT doc_id, quality AS y, 1 / (1 + exp(-CAST(n_chars AS DOUBLE) / 1000)) AS length, CAST(len(list_distinct(w)) AS DOUBLE) "
               "/ len(w) AS variety FROM (SELECT *, regexp_split_to_array(text, '[ \\t\\n\\x0B\\f\\r]+') AS w FROM documents) "
               "JOIN labels USING (doc_id)")
_DOC_RANKS = (f"SELECT doc_id, y, length, variety, {_DOC_RANK.format(c='length')} AS rl, {_DOC_RANK.format(c='variety')} AS rv "
              f"FROM ({_DOC_SCORES})")


def _pair_auc(score: str, source: str) -> str:
    """Tie-aware AUC of one score column."""
    return (f"SELECT (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))) AS auc FROM "
            f"(SELECT y, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS r FROM ({source}))")


@query(f"WITH d AS ({_DOC_RANKS}), a AS (SELECT 'ensemble' AS model, auc FROM ({_pair_auc('rl * 0.5 + rv * 0.5', 'SELECT * FROM d')}) UNION ALL "
       f"SELECT 'length', auc FROM ({_pair_auc('length', 'SELECT * FROM d')}) UNION ALL SELECT 'variety', auc FROM ({_pair_auc('variety', 'SELECT * FROM d')})), "
       "o AS (SELECT * FROM a WHERE model <> 'ensemble' ORDER BY auc DESC LIMIT 1) SELECT round(a.auc, 6) + 0.0 AS auc, o.model AS best_model, "
       "round(o.auc, 6) + 0.0 AS best_auc, round(a.auc - o.auc, 6) + 0.0 AS lift FROM a, o WHERE a.model = 'ensemble'")
def lift_of_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions, rows = document_predictions(spark, sf_dir)
    labels = rows.filter("TARGET IS NOT NULL")
    models = ["length", "variety"]
    oof = predictions.filter("split = 'oof'")
    blend = ensemble.rank_blend(oof, models, (0.5, 0.5), "doc_id")
    both = oof.unionByName(prediction_rows(blend, "doc_id", "ensemble", -1, "oof", F.col("blend")))
    return rounded(ensemble.lift_over_best(ensemble.model_aucs(both, labels, "doc_id"), "ensemble"))


_DRAWS = np.random.default_rng(SEED).dirichlet(np.ones(2), size=200)


@query(f"WITH d AS ({_DOC_RANKS}), w AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {a!r} :: DOUBLE, {b!r} :: DOUBLE)" for i, (a, b) in enumerate(_DRAWS.tolist()))
       + ") t(i, length, variety)), s AS (SELECT i, w.length, w.variety, y, rl * w.length + rv * w.variety AS score FROM d, w), "
       "r AS (SELECT *, rank() OVER (PARTITION BY i ORDER BY score) + (count(*) OVER (PARTITION BY i, score) - 1) / 2.0 AS r FROM s) "
       "SELECT round(length, 6) + 0.0 AS length, round(variety, 6) + 0.0 AS variety, "
       "round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))), 4) + 0.0 AS auc "
       "FROM r GROUP BY i, length, variety")
def weight_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All random weights with their exact AUC."""
    predictions, rows = document_predictions(spark, sf_dir)
    models = ["length", "variety"]
    ranks = ensemble.model_ranks(predictions.filter("split = 'oof'"), models, "doc_id")
    labelled = cut_lineage(ranks.join(rows.filter("TARGET IS NOT NULL").select("doc_id", "TARGET"), "doc_id"))
    found = ensemble.dirichlet_search(labelled, models, "TARGET", draws=len(_DRAWS))
    table = spark.createDataFrame([(float(w[0]), float(w[1]), float(a)) for a, w in found], "length double, variety double, auc double")
    return rounded(table).withColumn("auc", F.round("auc", 4))


# ---------------------------------------------------------------- the jobs one after the other


def scratch(spark: SparkSession) -> str:
    """A new folder under the session's checkpoint folder."""
    cut_lineage(spark.range(1))  # sets the folder where none is
    return f"{spark.sparkContext.getCheckpointDir()}/jobs-{uuid4().hex}"


@query(f"SELECT {ID}, true AS scored, true AS learnt FROM ({_APP_SQL}) WHERE TARGET IS NULL")
def scored_file_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds, two models, their blend and the scored file, each job reading what the last has stored."""
    out = scratch(spark)
    matrix = training_matrix(spark, sf_dir).drop("fold_main")
    write_table(matrix.drop("ORGANIZATION_TYPE"), out, "main")
    write_table(matrix, out, "catboost")
    jobs.fold_job(matrix, out, folds=_FOLDS, tolerance=0.05)
    jobs.train_job(spark, out, out, learner("xgb", **_QUICK), folds=_FOLDS)
    jobs.train_job(spark, out, out, learner("catboost", **_QUICK), FoldColumns(target_encode=("ORGANIZATION_TYPE",)), folds=_FOLDS)
    result = jobs.ensemble_job(spark, out, matrix.select(ID, "TARGET"), draws=40, rounds=3)
    _, ids = split_by_label(matrix.select(ID, "TARGET"), "TARGET")
    path = jobs.submit_job(spark, out, ids, oof_auc=result["oof_auc"])
    scored = spark.read.option("header", True).schema(f"{ID} bigint, TARGET double").csv(path)
    return scored.select(ID, F.col("TARGET").between(0, 1).alias("scored"), F.lit(result["oof_auc"] > _LEARNT).alias("learnt"))


_AUX_N = f"(SELECT count(DISTINCT {ID}) FROM {{t}} JOIN app USING ({ID}) WHERE TARGET IS NOT NULL)"


@query(with_ctes([("pay", role_sql("installments_payments")), ("prev", role_sql("previous_application")), ("app", _APP_SQL)],
                 "SELECT * FROM (VALUES " + ", ".join(
                     f"('INS_AUX_OOF_{s}', {_AUX_N.format(t='pay')}, 0 :: BIGINT), ('PREV_AUX_OOF_{s}', {_AUX_N.format(t='prev')}, 0 :: BIGINT)"
                     for s in ("MEAN", "MAX", "MIN")) + ") t(feature, gate_open, gate_closed)"))
def gated_auxiliary_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities with a value in each event-level column of the matrix, with the gate open and with it closed."""
    out = scratch(spark)
    labels = application(spark, sf_dir).select(ID, "TARGET")
    write_table(labels, out, "main")
    for name in jobs.AUXILIARY:
        write_table(role(spark, sf_dir, name), out, name)
    model, counts = Learner("auxiliary", "gbt", params=dict(maxIter=2, maxDepth=2)), []
    for k, auc in enumerate((0.8, 0.7)):
        append_ledger(spark, f"{out}/ensemble_ledger", ENSEMBLE_LEDGER, [(f"2020-01-0{k + 1}", "a,b", "1,0", auc, None, None)], f"run{k}")
        jobs.auxiliary_job(spark, out, out, labels, folds=_FOLDS, model=model)
        matrix = jobs.gated_matrix(spark, out, out)
        counts.append(matrix.agg(*[F.count(c).alias(c) for c in matrix.columns]).first().asDict())
    wanted = [f"{p}_AUX_OOF_{s}" for p in ("INS", "PREV") for s in ("MEAN", "MAX", "MIN")]
    return spark.createDataFrame([(c, *(n.get(c, 0) for n in counts)) for c in wanted], "feature string, gate_open bigint, gate_closed bigint")


@query("SELECT o_orderkey, o_totalprice FROM orders")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders through a CSV file with an explicit schema, two of its three columns read."""
    path = scratch(spark)
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    orders.write.option("header", True).csv(path)
    return read_csv(spark, path, orders.schema).select("o_orderkey", "o_totalprice")
