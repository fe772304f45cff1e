import csv
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskfeat.operators import checks
from riskfeat.session import cut_lineage
from riskfeat.sources import sinks, tables


def write(path, header, rows):
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([header, *rows])


def test_catalog():
    assert tables.table("application_train").file == "application_train.csv"
    with pytest.raises(KeyError):
        tables.table("nonexistent")


def test_ingest_cleans_and_overwrites(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    write(raw / "application_train.csv", ["SK_ID_CURR", "TARGET", "DAYS_EMPLOYED", "CODE_GENDER", "OTHER"],
          [[1, 0, 365243, "XNA", "XNA"], [2, 1, -100, "F", "x"]])
    write(raw / "bureau_balance.csv", ["SK_ID_BUREAU", "MONTHS_BALANCE", "STATUS"], [[7, -1, "C"], [7, -2, "0"]])
    write(raw / "previous_application.csv", ["SK_ID_PREV", "SK_ID_CURR", "DAYS_LAST_DUE", "NAME_CONTRACT_STATUS", "DAYS_DECISION"],
          [[5, 1, 365243.0, "XAP", 365243], [6, 1, -3.0, "Approved", -1]])
    for _ in range(2):
        tables.ingest(spark, str(raw), out, ["application_train", "bureau_balance", "previous_application"])
    app = {r["SK_ID_CURR"]: r for r in tables.read_table(spark, out, "application_train").collect()}
    assert app[1]["DAYS_EMPLOYED"] is None and app[1]["CODE_GENDER"] is None and app[1]["OTHER"] == "XNA"
    assert app[2]["DAYS_EMPLOYED"] == -100 and app[2]["CODE_GENDER"] == "F"
    prior = {r["SK_ID_PREV"]: r for r in tables.read_table(spark, out, "previous_application").collect()}
    assert prior[5]["DAYS_LAST_DUE"] is None and prior[5]["NAME_CONTRACT_STATUS"] is None
    assert prior[5]["DAYS_DECISION"] == 365243  # not a sentinel column
    balance = tables.read_table(spark, out, "bureau_balance")
    assert balance.count() == 2 and dict(balance.dtypes)["SK_ID_BUREAU"] == "bigint"
    assert list(Path(out, "bureau_balance.parquet").glob("*.snappy.parquet"))


def test_clustering_keeps_rows_and_spreads_hot_keys(spark):
    df = spark.range(6000).select((F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 500)).alias("k"), "id").repartition(6)
    out = tables.cluster_rows(df, "k", hot_rows=100)
    assert sorted(out.collect()) == sorted(df.collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # tiny partitions would be merged
    where = out.withColumn("p", F.spark_partition_id()).groupBy("k").agg(F.count_distinct("p").alias("places"))
    places = {r["k"]: r["places"] for r in where.collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert places.pop(-1) > 1 and set(places.values()) == {1}


def test_missing_table_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="bureau"):
        tables.read_table(spark, str(tmp_path), "bureau")


def test_csv_needs_a_schema_or_a_wish(spark, tmp_path):
    with pytest.raises(ValueError):
        tables.read_csv(spark, str(tmp_path))


def test_csv_projection_reads_one_column(spark, tmp_path):
    write(tmp_path / "t.csv", ["a", "b"], [[1, 2]])
    plan = tables.read_csv(spark, str(tmp_path / "t.csv"), tables.Table("t.csv", longs=("a", "b")).schema()).select("b")
    assert "ReadSchema: struct<b:bigint>" in plan._jdf.queryExecution().executedPlan().toString()


def test_narrow_types_keep_values(spark):
    df = spark.range(100).select(F.col("id").alias("i"), (F.col("id") * 1000).alias("big"), (F.col("id") * 10**12).alias("huge"),
                                 (F.col("id") / 49.5 - 1).alias("f"), F.lit("x").alias("s"), F.lit(None).cast("bigint").alias("none"))
    out = tables.narrow_types(df)
    assert dict(out.dtypes) == {"i": "tinyint", "big": "int", "huge": "bigint", "f": "float", "s": "string", "none": "bigint"}
    pairs = out.select(F.col("i").cast("bigint").alias("i"), "f").join(df.select("i", F.col("f").alias("g")), "i").collect()
    assert all(r["f"] == pytest.approx(r["g"], rel=1e-3, abs=1e-6) for r in pairs)


def predictions(spark, rows):
    return spark.createDataFrame(rows, "SK_ID_CURR long, model string, fold int, split string, pred double")


def test_prediction_store_replaces_only_what_is_written(spark, tmp_path):
    path = str(tmp_path / "preds")
    sinks.save_predictions(predictions(spark, [(1, "a", 0, "oof", 0.1), (1, "b", 0, "oof", 0.2), (2, "a", 1, "oof", 0.3)]), path)
    sinks.save_predictions(predictions(spark, [(1, "a", 0, "oof", 0.9)]), path)
    stored = sinks.load_predictions(spark, path)
    assert {(r["model"], r["fold"], r["pred"]) for r in stored.collect()} == {("a", 0, 0.9), ("b", 0, 0.2), ("a", 1, 0.3)}
    assert sinks.known_models(stored) == ["a", "b"]
    mean = sinks.mean_over_folds(predictions(spark, [(9, "a", 0, "score", 0.2), (9, "a", 1, "score", 0.4)])).first()
    assert mean["pred"] == pytest.approx(0.3)


def test_scored_file_and_ledger(spark, tmp_path):
    ids = spark.range(1, 4).withColumnRenamed("id", "SK_ID_CURR")
    preds = spark.createDataFrame([(1, 0.1), (2, 0.2), (3, 0.3)], "SK_ID_CURR long, pred double")
    ledger = str(tmp_path / "log")
    path = sinks.write_scored(ids, preds, str(tmp_path), "ensemble", "blend", 0.79518, ledger)
    assert "_blend_oof0.7952" in path
    back = spark.read.option("header", True).schema("SK_ID_CURR long, TARGET double").csv(path)
    assert {(r[0], r[1]) for r in back.collect()} == {(1, 0.1), (2, 0.2), (3, 0.3)}
    sinks.write_scored(ids, preds, str(tmp_path), "a", "again", None, ledger)
    log = sinks.read_ledger(spark, ledger, sinks.SUBMISSION_LEDGER)
    assert log.count() == 2 and log.filter("source = 'ensemble'").first()["oof_auc"] == 0.79518


def test_a_repeated_run_leaves_its_lines_once(spark, tmp_path):
    path, schema = str(tmp_path / "ledger"), "model string, auc double"
    sinks.append_ledger(spark, path, schema, [("a", 0.5), ("b", 0.6)], run="one")
    sinks.append_ledger(spark, path, schema, [("a", 0.7)], run="two")
    sinks.append_ledger(spark, path, schema, [("a", 0.55)], run="one")
    sinks.append_ledger(spark, path, schema, [("c", 0.1)])
    sinks.append_ledger(spark, path, schema, [("c", 0.1)])
    log = sinks.read_ledger(spark, path, schema)
    assert sorted((r["model"], r["auc"]) for r in log.collect()) == [("a", 0.55), ("a", 0.7), ("c", 0.1), ("c", 0.1)]
    assert log.filter("run_id = 'one'").count() == 1


@pytest.mark.parametrize("rows", [[(1, 0.1)], [(1, 0.1), (2, None)], [(1, 0.1), (2, 0.2), (3, 0.3)], [(1, 0.1), (2, 0.2), (2, 0.2)]])
def test_scored_rows_must_line_up(spark, rows):
    ids = spark.range(1, 3).withColumnRenamed("id", "SK_ID_CURR")
    with pytest.raises(ValueError):
        sinks.scored_rows(ids, spark.createDataFrame(rows, "SK_ID_CURR long, pred double"))


def test_checks(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, 2.0, 2.0)], "id long, INS_A double, other double")
    assert checks.check_features(df, "id", "INS_") == ["other"]
    with pytest.raises(ValueError):
        checks.check_features(df.union(df), "id", "INS_")
    with pytest.raises(ValueError):
        checks.check_features(df, "gone", "INS_")
    assert checks.identical_share(df, ["INS_A", "other"]).first()["identical_share"] == 0.5
    assert checks.guard_rails(0.79, [0.79, 0.79]) == []
    assert len(checks.guard_rails(0.79, [0.70, 0.80])) == 2


def test_gate_takes_the_best_row_of_the_latest_run(spark):
    log = spark.createDataFrame([("2026-01-01", 0.9), ("2026-01-02", 0.795), ("2026-01-02", 0.791)], "timestamp string, oof_auc double")
    assert checks.gate(log).first().asDict() == {"oof_auc": 0.795, "passed": 1}
    assert checks.gate(log.filter("oof_auc < 0")).first()["passed"] == 0


def test_cut_lineage_keeps_rows(spark):
    df = cut_lineage(spark.range(10).withColumn("x", F.col("id") * 2))
    assert df.count() == 10 and "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
