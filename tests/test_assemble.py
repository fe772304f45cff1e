import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskfeat.plans import assemble
from riskfeat.plans import columns as names
from riskfeat.session import checkpoint_folder
from riskfeat.sources import tables
from testbed import operator_queries
from testbed.roles import role

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def matrices(spark, tmp_path_factory):
    """From CSV files to the three matrices, as a user would run it."""
    root = tmp_path_factory.mktemp("run")
    raw, processed, features = (str(root / d) for d in ("raw", "processed", "features"))
    app = role(spark, SF, "application")
    parts = {"application_train": app.filter("TARGET IS NOT NULL"), "application_test": app.filter("TARGET IS NULL").drop("TARGET")}
    for name, spec in tables.CATALOG.items():
        df = parts.get(name)
        df = role(spark, SF, name) if df is None else df
        if spec.doubles or spec.strings:
            wanted = spec.schema().names
            df = df.select(*[(F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in wanted])
        df = df.select(*[F.col(c).cast("bigint").alias(c) if c == "MONTHS_BALANCE" else F.col(c) for c in df.columns])
        df.coalesce(1).write.option("header", True).csv(f"{raw}/{spec.file}")
    tables.ingest(spark, raw, processed)
    widths = assemble.assemble(spark, processed, features)
    return spark, features, widths


def test_feature_counts(matrices):
    spark, features, _ = matrices
    widths = {n: len(tables.read_table(spark, features, n).columns) - 1 for n in assemble.BUILDERS}
    assert widths == {"bureau": 241, "previous_application": 226, "installments_payments": 98,
                      "pos_cash_balance": 131, "credit_card_balance": 448}


def test_matrices_have_one_row_per_entity(matrices):
    spark, features, widths = matrices
    for name in ("main", "catboost", "nn"):
        m = tables.read_table(spark, features, name)
        assert m.count() == m.select("SK_ID_CURR").distinct().count() == 150
        assert "TARGET" in m.columns and len(m.columns) == widths[name] > 500


def test_matrix_kinds(matrices):
    spark, features, _ = matrices
    kinds = {n: dict(tables.read_table(spark, features, n).dtypes) for n in ("main", "catboost", "nn")}
    assert "string" not in kinds["main"].values() and any(c.startswith("APP_OHE_") for c in kinds["main"])
    assert set(names.CATEGORIES) <= set(kinds["catboost"]) and not any(c.startswith("APP_OHE_") for c in kinds["catboost"])
    assert {f"{c}__nn" for c in names.CATEGORIES} <= set(kinds["nn"]) and not set(names.CATEGORIES) & set(kinds["nn"])
    assert "EXT_SOURCE_1__isnan" in kinds["nn"]
    text = "".join(p.read_text() for p in Path(features, "cat_features.json").glob("part-*"))
    assert json.loads(text) == list(names.CATEGORIES)


def test_pruned_columns_are_gone(matrices):
    spark, features, _ = matrices
    main = tables.read_table(spark, features, "main")
    joined = tables.read_table(spark, features, "joined")
    row = joined.agg(*[F.count(c).alias(c) for c in joined.columns]).first()
    empty = [c for c in joined.columns if row[c] == 0]
    assert empty and not set(empty) & set(main.columns)


def test_feature_tables_wait_for_their_join_in_columns(spark, monkeypatch):
    """No table is checkpointed row by row; each is written as parquet once and joined by key."""
    base = spark.createDataFrame([(i, i % 2) for i in range(6)], "SK_ID_CURR long, TARGET int")
    monkeypatch.setattr(operator_queries, "application", lambda spark, sf_dir: base)
    for i, name in enumerate(operator_queries._SIX):
        table = base.filter(f"SK_ID_CURR > {i - 1}").selectExpr("SK_ID_CURR", f"SK_ID_CURR * {i} AS `c {i}`")
        monkeypatch.setitem(operator_queries.QUERIES, name, lambda spark, sf_dir, table=table: table)
    folder = checkpoint_folder(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    disk = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def made(kind):
        return {str(f.getPath()) for f in disk.listStatus(path) if f.getPath().getName().startswith(kind)}

    before = made("rdd-"), made("stored-")
    out = operator_queries.joined_features(spark, "").orderBy("SK_ID_CURR").collect()
    assert made("rdd-") == before[0] and len(made("stored-") - before[1]) == 6
    assert [tuple(r) for r in out] == [(k, k % 2, *[k * i if k > i - 1 else None for i in range(6)]) for k in range(6)]
