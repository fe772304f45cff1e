import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from riskfeat.operators import encode


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    n = 600
    cat = np.where(rng.random(n) < 0.35, "hot", np.array(list("abcdef"))[rng.integers(0, 6, n)]).astype(object)
    cat[rng.random(n) < 0.05] = None
    cat[5] = "once"
    fold = rng.integers(0, 3, n)
    y = (rng.random(n) < 0.3).astype(int)
    pdf = pd.DataFrame({"id": range(n), "cat": cat, "fold": fold, "y": y})
    data = [(int(r.id), r.cat, int(r.fold) if r.id < 500 else None, int(r.y) if r.id < 500 else None) for r in pdf.itertuples()]
    return spark.createDataFrame(data, "id long, cat string, fold int, y int"), pdf


def expected_encoding(pdf, f, m=10.0):
    train = pdf[(pdf.id < 500) & (pdf.fold != f)]
    mu = train.y.mean()
    g = train.groupby("cat", dropna=False).y.agg(["sum", "count"])
    table = (g["sum"] + m * mu) / (g["count"] + m)
    lookup = {("none" if pd.isna(k) else k): v for k, v in table.items()}
    return pdf.cat.map(lambda c: lookup.get("none" if c is None else c, mu))


@pytest.mark.parametrize("limit", [100_000, 0])
def test_target_encoding_contexts(rows, limit):
    df, pdf = rows
    for f in range(3):
        out = encode.target_encode(df, ["cat"], "y", "fold", 3, context=f, max_rows=limit).orderBy("id").collect()
        assert [r["cat_TE"] for r in out] == pytest.approx(list(expected_encoding(pdf, f)))


def test_target_encoding_out_of_fold(rows):
    df, pdf = rows
    out = encode.target_encode(df, ["cat"], "y", "fold", 3).orderBy("id").collect()
    by_fold = np.vstack([expected_encoding(pdf, f) for f in range(3)])
    expected = np.where(pdf.id < 500, by_fold[pdf.fold, pdf.id], by_fold.mean(axis=0))
    assert [r["cat_TE"] for r in out] == pytest.approx(list(expected))


@pytest.mark.parametrize("limit", [100_000, 0])
def test_counts_and_codes(rows, limit):
    df, pdf = rows
    out = encode.label_codes(encode.count_encode(df, ["cat"], max_rows=limit), ["cat"], max_rows=limit).orderBy("id").collect()
    counts = pdf.cat.value_counts()
    levels = sorted(counts.index)
    for r in out:
        if r["cat"] is None:
            assert r["APP_CAT_COUNT_cat"] is None and r["APP_CAT_FREQ_cat"] is None and r["cat__nn"] == -1
        else:
            assert r["APP_CAT_COUNT_cat"] == counts[r["cat"]]
            assert r["APP_CAT_FREQ_cat"] == pytest.approx(counts[r["cat"]] / 600)
            assert r["cat__nn"] == levels.index(r["cat"])


def test_one_hot_has_a_null_column(rows):
    df, _ = rows
    out = encode.one_hot(df, ["cat"])
    hot = [c for c in out.columns if c.startswith("APP_OHE_cat__")]
    assert "APP_OHE_cat__null" in hot and len(hot) == 9
    row = out.agg(*[F.sum(c).alias(c) for c in hot]).first()
    assert sum(row) == 600


@pytest.mark.parametrize("max_rows", [encode.BROADCAST_ROWS, 0])
def test_sparse_one_hot_agrees_with_columns(rows, max_rows):
    df, _ = rows
    narrow = encode.one_hot(df, ["cat"])
    hot = [c for c in narrow.columns if c.startswith("APP_OHE_cat__")]
    out = encode.sparse_one_hot(narrow, "cat", "v", max_rows=max_rows)
    assert out.columns == [*narrow.columns, "v"]
    for r in out.collect():
        assert r["v"].size == len(hot) and r["v"].toArray().tolist() == [r[c] for c in hot]
    given = encode.sparse_one_hot(df, "cat", "v", ["a", "hot"], max_rows=max_rows)
    for r in given.collect():
        assert r["v"].toArray().tolist() == [float(r["cat"] == "a"), float(r["cat"] == "hot")]


def test_ten_thousand_categories_go_into_one_vector(spark):
    df = spark.range(20_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'c0' ELSE concat('c', id % 10000) END AS c", "'k' AS few")
    out = encode.one_hot(df, ["few", "c"])
    assert out.columns == ["id", "c", "few", "APP_OHE_few__k", "APP_OHE_c"]
    levels = df.select("c").distinct().count()
    assert levels > 9_000
    taken = VectorAssembler(inputCols=["APP_OHE_few__k", "APP_OHE_c"], outputCol="x").transform(out).collect()
    assert all(r["x"].size == levels + 1 and r["x"].numNonzeros() == 2 for r in taken)
    places = {(r["c"], int(r["APP_OHE_c"].indices[0])) for r in taken}
    assert [i for _, i in sorted(places)] == list(range(levels))


def test_unseen_categories_are_zero(rows):
    df, pdf = rows
    out = encode.train_fold_codes(df, ["cat"], F.col("cat") != "hot")
    assert {r["cat__code"] for r in out.filter("cat = 'hot' OR cat IS NULL").collect()} == {0}
    assert out.filter("cat = 'a'").first()["cat__code"] == 1


def test_median_impute_and_standardize_use_train_rows_only(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 9.0), (0, 100.0), (0, None), (0, float("inf"))], "t int, x double")
    filled = encode.median_impute(df, ["x"], F.col("t") == 1)
    assert sorted(r["x"] for r in filled.collect()) == [1.0, 2.0, 2.0, 2.0, 9.0, 100.0]
    assert encode.medians(df.select(F.lit(None).cast("double").alias("z")), ["z"]) == {"z": 0.0}
    scaled = encode.standardize(filled, ["x"], F.col("t") == 1).filter("t = 1")
    row = scaled.agg(F.avg("x"), F.stddev_pop("x")).first()
    assert row[0] == pytest.approx(0, abs=1e-12) and row[1] == pytest.approx(1)


def test_standardize_constant_column(spark):
    out = encode.standardize(spark.createDataFrame([(3.0,), (3.0,)], "x double"), ["x"])
    assert [r["x"] for r in out.collect()] == [0.0, 0.0]


def test_rank_gauss(spark):
    rng = np.random.default_rng(2)
    x = rng.exponential(size=2000)
    df = spark.createDataFrame([(i, float(v), int(i % 4), 1) for i, v in enumerate(x)], "id long, x double, x__nn int, x__isnan int")
    out = encode.rank_gauss(df, exclude=("id",)).orderBy("id").toPandas()
    z = out["x"].to_numpy()
    order = np.argsort(x)
    assert (np.diff(z[order]) >= 0).all()
    assert abs(z.mean()) < 0.02 and abs(z.std() - 1) < 0.05
    assert list(out["x__nn"][:4]) == [0, 1, 2, 3] and set(out["x__isnan"]) == {1}
    assert out.columns.tolist() == ["id", "x", "x__nn", "x__isnan"]


def test_winsorize_and_log(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)] + [(None,)], "x double")
    out = [r["x"] for r in encode.winsorize(df, ["x"], 0.05, 0.95).collect()]
    assert min(v for v in out if v is not None) == 5.0 and max(v for v in out if v is not None) == 95.0 and None in out
    assert encode.log_income(df.limit(1), "x", "l").first()["l"] == pytest.approx(np.log(2))
