from statistics import NormalDist, mean, stdev

import pytest
from pyspark.sql import functions as F

from riskfeat.functions import rows as r


@pytest.fixture(scope="module")
def values(spark):
    return spark.createDataFrame(
        [(1, 4.0, 2.0, None), (2, 3.0, 0.0, 1.0), (3, None, None, None), (4, 5.0, 5.0, 5.0)],
        "id long, a double, b double, c double",
    )


def column(df, expr):
    return [row[0] for row in df.orderBy("id").select(expr).collect()]


def test_ratio_is_null_on_zero_or_missing(values):
    assert column(values, r.ratio("a", "b")) == [2.0, None, None, 1.0]


def test_row_statistics_skip_nulls(values):
    abc = ["a", "b", "c"]
    assert column(values, r.row_sum(abc)) == [6.0, 4.0, 0.0, 15.0]
    assert column(values, r.row_mean(abc)) == [3.0, pytest.approx(4 / 3), None, 5.0]
    assert column(values, r.row_min(abc)) == [2.0, 0.0, None, 5.0]
    assert column(values, r.row_max(abc)) == [4.0, 3.0, None, 5.0]
    assert column(values, r.row_std(abc)) == [
        pytest.approx(stdev([4, 2])), pytest.approx(stdev([3, 0, 1])), None, 0.0]
    assert column(values, r.null_count(abc)) == [1, 0, 3, 0]


def test_clipped_diff_is_zero_when_missing(values):
    assert column(values, r.clipped_diff("b", "a")) == [0.0, 0.0, 0.0, 0.0]
    assert column(values, r.clipped_diff("a", "b")) == [2.0, 3.0, 0.0, 0.0]


def test_flag_keeps_null(values):
    assert column(values, r.flag(F.col("a") > 3)) == [1, 0, None, 1]


def test_finite_or_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, float("-inf")), (4, 1.5), (5, None)], "id long, x double")
    assert column(df, r.finite_or_null("x")) == [None, None, None, 1.5, None]


def test_inverse_normal_matches_the_standard_library(spark):
    ps = [0.0001, 0.01, 0.02425, 0.2, 0.5, 0.77, 0.98, 0.9999]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(ps)], "id long, p double")
    for got, p in zip(column(df, r.inverse_normal("p")), ps):
        assert got == pytest.approx(NormalDist().inv_cdf(p), abs=1e-7)


def test_inverse_normal_and_logit_clip(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 1.0)], "id long, p double")
    low, high = column(df, r.inverse_normal("p"))
    assert low == pytest.approx(-high) and high == pytest.approx(NormalDist().inv_cdf(1 - 1e-7), abs=1e-6)
    low, high = column(df, r.logit("p"))
    assert low == pytest.approx(-13.8155, abs=1e-3) and high == pytest.approx(13.8155, abs=1e-3)
    assert mean([low, high]) == pytest.approx(0, abs=1e-6)
