import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskfeat.operators import rank


def frame(spark, values, labels=None, groups=None):
    n = len(values)
    return spark.createDataFrame(
        [(i, float(values[i]), int(labels[i]) if labels is not None else 0, str(groups[i]) if groups is not None else "g") for i in range(n)],
        "id long, v double, y int, g string").repartition(4)


def average_rank(v):
    return pd.Series(v).rank().to_numpy()


def brute_auc(v, y):
    p, n = np.array(v)[np.array(y) == 1], np.array(v)[np.array(y) == 0]
    return ((p[:, None] > n).sum() + 0.5 * (p[:, None] == n).sum()) / (len(p) * len(n))


@pytest.fixture(params=[250_000, 100, 7], autouse=True)
def rows_per_bucket(request, monkeypatch):
    """One bucket, some buckets, several blocks of buckets."""
    monkeypatch.setattr(rank, "ROWS_PER_BUCKET", request.param)


RNG = np.random.default_rng(0)
TIED = np.where(RNG.random(3000) < 0.4, 0.25, RNG.integers(0, 400, 3000) / 400)  # a hot value
LABELS = (RNG.random(3000) < 0.2 + 0.3 * TIED).astype(int)
GROUPS = RNG.integers(0, 3, 3000)


def test_rank_normalize(spark):
    out = rank.rank_normalize(frame(spark, TIED), "v").orderBy("id").collect()
    assert [r["rank"] for r in out] == pytest.approx((average_rank(TIED) - 1) / (len(TIED) - 1))


def test_rank_per_group(spark):
    out = rank.rank_normalize(frame(spark, TIED, groups=GROUPS), "v", by="g").toPandas().sort_values("id")
    expected = pd.Series(TIED).groupby(GROUPS).transform(lambda s: (s.rank() - 1) / (len(s) - 1))
    assert out["rank"].to_numpy() == pytest.approx(expected.to_numpy())


def test_roc_auc(spark):
    row = rank.roc_auc(frame(spark, TIED, LABELS), "v", "y").first()
    assert row["auc"] == pytest.approx(brute_auc(TIED, LABELS)) and row["n"] == 3000


def test_roc_auc_per_group(spark):
    out = {r["g"]: r["auc"] for r in rank.roc_auc(frame(spark, TIED, LABELS, GROUPS), "v", "y", by="g").collect()}
    for g in range(3):
        assert out[str(g)] == pytest.approx(brute_auc(TIED[GROUPS == g], LABELS[GROUPS == g]))


def test_auc_known_value_and_missing_class(spark):
    df = frame(spark, [0.1, 0.4, 0.4, 0.8], [0, 0, 1, 1])
    assert rank.roc_auc(df, "v", "y").first()["auc"] == 0.875
    assert rank.roc_auc(df.filter("y = 1"), "v", "y").first()["auc"] is None


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from([-1e9, -1.0, -0.0, 0.0, 0.5, 2.0, 1e9]), min_size=2, max_size=25))
def test_quantiles_match_numpy(spark, values):
    row = rank.exact_quantiles(frame(spark, values), "v", (0.0, 0.3, 0.5, 1.0)).first()
    assert list(row) == pytest.approx(list(np.quantile(values, (0.0, 0.3, 0.5, 1.0))))


def test_ordinals_are_a_permutation_in_order(spark):
    df = spark.range(500).withColumn("h", F.md5(F.col("id").cast("string"))).withColumn("g", F.col("id") % 2)
    out = rank.ordinals(df, "h", F.substring("h", 1, 2), by="g").toPandas()
    for _, part in out.groupby("g"):
        assert sorted(part["ordinal"]) == list(range(250))
        assert part.sort_values("ordinal")["h"].is_monotonic_increasing


def test_many_groups_need_no_cuts(spark, monkeypatch):
    monkeypatch.setattr(rank, "MAX_GROUPS", 2)
    out = {r["g"]: r["auc"] for r in rank.roc_auc(frame(spark, TIED, LABELS, GROUPS), "v", "y", by="g").collect()}
    assert out["1"] == pytest.approx(brute_auc(TIED[GROUPS == 1], LABELS[GROUPS == 1]))


def test_rows_are_never_ordered_in_one_task(spark):
    """Beyond the size one task is given, every window has a bucket among its keys."""
    if rank.ROWS_PER_BUCKET > 3000:
        return
    plan = rank.rank_normalize(frame(spark, TIED), "v")._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "_rows" not in line:
            assert "_bucket#" in line


@pytest.mark.parametrize("rows", [250_000, 20])
def test_the_null_group_is_a_group(spark, monkeypatch, rows):
    monkeypatch.setattr(rank, "ROWS_PER_BUCKET", rows)
    data = [(None if i % 3 == 0 else i % 3, float(i * 7 % 50), i % 2) for i in range(300)] + [(None, None, 1)]
    df = spark.createDataFrame(data, "g int, v double, y int")
    named = df.withColumn("g", F.coalesce("g", F.lit(9)))

    def same(fn):
        a, b = ([tuple(9 if c == "g" and r[c] is None else r[c] for c in r.asDict()) for r in fn(x).collect()] for x in (df, named))
        assert sorted(a, key=str) == sorted(b, key=str) and any(9 in r for r in a)

    same(lambda x: rank.rank_normalize(x, "v", by="g"))
    same(lambda x: rank.roc_auc(x, "v", "y", by="g"))
    same(lambda x: rank.exact_quantiles(x, "v", [0.0, 0.3, 0.5], by="g"))
