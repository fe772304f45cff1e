import numpy as np
import pytest
from pyspark.sql import functions as F

from riskfeat.operators import prune
from riskfeat.operators.encode import medians
from riskfeat.session import stored
from testbed import operator_queries


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    n = 1200
    y = (rng.random(n) < 0.4).astype(int)
    signal = y + rng.normal(size=n)
    noise = rng.normal(size=n)
    data = [
        (i, int(y[i]) if i < 1150 else None, float(signal[i]), float(-2 * signal[i]), float(signal[i] + 0.02 * noise[i]),
         float(noise[i]), 3.0, None if i > 5 else 1.0, "text")
        for i in range(n)
    ]
    return spark.createDataFrame(
        data, "id long, y int, signal double, mirrored double, blurred double, noise double, flat double, rare double, s string")


def test_missing_and_flat(table):
    assert prune.missing_columns(table, 0.99, {"id"}) == ["rare"]
    assert prune.flat_columns(table, 1e-6, {"id", "y"}) == ["flat", "rare"]


def test_missing_threshold_is_strict(spark):
    df = spark.createDataFrame([(1, None), (2, 1.0)], "id int, x double")
    assert prune.missing_columns(df, 0.5) == [] and prune.missing_columns(df, 0.49) == ["x"]


def test_correlation_drops_the_weaker_of_a_pair(table):
    slim = table.drop("rare", "flat")
    dropped = prune.correlated_columns(slim, "id", "y", 0.98)
    # equal strength keeps the earlier column; the blurred copy is the weaker or goes for being later
    assert "noise" not in dropped and len(dropped) == 2
    few = prune.correlated_columns(slim.limit(50), "id", "y", 0.98)  # small tables are pruned by the same rule
    assert "noise" not in few and len(few) == 2


def test_correlation_matrix_matches_numpy(table):
    names = ["signal", "mirrored", "blurred", "noise", "flat"]
    values = np.array([list(r) for r in table.select(*names).collect()])
    got = prune.correlation_matrix(table, names)
    expected = np.abs(np.corrcoef(values[:, :4].T))
    assert got[:4, :4] == pytest.approx(expected, abs=1e-9)
    assert (got[4, :4] == 0).all()


def losers_by_definition(corr, auc, threshold):
    """Every pair in order: skip lost columns, drop the one with the lower AUC."""
    lost = set()
    for i, j in [(i, j) for i in range(len(auc)) for j in range(i + 1, len(auc))]:
        if i not in lost and j not in lost and corr[i, j] > threshold:
            lost.add(j if auc[j] <= auc[i] else i)
    return sorted(lost)


@pytest.mark.parametrize("seed", range(8))
def test_pair_elimination(seed):
    rng = np.random.default_rng(seed)
    corr = rng.random((12, 12))
    corr = (corr + corr.T) / 2
    auc = rng.integers(5, 9, 12) / 10
    pairs = [(i, j) for i in range(12) for j in range(i + 1, 12) if corr[i, j] > 0.6]
    rng.shuffle(pairs)
    assert sorted(prune.losers_of_pairs([tuple(p) for p in pairs], auc)) == losers_by_definition(corr, auc, 0.6)


@pytest.mark.parametrize("tile,panel", [(128, None), (4, 1), (5, 2)])
def test_pairs_above_the_threshold(spark, monkeypatch, tile, panel):
    monkeypatch.setattr(prune, "TILE", tile)
    rng = np.random.default_rng(11)
    base = rng.normal(size=(400, 4))
    x = np.column_stack([base @ rng.normal(size=4) + 1e6 * (k % 3) + rng.normal(size=400) * rng.choice([0.01, 1]) for k in range(18)])
    x[:, 7] = 5.0
    x[rng.random(x.shape) < 0.1] = np.nan
    names = [f"n{k}" for k in range(18)]
    rows = [[None if np.isnan(v) else float(v) for v in r] for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names)).repartition(5)
    filled = x.copy()
    for k in range(18):
        known = np.sort(x[~np.isnan(x[:, k]), k])
        filled[np.isnan(x[:, k]), k] = known[(len(known) - 1) // 2]
    with np.errstate(invalid="ignore"):
        corr = np.abs(np.corrcoef(filled.T))
    want = {(names[i], names[j]): corr[i, j] for i in range(18) for j in range(i + 1, 18) if corr[i, j] > 0.5}
    got = {(r["a"], r["b"]): r["corr"] for r in prune.correlated_pairs(df, names, 0.5, panel).collect()}
    assert set(got) == set(want) and len(want) > 10
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
    assert prune.correlated_pairs(df, [], 0.5).count() == 0 and prune.correlated_pairs(df.limit(0), names, 0.5).count() == 0


def test_permuted_labels_keep_keys_and_counts(spark):
    df = spark.range(400).withColumn("y", (F.col("id") % 4 == 0).cast("int"))
    out = prune.permute_label(df, "id", "y", 5)
    assert out.count() == 400 and out.select("id").distinct().count() == 400
    assert out.agg(F.sum("y")).first()[0] == 100
    moved = out.join(df.withColumnRenamed("y", "before"), "id").filter("y <> before").count()
    assert 80 < moved < 220


def test_k_best(table):
    labelled = table.filter("y IS NOT NULL")
    assert prune.select_k_best(labelled, ["noise", "signal", "rare"], "y", 1) == ["signal"]


def test_prune_keeps_key_and_label(table):
    out = prune.prune(table, "id", "y")
    assert out.columns == ["id", "y", "signal", "noise", "s"]


def test_stored_table_is_read_by_columns(table):
    kept = stored(table)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, table.collect())) and kept.schema == table.schema
    plan = kept.select("noise")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<noise:double>" in plan


def test_correlated_payment_columns_builds_its_table_once(spark, monkeypatch):
    rows = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            rows.add(len(b))
            yield b

    names = operator_queries._PAIRED
    made = spark.range(40).select("id", *[(F.hash("id", F.lit(c)) % 50).cast("double").alias(c) for c in names])
    monkeypatch.setitem(operator_queries.QUERIES, "installments_table",
                        lambda *_: made.mapInPandas(counted, made.schema))
    operator_queries.correlated_payment_columns(spark, "").collect()
    assert rows.value == 40


def test_medians_are_merged_by_column(spark):
    df = spark.range(0, 99, 1, 4).select(F.col("id").alias("a b"), (F.col("id") * -2.5).alias("c"), F.lit(None).cast("double").alias("d"))
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    context.setJobGroup("medians", "medians")
    try:
        assert medians(df, df.columns) == {"a b": 49.0, "c": -122.5, "d": 0.0}
        tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("medians") for s in tracker.getJobInfo(j).stageIds]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert min(tasks) > 1
