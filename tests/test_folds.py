import pytest
from pyspark.sql import functions as F

from riskfeat.functions.rows import seeded_hash
from riskfeat.operators import folds


def toy(spark, n, seed=42):
    chance = F.conv(F.substring(seeded_hash("SK_ID_CURR", seed), 1, 6), 16, 10).cast("long") / F.lit(16**6)
    return spark.range(n).withColumnRenamed("id", "SK_ID_CURR").withColumn("TARGET", (chance < 0.08).cast("tinyint"))


def test_every_row_has_one_fold(spark):
    out = folds.stratified_folds(toy(spark, 1000), "SK_ID_CURR", "TARGET")
    assert out.count() == 1000 and folds.duplicate_keys(out, "SK_ID_CURR").isEmpty()
    assert sorted(r["fold_main"] for r in out.select("fold_main").distinct().collect()) == [0, 1, 2, 3, 4]


def test_class_rate_in_every_fold(spark):
    rows = toy(spark, 5000)
    joined = folds.stratified_folds(rows, "SK_ID_CURR", "TARGET").join(rows, "SK_ID_CURR")
    balance = folds.fold_balance(joined, "fold_main", "TARGET").collect()
    assert all(b["drift"] < 0.02 for b in balance)
    assert max(b["positives"] for b in balance) - min(b["positives"] for b in balance) <= 1
    assert folds.check_folds(folds.stratified_folds(rows, "SK_ID_CURR", "TARGET"), rows, "SK_ID_CURR", "TARGET") == []


def test_seed_and_layout(spark):
    rows = toy(spark, 2000)
    one = folds.stratified_folds(rows, "SK_ID_CURR", "TARGET").orderBy("SK_ID_CURR").collect()
    two = folds.stratified_folds(rows.repartition(7), "SK_ID_CURR", "TARGET").orderBy("SK_ID_CURR").collect()
    other = folds.stratified_folds(rows, "SK_ID_CURR", "TARGET", seed=7).orderBy("SK_ID_CURR").collect()
    assert one == two and one != other


def test_groups_stay_together_and_balance(spark):
    rows = spark.range(6000).select((F.sqrt("id").cast("int")).alias("g"))
    split = rows.join(folds.group_folds(rows, "g"), "g")
    assert folds.fold_overlap(split, "g", "fold_group").isEmpty()
    sizes = [r["count"] for r in split.groupBy("fold_group").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 155  # the largest group


def test_missing_label_and_failed_checks(spark):
    with pytest.raises(KeyError):
        folds.stratified_folds(spark.range(3), "id", "TARGET")
    rows = toy(spark, 1000)
    bad = rows.select("SK_ID_CURR", F.lit(0).alias("fold_main"))
    failed = folds.check_folds(bad.union(bad.limit(1)), rows, "SK_ID_CURR", "TARGET")
    assert "duplicate keys" in failed and "fold range" in failed


def test_seeded_sample(spark):
    df = spark.range(5000)
    picked = {r["id"] for r in folds.seeded_sample(df, "id", 700).collect()}
    assert len(picked) == 700
    assert picked == {r["id"] for r in folds.seeded_sample(df.repartition(9), "id", 700).collect()}
    hashed = df.withColumn("h", seeded_hash("id", 42)).orderBy("h").limit(700)
    assert picked == {r["id"] for r in hashed.collect()}
    assert folds.seeded_sample(df, "id", 9000).count() == 5000


def test_overlap(spark):
    assert folds.key_overlap(spark.range(10), spark.range(8, 12), "id").count() == 2
