from pyspark.sql import functions as F

from riskfeat.operators.lookup import as_small_table, attach


def sides(spark):
    # a third of the rows share one key, some have none
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 400)).alias("k"))
    table = rows.filter("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    return rows, table


def result(df):
    return sorted((r["id"], r["k"] or "", r["n"], r["top"]) for r in df.collect())


def test_large_path_equals_broadcast_path(spark):
    rows, table = sides(spark)
    expected = result(rows.join(table, "k", "left"))
    assert result(attach(rows, table, "k", weight="n")) == expected
    assert result(attach(rows, table, "k", weight="n", max_rows=0, hot_keys=5)) == expected
    assert result(attach(rows, table, "k", weight="n", max_rows=10)) == expected
    assert result(attach(rows, table, "k", max_rows=10)) == expected


def test_null_safe_keys_match(spark):
    rows, _ = sides(spark)
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    for limit in (100_000, 0):
        out = attach(rows, table, "k", weight="n", null_safe=True, max_rows=limit, hot_keys=3)
        assert out.filter("n IS NULL").count() == 0 and out.count() == 3000


def test_size_is_checked(spark):
    assert as_small_table(spark.range(11), 10) is None
    assert as_small_table(spark.range(10), 10).count() == 10


def test_answered_rows_are_scattered(spark):
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(4000).selectExpr("id", "CASE WHEN id % 10 > 0 THEN 0 ELSE id END AS k")
        table = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
        out = attach(rows, table, "k", weight="n", max_rows=0, hot_keys=3)
        held = [r["count"] for r in out.groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("count"), F.max("top")).collect()]
        assert sum(held) == 4000 and max(held) <= 2 * 4000 / 16
        assert {r["k"]: r["top"] for r in out.collect()} == {r["k"]: r["top"] for r in table.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
