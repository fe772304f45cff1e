import math

import pytest
from pyspark.sql import functions as F

from riskfeat.operators import aggspec as a


@pytest.fixture(scope="module")
def events(spark):
    rows = [(1, 0, 5.0), (1, -2, None), (1, -9, 7.0), (2, -9, 1.0), (3, -1, None), (3, -1, None)]
    rows += [(4, -(i % 12), float(i % 7)) for i in range(4000)]  # one key holds nearly everything
    return spark.createDataFrame(rows, "id long, m int, x double").repartition(5)


def blocks():
    stats = (a.ROWS, *a.numeric_block(["x"]))
    return [a.Block("L", stats), a.Block("W", stats, F.col("m") >= -3), a.Block("NONE", stats, F.col("m") > 0)]


def collected(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)


def test_both_strategies_agree(events):
    narrow = a.aggregate_blocks(events, "id", blocks(), one_pass_limit=1000)
    wide = a.aggregate_blocks(events, "id", blocks(), one_pass_limit=0)
    assert narrow.columns == wide.columns
    assert collected(narrow.select(*[F.round(c, 9).alias(c) for c in narrow.columns])) == collected(
        wide.select(*[F.round(c, 9).alias(c) for c in wide.columns]))


@pytest.mark.parametrize("limit", [0, 1000])
def test_null_rules(events, limit):
    out = {r["id"]: r for r in a.aggregate_blocks(events, "id", blocks(), one_pass_limit=limit).collect()}
    assert out[1]["L_COUNT"] == 3 and out[1]["L_x_MEAN"] == 6.0
    assert out[1]["L_x_STD"] == pytest.approx(math.sqrt(2))
    assert out[1]["W_COUNT"] == 2 and out[1]["W_x_SUM"] == 5.0
    assert out[1]["W_x_STD"] is None                                  # a single value has no deviation
    assert out[2]["W_COUNT"] is None and out[2]["W_x_SUM"] is None    # no row in the window
    assert out[3]["L_x_SUM"] == 0.0 and out[3]["L_x_MEAN"] is None    # rows, but no value
    assert all(r["NONE_COUNT"] is None and r["NONE_x_MAX"] is None for r in out.values())


def test_a_spec_needs_an_unconditional_block(events):
    with pytest.raises(ValueError):
        a.aggregate_blocks(events, "id", blocks()[1:])


def test_a_wide_lifetime_block_is_split_off(events):
    wide = a.Block("L", (a.ROWS, *a.numeric_block(["x", "m"])))
    slim = a.Block("W", (a.ROWS, *a.numeric_block(["x"], ("mean",))), F.col("m") >= -3)
    one, two = (a.aggregate_blocks(events, "id", [wide, slim], one_pass_limit=n) for n in (1000, 0))
    assert one.columns == two.columns and collected(one.drop("L_x_STD", "L_m_STD")) == collected(two.drop("L_x_STD", "L_m_STD"))
    assert a.conditional_blocks(events, "id", [slim]).count() == 3


def test_distinct_counts_count_null_once(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (1, "b", "x"), (2, None, None)], "id long, s string, t string")
    out = {r["id"]: (r["S"], r["T"]) for r in a.distinct_counts(df, "id", {"S": "s", "T": "t"}).collect()}
    assert out == {1: (2, 2), 2: (1, 1)}


def test_wide_specs_scan_once(spark, tmp_path):
    spark.range(100).selectExpr("id % 7 AS id", "cast(id AS double) AS x", "cast(-(id % 9) AS int) AS m").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = a.aggregate_blocks(df, "id", blocks(), one_pass_limit=0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def recent_blocks():
    stats = (a.ROWS, *a.numeric_block(["x", "n"]))
    return [a.Block("L", (*stats, *a.stats_of("m", ("min", "max")))), a.Block.of_recent("A", stats, "m", -3),
            a.Block.of_recent("B", stats, "m", -9), a.Block.of_recent("NONE", stats, "m", 0.5)]


def test_bands_agree_with_one_pass(spark):
    rows = [(k, -(i * k % 14) if i % 5 else None, None if (i + k) % 4 == 0 else 1e9 + (i * 7919 % 101) / 7, i % 3 if i % 6 else None)
            for k in range(1, 30) for i in range(k * 3)]
    rows += [(99, -2, None, None), (98, None, 1.0, 1), (97, -12, 5.0, 2), (None, -1, 2.0, 3), (None, -20, 3.0, 3)]
    df = spark.createDataFrame(rows, "id long, m int, x double, n int").repartition(4)
    one = {r["id"]: r.asDict() for r in a.aggregate_blocks(df, "id", recent_blocks(), one_pass_limit=1000).collect()}
    bands = a.aggregate_blocks(df, "id", recent_blocks(), one_pass_limit=0)
    assert bands.dtypes == a.aggregate_blocks(df, "id", recent_blocks(), one_pass_limit=1000).dtypes
    got = {r["id"]: r.asDict() for r in bands.collect()}
    assert set(got) == set(one) and len(got) == 33
    for key, row in one.items():
        for c, want in row.items():
            assert got[key][c] == (want if want is None else pytest.approx(want, rel=1e-12, abs=1e-6)), (key, c)


def test_bands_ship_one_row_per_key_and_band(spark):
    df = spark.range(0, 20_000, numPartitions=4).selectExpr(
        "id % 50 AS id", "cast(id AS double) AS x", "cast(id AS int) AS n", "cast(-(id % 13) AS int) AS m")
    out = a.aggregate_blocks(df, "id", recent_blocks(), one_pass_limit=0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange hashpartitioning") <= 2
    out.collect()
    text, shuffled = out._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.nodeName() == "Exchange":
            shuffled.append(node.metrics().apply("shuffleRecordsWritten").value())
        kids = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in node.nodeName() else []
        for kid in kids or [node.children().apply(i) for i in range(node.children().size())]:
            walk(kid)
    walk(text)
    assert shuffled and max(shuffled) <= 4 * 50 * 4  # partitions x keys x bands


def test_windows_of_two_columns_are_not_nested():
    stats = (a.ROWS,)
    life, w = a.Block("L", stats), a.Block.of_recent("A", stats, "m", -3)
    assert a._nested([life, w]) and a._nested([life, w, a.Block.of_recent("B", stats, "m", -9)])
    assert not a._nested([life, w, a.Block.of_recent("B", stats, "d", -9)])
    assert not a._nested([life, w, a.Block.of_recent("B", stats, "m", -9, inclusive=False)])
    assert not a._nested([life, w, a.Block("B", stats, w.where)]) and not a._nested([life])


def widths(df, kind):
    """Columns that the nodes of a kind put out in the optimised plan."""
    found, todo = [], [df._jdf.queryExecution().optimizedPlan()]
    while todo:
        node = todo.pop()
        todo += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == kind:
            found.append(node.output().size())
    return found


def test_joins_on_key_carry_a_struct_per_frame(spark):
    first = spark.createDataFrame([(1, 1.0), (2, None), (2, 3.0), (None, 4.0)], "id long, `a b` double")
    second = spark.createDataFrame([(1, "x"), (3, "y"), (None, "z")], "id long, s string").select(
        "id", "s", *[F.length("s").alias(f"w{i}") for i in range(40)])
    third = spark.createDataFrame([(2, 5)], "id long, n long")
    plain = first.join(second, "id", "left").join(third, "id", "left")
    out = a.join_on_key([first, second, third], "id")
    assert out.dtypes == plain.dtypes and collected(out) == collected(plain)
    assert max(widths(out, "Join")) <= 6
    assert collected(a.join_on_key([first.select("id"), second, third], "id")) == collected(plain.drop("a b"))


@pytest.mark.parametrize("spec", ["blocks", "recent_blocks"])
def test_folds_carry_a_struct_per_block(events, spec):
    df = events.withColumn("n", F.col("m") * 2)
    folded = a.aggregate_blocks(df, "id", globals()[spec](), one_pass_limit=0)
    assert min(widths(folded, "Aggregate")) <= 1 + len(globals()[spec]())
