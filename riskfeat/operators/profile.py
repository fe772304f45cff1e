"""Column statistics of whole tables.

A table of many columns is profiled in column chunks: with a columnar source
each pass reads only its own columns, so the passes together read the table
once and each aggregate stays narrow.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeat.functions.columns import numeric_columns, string_columns
from riskfeat.functions.rows import finite_sql, quoted
from riskfeat.operators.rank import exact_quantiles, roc_auc

CHUNK = 100


def _per_column(df: DataFrame, columns: Sequence[str], measures: Mapping[str, str], chunk: int = CHUNK) -> DataFrame:
    """One row per column; ``measures`` maps a result name to SQL text over ``{c}``.

    The statistics of a chunk come back as one row, a few numbers per column.
    """
    rows: list[tuple] = []
    kinds: dict[str, str] = {}
    for start in range(0, len(columns), chunk):
        part = columns[start:start + chunk]
        wide = df.selectExpr(*[
            f"{text.format(c=quoted(c))} AS {m}_{i}" for i, c in enumerate(part) for m, text in measures.items()
        ])
        kinds = {m: wide.schema[f"{m}_0"].dataType.simpleString() for m in measures}
        row = wide.first()
        rows += [(c, *[row[f"{m}_{i}"] for m in measures]) for i, c in enumerate(part)]
    schema = "column string" + "".join(f", {m} {kinds.get(m, 'double')}" for m in measures)
    return df.sparkSession.createDataFrame(rows, schema)


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = df.columns if columns is None else columns
    counted = _per_column(df, columns, {"n_null": "count_if({c} IS NULL)", "n": "count(1)"})
    return counted.select(
        "column", "n_null", F.try_divide(F.col("n_null"), F.col("n").cast("double")).alias("null_rate")
    )


def variances(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = numeric_columns(df) if columns is None else columns
    return _per_column(df, columns, {"variance": "var_samp(cast({c} AS double))"})


def sentinel_rates(df: DataFrame, columns: Sequence[str], sentinel: float) -> DataFrame:
    return _per_column(df, columns, {
        "n_sentinel": f"count_if({{c}} = {sentinel})",
        "rate": f"avg(cast(coalesce({{c}} = {sentinel}, false) AS int))",
    })


def cardinality(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct values per column, NULL counting as one value."""
    columns = string_columns(df) if columns is None else columns
    if approximate:
        return _per_column(df, columns, {
            "n_unique": "approx_count_distinct({c}) + max(cast({c} IS NULL AS int))"
        })
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])
    distinct = df.select(F.explode(pairs).alias("p")).select("p.column", "p.value").distinct()
    return distinct.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), column)


def quantile_report(df: DataFrame, column: str, fractions: Sequence[float], outlier: float) -> DataFrame:
    """Exact quantiles with the smallest and largest value and the count above ``outlier``."""
    quantiles = exact_quantiles(df, column, fractions)
    ends = df.agg(
        F.min(column).alias("min"), F.max(column).alias("max"),
        F.count_if(F.col(column) > outlier).alias("n_outlier"),
    )
    return quantiles.withColumn("_k", F.lit(1)).join(ends.withColumn("_k", F.lit(1)), "_k").drop("_k")


def approx_quantiles(df: DataFrame, columns: Sequence[str], fractions: Sequence[float]) -> DataFrame:
    listed = ", ".join(str(float(f)) for f in fractions)
    return _per_column(df, columns, {
        "quantiles": f"percentile_approx(cast({{c}} AS double), array({listed}), 10000)"
    })


def label_correlations(df: DataFrame, label: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every numeric column with the label, strongest first."""
    columns = numeric_columns(df, {label}) if columns is None else columns
    table = _per_column(df, columns, {
        "corr": f"corr(cast({{c}} AS double), cast({quoted(label)} AS double))"
    })
    return table.withColumn("abs_corr", F.abs("corr")).orderBy(F.col("abs_corr").desc_nulls_last(), "column")


def join_cardinality(df: DataFrame, key: str) -> DataFrame:
    """How many rows a parent key has: keys, mean, largest."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("n_keys"), F.avg("n").alias("mean_rows"), F.max("n").alias("max_rows")
    )


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows per equal-width bin; values outside the range fall into bins 0 and bins + 1."""
    bucket = F.width_bucket(F.col(column).cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    return df.filter(F.col(column).isNotNull()).groupBy(bucket.cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


def unpivot(df: DataFrame, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Long form ``(keep..., column, value)`` of numeric columns, without missing values."""
    doubles = df.selectExpr(*map(quoted, keep), *[f"{finite_sql(c)} AS {quoted(c)}" for c in columns])
    return doubles.unpivot(list(keep), list(columns), "column", "value").filter("value IS NOT NULL")


def univariate_auc(
    df: DataFrame, columns: Sequence[str], label: str, suspicious: float = 0.65
) -> DataFrame:
    """AUC of each column on its own, direction ignored, with the number of rows behind it.

    0.5 where one class is missing; ``suspicious`` marks columns that may leak
    the label.
    """
    labelled = df.filter(F.col(label).isNotNull())
    parts = [
        roc_auc(unpivot(labelled, columns[i:i + CHUNK], [label]), "value", label, by="column")
        for i in range(0, len(columns), CHUNK)
    ]
    scored = reduce(DataFrame.unionByName, parts)
    auc = F.when(F.col("auc").isNotNull(), F.greatest("auc", 1.0 - F.col("auc"))).otherwise(F.lit(0.5))
    return scored.select("column", "n", auc.alias("auc"), (auc > suspicious).cast("int").alias("suspicious"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows, positive share and the weight that balances the classes."""
    rate: Column = F.avg(F.col(label).cast("double"))
    return df.filter(F.col(label).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), rate.alias("pos_rate"),
        F.try_divide(1.0 - rate, rate).alias("balance_weight"),
    )


# ------------------------------------------------ drift and calibration reports


def population_stability(df: DataFrame, column: str, is_new: Column, bins: int = 10) -> DataFrame:
    """Shares per reference-quantile bin of old and new rows, with the stability index parts.

    The index is the sum of ``part``; a bin empty on one side counts as one
    ten-thousandth.
    """
    old = df.filter(~is_new)
    fractions = ", ".join(str(i / bins) for i in range(1, bins))
    cuts = old.selectExpr(f"percentile_approx({quoted(column)}, array({fractions}), 10000) AS c").first()["c"]
    bin_of = F.size(F.filter(F.lit([float(c) for c in cuts]), lambda c: c < F.col(column)))
    counts = df.filter(F.col(column).isNotNull()).groupBy(bin_of.cast("int").alias("bin")).agg(
        F.count_if(~is_new).alias("old"), F.count_if(is_new).alias("new")
    )
    both = Window.partitionBy(F.lit(0))  # one row per bin
    shares = counts.select("bin", *[
        F.greatest(F.try_divide(F.col(c).cast("double"), F.sum(c).over(both)), F.lit(1e-4)).alias(c)
        for c in ("old", "new")
    ])
    return shares.withColumn("part", (F.col("new") - F.col("old")) * F.ln(F.col("new") / F.col("old")))


def calibration(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Mean score against positive share per equal-width score bin."""
    bin_of = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(bin_of.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"),
        F.avg(F.col(label).cast("double")).alias("pos_rate"),
    )
