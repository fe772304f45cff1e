"""Category and numeric encoders.

Statistics that involve the label exclude the fold they are applied to. Where
a statistic can be subtracted (sums and counts) all folds come out of one
aggregate: the total minus the fold's own part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from riskfeat.functions.columns import numeric_columns
from riskfeat.functions.rows import finite_sql, inverse_normal, literal, quoted
from riskfeat.operators.lookup import BROADCAST_ROWS, attach, collect_bounded
from riskfeat.operators.rank import ordinals
from riskfeat.session import cut_lineage

NULL_FLAG = "__isnan"
CODE = "__nn"
ONE_HOT_LIMIT = 1_000
INLINE_ENTRIES = 100


# ------------------------------------------------------------- vocabularies


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` for every category of every column, one scan."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])
    return (
        df.select(F.explode(pairs).alias("p")).select("p.column", "p.value")
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def count_encode(
    df: DataFrame, columns: Sequence[str], prefix: str = "APP_CAT", max_rows: int = BROADCAST_ROWS,
    counts: Sequence[Row] | None = None,
) -> DataFrame:
    """Count and relative frequency of each row's category.

    A NULL category gets NULL, not the number of NULLs. ``counts`` are rows of
    ``category_counts`` where they have been collected before.
    """
    measured = category_counts(df, columns)
    known = measured.filter(F.col("value").isNotNull())
    rows = counts if counts is not None else collect_bounded(measured, max_rows) if max_rows > 0 else None
    if rows is None:
        total = df.count()
    else:
        total = sum(r["n"] for r in rows if r["column"] == columns[0])
    looked_up: dict[str, Column] = {}
    out = df
    for c in columns:
        mine = None if rows is None else {
            r["value"]: r["n"] for r in rows if r["column"] == c and r["value"] is not None
        }
        if mine is not None and len(mine) <= INLINE_ENTRIES:
            looked_up[c] = _inline(mine, c)
            continue
        if mine is not None:
            dictionary = df.sparkSession.createDataFrame(list(mine.items()), f"`{c}` string, `_n_{c}` bigint")
            side = F.broadcast(dictionary.withColumnRenamed(c, "_value"))
            out = out.join(side, out[c] == side["_value"], "left").drop("_value")
        else:
            dictionary = known.filter(F.col("column") == c).select(
                F.col("value").alias(c), F.col("n").alias(f"_n_{c}")
            )
            out = attach(out, dictionary, c, weight=f"_n_{c}", max_rows=0)
        looked_up[c] = F.col(f"_n_{c}")
    made = []
    for c in columns:
        made += [
            looked_up[c].alias(f"{prefix}_COUNT_{c}"),
            F.try_divide(looked_up[c].cast("double"), F.lit(float(total))).alias(f"{prefix}_FREQ_{c}"),
        ]
    return out.select(*df.columns, *made)


def _inline(entries: Mapping[str, int], column: str) -> Column:
    """A short dictionary as a literal map: no join for the usual few categories."""
    if not entries:
        return F.lit(None).cast("bigint")
    pairs = ", ".join(f"{literal(value)}, {n}L" for value, n in entries.items())
    return F.expr(f"try_element_at(map({pairs}), {quoted(column)})")


def one_hot(
    df: DataFrame, columns: Sequence[str], prefix: str = "APP_OHE_", limit: int = ONE_HOT_LIMIT,
    vocabulary: Mapping[str, Sequence[str | None]] | None = None,
) -> DataFrame:
    """A 0/1 column per category; NULL is a category of its own (``__null``).

    The vocabulary comes from the data unless given. A column of more than
    ``limit`` categories becomes one sparse vector column, ``prefix`` and its
    name, which ``VectorAssembler`` takes as it is.
    """
    wide: list[str] = []
    if vocabulary is None:
        measured = category_counts(df, columns)
        found = collect_bounded(measured.select("column", "value"), limit * len(columns))
        if found is None:  # the few columns' sizes first, then the values of the narrow ones
            sizes = {r["column"]: r["n"] for r in measured.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
            narrow = [c for c in columns if sizes.get(c, 0) <= limit]
            found = category_counts(df, narrow).select("column", "value").collect() if narrow else []
            wide = [c for c in columns if c not in narrow]
        vocabulary = {c: [r["value"] for r in found if r["column"] == c] for c in columns if c not in wide}
    wide += [c for c in columns if c not in wide and len(vocabulary[c]) > limit]
    hot: dict[str, Column] = {}
    for c in columns:
        if c in wide:
            continue
        for level in sorted(vocabulary[c], key=lambda v: (v is None, v or "")):
            name = f"{prefix}{c}__{'null' if level is None else level}"
            same = f"{quoted(c)} IS NULL" if level is None else f"{quoted(c)} <=> {literal(level)}"
            hot[name] = F.expr(f"cast({same} AS int)")
    out = df.select("*", *[e.alias(n) for n, e in hot.items()])
    for c in wide:
        out = sparse_one_hot(out, c, f"{prefix}{c}", vocabulary.get(c))
    return out


def sparse_one_hot(
    df: DataFrame, column: str, out: str, vocabulary: Sequence[str | None] | None = None, max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One sparse vector per row: a place for every category in lexicographic order, NULL behind them.

    The NULL place is there only where the vocabulary has NULL; a category that
    a given vocabulary lacks is the zero vector. Places come from a dictionary
    join, so neither the plan nor the driver holds the categories that the data
    bring, and a frequent category does not gather its rows.
    """
    if vocabulary is None:
        fitted = df.select(column)
    else:
        levels = [(v,) for v in dict.fromkeys(vocabulary)]
        fitted = df.sparkSession.createDataFrame(levels, f"{quoted(column)} string")
    known = category_counts(fitted, [column])
    size, has_null = known.agg(F.count("value"), F.count(F.lit(1)) > F.count("value")).first()
    suffix, place, kept = "__place", f"{column}__place", f"{column}__known"
    coded = _add_codes(df, fitted, [column], 0, -1, suffix, max_rows)
    total = size + int(has_null)
    number = F.when(F.col(place) >= 0, F.col(place)).when(F.lit(has_null) & F.col(column).isNull(), F.lit(size))
    # one place more takes the categories that are not in the vocabulary; dropLast makes it the zero vector
    attribute = {"ml_attr": {"type": "nominal", "name": kept, "num_vals": total + 1}}
    numbered = coded.withColumn(kept, F.coalesce(number, F.lit(total)).cast("double").alias(kept, metadata=attribute))
    encoder = OneHotEncoder(inputCols=[kept], outputCols=[out], dropLast=True)
    return encoder.fit(numbered).transform(numbered).drop(place, kept)


def _add_codes(
    df: DataFrame, fitted: DataFrame, columns: Sequence[str], first: int, missing: int, suffix: str, max_rows: int
) -> DataFrame:
    """Codes ``first, first + 1, ...`` in lexicographic order of the categories of ``fitted``."""
    known = category_counts(fitted, columns).filter(F.col("value").isNotNull())
    rows = collect_bounded(known, max_rows) if max_rows > 0 else None
    codes = None
    if rows is None:
        # numbered in ranges of the sorted values, which no common prefix can make uneven
        ranged = cut_lineage(known.repartitionByRange("column", "value").withColumn("_range", F.spark_partition_id()))
        codes = ordinals(ranged, "value", F.col("_range"), by="column", out="code")
    out = df
    found: dict[str, Column] = {}
    for c in columns:
        code = f"{c}{suffix}"
        if rows is not None:
            mine = {v: i + first for i, v in enumerate(sorted(r["value"] for r in rows if r["column"] == c))}
            if len(mine) <= INLINE_ENTRIES:
                found[c] = _inline(mine, c)
                continue
            table = df.sparkSession.createDataFrame(list(mine.items()), f"`{c}` string, `_c_{c}` bigint")
            out = attach(out, table, c, max_rows=max_rows)
        else:
            table = codes.filter(F.col("column") == c).select(
                F.col("value").alias(c), (F.col("code") + first).cast("bigint").alias(f"_c_{c}"), F.col("n").alias("_n")
            )
            out = attach(out, table, c, weight="_n", max_rows=0).drop("_n")
        found[c] = F.col(f"_c_{c}")
    made = [F.coalesce(found[c].cast("int"), F.lit(missing)).alias(f"{c}{suffix}") for c in columns]
    return out.select(*df.columns, *made)


def label_codes(
    df: DataFrame, columns: Sequence[str], suffix: str = CODE, missing: int = -1,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Integer code per category in lexicographic order; NULL becomes ``missing``."""
    return _add_codes(df, df, columns, 0, missing, suffix, max_rows)


def train_fold_codes(
    df: DataFrame, columns: Sequence[str], train: Column, suffix: str = "__code", max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Codes 1, 2, ... fitted on the rows where ``train`` holds; unseen and NULL are 0."""
    return _add_codes(df, df.filter(train), columns, 1, 0, suffix, max_rows)


# ---------------------------------------------------------- target encoding


def fold_counts(df: DataFrame, label: str, fold: str, folds: int) -> list[tuple[int, int]]:
    """Labelled rows and positives outside each fold."""
    own = {
        r[fold]: (r["n"], r["pos"])
        for r in df.filter(F.col(label).isNotNull()).groupBy(fold).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos")
        ).collect()
    }
    n, pos = sum(v[0] for v in own.values()), sum(v[1] for v in own.values())
    mine = [own.get(f, (0, 0)) for f in range(folds)]
    return [(n - fn, pos - fp) for fn, fp in mine]


def fold_means(counts: Sequence[tuple[int, int]]) -> list[float]:
    return [pos / n if n else 0.0 for n, pos in counts]


def target_encodings(
    df: DataFrame, column: str, label: str, fold: str, folds: int, smoothing: float = 10.0,
    counts: Sequence[tuple[int, int]] | None = None,
) -> DataFrame:
    """``(column, rows, enc)``: per category its encoding in every fold context.

    ``enc[f]`` is fitted on the labelled rows outside fold ``f``:
    ``(positives + m * mean) / (rows + m)``. A category that occurs in fold
    ``f`` alone comes out as the mean of the other folds, as it should.
    """
    means = fold_means(counts or fold_counts(df, label, fold, folds))
    rows = df.filter(F.col(label).isNotNull()).select(
        column, fold, F.col(label).cast("bigint").alias("_y")
    )
    own_n = [F.count(F.when(F.col(fold) == f, F.lit(1))).alias(f"_n{f}") for f in range(folds)]
    own_pos = [
        F.coalesce(F.sum(F.when(F.col(fold) == f, F.col("_y"))), F.lit(0)).alias(f"_p{f}")
        for f in range(folds)
    ]
    sums = rows.groupBy(column).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_y").alias("pos"), *own_n, *own_pos
    )
    contexts = [
        (F.col("pos") - F.col(f"_p{f}") + F.lit(smoothing * mean))
        / (F.col("rows") - F.col(f"_n{f}") + F.lit(smoothing))
        for f, mean in enumerate(means)
    ]
    return sums.select(column, "rows", F.array(*contexts).alias("enc"))


@dataclass(frozen=True)
class TargetEncoder:
    """Fitted encodings of some columns in every fold context."""

    tables: Mapping[str, DataFrame]
    means: Sequence[float]
    fold: str
    max_rows: int = BROADCAST_ROWS

    def apply(self, df: DataFrame, context: int | None = None) -> DataFrame:
        """Add ``<column>_TE``.

        Without ``context`` a labelled row gets the encoding of its own fold's
        context (out of fold) and a row without fold the mean over all
        contexts. With ``context=f`` every row gets the encoding fitted
        outside fold ``f``: the columns a model for that fold trains on.
        """
        out = df
        for c, table in self.tables.items():
            out = attach(out, table, c, weight="rows", null_safe=True, max_rows=self.max_rows)
            enc = F.coalesce(F.col("enc"), F.lit(list(self.means)))
            if context is not None:
                value = enc[context]
            else:
                average = F.aggregate(enc, F.lit(0.0), lambda a, x: a + x) / F.lit(float(len(self.means)))
                value = F.when(F.col(self.fold).isNull(), average).otherwise(F.get(enc, F.col(self.fold)))
            out = out.withColumn(f"{c}_TE", value).drop("enc", "rows")
        return out


def fit_target_encoder(
    df: DataFrame, columns: Sequence[str], label: str, fold: str, folds: int = 5,
    smoothing: float = 10.0, max_rows: int = BROADCAST_ROWS,
) -> TargetEncoder:
    """All columns and all fold contexts, written out once for every later use."""
    counts = fold_counts(df, label, fold, folds)
    tables = {
        c: cut_lineage(target_encodings(df, c, label, fold, folds, smoothing, counts)) for c in columns
    }
    return TargetEncoder(tables, fold_means(counts), fold, max_rows)


def target_encode(
    df: DataFrame, columns: Sequence[str], label: str, fold: str, folds: int = 5,
    smoothing: float = 10.0, context: int | None = None, max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Fit and apply in one step; see ``TargetEncoder.apply``."""
    return fit_target_encoder(df, columns, label, fold, folds, smoothing, max_rows).apply(df, context)


# ------------------------------------------------------- numeric transforms


def _chunks(names: Sequence[str], size: int) -> Iterator[Sequence[str]]:
    for i in range(0, len(names), size):
        yield names[i:i + size]


def medians(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000, chunk: int = 100) -> dict[str, float]:
    """Approximate medians; 0 for a column without a value.

    A chunk's sketches are merged column by column, in as many tasks as there
    are columns: merged as one row they would all meet in a single task, which
    has the more to do the more partitions there are.
    """
    out = dict.fromkeys(columns, 0.0)
    for part in _chunks(columns, chunk):
        wide = df.selectExpr(*[f"cast({finite_sql(c)} AS double) AS m{i}" for i, c in enumerate(part)])
        long = wide.unpivot([], wide.columns, "which", "value").filter("value IS NOT NULL")
        rows = long.groupBy("which").agg(F.percentile_approx("value", 0.5, accuracy).alias("m")).collect()
        out.update({part[int(r["which"][1:])]: float(r["m"]) for r in rows})
    return out


def fill_values(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Missing and non-finite entries replaced by the given value of their column."""
    return df.selectExpr(*[
        f"coalesce({finite_sql(c)}, double('{float(values[c])!r}')) AS {quoted(c)}" if c in values else quoted(c)
        for c in df.columns
    ])


def median_impute(
    df: DataFrame, columns: Sequence[str], train: Column | None = None, accuracy: int = 10_000
) -> DataFrame:
    """Fill with medians fitted on the rows where ``train`` holds (all by default)."""
    fitted = df if train is None else df.filter(train)
    return fill_values(df, medians(fitted, columns, accuracy))


def null_flags(df: DataFrame, columns: Iterable[str], suffix: str = NULL_FLAG) -> DataFrame:
    return df.selectExpr("*", *[f"cast({quoted(c)} IS NULL AS int) AS {quoted(c + suffix)}" for c in columns])


def standardize(df: DataFrame, columns: Sequence[str], train: Column | None = None) -> DataFrame:
    """Zero mean and unit (population) deviation, fitted on the train rows.

    A constant column is only centred.
    """
    fitted = df if train is None else df.filter(train)
    row = fitted.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    scaled = {
        c: (F.col(c) - F.lit(row[f"m{i}"] or 0.0)) / F.lit(row[f"s{i}"] or 1.0)
        for i, c in enumerate(columns)
    }
    return df.withColumns(scaled) if scaled else df


def quantile_tables(
    df: DataFrame, columns: Sequence[str], quantiles: int = 1000, accuracy: int = 10_000, chunk: int = 25
) -> dict[str, np.ndarray]:
    """``quantiles`` evenly spaced approximate quantiles per column.

    What reaches the driver is (columns x quantiles) numbers, whatever the
    number of rows.
    """
    fractions = [i / (quantiles - 1) for i in range(quantiles)]
    out: dict[str, np.ndarray] = {}
    for part in _chunks(columns, chunk):
        row = df.agg(*[
            F.percentile_approx(c, F.lit(fractions), accuracy).alias(f"q{i}") for i, c in enumerate(part)
        ]).first()
        for i, c in enumerate(part):
            out[c] = np.asarray(row[f"q{i}"] if row[f"q{i}"] else [0.0], dtype=float)
    return out


def _position_udf(tables: Mapping[str, np.ndarray], schema: StructType):
    """Share of the fitted values below each input, averaged over ties."""

    @F.pandas_udf(schema)
    def positions(block: pd.DataFrame) -> pd.DataFrame:
        out = {}
        for c in block.columns:
            knots = tables[c]
            grid = np.linspace(0.0, 1.0, len(knots)) if len(knots) > 1 else np.array([0.5])
            x = block[c].to_numpy(dtype=float)
            up = np.interp(x, knots, grid)
            down = 1.0 - np.interp(-x, -knots[::-1], grid) if len(knots) > 1 else up
            share = 0.5 * (up + down)
            share = np.where(x < knots[0], 0.0, np.where(x > knots[-1], 1.0, share))
            out[c] = share
        return pd.DataFrame(out)

    return positions


def rank_gauss(
    df: DataFrame, columns: Sequence[str] | None = None, train: Column | None = None,
    quantiles: int = 1000, exclude: Sequence[str] = (),
) -> DataFrame:
    """Map numeric columns through their quantile function onto N(0, 1).

    Null flags and category codes are left alone. Missing and non-finite
    entries take the train median first.
    """
    if columns is None:
        columns = [
            c for c in numeric_columns(df, exclude) if not c.endswith((NULL_FLAG, CODE))
        ]
    if not columns:
        return df
    fitted = df if train is None else df.filter(train)
    middle = medians(fitted, columns)
    n = fitted.count()
    filled = fill_values(df, middle)
    source = filled if train is None else filled.filter(train)
    tables = quantile_tables(source, columns, max(2, min(quantiles, n)))
    schema = StructType([StructField(c, DoubleType()) for c in columns])
    shares = _position_udf(tables, schema)(F.struct(*columns))
    kept = [c for c in df.columns if c not in set(columns)]
    spread = filled.select(*kept, shares.alias("_share"))
    return spread.select(*[
        inverse_normal(F.col("_share")[c]).alias(c) if c in schema.names else F.col(c)
        for c in df.columns
    ])


# ------------------------------------------------- documented extra transforms


def log_income(df: DataFrame, column: str, out: str) -> DataFrame:
    return df.withColumn(out, F.ln(F.greatest(F.col(column), F.lit(0.0)) + 1.0))


def winsorize(df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Clip each column to two of its approximate quantiles."""
    row = df.agg(*[
        F.percentile_approx(c, F.lit([low, high]), 10_000).alias(f"q{i}") for i, c in enumerate(columns)
    ]).first()
    clipped = {
        c: F.when(F.col(c).isNotNull(),
                  F.least(F.greatest(F.col(c), F.lit(row[f"q{i}"][0])), F.lit(row[f"q{i}"][1])))
        for i, c in enumerate(columns) if row[f"q{i}"]
    }
    return df.withColumns(clipped) if clipped else df
