"""Column pruning: statistics come from Spark, decisions are column lists."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.functions.columns import numeric_columns
from riskfeat.functions.rows import seeded_hash
from riskfeat.operators import profile
from riskfeat.operators.encode import fill_values, medians
from riskfeat.operators.folds import SEED, seeded_sample
from riskfeat.operators.rank import ordinals

TILE = 128  # columns of a block of the correlation matrix
PANEL_BYTES = 32 << 20  # of the part of that matrix that one task sums up


def missing_columns(df: DataFrame, threshold: float = 0.99, keep: Collection[str] = ()) -> list[str]:
    """Columns whose share of NULLs exceeds ``threshold``."""
    rates = profile.null_rates(df, [c for c in df.columns if c not in keep])
    return [r["column"] for r in rates.filter(F.col("null_rate") > threshold).collect()]


def flat_columns(df: DataFrame, threshold: float = 1e-6, keep: Collection[str] = ()) -> list[str]:
    """Numeric columns whose variance lies below ``threshold``."""
    names = numeric_columns(df, set(keep))
    if not names:
        return []
    table = profile.variances(df, names)
    return [r["column"] for r in table.filter(F.col("variance") < threshold).collect()]


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Absolute Pearson correlations after median imputation; a constant column correlates with nothing."""
    filled = fill_values(df.select(*columns), medians(df, columns))
    vectors = VectorAssembler(inputCols=list(columns), outputCol="v").transform(filled).select("v")
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    return np.abs(np.nan_to_num(matrix, nan=0.0))


def correlated_pairs(df: DataFrame, columns: Sequence[str], threshold: float, panel: int | None = None) -> DataFrame:
    """(a, b, corr) of all pairs of columns whose absolute correlation exceeds ``threshold``, a before b.

    Medians stand for missing values. Columns are cut into blocks of ``TILE``;
    every task sums the products of its standardised rows for the tiles of a
    panel of blocks against all columns, the tiles of all tasks are added up by
    (block, block), and only pairs above the threshold leave them. A panel is
    as high as ``PANEL_BYTES`` allows, so a task's memory does not grow with
    the square of the columns; each panel is one pass. A constant column
    correlates with nothing.
    """
    names, spark = list(columns), df.sparkSession
    fill = medians(df, names)
    filled = np.array([fill.get(c) or 0.0 for c in names], dtype=float)
    moments = _moments(fill_values(df.select(*names), fill), names)
    count, mean, std = moments
    blocks = -(-len(names) // TILE)
    panel = panel or max(1, PANEL_BYTES // (8 * TILE * max(len(names), 1)))
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])

    def partial(first: int, last: int):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high = first * TILE, min(last * TILE, len(names))
            total = np.zeros((high - low, len(names) - low))
            for batch in batches:
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
                x = np.where(np.isfinite(x), x, filled)
                z = np.divide(x - mean, std, out=np.zeros_like(x), where=std > 0)
                total += z[:, low:high].T @ z[:, low:]
            for i in range(first, last):
                for j in range(i, blocks):
                    tile = total[i * TILE - low:(i + 1) * TILE - low, j * TILE - low:(j + 1) * TILE - low]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([tile.tobytes()], pa.binary())],
                        names=["i", "j", "tile"])
        return run

    def above(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(key: tuple[int, int], total: np.ndarray) -> pa.RecordBatch:
            i, j = key
            corr = np.abs(total.reshape(-1, min(TILE, len(names) - j * TILE))) / count
            rows, cols = np.nonzero(corr > threshold)
            a, b = rows + i * TILE, cols + j * TILE
            keep = a < b
            return pa.RecordBatch.from_arrays(
                [pa.array(a[keep], pa.int32()), pa.array(b[keep], pa.int32()), pa.array(corr[rows, cols][keep])],
                names=["x", "y", "corr"])
        key = total = None
        for batch in batches:
            for row in batch.to_pylist():
                this, tile = (row["i"], row["j"]), np.frombuffer(row["tile"])
                if this == key:
                    total = total + tile
                    continue
                if key is not None:
                    yield pairs(key, total)
                key, total = this, tile
        if key is not None:
            yield pairs(key, total)

    found = None
    for first in range(0, blocks, panel):
        tiles = values.mapInArrow(partial(first, min(first + panel, blocks)), "i int, j int, tile binary")
        part = tiles.repartition("i", "j").sortWithinPartitions("i", "j").mapInArrow(above, "x int, y int, corr double")
        found = part if found is None else found.union(part)
    listed = F.array(*[F.lit(c) for c in names]) if names else F.array().cast("array<string>")
    if found is None:
        return spark.createDataFrame([], "a string, b string, corr double")
    return found.select(F.get(listed, F.col("x")).alias("a"), F.get(listed, F.col("y")).alias("b"), "corr")


def _moments(filled: DataFrame, names: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means and standard deviations, a chunk of columns at a time."""
    count, mean, std = 0, [], []
    for i in range(0, len(names), profile.CHUNK):
        part = names[i:i + profile.CHUNK]
        row = filled.agg(F.count(F.lit(1)).alias("n"), *[
            e for k, c in enumerate(part) for e in (F.avg(F.col(c).cast("double")).alias(f"m{k}"),
                                                    F.stddev_pop(F.col(c).cast("double")).alias(f"s{k}"))]).first()
        count = row["n"]
        mean += [row[f"m{k}"] or 0.0 for k in range(len(part))]
        std += [row[f"s{k}"] or 0.0 for k in range(len(part))]
    mean, std = np.array(mean), np.array(std)
    return max(count, 1), mean, np.where(std > 1e-12 * np.maximum(np.abs(mean), 1e-300), std, 0.0)


def losers_of_pairs(pairs: Collection[tuple[int, int]], auc: Sequence[float]) -> list[int]:
    """Which column of each too-similar pair goes: the one with the lower AUC.

    Columns are visited in order, each against the later ones; equal AUCs keep
    the earlier column, and a column that loses takes part in no further pair.
    """
    alive = np.ones(len(auc), dtype=bool)
    for i, j in sorted(pairs):
        if alive[i] and alive[j]:
            alive[i if auc[j] > auc[i] else j] = False
    return [int(i) for i in np.flatnonzero(~alive)]


def correlated_columns(
    df: DataFrame, key: str, label: str, threshold: float = 0.98, sample: int | None = None, seed: int = SEED,
) -> list[str]:
    """The weaker member of every numeric pair correlated beyond ``threshold``.

    All labelled rows are measured unless a ``sample`` size is asked for. AUCs
    are computed for the columns of such pairs only.
    """
    names = numeric_columns(df, {key, label})
    if len(names) < 2:
        return []
    measured = df.filter(F.col(label).isNotNull()).select(key, label, *names)
    if sample is not None:
        measured = seeded_sample(measured, key, sample, seed)
    place = {c: i for i, c in enumerate(names)}
    pairs = [(place[r["a"]], place[r["b"]]) for r in correlated_pairs(measured, names, threshold).collect()]
    if not pairs:
        return []
    asked = [names[i] for i in sorted({i for p in pairs for i in p})]
    table = {r["column"]: r["auc"] for r in profile.univariate_auc(measured, asked, label).collect()}
    return [names[i] for i in losers_of_pairs(pairs, [table.get(c, 0.5) for c in names])]


def permute_label(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    """Deal the labels of all rows out again in another seeded order.

    Row number r of one order receives the label of row number r of the other.
    """
    here = ordinals(df.withColumn("_h", seeded_hash(key, seed)), "_h", F.substring("_h", 1, 3))
    there = ordinals(
        df.select(seeded_hash(key, seed + 1).alias("_h"), F.col(label).alias("_label")),
        "_h", F.substring("_h", 1, 3),
    ).select("ordinal", "_label")
    return here.drop("_h", label).join(there, "ordinal").withColumnRenamed("_label", label).drop("ordinal")


def f_statistics(df: DataFrame, columns: Sequence[str], label: str) -> list[float]:
    """One-way F statistic of each column over the classes of the label, medians for missing values.

    Per class one row of counts, means and variances comes back, over all rows;
    a column without variance inside the classes has no finite F and counts as 0.
    """
    filled = fill_values(df.filter(F.col(label).isNotNull()).select(label, *columns), medians(df, columns))
    found: list[float] = []
    for i in range(0, len(columns), profile.CHUNK):
        part = columns[i:i + profile.CHUNK]
        rows = filled.groupBy(label).agg(F.count(F.lit(1)).alias("_n"), *[
            e for k, c in enumerate(part) for e in (F.avg(c).alias(f"_m{k}"), F.var_pop(c).alias(f"_v{k}"))]).collect()
        n = np.array([r["_n"] for r in rows], dtype=float)
        for k in range(len(part)):
            mean, var = (np.array([r[f"_{x}{k}"] or 0.0 for r in rows], dtype=float) for x in "mv")
            between = (n * (mean - (n * mean).sum() / n.sum()) ** 2).sum() / max(len(n) - 1, 1)
            within = (n * var).sum() / max(n.sum() - len(n), 1)
            found.append(float(between / within) if within > 0 else 0.0)
    return found


def select_k_best(df: DataFrame, columns: Sequence[str], label: str, k: int = 300) -> list[str]:
    """The ``k`` columns with the strongest F statistic against the label, measured on all rows.

    Statistics that agree to six decimals count as equal and leave the choice
    to the order of columns.
    """
    strength = f_statistics(df, columns, label)
    best = sorted(range(len(columns)), key=lambda i: (-round(strength[i], 6), i))[:k]
    return [columns[i] for i in sorted(best)]


def prune(df: DataFrame, key: str, label: str, missing: float = 0.99, variance: float = 1e-6,
          correlation: float = 0.98) -> DataFrame:
    """The three statistical prunes one after the other."""
    out = df.drop(*missing_columns(df, missing, {key}))
    out = out.drop(*flat_columns(out, variance, {key, label}))
    return out.drop(*correlated_columns(out, key, label, correlation))
