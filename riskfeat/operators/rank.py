"""Global order statistics: ranks, ordinals, ROC AUC and exact quantiles.

None of them sorts a table in one task. Values are cut into buckets by a
function of the value alone, the ordered window runs inside a bucket, and the
(few) bucket totals turn local positions into global ones. Buckets come from
approximate quantiles, yet every result is exact: any monotone cut would do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeat.operators.lookup import attach, collect_bounded

MAX_GROUPS = 10_000
BUCKETS = 1_024
ROWS_PER_BUCKET = 250_000
_BLOCK = 32


def _group_list(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def _blocks(cuts: Sequence[float], rows: int, buckets: int) -> tuple[list[float], list[list[float]]]:
    """The cuts a group of ``rows`` rows needs, in blocks, and the last cut of each block."""
    wanted = min(buckets, -(-rows // ROWS_PER_BUCKET))
    if wanted <= 1:
        return [], []
    spaced = [cuts[i * len(cuts) // wanted] for i in range(1, wanted)]
    kept = sorted({float(c) for c in spaced})
    blocks = [kept[i:i + _BLOCK] for i in range(0, len(kept), _BLOCK)]
    return [b[-1] for b in blocks], blocks


def _cuts_below(value: str, ends: Column, blocks: Column) -> Column:
    """How many cuts lie below the value: first whole blocks, then inside one."""
    passed = F.size(F.filter(ends, lambda c: c < F.col(value)))
    inside = F.size(F.filter(F.get(blocks, passed), lambda c: c < F.col(value)))
    return passed * _BLOCK + F.coalesce(F.when(passed < F.size(blocks), inside), F.lit(0))


def _with_bucket(df: DataFrame, source: DataFrame, value: str, by: list[str], buckets: int) -> DataFrame:
    """Add ``_bucket``, a monotone function of the value per group.

    Groups are cut at approximate quantiles of ``source``, the finer the more
    rows they have; what fits one task is not cut at all.
    """
    steps = min(buckets, BUCKETS if not by else 256)
    fractions = F.lit([i / steps for i in range(steps)])
    measured = [F.count(value).alias("_rows"), F.percentile_approx(value, fractions, 10_000).alias("_cuts")]
    sketch = source.groupBy(*by).agg(*measured) if by else source.agg(*measured)
    rows = collect_bounded(sketch, MAX_GROUPS)
    if rows is None:
        # more groups than the driver should see: every group is cut, the cuts travel by join
        starts = F.sequence(F.lit(1), F.lit(steps), F.lit(_BLOCK))
        nested = sketch.select(*by, "_rows", F.transform(starts, lambda i: F.slice("_cuts", i, _BLOCK)).alias("_blocks"))
        ended = nested.withColumn("_ends", F.transform("_blocks", lambda b: F.element_at(b, -1)))
        known = attach(df, ended, by, weight="_rows", max_rows=0, null_safe=True)
        bucket = _cuts_below(value, F.col("_ends"), F.col("_blocks"))
        return known.withColumn("_bucket", bucket).drop("_ends", "_blocks", "_rows")
    made = [(*[r[c] for c in by], *_blocks(r["_cuts"], r["_rows"], steps)) for r in rows if r["_cuts"]]
    if not any(m[-1] for m in made):
        return df.withColumn("_bucket", F.lit(0))
    if not by:
        ends, blocks = made[0][-2:]
        nested = F.array(*[F.lit(b) for b in blocks])
        return df.withColumn("_bucket", _cuts_below(value, F.lit(ends), nested))
    kinds = "".join(f"`{c}` {source.schema[c].dataType.simpleString()}, " for c in by)
    table = df.sparkSession.createDataFrame(made, f"{kinds}_ends array<double>, _blocks array<array<double>>")
    known = attach(df, table, by, null_safe=True)
    return known.withColumn("_bucket", _cuts_below(value, F.col("_ends"), F.col("_blocks"))).drop("_ends", "_blocks")


def _before(by: list[str]) -> Window:
    """Window over the bucket totals of a group: at most ``buckets`` rows."""
    keys = [F.col(c) for c in by] or [F.lit(0)]
    return Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)


def _up_to(by: list[str], value: str) -> Window:
    return (
        Window.partitionBy(*by, "_bucket").orderBy(value)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def value_positions(df: DataFrame, value: str, by: str | Sequence[str] = (), buckets: int = BUCKETS) -> DataFrame:
    """Per distinct value: ``n`` rows, ``below`` rows with a smaller value, ``total`` rows.

    Equal values are combined before the shuffle, so ties cost nothing.
    """
    by = _group_list(by)
    rows = df.filter(F.col(value).isNotNull()).select(*by, value)
    counts = rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    bucketed = _with_bucket(counts, rows, value, by, buckets)
    inside = bucketed.withColumn("_below", F.sum("n").over(_up_to(by, value)) - F.col("n"))
    totals = bucketed.groupBy(*by, "_bucket").agg(F.sum("n").alias("_rows"))
    keys = [F.col(c) for c in by] or [F.lit(0)]
    offsets = totals.select(
        *by, "_bucket",
        F.coalesce(F.sum("_rows").over(_before(by)), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(Window.partitionBy(*keys)).alias("total"),
    )
    return attach(inside, offsets, [*by, "_bucket"], null_safe=True).select(
        *by, value, "n", (F.col("_below") + F.col("_offset")).alias("below"), "total"
    )


def rank_normalize(
    df: DataFrame, value: str, by: str | Sequence[str] = (), out: str = "rank", buckets: int = BUCKETS
) -> DataFrame:
    """Average rank scaled to [0, 1]: ``(rank - 1) / (rows - 1)``, per group."""
    by = _group_list(by)
    positions = value_positions(df, value, by, buckets)
    ranks = positions.select(
        *by, value, "n",
        F.try_divide(F.col("below") + (F.col("n") - 1) / 2, (F.col("total") - 1).cast("double")).alias(out),
    )
    return attach(df, ranks, [*by, value], weight="n", max_rows=0, null_safe=by).drop("n")


def roc_auc(
    df: DataFrame, score: str, label: str, by: str | Sequence[str] = (), buckets: int = BUCKETS
) -> DataFrame:
    """Tie-aware ROC AUC per group with row and positive counts.

    A pair of a positive and a negative row counts 1 when the positive scores
    higher and 1/2 on a tie; NULL scores and labels are left out, and the AUC
    is NULL where one class is missing.
    """
    by = _group_list(by)
    rows = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).select(
        *by, score, F.col(label).cast("bigint").alias("_y")
    )
    counts = rows.groupBy(*by, score).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_y").alias("pos")
    ).withColumn("neg", F.col("n") - F.col("pos"))
    bucketed = _with_bucket(counts, rows, score, by, buckets)
    lower = F.sum("neg").over(_up_to(by, score)) - F.col("neg")
    wins = F.col("pos").cast("double") * (lower + F.col("neg") / 2)
    per_bucket = bucketed.withColumn("_wins", wins).groupBy(*by, "_bucket").agg(
        F.sum("_wins").alias("_wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg")
    )
    offset = F.coalesce(F.sum("neg").over(_before(by)), F.lit(0))
    summed = per_bucket.withColumn("_wins", F.col("_wins") + F.col("pos").cast("double") * offset)
    pos, neg = F.sum("pos"), F.sum("neg")
    measures = [
        (pos + neg).alias("n"), pos.alias("positives"),
        F.try_divide(F.sum("_wins"), pos.cast("double") * neg).alias("auc"),
    ]
    return summed.groupBy(*by).agg(*measures) if by else summed.agg(*measures)


def exact_quantiles(
    df: DataFrame, value: str, fractions: Sequence[float], by: str | Sequence[str] = (),
    buckets: int = BUCKETS,
) -> DataFrame:
    """Interpolated quantiles per group as columns ``q0, q1, ...``.

    Only the two order statistics around each position are picked out of the
    distributed order; no group is ever held in one place.
    """
    by = _group_list(by)
    positions = value_positions(df, value, by, buckets)
    first, last = F.col("below"), F.col("below") + F.col("n") - 1
    picks, outputs = [], []
    for i, q in enumerate(fractions):
        spot = F.lit(float(q)) * (F.col("total") - 1)
        lo, hi = F.floor(spot), F.ceil(spot)
        picks += [
            F.max(F.when((first <= lo) & (lo <= last), F.col(value))).alias(f"_lo{i}"),
            F.max(F.when((first <= hi) & (hi <= last), F.col(value))).alias(f"_hi{i}"),
            F.max(spot - lo).alias(f"_part{i}"),
        ]
        outputs.append(
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_part{i}")).alias(f"q{i}")
        )
    picked = positions.groupBy(*by).agg(*picks) if by else positions.agg(*picks)
    return picked.select(*by, *outputs)


def ordinals(df: DataFrame, order: str, bucket: Column, by: str | Sequence[str] = (), out: str = "ordinal") -> DataFrame:
    """Position 0, 1, 2, ... of every row of a group in the order of a unique column.

    ``bucket`` must be a prefix of ``order`` so that bucket order and row order
    agree; it sets how finely the numbering is spread over tasks.
    """
    by = _group_list(by)
    bucketed = df.withColumn("_bucket", bucket)
    totals = bucketed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = totals.select(
        *by, "_bucket", F.coalesce(F.sum("_rows").over(_before(by)), F.lit(0)).alias("_offset")
    )
    numbered = bucketed.withColumn(
        "_position", F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(order)) - 1
    )
    return attach(numbered, offsets, [*by, "_bucket"], null_safe=True).withColumn(
        out, F.col("_position") + F.col("_offset")
    ).drop("_bucket", "_position", "_offset")
