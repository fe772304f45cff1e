"""Declarative aggregate blocks: statistics x strata x recency windows per key.

A ``Block`` is one output family: a name prefix, an optional row predicate (a
stratum or a recency window) and a list of ``Stat``. ``aggregate_blocks``
turns any number of blocks over one table into few passes.

Narrow specs become a single ``groupBy`` whose aggregates are guarded by the
block predicate. Wide specs would then make every row touch every accumulator
and outgrow generated code, so each row is instead expanded to the blocks it
belongs to inside the scan stage, aggregated by (key, block) with map-side
combine, and the few combined rows per key are folded into columns. Only
combined rows are shuffled, so a key holding a large share of the table costs
no more than any other key.

Blocks expanded together compute the union of their statistics. An
unconditional block much wider than the conditional ones therefore gets a
plain aggregate of its own.

Recency windows over one column lie inside each other, so no row has to be
copied into them: the windows cut the column into bands, every row belongs to
one, and counts, sums, extremes and second moments of (key, band) are merged
from the newest band outwards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.functions.rows import quoted

ONE_PASS_LIMIT = 40
SPLIT_RATIO = 1.5
_TAG = "_block"


@dataclass(frozen=True)
class Stat:
    """One aggregate: ``fn`` over ``column``, named ``<block prefix>_<suffix>``."""

    suffix: str
    fn: str
    column: str | None = None


@dataclass(frozen=True)
class Recent:
    """Rows whose ``column`` lies above ``bound``, or on it where ``inclusive``."""

    column: str
    bound: float
    inclusive: bool = True

    def rows(self) -> Column:
        value = F.col(self.column)
        return value >= self.bound if self.inclusive else value > self.bound


@dataclass(frozen=True)
class Block:
    prefix: str
    stats: tuple[Stat, ...]
    where: Column | None = None
    recent: Recent | None = None

    @staticmethod
    def of_recent(prefix: str, stats: tuple[Stat, ...], column: str, bound: float, inclusive: bool = True) -> Block:
        recent = Recent(column, bound, inclusive)
        return Block(prefix, stats, recent.rows(), recent)

    def name(self, stat: Stat) -> str:
        return f"{self.prefix}_{stat.suffix}"


ROWS = Stat("COUNT", "count")
FULL = ("mean", "max", "min", "sum", "std")
SHORT = ("mean", "max", "sum")


def stats_of(column: str, fns: Sequence[str], label: str | None = None) -> list[Stat]:
    label = column if label is None else label
    return [Stat(f"{label}_{fn.upper()}", fn, column) for fn in fns]


def numeric_block(columns: Sequence[str], fns: Sequence[str] = FULL) -> list[Stat]:
    return [s for c in columns for s in stats_of(c, fns)]


def flag_stats(column: str, label: str, sum_name: str = "SUM", rate_name: str = "RATE") -> list[Stat]:
    return [Stat(f"{label}_{sum_name}", "sum", column), Stat(f"{label}_{rate_name}", "mean", column)]


_SQL = {
    "count": "count(1)", "mean": "avg({c})", "max": "max({c})", "min": "min({c})",
    "std": "stddev_samp({c})",
    # rows without any value sum to zero
    "sum": "coalesce(sum({c}), 0)",
}


def _plain(stat: Stat, name: str) -> Column:
    """The aggregate over all rows; one parsed expression keeps wide plans quick to build."""
    value = "" if stat.column is None else quoted(stat.column)
    return F.expr(f"{_SQL[stat.fn].format(c=value)} AS {quoted(name)}")


def _guarded(stat: Stat, where: Column) -> Column:
    """The aggregate over the rows of a block; NULL when the key has none there."""
    rows = F.count(F.when(where, F.lit(1)))
    if stat.fn == "count":
        return F.nullif(rows, F.lit(0).cast("bigint"))
    value = F.when(where, F.col(stat.column))
    if stat.fn == "sum":
        return F.when(rows > 0, F.coalesce(F.sum(value), F.lit(0)))
    return {"mean": F.avg, "max": F.max, "min": F.min, "std": F.stddev_samp}[stat.fn](value)


def _one_pass(df: DataFrame, keys: Sequence[str], blocks: Sequence[Block]) -> DataFrame:
    return df.groupBy(*keys).agg(*[
        _plain(s, b.name(s)) if b.where is None else _guarded(s, b.where).alias(b.name(s))
        for b in blocks for s in b.stats
    ])


def _tagged(df: DataFrame, keys: Sequence[str], blocks: Sequence[Block]) -> DataFrame:
    wanted: dict[tuple[str, str | None], str] = {}
    for b in blocks:
        for s in b.stats:
            wanted.setdefault((s.fn, s.column), f"s{len(wanted)}")
    inputs = list(dict.fromkeys(c for _, c in wanted if c is not None and c not in keys))

    tags = [
        F.lit(i) if b.where is None else F.when(b.where, F.lit(i)) for i, b in enumerate(blocks)
    ]
    by_block = (
        df.select(*keys, *inputs, F.explode(F.array_compact(F.array(*tags))).alias(_TAG))
        .groupBy(*keys, _TAG)
        .agg(*[_plain(Stat("", fn, c), n) for (fn, c), n in wanted.items()])
    )
    return _by_key(by_block, keys, list(wanted.values()), len(blocks)).selectExpr(*map(quoted, keys), *[
        f"b{i}.{wanted[s.fn, s.column]} AS {quoted(b.name(s))}"
        for i, b in enumerate(blocks) for s in b.stats
    ])


def _by_key(by_tag: DataFrame, keys: Sequence[str], columns: Sequence[str], tags: int) -> DataFrame:
    """One row per key with the columns of tag ``i`` as struct ``b<i>``, NULL where the key lacks it.

    A key has one row per tag, so ``max`` picks that tag's struct. Rows meet by
    key before they are folded: folded first, every row would carry the places of all tags.
    """
    packed = by_tag.select(*keys, _TAG, F.struct(*columns).alias("_all")).repartition(*keys)
    return packed.groupBy(*keys).agg(*[
        F.expr(f"max(CASE WHEN {_TAG} = {i} THEN _all END) AS b{i}") for i in range(tags)])


def _parts(fn: str) -> tuple[str, ...]:
    """What a statistic is merged from: values, sum, second moment about the mean, extremes."""
    return {"mean": ("n", "s"), "sum": ("s",), "std": ("n", "s", "q"), "min": ("min",), "max": ("max",)}[fn]


_PART_SQL = {"n": "count({c})", "s": "sum({c})", "q": "var_pop({c}) * count({c})", "min": "min({c})", "max": "max({c})"}


def _total(names: Sequence[str]) -> str:
    return " + ".join(f"coalesce({n}, 0)" for n in names)


def _banded(df: DataFrame, keys: Sequence[str], blocks: Sequence[Block]) -> DataFrame:
    """A lifetime block and recency windows over one column, from one row per (key, band).

    A window's mean is its sum over its count. Its second moment is that of
    its bands plus what their means are apart, so nothing cancels.
    """
    windows = sorted((b for b in blocks if b.recent), key=lambda b: -b.recent.bound)
    bands = {id(b): range(i + 1) for i, b in enumerate(windows)} | {
        id(b): range(len(windows) + 1) for b in blocks if not b.recent}
    band = F.lit(len(windows))
    for i, b in reversed(list(enumerate(windows))):
        band = F.when(b.recent.rows(), F.lit(i)).otherwise(band)
    needed = list(dict.fromkeys((s.column, p) for b in blocks for s in b.stats if s.fn != "count" for p in _parts(s.fn)))
    number = {c: i for i, c in enumerate(dict.fromkeys(c for c, _ in needed))}
    part = {(c, p): f"c{number[c]}_{p}" for c, p in needed}
    by_band = df.select(*keys, *[c for c in number if c not in keys], band.alias(_TAG)).groupBy(*keys, _TAG).agg(
        F.expr("count(1) AS rows"), *[F.expr(f"{_PART_SQL[p].format(c=quoted(c))} AS {n}") for (c, p), n in part.items()])
    wide = _by_key(by_band, keys, ["rows", *part.values()], len(windows) + 1)

    def over(b: Block, f: str) -> list[str]:
        return [f"b{i}.{f}" for i in bands[id(b)]]

    means = {}  # (window, column) to the name of its mean, computed before the moments
    for k, b in enumerate(blocks):
        for s in b.stats:
            if s.fn in ("mean", "std"):
                n, total = (_total(over(b, part[s.column, p])) for p in ("n", "s"))
                means[k, s.column] = f"w{k}_c{number[s.column]}", f"CAST({total} AS DOUBLE) / nullif({n}, 0)"
    wide = wide.selectExpr("*", *[f"{e} AS {n}" for n, e in means.values()])

    def merged(k: int, b: Block, s: Stat) -> str:
        rows = _total(over(b, "rows"))
        if s.fn == "count":
            return f"nullif({rows}, 0)"
        if s.fn == "mean":
            return means[k, s.column][0]
        own = over(b, part[s.column, _parts(s.fn)[-1]])
        if s.fn == "sum":
            return f"CASE WHEN {rows} > 0 THEN {_total(own)} END"
        if s.fn in ("min", "max"):
            return own[0] if len(own) == 1 else f"{'least' if s.fn == 'min' else 'greatest'}({', '.join(own)})"
        counts, sums = over(b, part[s.column, "n"]), over(b, part[s.column, "s"])
        apart = " + ".join(f"coalesce({n} * pow({t} / nullif({n}, 0) - {means[k, s.column][0]}, 2), 0)" for n, t in zip(counts, sums))
        return f"sqrt(({_total(own)} + {apart}) / nullif(greatest({_total(counts)} - 1, 0), 0))"

    return wide.selectExpr(*map(quoted, keys), *[
        f"{merged(k, b, s)} AS {quoted(b.name(s))}" for k, b in enumerate(blocks) for s in b.stats])


def _nested(blocks: Sequence[Block]) -> bool:
    """Whether all blocks but the first are recency windows over one column."""
    return len({(b.recent.column, b.recent.inclusive) if b.recent else None for b in blocks[1:]} | {None}) == 2 and all(
        b.recent for b in blocks[1:])


def conditional_blocks(df: DataFrame, key: str | Sequence[str], blocks: Sequence[Block]) -> DataFrame:
    """Blocks with predicates only: a key appears when it has a row in any of them."""
    keys = [key] if isinstance(key, str) else list(key)
    return _tagged(df, keys, blocks)


def aggregate_blocks(
    df: DataFrame,
    key: str | Sequence[str],
    blocks: Sequence[Block],
    one_pass_limit: int = ONE_PASS_LIMIT,
) -> DataFrame:
    """All blocks of a spec, one row per key.

    The first block must be unconditional so that every key keeps its row.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if blocks[0].where is not None:
        raise ValueError("the first block of a spec must have no predicate")
    width = sum(len(b.stats) for b in blocks)
    if len(blocks) == 1 or width <= one_pass_limit:
        return _one_pass(df, keys, blocks)
    if _nested(blocks):
        return _banded(df, keys, blocks)
    shared = {(s.fn, s.column) for b in blocks[1:] for s in b.stats}
    if len(blocks[0].stats) > SPLIT_RATIO * len(shared):
        return _one_pass(df, keys, blocks[:1]).join(_tagged(df, keys, blocks[1:]), keys, "left")
    return _tagged(df, keys, blocks)


def distinct_counts(df: DataFrame, key: str, outputs: Mapping[str, str]) -> DataFrame:
    """Distinct values per key and column, NULL counting as one value.

    ``outputs`` maps output name to column. The (key, column, value) triples
    are de-duplicated with map-side combine before anything is counted.
    """
    triples = df.select(
        key,
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("which"), F.col(c).cast("string").alias("value"))
            for i, c in enumerate(outputs.values())
        ])).alias("t"),
    ).select(key, "t.which", "t.value").distinct()
    return triples.groupBy(key).agg(
        *[F.count_if(F.col("which") == i).alias(out) for i, out in enumerate(outputs)]
    )


def join_on_key(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Chain of left joins of per-key frames onto the first one.

    The columns of a frame travel as one struct, so that a join copies a few
    values a row and not every column of all frames before it.
    """
    packed = []
    for i, f in enumerate(frames):
        values = [F.col(quoted(c)) for c in f.columns if c != key]
        packed.append(f.select(key, F.struct(*values).alias(f"_f{i}")) if values else f)
    joined = reduce(lambda left, right: left.join(right, key, "left"), packed)
    return joined.select(key, *[f"{c}.*" for c in joined.columns if c != key])
