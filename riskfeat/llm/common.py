"""What several text operators share: running totals, bucket tiles, components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeat.operators.lookup import attach
from riskfeat.session import cut_lineage

WORDS = r"[^\x20\x09-\x0D]+"
GAPS = r"[\x20\x09-\x0D]+"
TILE = 4096


def words_of(text: str | Column) -> Column:
    """Array of the runs of characters other than ASCII white space; NULL text has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAPS), "")


def whole_texts(docs: DataFrame, rows: int = 500) -> DataFrame:
    """``docs``, with the session set to send ``rows`` at a time to Python.

    Texts may be long: a worker holds one batch of them and of its results.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    return docs


def spare(name: str, taken: Iterable[str]) -> str:
    """``name``, with underscores in front until no column of ``taken`` has it."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def running_total(
    rows: DataFrame, within: Sequence[str], bucket: str, order: Sequence[str], value: str, name: str
) -> DataFrame:
    """``rows`` with the running sum of ``value`` along ``order`` inside each ``within`` group.

    ``bucket`` cuts the order into consecutive stretches: a row of a lower
    bucket comes first. Sums run inside one stretch of one group; the totals of
    the stretches before it are added, so no group has to fit into one task.
    """
    keys = [*within, bucket]
    before = Window.partitionBy(*within).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys).agg(F.sum(value).alias("_sum")).select(
        *[F.col(k).alias(f"_of_{k}") for k in keys],
        F.coalesce(F.sum("_sum").over(before if within else Window.orderBy(bucket).rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn(name, F.sum(value).over(inside))
    match = F.lit(True)
    for k in keys:
        match = match & local[k].eqNullSafe(totals[f"_of_{k}"])
    joined = local.join(totals, match, "left")
    return joined.select(*rows.columns, (F.col(name) + F.col("_before")).alias(name))


def stretched(rows: DataFrame, order: Sequence[str], name: str = "_stretch") -> DataFrame:
    """``rows`` range-sorted over the partitions; ``name`` numbers the partitions in order.

    The result is written, because the bounds of the ranges are sampled: what
    reads it twice has to see the same numbers.
    """
    return cut_lineage(rows.repartitionByRange(*order).withColumn(name, F.spark_partition_id()))


# ---------------------------------------------------------------- bucket tiles


def tiled(rows: DataFrame, key: str, sizes: DataFrame, member: Column, limit: int = TILE) -> DataFrame:
    """``rows`` with a ``tile`` column, sent to every tile of its ``key`` that needs it.

    ``sizes`` holds (key, n). Keys of up to ``limit`` members are one tile. A
    larger key is cut into p pieces by the hash of ``member`` and gets the
    tiles (i, j) of the p x p square: every row goes to all (*, j) of its piece,
    ``_row`` rows to all (i, *) as well. So a ``_row`` row meets every other.
    """
    hot = sizes.where(F.col("n") > limit).select(
        key, F.ceil(F.col("n") / limit).cast("int").alias("_pieces"))
    known = attach(rows, hot, key)
    piece = F.pmod(F.xxhash64(member), F.col("_pieces")).cast("int")
    others = F.sequence(F.lit(0), F.col("_pieces") - 1)
    tiles = F.when(F.col("_pieces").isNull(), F.array(F.lit(0))).when(
        F.col("_row"), F.array_union(F.transform(others, lambda j: piece * F.col("_pieces") + j),
                                     F.transform(others, lambda i: i * F.col("_pieces") + piece))
    ).otherwise(F.transform(others, lambda i: i * F.col("_pieces") + piece))
    return known.withColumn("tile", F.explode(tiles)).drop("_pieces")


def paired(rows: DataFrame, key: str, sizes: DataFrame, member: Column, limit: int = TILE) -> DataFrame:
    """Like ``tiled`` for pairs among equals: columns tile, _piece and _same are added.

    A key of p pieces gets the tiles (i, j) with i <= j. Two rows of different
    pieces meet only where their pieces cross, two rows of one piece are to be
    paired only where ``_same`` holds.
    """
    hot = sizes.where(F.col("n") > limit).select(
        key, F.ceil(F.col("n") / limit).cast("int").alias("_pieces"))
    known = attach(rows, hot, key).withColumn("_piece", F.coalesce(
        F.pmod(F.xxhash64(member), F.col("_pieces")).cast("int"), F.lit(0)))
    pieces, own = F.coalesce("_pieces", F.lit(1)), F.col("_piece")
    tiles = F.transform(F.sequence(F.lit(0), pieces - 1), lambda j: F.struct(
        (F.least(own, j) * pieces + F.greatest(own, j)).alias("tile"), (own == j).alias("_same")))
    spread = known.withColumn("_tile", F.explode(tiles))
    return spread.select(*rows.columns, "_piece", "_tile.tile", "_tile._same")


def whole_groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Sorted batches cut anew so that no group of ``keys`` is spread over two tables."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cut = n
        last = [batch.column(k)[n - 1] for k in keys]
        same = np.ones(n, bool)
        for k, v in zip(keys, last):
            same &= np.asarray(batch.column(k)) == v.as_py()
        cut = int(n - same.sum())  # sorted: the last group is the tail
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
            continue
        if held and any(held[0].column(k)[0] != v for k, v in zip(keys, last)):
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def pair_slabs(start: np.ndarray, stop: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) for every row i and all j of start[i]..stop[i], a bounded number at a time."""
    count = np.maximum(stop - start, 0)
    ends = np.cumsum(count)
    i = 0
    while i < len(count):
        base = ends[i - 1] if i else 0
        k = max(i + 1, int(np.searchsorted(ends, base + most, side="right")))
        n = count[i:k]
        total = int(n.sum())
        if total:
            left = np.repeat(np.arange(i, k), n)
            shift = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
            yield left, np.repeat(start[i:k], n) + shift
        i = k


class Forest:
    """Union of links seen so far over positions 0..n-1; gives one star per class."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            x, y = root[a], root[b]
            open_ = x != y
            if not open_.any():
                return
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            low, high = np.minimum(x, y), np.maximum(x, y)
            np.minimum.at(root, high, low)
            while True:  # flatten
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up
            self.root = root

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        node = np.flatnonzero(self.root != np.arange(len(self.root)))
        return node, self.root[node]


# ------------------------------------------------------------------ components


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("_m"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b): root is its component's least node.

    Large-star and small-star rounds: every node passes its least neighbour on
    to the others, until only stars are left. Each round is aggregations with
    map-side combine and joins on written, deduplicated links; the number of
    rounds grows with the logarithm of the longest path.
    """
    edges = cut_lineage(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _least_neighbour(both).select(
            F.col("a").alias("u"), F.least("a", "_m").alias("m"))
        # large star: neighbours above u go to u's least neighbour
        large = edges.join(low, edges["b"] == low["u"]).select(
            edges["a"].alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: u and its lower neighbours go to the least of them
        least = _least_neighbour(large).withColumnRenamed("a", "u")
        small = large.join(least, large["a"] == least["u"]).select(
            F.when(F.col("b") == F.col("_m"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.col("_m").alias("b"))
        small = small.union(least.select(F.col("u").alias("a"), F.col("_m").alias("b")))
        edges = cut_lineage(small.where("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
