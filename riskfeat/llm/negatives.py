"""Hard negatives by exact integer scores of anchor and candidate tiles.

Vectors become integers, floor(256 * x), padded with zeros to one even length.
Strips of anchors meet strips of candidates, every pair of strips in one group.
Inside a group candidates come in tiles; a tile's scores are one matrix product,
computed by Strassen's recursion: seven products of half size instead of eight,
joined by int64 additions. Int64 wraps around and the additions are exact in
that ring, so a product is exact whenever the score itself fits.

Every group keeps per anchor a heap of its best positives; heaps of all groups
merge by rank. The windows that the positives open are then filled by a second
pass, with a heap per window. Nothing larger than a strip of anchors, a tile of
candidates and the heaps is held at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeat.session import cut_lineage

SCALE = 256
EVERY = 50  # anchors: rows whose id this divides
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # a negative's score, in hundredths of the positive's
TILE = 1024
LEAF = 32  # sides up to this are multiplied directly
STRIP_BYTES = 32 << 20  # of one strip of anchors
STRIP_WORK = 1 << 28  # multiplications of one group, at least
LARGEST = 2**63 - 1
EXACT_FLOAT = 2**53
SAFE = 2.0**62  # rows of a squared length below this have scores that fit


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b for int64 matrices, by halves with seven products; odd sides are padded with zeros."""
    (n, k), m = a.shape, b.shape[1]
    if min(n, k, m) <= LEAF:
        return _product(a, b)
    even = lambda x: np.pad(x, [(0, s % 2) for s in x.shape]) if any(s % 2 for s in x.shape) else x
    a, b = even(a), even(b)
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * i, 2 * l), np.int64)
    out[:i, :l] = p1 + p4 - p5 + p7
    out[:i, l:] = p3 + p5
    out[i:, :l] = p2 + p4
    out[i:, l:] = p1 - p2 + p3 + p6
    return out[:n, :m]


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of a leaf; floats are as exact as integers while every sum stays below 2^53."""
    if a.size and b.size:
        top = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
        if 0 <= top < EXACT_FLOAT:
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


class Rows:
    """Integer vectors of one width, with the few whose scores may not fit kept as Python integers."""

    def __init__(self, vectors: list[np.ndarray], width: int) -> None:
        x = np.zeros((len(vectors), width))
        for k, v in enumerate(vectors):
            x[k, :len(v)] = np.floor(np.asarray(v, np.float64) * SCALE)
        self.large = np.flatnonzero(np.einsum("ij,ij->i", x, x) >= SAFE)
        self.exact = {int(k): [int(y) for y in x[k]] for k in self.large}
        x[self.large] = 0
        self.ints = x.astype(np.int64)

    def integers(self, k: int) -> list[int]:
        return self.exact.get(k) or self.ints[k].tolist()


def scores(anchors: Rows, tile: Rows) -> np.ndarray:
    """All inner products; one that does not fit int64 is its largest or smallest value."""
    s = strassen(anchors.ints, np.ascontiguousarray(tile.ints.T))
    whole = lambda i, j: max(-LARGEST, min(LARGEST, sum(
        x * y for x, y in zip(anchors.integers(i), tile.integers(j)))))
    for i in anchors.large:
        s[i] = [whole(int(i), j) for j in range(s.shape[1])]
    for j in tile.large:
        s[:, j] = [whole(i, int(j)) for i in range(s.shape[0])]
    return s


class Heaps:
    """The best ``k`` candidates of each row: score falling, then the order in which they came."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.score = np.zeros((n, k), np.int64)
        self.id = np.zeros((n, k), np.int64)
        self.known = np.zeros((n, k), bool)  # whether the candidate has an id
        self.size = np.zeros(n, np.int64)

    def open(self, s: np.ndarray) -> np.ndarray:
        """Which scores may enter: an equal score that comes later does not."""
        full = self.size == self.k
        return (s > self.score[:, -1][:, None]) | ~full[:, None]

    def push(self, rows: np.ndarray, s: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        hit = np.unique(rows)
        held = np.arange(self.k)[None, :] < self.size[hit][:, None]
        r = np.concatenate([np.repeat(hit, self.k)[held.ravel()], rows])
        s = np.concatenate([self.score[hit][held], s])
        ids, known = np.concatenate([self.id[hit][held], ids]), np.concatenate([self.known[hit][held], known])
        order = np.lexsort((np.arange(len(r)), -s, r))
        r, s, ids, known = r[order], s[order], ids[order], known[order]
        start = np.searchsorted(r, r)
        rank = np.arange(len(r)) - start
        keep = rank < self.k
        r, rank = r[keep], rank[keep]
        self.score[r, rank], self.id[r, rank], self.known[r, rank] = s[keep], ids[keep], known[keep]
        np.maximum.at(self.size, r, rank + 1)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        return np.nonzero(np.arange(self.k)[None, :] < self.size[:, None])


def _take(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _vectors(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.asarray(v.values) for v in batch.column("embedding")]


class _Block:
    """Up to ``TILE`` anchors with their heaps."""

    def __init__(self, batch: pa.RecordBatch, width: int, windows: bool) -> None:
        self.width, self.vectors = width, Rows(_vectors(batch), width)
        self.node, self.label = _take(batch, "node"), _take(batch, "label")
        n = len(self.node)
        if not windows:
            self.heaps = [Heaps(n, POSITIVES)]
            return
        self.heaps = [Heaps(n, NEGATIVES) for _ in range(POSITIVES)]
        self.low, self.high = np.ones((POSITIVES, n), np.int64), np.zeros((POSITIVES, n), np.int64)
        for i, own in enumerate(batch.column("windows").to_pylist()):
            for k, score in enumerate(own or []):
                self.low[k, i] = max(-LARGEST, -(-LOW * score // 100))
                self.high[k, i] = min(LARGEST, HIGH * score // 100)

    def meet(self, tile: Rows, batch: pa.RecordBatch) -> None:
        s = scores(self.vectors, tile)
        ids, known = batch.column("vec_id").fill_null(0).to_numpy(), ~_take(batch, "no_id").astype(bool)
        same = self.label[:, None] == _take(batch, "label")[None, :]
        if len(self.heaps) == 1:
            self._enter(self.heaps[0], s, same & (self.node[:, None] != _take(batch, "node")[None, :]), ids, known)
            return
        for k, heap in enumerate(self.heaps):
            inside = (s >= self.low[k][:, None]) & (s <= self.high[k][:, None])
            self._enter(heap, s, inside & ~same, ids, known)

    @staticmethod
    def _enter(heap: Heaps, s: np.ndarray, may: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        rows, columns = np.nonzero(may & heap.open(s))
        if len(rows):
            heap.push(rows, s[rows, columns], ids[columns], known[columns])

    def out(self) -> Iterator[pa.RecordBatch]:
        for k, heap in enumerate(self.heaps):
            rows, at = heap.entries()
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(self.node[rows]), pa.array(np.full(len(rows), k, np.int32)),
                     pa.array(heap.id[rows, at], mask=~heap.known[rows, at]), pa.array(heap.score[rows, at])],
                    names=["node", "k", "other", "score"])


def _matched(width: int, windows: bool):
    """Function over sorted rows: a group's anchors come first, its candidates follow by id."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blocks = None, []
        for batch in batches:
            keys = np.stack([_take(batch, "strip"), _take(batch, "side")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, stop in zip(np.r_[0, cuts], np.r_[cuts, len(keys)]):
                strip, side = keys[start]
                if strip != current:
                    for block in blocks:
                        yield from block.out()
                    current, blocks = strip, []
                for at in range(start, stop, TILE):
                    part = batch.slice(int(at), int(min(TILE, stop - at)))
                    if side == 0:
                        blocks.append(_Block(part, width, windows))
                        continue
                    tile = Rows(_vectors(part), width)
                    for block in blocks:
                        block.meet(tile, part)
        for block in blocks:
            yield from block.out()
    return run


def _strips(anchors: DataFrame, candidates: DataFrame, across: int, along: int) -> DataFrame:
    """Rows of both sides in each of the ``across`` x ``along`` pairs of strips they belong to."""
    def piece(n: int) -> Column:
        return F.pmod(F.xxhash64("node"), F.lit(n))

    def all_of(n: int) -> Column:
        return F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))

    one = anchors.withColumns({"side": F.lit(0), "strip": F.explode(F.transform(
        all_of(along), lambda j: piece(across) * along + j))})
    other = candidates.withColumns({"side": F.lit(1), "strip": F.explode(F.transform(
        all_of(across), lambda i: i * along + piece(along)))})
    both = one.unionByName(other, allowMissingColumns=True)
    return both.repartition(across * along, "strip").sortWithinPartitions("strip", "side", "no_id", "vec_id", "node")


def taking_part(rows: DataFrame) -> DataFrame:
    """(node, vec_id, no_id, label, embedding) of the rows with a label and a vector of finite components."""
    v = F.col("embedding")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    held = rows.where(F.col("label").isNotNull() & F.coalesce(sound, F.lit(False))).select(
        "vec_id", F.col("vec_id").isNull().alias("no_id"), label.cast("bigint").alias("label"), "embedding")
    # numbered after it is written, so that a lost executor cannot number it anew
    return cut_lineage(held).withColumn("node", F.monotonically_increasing_id())


def _best(found: DataFrame, keys: list[str], most: int, name: str) -> DataFrame:
    """Heaps of all groups merged: the first ``most`` of each key, numbered from 1; partly merged before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("other").asc_nulls_last())
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= most)


def hard_negatives(rows: DataFrame, every: int = EVERY) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from (vec_id, embedding, label).

    Anchors are the rows whose vec_id ``every`` divides. Rows with a NULL label,
    vector or component, or one that is not finite, take no part. A row without
    a vec_id can be found, as NULL and after equal scores with one, but is no
    anchor. Repeated rows are rows of their own: copies of an anchor are its
    positives, and each copy that is an anchor gets its own result. Vectors of
    different lengths, empty ones too, are compared as if zeros followed the
    shorter. Scores beyond int64 count as its largest or smallest value. An
    empty table, or one without anchors, gives no rows; other columns are not
    looked at.
    """
    held = taking_part(rows)
    anchor = F.col("vec_id") % every == 0
    seen = held.agg(F.count("*").alias("rows"), F.sum(anchor.cast("int")).alias("anchors"),
                    F.max(F.size("embedding")).alias("width")).first()
    width, n_anchors = max(seen["width"] or 1, 1), seen["anchors"] or 0
    strip = max(TILE, STRIP_BYTES // (8 * width))  # anchors of one group
    across = max(1, -(-n_anchors // strip))
    each = max(TILE, min(strip, n_anchors), STRIP_WORK // (width * max(1, min(strip, n_anchors))))
    along = max(1, -(-seen["rows"] // each))  # as many candidates as anchors a group, or enough work for it

    anchors = held.where(anchor)
    schema = "node bigint, k int, other bigint, score bigint"
    found = _strips(anchors, held, across, along).mapInArrow(_matched(width, False), schema)
    positives = cut_lineage(_best(found, ["node"], POSITIVES, "k").select(
        "node", (F.col("k") - 1).alias("k"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score")))
    windows = positives.groupBy(F.col("node").alias("_node")).agg(F.transform(F.sort_array(F.collect_list(
        F.struct("k", "positive_score"))), lambda w: w["positive_score"]).alias("windows"))
    asking = anchors.join(windows, anchors["node"] == windows["_node"]).drop("_node")
    found = _strips(asking, held, across, along).mapInArrow(_matched(width, True), schema)
    negatives = _best(found, ["node", "k"], NEGATIVES, "rank").select(
        F.col("node").alias("_node"), F.col("k").alias("_k"), "rank", F.col("other").alias("negative_id"),
        F.col("score").alias("negative_score"))
    named = anchors.select(F.col("node").alias("_anchor"), F.col("vec_id").alias("anchor_id"))
    both = positives.join(negatives, (positives["node"] == negatives["_node"]) & (positives["k"] == negatives["_k"]))
    return both.join(named, both["node"] == named["_anchor"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = f"""
WITH held AS (
  SELECT row_number() OVER () AS node, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.node, a.vec_id AS anchor_id, b.node AS other, b.vec_id, a.label = b.label AS same, coalesce(list_sum(
    list_transform(list_zip(a.v, b.v, true), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM held a JOIN held b ON a.vec_id % {EVERY} = 0 AND a.node <> b.node),
positives AS (
  SELECT node, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (
    PARTITION BY node ORDER BY score DESC, vec_id NULLS LAST) AS k
  FROM scored WHERE same QUALIFY k <= {POSITIVES}),
ranked AS (
  SELECT p.anchor_id, p.positive_id, (row_number() OVER (
    PARTITION BY p.node, p.k ORDER BY s.score DESC, s.vec_id NULLS LAST))::INTEGER AS rank,
    s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM positives p JOIN scored s ON s.node = p.node AND NOT s.same
    AND {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score)
SELECT * FROM ranked WHERE rank <= {NEGATIVES}"""
