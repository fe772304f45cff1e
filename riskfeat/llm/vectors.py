"""Near-duplicate embeddings by randomised-rotation binary codes.

A vector is rotated at random and each coordinate kept as its sign. With the
sign vector b / sqrt(D) and the stored factor f = <b / sqrt(D), rotated x>, the
inner product of x and y is estimated without bias by
<b / sqrt(D), rotated y> / f, off by at most CONFIDENCE * sqrt((1 - f^2) / f^2)
/ sqrt(D - 1) with near certainty. Only pairs whose upper bound reaches the
threshold are computed exactly, in double precision, and only those that reach
it there are linked.

Pairs are met in ``TABLES`` hash tables, each over 16 sign bits of further
rotations. At cosine 0.98 two signs agree with chance 0.936, so a pair is missed
by all tables with chance (1 - 0.936^16)^20 = 0.0002; closer pairs far less.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructType

from riskfeat.llm.common import TILE, Forest, components, pair_slabs, paired, whole_groups
from riskfeat.operators.lookup import attach
from riskfeat.session import cut_lineage

THRESHOLD = 0.98
TABLES = 20
CONFIDENCE = 4.0
SEED = 42


@cache
def rotation(size: int, number: int) -> np.ndarray:
    """The ``number``-th random orthogonal matrix of this size; the same everywhere."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, size, number]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows over their lengths; scaled first, so that no finite row overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _signs(x: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` signs of unit rows, from as many rotations after the first as that takes."""
    size = x.shape[1]
    turns = [x @ rotation(size, 1 + k) for k in range(-(-bits // size))]
    return np.packbits(np.concatenate(turns, axis=1)[:, :bits] > 0, axis=1, bitorder="little")


_CODED = StructType().add("signs", BinaryType()).add("code", BinaryType()).add("factor", DoubleType())


@F.arrow_udf(_CODED)
def _codes(vectors: pa.Array) -> pa.Array:
    """Table bits, binary code and correction factor of each (valid) vector."""
    rows: list[tuple] = [()] * len(vectors)
    sizes = np.array([len(v) for v in vectors], dtype=np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        x = unit(np.array([vectors[int(i)].as_py() for i in at], dtype=np.float64))
        turned = x @ rotation(int(size), 0)
        signs, code = _signs(x, 16 * TABLES), np.packbits(turned > 0, axis=1, bitorder="little")
        factor = np.abs(turned).sum(axis=1) / np.sqrt(size)
        for k, i in enumerate(at):
            rows[i] = signs[k].tobytes(), code[k].tobytes(), float(factor[k])
    return pa.StructArray.from_arrays(
        [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()),
         pa.array([r[2] for r in rows], pa.float64())], ["signs", "code", "factor"])


def _stack(table: pa.Table, name: str) -> list[np.ndarray]:
    return [np.asarray(v.values) for v in table.column(name)]


def _linked(x: np.ndarray, code: np.ndarray, factor: np.ndarray, i: np.ndarray, j: np.ndarray,
            turned: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) reach the threshold; exact only where the estimate leaves it open."""
    size = x.shape[1]
    guess = np.einsum("ij,ij->i", code[i], turned[j]) / (np.sqrt(size) * factor[i])
    spread = np.sqrt(np.maximum(1 - factor[i] ** 2, 0)) / factor[i]
    bound = guess + CONFIDENCE * spread / np.sqrt(max(size - 1, 1))
    open_ = np.flatnonzero(bound >= THRESHOLD)
    result = np.zeros(len(i), bool)
    a, b = x[i[open_]], x[j[open_]]
    result[open_] = np.einsum("ij,ij->i", a, b) >= THRESHOLD
    return result


def _pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root, links): for every linked row of a tile its class's least node and how many it links."""
    for table in whole_groups(batches, ["bucket", "tile"]):
        label = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        vectors = _stack(table, "embedding")
        columns = {c: table.column(c).to_numpy(zero_copy_only=False) for c in (
            "bucket", "tile", "number", "_piece", "_same", "node", "copies", "factor")}
        sizes = np.array([len(v) for v in vectors])
        signs, codes = table.column("signs").to_pylist(), table.column("code").to_pylist()
        for size in np.unique(sizes):
            keep = np.flatnonzero(sizes == size)
            c = {k: v[keep] for k, v in columns.items()}
            order = np.lexsort((c["node"], c["_piece"], c["number"], label[keep], c["tile"], c["bucket"]))
            keep, c = keep[order], {k: v[order] for k, v in c.items()}
            x = unit(np.stack([vectors[k] for k in keep]).astype(np.float64))
            bits = np.frombuffer(b"".join([signs[k] for k in keep]), "<u2").reshape(len(keep), TABLES)
            code = np.unpackbits(np.frombuffer(b"".join([codes[k] for k in keep]), np.uint8).reshape(len(keep), -1),
                                 axis=1, count=int(size), bitorder="little") * 2.0 - 1
            turned = x @ rotation(int(size), 0)
            changes = np.zeros(len(keep), bool)
            changes[0] = True
            for k in ("bucket", "tile", "number"):
                changes[1:] |= c[k][1:] != c[k][:-1]
            changes[1:] |= label[keep][1:] != label[keep][:-1]
            fresh = np.flatnonzero(changes)
            length = np.diff(np.r_[fresh, len(keep)])
            end = np.repeat(fresh + length, length)
            other = changes.copy()
            other[1:] |= c["_piece"][1:] != c["_piece"][:-1]
            own = np.flatnonzero(other)
            piece_end = np.repeat(own + np.diff(np.r_[own, len(keep)]), np.diff(np.r_[own, len(keep)]))
            place = np.arange(len(keep))
            start, stop = np.where(c["_same"], place + 1, piece_end), np.where(c["_same"], piece_end, end)
            links, forest, found = np.zeros(len(keep), np.int64), Forest(len(keep)), False
            for i, j in pair_slabs(start, stop, 1 << 18):
                near = _linked(x, code, c["factor"], i, j, turned)
                i, j = i[near], j[near]
                first = np.argmax(bits[i] == bits[j], axis=1) == c["number"][i]
                i, j = i[first], j[first]  # each pair counts in its first common table alone
                if len(i):
                    found = True
                    np.add.at(links, i, c["copies"][j])
                    np.add.at(links, j, c["copies"][i])
                    forest.link(i, j)
            if found:
                hit = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c["node"][hit]), pa.array(c["node"][forest.root[hit]]), pa.array(links[hit])],
                    names=["node", "root", "links"])


def valid(vector: str = "embedding", label: str = "label") -> F.Column:
    """Whether a row can link: it has a label, finite components throughout and a length above zero."""
    v = F.col(vector).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(label).isNotNull() & sound & F.exists(v, lambda x: x != 0), F.lit(False))


def near_duplicates(rows: DataFrame, limit: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``rows`` (vec_id, embedding, label).

    Rows link only within a label and a number of components. Equal vectors of
    a label are one class, compared once however many there are; n_links
    counts rows. Rows that ``valid`` leaves out have no links and are their own
    component. component_id is the smallest vec_id reachable, NULL where no row
    of the component has one; kept tells whether it is the row's own. An empty
    table gives no rows; other columns of ``rows`` are not looked at.
    """
    keyed = rows.select("vec_id", "embedding", "label", valid().alias("_valid")).withColumns({
        "h1": F.when(F.col("_valid"), F.xxhash64("label", "embedding")),
        "h2": F.when(F.col("_valid"), F.xxhash64(F.lit("v"), "label", "embedding"))})
    classes = keyed.where("_valid").groupBy("h1", "h2", "label", "embedding").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    classes = cut_lineage(classes.withColumn("c", _codes("embedding")).select(
        "h1", "h2", "label", "embedding", "least", "copies", "c.*")).withColumn(
        "node", F.monotonically_increasing_id())  # of written rows: the same each time

    met = classes.select("node", "copies", "label", "embedding", "signs", "code", "factor", F.posexplode(
        F.transform(F.sequence(F.lit(0), F.lit(TABLES - 1)), lambda t: F.substring("signs", t * 2 + 1, 2))
    ).alias("number", "bits"))
    bucket = F.xxhash64("label", F.size("embedding"), "number", "bits")
    met = met.withColumn("bucket", bucket).drop("bits")
    sizes = met.groupBy("bucket").agg(F.count("*").alias("n"))
    tiles = paired(met, "bucket", sizes, F.col("node"), limit)
    found = cut_lineage(tiles.repartition("bucket", "tile").sortWithinPartitions("bucket", "tile").mapInArrow(
        _pairs, "node bigint, root bigint, links bigint"))

    counts = found.groupBy("node").agg(F.sum("links").alias("links")).withColumnRenamed("node", "_node")
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).select(
        F.col("node").alias("_of"), "root")
    known = classes.select("h1", "h2", "node", "least", "copies")
    known = known.join(counts, known["node"] == counts["_node"], "left")
    known = known.join(roots, known["node"] == roots["_of"], "left").select(
        "h1", "h2", "least", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("root"))
    known = cut_lineage(known)
    named = cut_lineage(known.groupBy("root").agg(
        F.min("least").alias("component"), F.count("*").alias("members")))
    known = cut_lineage(attach(known, named, "root", weight="members", max_rows=0).select(
        "h1", "h2", "copies", "n_links", "component"))
    # rows without a class have NULL keys, which attach scatters like those of the largest classes
    keys = keyed.select("vec_id", "h1", "h2", "_valid")
    joined = attach(keys, known, ["h1", "h2"], weight="copies", max_rows=0)
    component = F.when(F.col("_valid"), F.col("component")).otherwise(F.col("vec_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                         component.alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
