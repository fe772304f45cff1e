"""Near-duplicates by SimHash, found through covering codes.

A document's fingerprint is the majority of the XXH64 hashes of its word
shingles. Two fingerprints link at ``THRESHOLD`` or fewer differing bits.

Candidates come from anchor points. The 64 bits are cut into three blocks; two
fingerprints within 4 bits differ by at most 1 bit in one of them. Each block
has a covering code: the words of the [15, 11] Hamming code on its first 15
bits, every value on the rest. The code's covering radius is 1, so each block
value has a home anchor within 1 bit, and an anchor that is the home of one
fingerprint lies within 1 + 1 bits of every fingerprint that differs from it
by 1 bit there. So a fingerprint is sent to all anchors within 2 bits of its
three block values - about 42 - and compared there with those that live there.
No link is missed, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from riskfeat.llm.common import TILE, Forest, components, pair_slabs, spare, tiled, whole_groups, whole_texts
from riskfeat.operators.lookup import attach
from riskfeat.session import cut_lineage

SHINGLE = 4
SEED = 42
THRESHOLD = 4
BLOCKS = ((0, 22), (22, 21), (43, 21))  # first bit, bits
CODED = 15
_SLAB = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of one UTF-8 text: A-Z lowered, split at ASCII white space.

    Texts with fewer words than ``shingle`` have the whole sequence as their
    only shingle; texts without a word, and None, have fingerprint zero.
    """
    words = text.lower().split() if text else []
    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    stops = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate(([0], stops[:-1]))[: n - shingle + 1].tolist()
    ends = (stops[shingle - 1:] - 1).tolist()
    h, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(starts), _SLAB):
        part = np.array([h(line[a:b], SEED) for a, b in
                         zip(starts[k:k + _SLAB], ends[k:k + _SLAB])], dtype="<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


@F.arrow_udf(LongType())
def _fingerprints(text: pa.Array) -> pa.Array:
    values = text.cast(pa.large_binary())
    return pa.array(np.array([fingerprint(v.as_py()) for v in values], np.uint64).view(np.int64))


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed long in ``name``."""
    return whole_texts(docs).withColumn(name, _fingerprints(F.col(text)))


# --------------------------------------------------------------------- anchors


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Position 1..15 of the bit that is off from the nearest code word; 0 on a code word."""
    s = np.zeros(words.shape, np.int64)
    for p in range(1, CODED + 1):
        s ^= np.where((words >> (p - 1)) & 1, p, 0)
    return s


def _flip(position: np.ndarray) -> np.ndarray:
    return np.where(position > 0, np.int64(1) << np.maximum(position - 1, 0), 0)


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into fps, anchor, is home) of every anchor that each fingerprint is sent to."""
    fps = fps.astype(np.uint64)
    own = np.arange(len(fps))
    index, anchor, home = [], [], []

    def put(block: int, who: np.ndarray, value: np.ndarray, at_home: bool) -> None:
        index.append(who)
        anchor.append((np.int64(block) << 32) | value)
        home.append(np.full(len(who), at_home))

    for block, (first, bits) in enumerate(BLOCKS):
        value = ((fps >> np.uint64(first)) & np.uint64((1 << bits) - 1)).astype(np.int64)
        s = _syndrome(value)
        near = value ^ _flip(s)
        put(block, own, near, True)
        for k in range(CODED, bits):  # the one differing bit is not under the Hamming code
            put(block, own, near ^ (np.int64(1) << k), False)
        off = np.flatnonzero(s)  # code words at two bits: both positions xor to the syndrome
        for p in range(1, CODED + 1):
            q = s[off] ^ p
            good = (q > p) & (q <= CODED)
            who = off[good]
            put(block, who, value[who] ^ (np.int64(1) << (p - 1)) ^ _flip(q[good]), False)
    return np.concatenate(index), np.concatenate(anchor), np.concatenate(home)


def _sent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = np.asarray(batch.column("fp")).view(np.uint64)
        i, a, h = anchors(fps)
        yield pa.RecordBatch.from_arrays(
            [pa.array(fps[i].view(np.int64)), pa.array(a), pa.array(h)], names=["fp", "anchor", "_row"])


def _homes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _sent(batches):
        yield batch.filter(batch.column("_row")).select(["anchor"])


def _links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stars over the classes that the links inside each (anchor, tile) make."""
    for table in whole_groups(batches, ["anchor", "tile"]):
        fp = table.column("fp").to_numpy().view(np.uint64)
        home = table.column("_row").to_numpy(zero_copy_only=False)
        anchor, tile = table.column("anchor").to_numpy(), table.column("tile").to_numpy()
        order = np.lexsort((fp, ~home, tile, anchor))
        fp, home, anchor, tile = fp[order], home[order], anchor[order], tile[order]
        fresh = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (tile[1:] != tile[:-1])])
        size = np.diff(np.r_[fresh, len(fp)])
        homes = np.add.reduceat(home.astype(np.int64), fresh)
        start, stop = np.repeat(fresh, size), np.repeat(fresh + homes, size)
        forest = Forest(len(fp))
        found = False
        for i, j in pair_slabs(start, stop):
            near = np.bitwise_count(fp[i] ^ fp[j]) <= THRESHOLD
            near &= fp[i] != fp[j]
            if near.any():
                found = True
                forest.link(i[near], j[near])
        if found:
            node, root = forest.stars()
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp[node].view(np.int64)), pa.array(fp[root].view(np.int64))], names=["a", "b"])


def near_links(fps: DataFrame, limit: int = TILE) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints which are connected at ``THRESHOLD``.

    ``fps`` holds each fingerprint once in ``fp``. Within an anchor's tile
    classes come back as stars: never more rows than members.
    """
    sent = fps.select("fp").mapInArrow(_sent, "fp bigint, anchor bigint, _row boolean")
    sizes = fps.select("fp").mapInArrow(_homes, "anchor bigint").groupBy("anchor").agg(
        F.count("*").alias("n"))
    rows = tiled(sent, "anchor", sizes, F.col("fp"), limit)
    return rows.repartition("anchor", "tile").sortWithinPartitions("anchor", "tile").mapInArrow(
        _links, "a bigint, b bigint").where("a <> b")


def near_duplicates(docs: DataFrame, carry: tuple[str, ...] = (), limit: int = TILE) -> DataFrame:
    """(doc_id, fp, component_id, root, *carry) for every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links reach, itself included; root
    is the least fingerprint they reach. Texts without words and NULL texts
    share fingerprint zero and link like others. Repeated rows come back
    repeated; NULL doc_ids are linked, and component_id is NULL only where no
    row of the group has one. An empty table gives no rows; columns of ``docs``
    other than ``carry`` are not looked at.

    Equal fingerprints are one node, so a group of copies costs one row after
    map-side combine however large it is. Names go back to fingerprints, and
    then to rows, with the largest classes broadcast and their rows scattered.
    """
    marked = cut_lineage(with_fingerprint(docs.select("doc_id", "text", *carry)).select(
        "doc_id", "fp", *carry))
    nodes = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("_copies")))
    classes = components(near_links(nodes, limit))
    rooted = cut_lineage(nodes.join(classes, nodes["fp"] == classes["node"], "left").select(
        "fp", "least", "_copies", F.coalesce("root", "fp").alias("root")))
    named = cut_lineage(rooted.groupBy("root").agg(
        F.min("least").alias("component_id"), F.count("*").alias("_members")))
    by_fp = cut_lineage(attach(rooted, named, "root", weight="_members", max_rows=0).select(
        "fp", "_copies", "component_id", "root"))
    return attach(marked, by_fp, "fp", weight="_copies", max_rows=0).select(
        "doc_id", "fp", "component_id", "root", *carry)


def first_of_group(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each near-duplicate group, the one with the smallest doc_id.

    Rows without a doc_id come last; between rows of one doc_id the text with
    the smaller hash stays, and of equal rows one.
    """
    key = spare("text_key", docs.columns)
    rows = docs.withColumn(key, F.xxhash64("text"))
    classes = near_duplicates(rows.select("doc_id", "text", F.col(key).alias("_key")), ("_key",))
    best = classes.groupBy("root", "doc_id", "_key").agg(F.count("*").alias("n")).groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_key", "n")).alias("best"))
    best = cut_lineage(best.select(
        F.col("best.doc_id").alias("_id"), F.col("best._key").alias("_key"), F.col("best.n").alias("_n")))

    def chosen(of: DataFrame) -> DataFrame:
        return rows.join(of, rows["doc_id"].eqNullSafe(of["_id"]) & (rows[key] == of["_key"]), "left_semi")

    single = chosen(best.where("_n = 1")).select(*docs.columns)
    if best.where("_n > 1").isEmpty():
        return single
    return single.union(chosen(best.where("_n > 1")).dropDuplicates(["doc_id", key]).select(*docs.columns))
