"""Merkle manifest of a table, with a proof for every row by pointer jumping.

A row's leaf is the digest of its columns. Inside a group leaves are ordered
and every ``FAN`` consecutive nodes become their digest, until one is left; the
groups' subroots are joined to the root the same way.

Every inner node starts with the digests of its siblings, the segment towards
its parent. A self-join appends to each node the segment of the node it points
to and takes over that node's pointer, so the distance doubles each time until
all point past the root. Leaves are kept in runs of one parent and take their
parent's path at the end, so no join is as large as the table times its depth.

Only DataFrame operations. Digests travel as 32 bytes and are hashed as hex text.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskfeat.operators.lookup import BROADCAST_ROWS, attach
from riskfeat.session import cut_lineage

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 8
PATH_BYTES = 32 << 20  # most bytes of paths that a jump broadcasts
STEP_BYTES = FAN * 32 + 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROW_BITS = 33  # of monotonically_increasing_id: the row inside its partition


def canonical(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[canonical(v) for v in values]), 256))


def hexed(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(b""), lambda a, d: F.concat(a, d))


def node(digests: Column) -> Column:
    """Digest of digests."""
    return F.unhex(F.sha2(hexed(joined(digests)), 256))


def levels(size: int) -> int:
    """How often ``size`` nodes are grouped until one is left."""
    n = 0
    while size > 1:
        size, n = -(-size // FAN), n + 1
    return n


def placed(rows: DataFrame, within: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` globally sorted and written, with _part and _at, and what their numbers start from.

    The second table holds for every group and partition its first _at, its
    rows and those of the group before it (_first, _rows, _before): a row's
    number in its group is _at - _first + _before. Rows equal in all of
    ``order`` are spread by their place in the input, so they need not share a task.
    """
    keys = [*within, *order, "_copy"]
    by_range = rows.withColumn("_copy", F.monotonically_increasing_id()).repartitionByRange(
        *keys).sortWithinPartitions(*keys)
    done = cut_lineage(by_range.drop("_copy").withColumn("_at", F.monotonically_increasing_id()))
    done = done.withColumn("_part", F.shiftright("_at", _ROW_BITS))
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = done.groupBy(*within, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    return done, blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))


def _number() -> Column:
    return F.col("_at") - F.col("_first") + F.col("_before")


def _climb(nodes: DataFrame, rounds: int) -> tuple[list[DataFrame], DataFrame]:
    """Steps from node to parent, (key, up, step), and the one node left of every tree.

    ``nodes`` has (tree, level, at, size, digest, key), size being the number
    of nodes on the tree's level.
    """
    steps, tops = [], [nodes.where("size = 1")]
    for _ in range(rounds):
        runs = cut_lineage(nodes.where("size > 1").groupBy(
            "tree", "level", F.floor(F.col("at") / FAN).alias("at")).agg(
            F.min("size").alias("size"), F.sort_array(F.collect_list(F.struct("at", "digest", "key"))).alias("kids")))
        up = F.struct("tree", (F.col("level") + 1).alias("level"), "at")
        steps.append(runs.select(up.alias("up"), F.posexplode("kids").alias("_pos", "_kid"), "kids").select(
            F.col("_kid.key").alias("key"), "up", _siblings("digest").alias("step")))
        nodes = runs.select("tree", (F.col("level") + 1).alias("level"), "at",
                            F.ceil(F.col("size") / FAN).alias("size"), node(F.col("kids.digest")).alias("digest"),
                            up.alias("key"))
        tops.append(nodes.where("size = 1"))
    return steps, reduce(DataFrame.union, tops)


def _siblings(digest: str) -> Column:
    """The other digests of ``kids``, joined: those left of _pos and those right of it."""
    kids = F.col(f"kids.{digest}")
    return F.struct(joined(F.slice(kids, 1, F.col("_pos"))).alias("left"),
                    joined(F.slice(kids, F.col("_pos") + 2, FAN)).alias("right"))


def _jumped(steps: list[DataFrame], height: int) -> DataFrame:
    """(key, path): for every inner node the segments up to the root."""
    paths = reduce(DataFrame.union, steps).select("key", "up", F.array("step").alias("path"))
    hop = 1
    while hop < height:
        targets = paths.where((F.col("key.level") > hop) | (F.col("key.tree") < 0)).select(
            F.col("key").alias("up"), F.col("path").alias("_rest"), F.col("up").alias("_next"))
        met = attach(paths, targets, "up", max_rows=PATH_BYTES // (hop * STEP_BYTES))
        paths = cut_lineage(met.select("key", F.col("_next").alias("up"), F.when(
            F.col("_rest").isNull(), F.col("path")).otherwise(F.concat("path", "_rest")).alias("path")))
        hop *= 2
    return paths.select("key", "path")


def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", order: str = "doc_id",
             tampered: Column | None = None) -> DataFrame:
    """(order, leaf, subroot, root, proof_sha256, folded_root, verified) for every row of ``docs``.

    Leaves are grouped by ``group`` (NULL is a group, and the first) and
    ordered by ``order`` (NULL first), rows equal in it by leaf; rows equal in
    all of ``columns`` have equal leaves and are leaves of their own.
    ``tampered`` replaces the last of ``columns`` where it is not NULL: then
    folded_root is computed from the changed row and the original siblings, and
    verified tells whether it still equals root. A NULL value differs from an
    empty one. Texts may be of any length, each is read once. Other columns of
    ``docs``, whatever their names, are not looked at; an empty table gives no
    rows.
    """
    values = [F.col(c) for c in columns]
    changed = F.when(tampered.isNotNull(), leaf([*values[:-1], tampered])) if tampered is not None else F.lit(None)
    leaves, blocks = placed(docs.select(
        F.col(group).alias("_group"), F.col(order).alias("_order"), leaf(values).alias("leaf"),
        changed.cast("binary").alias("changed")), ["_group"], ["_order", "leaf"])
    groups = blocks.groupBy("_group").agg(F.sum("_rows").alias("n"), F.count("*").alias("_weight"))
    groups, starts = placed(groups, [], ["_group"])
    groups = cut_lineage(attach(groups, starts, "_part").select("_group", "n", "_weight", _number().alias("tree")))
    seen = groups.agg(F.max("n").alias("most"), F.count("*").alias("groups")).first()
    most, n_groups = seen["most"] or 0, seen["groups"]
    blocks = attach(blocks, groups, "_group", weight="_weight", null_safe=True).drop("_weight")
    leaves = attach(leaves, blocks, ["_group", "_part"], weight="_rows", null_safe=["_group"])

    runs = cut_lineage(leaves.withColumn("_i", _number()).groupBy(
        "tree", F.floor(F.col("_i") / FAN).alias("at")).agg(
        F.min("n").alias("n"), F.sort_array(F.collect_list(F.struct("_i", "leaf", "_order", "changed"))).alias("kids")))
    lone = F.col("n") == 1  # a single leaf is its group's subroot as it is
    runs = runs.withColumn("key", F.struct("tree", F.lit(1).alias("level"), "at"))
    first = runs.select("tree", F.lit(1).alias("level"), "at", F.ceil(F.col("n") / FAN).alias("size"),
                        F.when(lone, F.col("kids.leaf")[0]).otherwise(node(F.col("kids.leaf"))).alias("digest"), "key")
    inner, subroots = _climb(first, max(levels(most) - 1, 0))
    subroots = cut_lineage(subroots.select("tree", "digest", "key"))
    top = subroots.select(F.lit(-1).cast("bigint").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("at"),
                          F.lit(n_groups).cast("bigint").alias("size"), "digest", "key")
    outer, root = _climb(top, levels(n_groups))
    root = root.select(hexed(F.col("digest")).alias("root")).first()

    steps, height = inner + outer, max(levels(most) - 1, 0) + levels(n_groups)
    if steps:
        runs = attach(runs, _jumped(steps, height), "key", max_rows=min(
            BROADCAST_ROWS, PATH_BYTES // (height * STEP_BYTES)))
    else:
        runs = runs.withColumn("path", F.lit(None).cast("array<struct<left:binary,right:binary>>"))
    weights = groups.select(F.col("tree").alias("_tree"), F.ceil(F.col("n") / FAN).alias("_runs"))
    named = subroots.select("tree", hexed(F.col("digest")).alias("subroot"))
    named = named.join(weights, named["tree"] == weights["_tree"]).drop("_tree")
    runs = attach(runs, named, "tree", weight="_runs")

    kid = runs.select("n", "path", "subroot", "kids", F.posexplode("kids").alias("_pos", "_kid"))
    own = F.array(_siblings("leaf"))
    path = F.coalesce("path", F.array().cast("array<struct<left:binary,right:binary>>"))
    kid = kid.select("_kid", "subroot", F.when(lone, path).otherwise(F.concat(own, path)).alias("path"))
    proof = F.sha2(hexed(joined(F.transform("path", lambda s: F.concat(s["left"], s["right"])))), 256)
    folded = F.aggregate("path", hexed(F.coalesce("_kid.changed", "_kid.leaf")), lambda d, s: F.sha2(
        F.concat(hexed(s["left"]), d, hexed(s["right"])), 256))
    whole = F.lit(root["root"] if root else None).cast("string")
    return kid.select(F.col("_kid._order").alias(order), hexed(F.col("_kid.leaf")).alias("leaf"), "subroot",
                      whole.alias("root"), proof.alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def lowered(text: str = "text", key: str = "doc_id") -> Column:
    """``text`` with A-Z in lower case where 3 divides the key's crc32, else NULL."""
    hit = F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 0
    return F.when(hit, F.translate(F.col(text), UPPER, LOWER))


# ------------------------------------------------------------------------- SQL


def _tree_sql(name: str, source: str, part: str, rounds: int) -> str:
    """CTEs of one tree by plain grouping, level by level: {name}0.. nodes, {name}s0.. siblings of nodes."""
    sql = [f"{name}0 AS ({source})"]
    for k in range(rounds):
        sql.append(f"""{name}s{k} AS (SELECT a.{part}, a.place, a.n,
            coalesce(string_agg(b.d, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS l,
            coalesce(string_agg(b.d, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS r
            FROM {name}{k} a JOIN {name}{k} b ON a.{part} IS NOT DISTINCT FROM b.{part} AND a.place // {FAN} = b.place // {FAN}
            GROUP BY a.{part}, a.place, a.n)""")
        sql.append(f"""{name}{k + 1} AS (SELECT {part}, place // {FAN} AS place, (min(n) + {FAN - 1}) // {FAN} AS n,
            CASE WHEN min(n) > 1 THEN sha256(string_agg(d, '' ORDER BY place)) ELSE min(d) END AS d
            FROM {name}{k} GROUP BY {part}, place // {FAN})""")
    return ",\n".join(sql)


def _sql(rounds: int = 6, top_rounds: int = 3) -> str:
    """The manifest of tables of up to 8^rounds rows a language, by grouping and folding level by level."""
    value = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
    fields = " || ".join(value.format(c) for c in COLUMNS)
    low = f"translate(text, '{UPPER}', '{LOWER}')"
    changed = " || ".join(value.format(c if c != "text" else low) for c in COLUMNS)
    crc = """xor(list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c:
        [unicode(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])), lambda c, b: CASE WHEN b >= 0 THEN xor(c, b)
        WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, 4294967295::BIGINT), 4294967295)"""
    fold, joins, proof = "f", [], []
    for k in range(rounds):
        joins.append(f"LEFT JOIN ts{k} s{k} ON p.lang IS NOT DISTINCT FROM s{k}.lang AND s{k}.place = p.place // {FAN ** k}")
        proof.append(f"CASE WHEN s{k}.n > 1 THEN s{k}.l || s{k}.r ELSE '' END")
        fold = f"CASE WHEN s{k}.n > 1 THEN sha256(s{k}.l || {fold} || s{k}.r) ELSE {fold} END"
    tops = []
    for k in range(top_rounds):
        tops.append(f"LEFT JOIN us{k} u{k} ON u{k}.place = g.place // {FAN ** k}")
        proof.append(f"CASE WHEN u{k}.n > 1 THEN u{k}.l || u{k}.r ELSE '' END")
    lines = [f"""WITH leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
        count(*) OVER (PARTITION BY lang) AS n FROM (SELECT doc_id, lang, sha256({fields}) AS leaf,
        CASE WHEN {crc} % 3 = 0 THEN sha256({changed}) ELSE sha256({fields}) END AS f FROM documents))""",
             _tree_sql("t", "SELECT lang, place, n, leaf AS d FROM leaves", "lang", rounds),
             f"""langs AS (SELECT lang, d AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place,
        count(*) OVER () AS n FROM t{rounds})""",
             _tree_sql("u", "SELECT 0 AS one, place, n, subroot AS d FROM langs", "one", top_rounds)]
    lines.append(f"""folded AS (SELECT p.doc_id, p.leaf, g.subroot, g.place, {' || '.join(proof[:rounds])} AS lower_proof,
        {fold} AS h FROM leaves p JOIN langs g ON p.lang IS NOT DISTINCT FROM g.lang {' '.join(joins)})""")
    h = "g.h"
    for k in range(top_rounds):
        h = f"CASE WHEN u{k}.n > 1 THEN sha256(u{k}.l || {h} || u{k}.r) ELSE {h} END"
    lines.append(f"""done AS (SELECT g.doc_id, g.leaf, g.subroot, (SELECT d FROM u{top_rounds}) AS root,
        sha256(g.lower_proof || {' || '.join(proof[rounds:])}) AS proof_sha256, {h} AS folded_root
        FROM folded g {' '.join(tops)})""")
    return ",\n".join(lines) + "\nSELECT *, folded_root = root AS verified FROM done"


SQL = _sql()
