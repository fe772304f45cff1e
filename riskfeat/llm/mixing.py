"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its shuffled documents, repeated up to ``EPOCHS``
times. A copy's virtual finish time is the number of words its source has sent
up to and including it, divided by the source's target. All copies are sorted
by finish time and taken until the budget - the words of all documents - is
spent. At finish time 1 every source has sent its target, so the truncation
leaves each within a document of it.

Only DataFrame operations; no source has to fit into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskfeat.llm.common import WORDS, running_total, spare, stretched, words_of
from riskfeat.session import cut_lineage

WEIGHTS = (5, 2, 1)
EPOCHS = 3
SEED = 42
ROWS_A_STRETCH = 5_000


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """(source, source_size, weight, target) from rows of (source, size).

    Sources in code point order, NULL last, get ``weights`` in turn and share
    the words of all sources. A target stops at ``epochs`` times its source;
    the excess goes to the others by weight, until none is above. With sources
    ordered by cap / weight the share of one unit of weight is the largest of
    (budget - caps before) / (weights from here on): it grows while sources are
    capped and falls afterwards.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumns(
        {"_one": F.lit(1), "_last": F.col("source").isNull()})
    ranked = running_total(
        stretched(sources, ["_last", "source"]), [], "_stretch", ["_last", "source"], "_one", "_rank")
    turn = F.array(*[F.lit(w) for w in weights])
    capped = ranked.withColumn(
        "weight", F.get(turn, ((F.col("_rank") - 1) % len(weights)).cast("int")).cast("bigint")
    ).withColumn("_cap", F.col("source_size") * epochs).withColumn(
        "_ratio", F.col("_cap") / F.col("weight"))
    order = ["_ratio", "_last", "source"]
    capped = stretched(capped.drop("_stretch", "_one", "_rank"), order)
    capped = running_total(capped, [], "_stretch", order, "_cap", "_caps")
    capped = cut_lineage(running_total(capped, [], "_stretch", order, "weight", "_weights"))
    whole = capped.agg(F.sum("source_size").alias("budget"), F.sum("weight").alias("weights")).first()
    budget, all_weights = whole["budget"] or 0, whole["weights"] or 0
    unit = capped.agg(F.max(
        (F.lit(budget) - F.col("_caps") + F.col("_cap")).cast("double")
        / (F.lit(all_weights) - F.col("_weights") + F.col("weight"))).alias("unit")).first()["unit"]
    share = F.lit(float(unit or 0.0)) * F.col("weight")
    return capped.select("source", "source_size", "weight",
                         F.least(F.col("_cap").cast("double"), share).alias("target"))


def mix(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, epochs: int = EPOCHS, seed: int = SEED,
    rows_a_stretch: int = ROWS_A_STRETCH,
) -> DataFrame:
    """``sizes`` (doc_id, source, size, ...) with source_size, target, copies and taken.

    The shuffled order of a source is that of md5(doc_id:seed), so reruns and
    other layouts agree. Documents are taken whole: ``taken`` is ``copies``
    times ``size``. NULL sources are one source, the last; NULL doc_ids are
    shuffled like others; repeated rows are separate documents; empty documents
    are never taken; an empty table gives no rows. ``sizes`` must be stored:
    it is read several times.
    """
    shares = targets(sizes, weights, epochs)
    whole = sizes.agg(F.count("*").alias("n"), F.sum("size").alias("budget")).first()
    stretches = 1
    while stretches * rows_a_stretch < whole["n"] and stretches < 1 << 20:
        stretches *= 2
    known = sizes.join(
        shares.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left"
    ).drop("_source", "weight")
    shuffled = known.withColumn(
        "_key", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")))
    ).withColumn("_place", F.floor(
        F.conv(F.substring("_key", 1, 8), 16, 10).cast("bigint") * F.lit(stretches) / F.lit(1 << 32)))
    queued = running_total(shuffled, ["source"], "_place", ["_key", "doc_id", "size"], "size", "_sent")
    queued = cut_lineage(queued.drop("_place"))

    def finish(epoch) -> F.Column:
        return (F.col("source_size") * epoch + F.col("_sent")).cast("double") / F.col("target")

    order = ["_finish", "_key", "size", "_epoch"]
    sent = queued.where("size > 0").withColumn(
        "_epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))
    ).select(finish(F.col("_epoch")).alias("_finish"), "_key", "size", "_epoch")
    line = running_total(stretched(sent, order), [], "_stretch", order, "size", "_spent")
    last = line.where(F.col("_spent") <= F.lit(whole["budget"] or 0)).agg(
        F.max(F.struct(*order)).alias("last")).first()["last"]
    if last is None:
        copies = F.lit(0)
    else:
        end = F.struct(F.lit(last["_finish"]), F.lit(last["_key"]), F.lit(last["size"]).cast("bigint"),
                       F.lit(last["_epoch"]))
        copies = F.lit(0)
        for epoch in range(epochs):
            own = F.struct(finish(epoch), F.col("_key"), F.col("size"), F.lit(epoch))
            copies = copies + F.when((F.col("size") > 0) & (own <= end), 1).otherwise(0)
    return queued.withColumn("copies", copies.cast("bigint")).withColumn(
        "taken", F.col("copies") * F.col("size")).drop("_key", "_sent")


def document_sizes(docs: DataFrame, *carry: str) -> DataFrame:
    """(doc_id, source, size, *carry), stored; size counts the words of the whole text."""
    return cut_lineage(docs.select(
        "doc_id", "source", F.size(words_of("text")).cast("bigint").alias("size"), *carry))


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it takes them.

    Rows equal in doc_id, source and text are one document of several copies.
    """
    key = spare("text_key", docs.columns)
    rows = docs.withColumn(key, F.coalesce(F.xxhash64("text"), F.lit(0)))
    takes = mix(document_sizes(rows.select("doc_id", "source", "text", F.col(key).alias("_text")), "_text"))
    own = {c: spare(c, rows.columns) for c in ("id", "of", "words", "copies", "rows", "copy")}
    takes = cut_lineage(takes.groupBy(
        F.col("doc_id").alias(own["id"]), F.col("source").alias(own["of"]), F.col("_text").alias(own["words"])).agg(
        F.sum("copies").alias(own["copies"]), F.count("*").alias(own["rows"])).where(F.col(own["copies"]) > 0))

    def repeated(of: DataFrame, once: bool) -> DataFrame:
        found = rows.join(of, rows["doc_id"].eqNullSafe(of[own["id"]]) & (rows[key] == of[own["words"]])
                          & rows["source"].eqNullSafe(of[own["of"]]))
        if once:
            found = found.dropDuplicates([own["id"], own["of"], own["words"]])
        times = F.sequence(F.lit(1), F.col(own["copies"]).cast("int"))
        return found.withColumn(own["copy"], F.explode(times)).select(*docs.columns)

    single = repeated(takes.where(F.col(own["rows"]) == 1), False)
    several = takes.where(F.col(own["rows"]) > 1)
    return single if several.isEmpty() else single.union(repeated(several, True))


SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS BIGINT) AS size
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1] AS weight FROM s),
c AS (SELECT *, CAST(3 * source_size AS DOUBLE) AS cap, CAST(3 * source_size AS DOUBLE) / weight AS ratio FROM w),
b AS (SELECT sum(source_size) AS budget FROM s),
u AS (SELECT max(CAST(budget - coalesce(caps, 0) AS DOUBLE) / weights) AS unit FROM (
        SELECT sum(3 * source_size) OVER (ORDER BY ratio, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS caps,
               sum(weight) OVER (ORDER BY ratio, source NULLS LAST
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM c), b),
t AS (SELECT source, source_size, least(cap, unit * weight) AS target FROM c, u),
q AS (SELECT d.doc_id, d.size, t.source_size, t.target, md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || ':{SEED}') AS k,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '') || ':{SEED}'),
               d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS sent
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
f AS (SELECT *, CAST(source_size * epoch + sent AS DOUBLE) / target AS finish
      FROM q, (SELECT unnest([0, 1, 2]) AS epoch) WHERE size > 0),
r AS (SELECT *, sum(size) OVER (ORDER BY finish, k, size, epoch ROWS UNBOUNDED PRECEDING) AS spent FROM f),
n AS (SELECT doc_id, CAST(sum(size) AS BIGINT) AS taken FROM r, b WHERE spent <= budget GROUP BY doc_id)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(n.taken, 0) AS taken FROM q LEFT JOIN n USING (doc_id)
"""
