"""Documents to token ids: the stages of a training corpus, one after the other.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame. The last one
returns token ids, all others the columns of ``docs``, whatever further columns
those are. Empty tables pass through all stages as empty tables. NULL ids,
languages and sources are values like others; what happens to NULL, empty and
repeated rows is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskfeat.llm import bytepair, mixing, privacy, quality, simhash


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model rejects go; it learns from the labels of ``docs``.

    Every row is judged by its text alone, so repeated rows share their fate;
    NULL and empty texts are judged as texts without words. Without labels of
    both kinds the share of accepted labels decides, and without any all stay.
    """
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest doc_id.

    Repeated rows are copies; NULL and empty texts are one group; a row without
    a doc_id stays only where its group has none with one.
    """
    return simhash.first_of_group(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that give it away are replaced in the texts.

    All rows stay, repeated ones too; NULL texts stay NULL; n_chars is counted
    anew where a text has changed.
    """
    return privacy.cleaned(docs)


def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, from not at all to three times.

    Texts without words, NULL ones included, are never taken; rows equal in
    doc_id, source and text are copies of one document and taken as often as
    the mix takes them together.
    """
    return mixing.mixed(docs)


def to_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, little-endian unsigned 32-bit integers, in place of the texts.

    All rows stay; NULL and empty texts have no ids.
    """
    return bytepair.encoded(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("simhash near-dedup", near_dedup),
    ("personal data", without_personal_data),
    ("mixing to target weights", to_target_weights),
    ("byte-level bpe", to_token_ids),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
