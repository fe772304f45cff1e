"""The operators applied to whole tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.llm import (
    bytepair, chat, language, manifest, mixing, negatives, privacy, quality, rules, simhash, urls, vectors, wrappers,
)
from riskfeat.llm.common import whole_texts

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_mixing_to_target_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = mixing.document_sizes(table(spark, sf_dir, "documents"))
    return mixing.mix(sizes).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op8_mixing_to_target_weights"] = mixing.SQL


@query
def op1_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = privacy.sanitise(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *[f"found.{c}" for c in (
        "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term")])


@query
def op3_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = whole_texts(table(spark, sf_dir, "documents")).select("doc_id", bytepair.digests().alias("d"))
    return docs.select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256")


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score",
        (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


@query
def op2_language_rank_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.profiles(docs.where(~language.held_out()))
    guess = language.predicted(docs.select("doc_id", "text"), found)
    return guess.select("doc_id", language.held_out().alias("held_out"), "guess.lang_pred", "guess.score")


@query
def op10_adaptive_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLES["op10_adaptive_quality_rules"] = rules.SQL


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query
def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


ORACLES["op5_perspective_rotation"] = chat.SQL


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"), tampered=manifest.lowered())


ORACLES["op13_merkle_manifest"] = manifest.SQL


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLES["op12_hard_negatives"] = negatives.SQL


@query
def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = wrappers.extracted(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
