"""Application-table features: ratios, external scores, flag and building families, categories."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskfeat.functions.columns import key_first, present, with_prefix
from riskfeat.functions.rows import (
    is_null_flag, null_count, ratio, row_max, row_mean, row_min, row_std, row_sum,
)
from riskfeat.operators.encode import category_counts, count_encode, one_hot
from riskfeat.operators.lookup import BROADCAST_ROWS, collect_bounded
from riskfeat.plans import columns as names
from riskfeat.sources.tables import ENTITY, LABEL


def years(days: str) -> Column:
    """Negative day offset as positive years."""
    return (0 - F.col(days)) / F.lit(365.0)


def domain_ratios() -> dict[str, Column]:
    return {
        "APP_CREDIT_TERM": ratio("AMT_ANNUITY", "AMT_CREDIT"),
        "APP_CREDIT_INCOME_RATIO": ratio("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        "APP_ANNUITY_INCOME_RATIO": ratio("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
        "APP_GOODS_PRICE_TO_CREDIT": ratio("AMT_GOODS_PRICE", "AMT_CREDIT"),
        "APP_ANNUITY_TO_GOODS": ratio("AMT_ANNUITY", "AMT_GOODS_PRICE"),
        "APP_CREDIT_GOODS_DIFF": F.col("AMT_CREDIT") - F.col("AMT_GOODS_PRICE"),
        "APP_INCOME_PER_PERSON": ratio("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
        "APP_INCOME_PER_CHILD": ratio("AMT_INCOME_TOTAL", F.col("CNT_CHILDREN") + 1),
        "APP_CREDIT_PER_PERSON": ratio("AMT_CREDIT", "CNT_FAM_MEMBERS"),
        "APP_AGE_YEARS": years("DAYS_BIRTH"),
        "APP_EMPLOYED_YEARS": years("DAYS_EMPLOYED"),
        "APP_DAYS_EMPLOYED_RATIO": ratio("DAYS_EMPLOYED", "DAYS_BIRTH"),
        "APP_REGISTRATION_AGE_YEARS": years("DAYS_REGISTRATION"),
        "APP_ID_PUBLISH_AGE_YEARS": years("DAYS_ID_PUBLISH"),
        "APP_CAR_TO_AGE": ratio("OWN_CAR_AGE", years("DAYS_BIRTH")),
    }


def external_scores() -> dict[str, Column]:
    scores = list(names.EXTERNAL_SCORES)
    one, two, three = (F.col(c) for c in scores)
    return {
        "APP_EXT_MEAN": row_mean(scores),
        "APP_EXT_MIN": row_min(scores),
        "APP_EXT_MAX": row_max(scores),
        "APP_EXT_STD": row_std(scores),
        "APP_EXT_PROD": one * two * three,
        "APP_EXT_WEIGHTED": 2 * one + 3 * two + 4 * three,
        "APP_EXT12_PROD": one * two,
        "APP_EXT13_PROD": one * three,
        "APP_EXT23_PROD": two * three,
        "APP_EXT12_SUM": one + two,
        "APP_EXT23_SUM": two + three,
        "APP_EXT12_DIFF": one - two,
        "APP_EXT23_DIFF": two - three,
        **{f"APP_EXT{i}_ISNULL": is_null_flag(c) for i, c in enumerate(scores, 1)},
        "APP_EXT_NONNULL_COUNT": F.lit(len(scores)) - null_count(scores),
    }


def interactions(built: Mapping[str, Column]) -> dict[str, Column]:
    """Credit and employment terms divided by external-score terms, out of those ``built`` before."""
    term, mean = built["APP_CREDIT_TERM"], built["APP_EXT_MEAN"]
    return {
        "APP_CREDIT_TERM_DIV_EXT1_TO_BIRTH": ratio(term, ratio("EXT_SOURCE_1", "DAYS_BIRTH")),
        "APP_CREDIT_TERM_DIV_DAYS_BIRTH": ratio(term, "DAYS_BIRTH"),
        "APP_INCOME_PER_PERSON_DIV_EXT_MEAN": ratio(built["APP_INCOME_PER_PERSON"], mean),
        "APP_CREDIT_DIV_EXT_PROD": ratio("AMT_CREDIT", built["APP_EXT_PROD"]),
        "APP_ANNUITY_DIV_EXT_MAX": ratio("AMT_ANNUITY", built["APP_EXT_MAX"]),
        "APP_DAYS_EMPLOYED_DIV_EXT_MIN": ratio("DAYS_EMPLOYED", built["APP_EXT_MIN"]),
        "APP_EXT_MEAN_DIV_DAYS_EMPLOYED": ratio(mean, 1 - F.col("DAYS_EMPLOYED")),
        "APP_EXT_MEAN_MUL_AGE_YEARS": mean * years("DAYS_BIRTH"),
    }


def document_flags(df: DataFrame) -> dict[str, Column]:
    documents = with_prefix(df, "FLAG_DOCUMENT_")
    contacts = with_prefix(df, "FLAG_", exclude={*documents, "FLAG_OWN_CAR", "FLAG_OWN_REALTY"})
    out: dict[str, Column] = {}
    if documents:
        out["APP_DOCUMENT_COUNT"] = row_sum(documents)
        out["APP_DOCUMENT_MEAN"] = row_mean(documents)
    if "FLAG_DOCUMENT_3" in documents:
        out["APP_DOCUMENT_3_PRESENT"] = F.col("FLAG_DOCUMENT_3")
    if contacts:
        out["APP_FLAG_CONTACT_SUM"] = row_sum(contacts)
    return out


def building_columns(df: DataFrame) -> list[str]:
    return present(df, [p + s for p in names.BUILDING_PREFIXES for s in names.BUILDING_SUFFIXES])


def building_means(df: DataFrame) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for suffix in names.BUILDING_SUFFIXES:
        family = present(df, [p + suffix for p in names.BUILDING_PREFIXES])
        if family:
            out[f"APP_BUILDING{suffix}_MEAN"] = row_mean(family)
            out[f"APP_BUILDING{suffix}_NULLCOUNT"] = null_count(family)
    everything = building_columns(df)
    if everything:
        out["APP_BUILDING_GLOBAL_MEAN"] = row_mean(everything)
    return out


def application_rows(df: DataFrame) -> DataFrame:
    """All row-level features in one projection."""
    built = {**domain_ratios(), **external_scores()}
    made = {**built, **interactions(built), **document_flags(df), **building_means(df)}
    return df.select("*", *[e.alias(n) for n, e in made.items()])


def union_base(train: DataFrame, score: DataFrame, label: str = LABEL) -> DataFrame:
    """Labelled and score rows together; the label is NULL on score rows."""
    if label in score.columns:
        score = score.drop(label)
    return train.unionByName(score, allowMissingColumns=True)


def application_features(
    base: DataFrame, vocabulary: Mapping[str, Sequence[str | None]] | None = None
) -> DataFrame:
    """One row per entity: raw numerics plus engineered columns, key first.

    Raw document flags, building columns and categories are replaced by what
    was made of them. Categories are counted over all rows of ``base``.
    """
    df = base.drop(LABEL)
    # the rows become many times as wide here: dealt before, by the key they are joined on afterwards
    rows = application_rows(df.repartition(ENTITY))
    categories, low_card = present(df, names.CATEGORIES), present(df, names.LOW_CARD_CATEGORIES)
    counts = collect_bounded(category_counts(df, categories), BROADCAST_ROWS) if categories else None
    counted = count_encode(rows, categories, counts=counts)
    if vocabulary is None and counts is not None and set(low_card) <= set(categories):
        vocabulary = {c: [r["value"] for r in counts if r["column"] == c] for c in low_card}
    hot = one_hot(counted, low_card, vocabulary=vocabulary) if low_card else counted
    replaced = [
        *present(df, names.CATEGORIES), *with_prefix(df, "FLAG_DOCUMENT_"), *building_columns(df)
    ]
    return key_first(hot.drop(*replaced), ENTITY)
