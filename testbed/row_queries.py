"""Row-level operators: cleaning, ratios, row statistics, families, encoders without labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.functions.columns import numeric_columns, string_columns
from riskfeat.functions.rows import logit, row_max, row_mean, row_min, row_std, row_sum
from riskfeat.operators.encode import (
    count_encode, label_codes, log_income, median_impute, null_flags, one_hot, standardize,
    train_fold_codes, winsorize,
)
from riskfeat.operators.folds import split_by_label
from riskfeat.plans import columns as names
from riskfeat.plans.application import application_features, application_rows, union_base
from riskfeat.plans.assemble import categorical_matrix, coded_matrix, main_matrix
from riskfeat.sources.tables import CATALOG, clean, fill_missing_category, narrow_types, scrub_non_finite
from testbed.feature_queries import cleaned_sql
from testbed.registry import query, rounded, rounded_sql, with_ctes
from testbed.roles import APPLICATION, load, role

ID = "SK_ID_CURR"


def application(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(role(spark, sf_dir, "application"), CATALOG["application_train"])


_APP = cleaned_sql("application_train")

# ------------------------------------------------------------------ cleaning

_DAYS = ("DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION")
_TOKENS = ("NAME_CONTRACT_STATUS", "NAME_CASH_LOAN_PURPOSE", "CODE_REJECT_REASON")


@query(f"SELECT SK_ID_PREV, {', '.join(_DAYS + _TOKENS)} FROM ({cleaned_sql('previous_application')})")
def clean_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    prior = clean(role(spark, sf_dir, "previous_application"), CATALOG["previous_application"])
    return prior.select("SK_ID_PREV", *_DAYS, *_TOKENS)


@query(f"SELECT SK_ID_CURR, DAYS_EMPLOYED, CODE_GENDER, ORGANIZATION_TYPE, NAME_FAMILY_STATUS FROM ({_APP})")
def clean_application(spark: SparkSession, sf_dir: str) -> DataFrame:
    return application(spark, sf_dir).select(
        ID, "DAYS_EMPLOYED", "CODE_GENDER", "ORGANIZATION_TYPE", "NAME_FAMILY_STATUS")


@query("SELECT event_id, CASE WHEN CAST(regexp_extract(props, '[0-9]+', 0) AS INT) > 0 THEN value END AS value FROM events")
def non_finite_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    dirty = events.select("event_id", F.when(k > 0, F.col("value")).when(
        F.col("event_id") % 2 == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan"))).alias("value"))
    return scrub_non_finite(dirty)


_ORDER_CODES = "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE o_orderpriority END"


@query(f"SELECT o_orderkey, coalesce({_ORDER_CODES}, '__missing__') AS priority FROM orders")
def missing_category_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_ORDER_CODES} AS priority")
    return fill_missing_category(orders, ["priority"])


@query("SELECT l_orderkey, CAST(l_linenumber AS TINYINT) AS l_linenumber, CAST(l_quantity AS FLOAT) AS l_quantity, "
       "CAST(l_discount AS FLOAT) + CAST(0.0 AS FLOAT) AS l_discount, l_returnflag FROM (SELECT * REPLACE (CAST(l_orderkey AS SMALLINT) AS l_orderkey) FROM lineitem)")
def narrowed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_discount") + 0.0).alias("l_discount"), "l_returnflag")
    return narrow_types(lines)


@query(f"SELECT split, count(*) AS n, CAST(sum(SK_ID_CURR) AS BIGINT) AS keys FROM (SELECT SK_ID_CURR, CASE WHEN TARGET IS NULL THEN 'score' ELSE 'train' END AS split FROM ({_APP})) GROUP BY split")
def train_score_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, score = split_by_label(application(spark, sf_dir), "TARGET")
    both = train.withColumn("split", F.lit("train")).unionByName(score.withColumn("split", F.lit("score")))
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum(ID).alias("keys"))


@query("SELECT o_orderkey, " + rounded_sql("ln(p / (1 - p))", "logit") +
       " FROM (SELECT o_orderkey, least(greatest(o_totalprice / 400000, 1e-6), 1 - 1e-6) AS p FROM orders)")
def clipped_logit(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    return rounded(orders.select("o_orderkey", logit(F.col("o_totalprice") / 400000).alias("logit")))


# ------------------------------------------------- application table (D01, P03-P10)

_E = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")
_PRESENT = "(" + " + ".join(f"CAST({e} IS NOT NULL AS INT)" for e in _E) + ")"
_EXT_SUM = "(" + " + ".join(f"coalesce({e}, 0)" for e in _E) + ")"
_MEAN = f"({_EXT_SUM} / nullif({_PRESENT}, 0))"
_STD = ("(CASE WHEN " + _PRESENT + " > 1 THEN sqrt((" + " + ".join(f"coalesce(power({e} - {_MEAN}, 2), 0)" for e in _E)
        + f") / ({_PRESENT} - 1)) END)")
_PROD = "(EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3)"
_TERM = "(AMT_ANNUITY / nullif(AMT_CREDIT, 0))"
_PERSON = "(AMT_INCOME_TOTAL / nullif(CNT_FAM_MEMBERS, 0))"
_DOCS = [f"FLAG_DOCUMENT_{i}" for i in range(2, 22)]
_CONTACT = [c for c in APPLICATION if c.startswith("FLAG_") and c not in _DOCS and not c.startswith("FLAG_OWN")]


def _family_mean(cols: list[str]) -> str:
    total = " + ".join(f"coalesce({c}, 0)" for c in cols)
    count = " + ".join(f"CAST({c} IS NOT NULL AS INT)" for c in cols)
    return f"({total}) / nullif({count}, 0)"


def _family(suffix: str) -> list[str]:
    return [p + suffix for p in names.BUILDING_PREFIXES]


ROW_DOUBLES = {
    "APP_CREDIT_TERM": _TERM,
    "APP_CREDIT_INCOME_RATIO": "AMT_CREDIT / nullif(AMT_INCOME_TOTAL, 0)",
    "APP_ANNUITY_INCOME_RATIO": "AMT_ANNUITY / nullif(AMT_INCOME_TOTAL, 0)",
    "APP_GOODS_PRICE_TO_CREDIT": "AMT_GOODS_PRICE / nullif(AMT_CREDIT, 0)",
    "APP_ANNUITY_TO_GOODS": "AMT_ANNUITY / nullif(AMT_GOODS_PRICE, 0)",
    "APP_CREDIT_GOODS_DIFF": "AMT_CREDIT - AMT_GOODS_PRICE",
    "APP_INCOME_PER_PERSON": _PERSON,
    "APP_INCOME_PER_CHILD": "AMT_INCOME_TOTAL / nullif(CNT_CHILDREN + 1, 0)",
    "APP_CREDIT_PER_PERSON": "AMT_CREDIT / nullif(CNT_FAM_MEMBERS, 0)",
    "APP_AGE_YEARS": "-DAYS_BIRTH / 365.0",
    "APP_EMPLOYED_YEARS": "-DAYS_EMPLOYED / 365.0",
    "APP_DAYS_EMPLOYED_RATIO": "DAYS_EMPLOYED / nullif(DAYS_BIRTH, 0)",
    "APP_REGISTRATION_AGE_YEARS": "-DAYS_REGISTRATION / 365.0",
    "APP_ID_PUBLISH_AGE_YEARS": "-DAYS_ID_PUBLISH / 365.0",
    "APP_CAR_TO_AGE": "OWN_CAR_AGE / nullif(-DAYS_BIRTH / 365.0, 0)",
    "APP_EXT_MEAN": _MEAN,
    "APP_EXT_MIN": f"least({', '.join(_E)})",
    "APP_EXT_MAX": f"greatest({', '.join(_E)})",
    "APP_EXT_STD": _STD,
    "APP_EXT_PROD": _PROD,
    "APP_EXT_WEIGHTED": "2 * EXT_SOURCE_1 + 3 * EXT_SOURCE_2 + 4 * EXT_SOURCE_3",
    "APP_EXT12_PROD": "EXT_SOURCE_1 * EXT_SOURCE_2",
    "APP_EXT13_PROD": "EXT_SOURCE_1 * EXT_SOURCE_3",
    "APP_EXT23_PROD": "EXT_SOURCE_2 * EXT_SOURCE_3",
    "APP_EXT12_SUM": "EXT_SOURCE_1 + EXT_SOURCE_2",
    "APP_EXT23_SUM": "EXT_SOURCE_2 + EXT_SOURCE_3",
    "APP_EXT12_DIFF": "EXT_SOURCE_1 - EXT_SOURCE_2",
    "APP_EXT23_DIFF": "EXT_SOURCE_2 - EXT_SOURCE_3",
    "APP_CREDIT_TERM_DIV_EXT1_TO_BIRTH": f"{_TERM} / nullif(EXT_SOURCE_1 / nullif(DAYS_BIRTH, 0), 0)",
    "APP_CREDIT_TERM_DIV_DAYS_BIRTH": f"{_TERM} / nullif(DAYS_BIRTH, 0)",
    "APP_INCOME_PER_PERSON_DIV_EXT_MEAN": f"{_PERSON} / nullif({_MEAN}, 0)",
    "APP_CREDIT_DIV_EXT_PROD": f"AMT_CREDIT / nullif({_PROD}, 0)",
    "APP_ANNUITY_DIV_EXT_MAX": f"AMT_ANNUITY / nullif(greatest({', '.join(_E)}), 0)",
    "APP_DAYS_EMPLOYED_DIV_EXT_MIN": f"DAYS_EMPLOYED / nullif(least({', '.join(_E)}), 0)",
    "APP_EXT_MEAN_DIV_DAYS_EMPLOYED": f"{_MEAN} / nullif(1 - DAYS_EMPLOYED, 0)",
    "APP_EXT_MEAN_MUL_AGE_YEARS": f"{_MEAN} * (-DAYS_BIRTH / 365.0)",
    "APP_DOCUMENT_COUNT": " + ".join(_DOCS),
    "APP_DOCUMENT_MEAN": _family_mean(_DOCS),
    "APP_FLAG_CONTACT_SUM": " + ".join(_CONTACT),
    **{f"APP_BUILDING{s}_MEAN": _family_mean(_family(s)) for s in names.BUILDING_SUFFIXES},
    "APP_BUILDING_GLOBAL_MEAN": _family_mean([p + s for p in names.BUILDING_PREFIXES for s in names.BUILDING_SUFFIXES]),
}
ROW_INTS = {
    **{f"APP_EXT{i}_ISNULL": f"CAST({e} IS NULL AS INT)" for i, e in enumerate(_E, 1)},
    "APP_EXT_NONNULL_COUNT": f"CAST({_PRESENT} AS INT)",
    "APP_DOCUMENT_3_PRESENT": "FLAG_DOCUMENT_3",
    **{f"APP_BUILDING{s}_NULLCOUNT": "CAST(" + " + ".join(f"CAST({c} IS NULL AS INT)" for c in _family(s)) + " AS INT)"
       for s in names.BUILDING_SUFFIXES},
}


def _row_sql() -> list[str]:
    return [rounded_sql(e, c) for c, e in ROW_DOUBLES.items()] + [f"{e} AS {c}" for c, e in ROW_INTS.items()]


@query(with_ctes([("app", _APP)], f"SELECT {ID}, {', '.join(_row_sql())} FROM app"))
def application_row_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(application_rows(application(spark, sf_dir)).select(ID, *ROW_DOUBLES, *ROW_INTS))



@query("SELECT c_custkey, " + ", ".join([
    rounded_sql("(coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0))", "total"),
    rounded_sql("list_avg(list_filter([a, b, c], lambda x: x IS NOT NULL))", "mean"),
    rounded_sql("least(a, b, c)", "low"), rounded_sql("greatest(a, b, c)", "high"),
    "round(list_stddev_samp(list_filter([a, b, c], lambda x: x IS NOT NULL)), 2) + 0.0 AS row_STD",
]) + " FROM (SELECT c_custkey, c_acctbal AS a, nullif(c_nationkey, 3) AS b, "
     "CASE WHEN c_custkey % 2 = 0 THEN c_custkey / 2 END AS c FROM customer)")
def row_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_acctbal AS a", "cast(nullif(c_nationkey, 3) AS double) AS b",
        "CASE WHEN c_custkey % 2 = 0 THEN c_custkey / 2 END AS c")
    abc = ["a", "b", "c"]
    return rounded(rows.select("c_custkey", row_sum(abc).alias("total"), row_mean(abc).alias("mean"),
                               row_min(abc).alias("low"), row_max(abc).alias("high"), row_std(abc).alias("row_STD")))


# ------------------------------------------------------------- category encoders

_COUNT_SQL = ", ".join(
    f'c{i}.n AS "APP_CAT_COUNT_{c}", round(c{i}.n / (SELECT CAST(count(*) AS DOUBLE) FROM app), 6) + 0.0 AS "APP_CAT_FREQ_{c}"'
    for i, c in enumerate(names.CATEGORIES)
)
_COUNT_JOINS = "".join(
    f" LEFT JOIN (SELECT {c} AS v, count(*) AS n FROM app GROUP BY {c}) c{i} ON app.{c} = c{i}.v"
    for i, c in enumerate(names.CATEGORIES)
)


@query(with_ctes([("app", _APP)], f"SELECT {ID}, {_COUNT_SQL} FROM app{_COUNT_JOINS}"))
def category_counts_and_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    app = application(spark, sf_dir).select(ID, *names.CATEGORIES)
    return rounded(count_encode(app, names.CATEGORIES).drop(*names.CATEGORIES))


# categories the application role can produce
VOCABULARY: dict[str, list[str | None]] = {
    "CODE_GENDER": ["F", "M", None],
    "FLAG_OWN_CAR": ["N", "Y"],
    "FLAG_OWN_REALTY": ["N", "Y"],
    "NAME_CONTRACT_TYPE": ["Cash loans", "Revolving loans"],
    "NAME_TYPE_SUITE": ["suite 0", "suite 1", "suite 2", "suite 3", None],
    "NAME_INCOME_TYPE": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "NAME_EDUCATION_TYPE": [f"education {i}" for i in range(5)],
    "NAME_FAMILY_STATUS": [*[f"status {i}" for i in range(4)], None],
    "NAME_HOUSING_TYPE": [f"housing {i}" for i in range(6)],
    "WEEKDAY_APPR_PROCESS_START": [f"day {i}" for i in range(7)],
    "FONDKAPREMONT_MODE": ["fund 0", "fund 1", "fund 2", None],
    "HOUSETYPE_MODE": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "WALLSMATERIAL_MODE": ["wall 0", "wall 2", "wall 4", None],
    "EMERGENCYSTATE_MODE": ["No", "Yes"],
}


def _one_hot_sql() -> str:
    out = []
    for c, levels in VOCABULARY.items():
        for v in levels:
            test = f"{c} IS NULL" if v is None else f"{c} IS NOT DISTINCT FROM '{v}'"
            out.append(f'CAST({test} AS INT) AS "APP_OHE_{c}__{"null" if v is None else v}"')
    return ", ".join(out)


@query(with_ctes([("app", _APP)], f"SELECT {ID}, {_one_hot_sql()} FROM app"))
def one_hot_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    app = application(spark, sf_dir).select(ID, *names.LOW_CARD_CATEGORIES)
    return one_hot(app, names.LOW_CARD_CATEGORIES).drop(*names.LOW_CARD_CATEGORIES)


_RAW_NUMBERS = [
    c for c in APPLICATION
    if c.startswith(("AMT_", "CNT_", "DAYS_", "OWN_", "EXT_")) or c in _CONTACT
]
APPLICATION_TABLE_SQL = with_ctes([("app", _APP)], (
    f"SELECT app.{ID}, "
    + ", ".join(c if c in _CONTACT else rounded_sql(c, c) for c in _RAW_NUMBERS)
    + f", {', '.join(_row_sql())}, {_COUNT_SQL}, {_one_hot_sql()} FROM app{_COUNT_JOINS}"
))


@query(APPLICATION_TABLE_SQL)
def application_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(application_features(application(spark, sf_dir)))


@query("SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INT) AS c_mktsegment__nn, "
       "coalesce(n.code, -1) AS n_name__nn FROM customer JOIN nation ON c_nationkey = n_nationkey "
       "LEFT JOIN (SELECT n_name AS v, CAST(row_number() OVER (ORDER BY n_name) - 1 AS INT) AS code FROM nation "
       "WHERE n_nationkey <> 7 AND n_nationkey IN (SELECT c_nationkey FROM customer)) n ON n_name = n.v")
def category_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation").selectExpr("n_nationkey", "CASE WHEN n_nationkey <> 7 THEN n_name END AS n_name")
    rows = load(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    coded = label_codes(rows.select("c_custkey", "c_mktsegment", "n_name"), ["c_mktsegment", "n_name"])
    return coded.drop("c_mktsegment", "n_name")


@query("WITH v AS (SELECT source AS s, CAST(row_number() OVER (ORDER BY source) AS INT) AS code FROM "
       "(SELECT DISTINCT source FROM documents JOIN labels USING (doc_id))) "
       "SELECT doc_id, coalesce(code, 0) AS source__code FROM documents LEFT JOIN v ON source = s")
def train_only_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = load(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("labelled"))
    docs = load(spark, sf_dir, "documents").select("doc_id", "source").join(labels, "doc_id", "left")
    return train_fold_codes(docs, ["source"], F.col("labelled")).select("doc_id", "source__code")


# ------------------------------------------------------------ numeric transforms

_IMPUTED = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_ANNUITY", "OWN_CAR_AGE", "DAYS_EMPLOYED")


@query(with_ctes([("app", _APP)], f"SELECT {ID}, " + ", ".join(
    rounded_sql(f"coalesce({c}, (SELECT quantile_disc({c}, 0.5) FROM app WHERE TARGET IS NOT NULL))", c)
    for c in _IMPUTED) + " FROM app"))
def train_median_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    app = application(spark, sf_dir).select(ID, "TARGET", *_IMPUTED)
    return rounded(median_impute(app, _IMPUTED, F.col("TARGET").isNotNull()).drop("TARGET"))


@query("SELECT o_orderkey, " + rounded_sql("(o_totalprice - m) / s", "o_totalprice") +
       " FROM orders, (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders WHERE o_orderstatus <> 'P')")
def train_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return rounded(standardize(orders, ["o_totalprice"], F.col("o_orderstatus") != "P").drop("o_orderstatus"))


@query(with_ctes([("app", _APP)], f"SELECT {ID}, " + ", ".join(f'CAST({c} IS NULL AS INT) AS "{c}__isnan"' for c in _IMPUTED) + " FROM app"))
def null_indicator_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    app = application(spark, sf_dir).select(ID, *_IMPUTED)
    return null_flags(app, _IMPUTED).drop(*_IMPUTED)


@query("SELECT c_custkey, " + rounded_sql("ln(greatest(c_acctbal, 0) + 1)", "log_acctbal") + " FROM customer")
def log_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return rounded(log_income(rows, "c_acctbal", "log_acctbal").drop("c_acctbal"))


@query("SELECT c_custkey, least(greatest(c_acctbal, lo), hi) AS c_acctbal FROM customer, "
       "(SELECT quantile_disc(c_acctbal, 0.01) AS lo, quantile_disc(c_acctbal, 0.99) AS hi FROM customer)")
def winsorized_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winsorize(load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])


# -------------------------------------------------- unions and matrices (U01, D08-D10)

_UNION = ("SELECT SK_ID_CURR, TARGET, AMT_CREDIT, CODE_GENDER FROM app WHERE TARGET IS NOT NULL UNION ALL "
          "SELECT SK_ID_CURR, NULL, AMT_CREDIT, CODE_GENDER FROM app WHERE TARGET IS NULL")


@query(with_ctes([("app", _APP)], _UNION))
def base_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    app = application(spark, sf_dir).select(ID, "TARGET", "AMT_CREDIT", "CODE_GENDER")
    train, score = split_by_label(app, "TARGET")
    return union_base(train, score.drop("TARGET").select("CODE_GENDER", ID, "AMT_CREDIT"))


_SMALL = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "AMT_CREDIT", "AMT_ANNUITY", "OWN_CAR_AGE"]
_CATS = ["CODE_GENDER", "NAME_EDUCATION_TYPE", "ORGANIZATION_TYPE"]


def _matrix_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    base = application(spark, sf_dir).select(ID, "TARGET", *_SMALL, *_CATS)
    df = one_hot(base, ["CODE_GENDER"])
    return df, base


_SMALL_SQL = ", ".join(rounded_sql(c, c) for c in _SMALL)


@query(with_ctes([("app", _APP)], f"SELECT {ID}, TARGET, {_SMALL_SQL}, "
       "CAST(CODE_GENDER IS NOT DISTINCT FROM 'F' AS INT) AS APP_OHE_CODE_GENDER__F, "
       "CAST(CODE_GENDER IS NOT DISTINCT FROM 'M' AS INT) AS APP_OHE_CODE_GENDER__M, "
       "CAST(CODE_GENDER IS NULL AS INT) AS APP_OHE_CODE_GENDER__null FROM app"))
def matrix_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, _ = _matrix_input(spark, sf_dir)
    return rounded(main_matrix(df))


@query(with_ctes([("app", _APP)], f"SELECT {ID}, TARGET, {_SMALL_SQL}, "
       + ", ".join(f"coalesce({c}, '__missing__') AS {c}" for c in _CATS) + " FROM app"))
def matrix_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, base = _matrix_input(spark, sf_dir)
    return rounded(categorical_matrix(df, base, _CATS))


_FLAGGED = [c for c in _SMALL if c != "AMT_CREDIT"]


@query(with_ctes([("app", _APP)], f"SELECT {ID}, TARGET, {_SMALL_SQL}, "
       + ", ".join(f'CAST({c} IS NULL AS INT) AS "{c}__isnan"' for c in _FLAGGED) + ", "
       + ", ".join(f'coalesce(CASE WHEN {c} IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY {c} IS NULL ORDER BY {c}) - 1 AS INT) END, -1) AS "{c}__nn"' for c in _CATS)
       + " FROM app"))
def matrix_coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, base = _matrix_input(spark, sf_dir)
    return rounded(coded_matrix(df, base, _CATS))


@query(with_ctes([("app", _APP)], "SELECT "
       + ", ".join(f"CAST(count({c}) AS BIGINT) AS {c}" for c in _RAW_NUMBERS) + " FROM app"))
def selected_numeric_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column selection by type, prefix and exclusion, then how many values each holds."""
    app = application(spark, sf_dir)
    buildings = {p + s for p in names.BUILDING_PREFIXES for s in names.BUILDING_SUFFIXES}
    chosen = [c for c in numeric_columns(app, {ID, "TARGET", *buildings, *string_columns(app)})
              if not c.startswith("FLAG_DOCUMENT_")]
    return app.agg(*[F.count(c).alias(c) for c in chosen])
