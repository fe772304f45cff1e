"""Joins, profiles, ranks, folds, label encoders, neighbours, pruning and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskfeat.functions.columns import numeric_columns
from riskfeat.operators import checks, encode, folds, knn, profile, prune, rank
from riskfeat.operators.aggspec import ROWS, Block, aggregate_blocks, distinct_counts, stats_of
from riskfeat.plans import columns as names
from riskfeat.plans import extras
from riskfeat.plans.application import application_rows
from riskfeat.plans.assemble import join_features
from riskfeat.plans.auxiliary import rollup_predictions
from riskfeat.plans.ensemble import rank_blend, wide_predictions
from riskfeat.plans.installments import PAYMENT_STATS, installments_features
from riskfeat.plans.balances import pos_features, recency_weighted_lateness
from riskfeat.session import cut_lineage, stored
from riskfeat.sources.sinks import constant_scores, fold_table, mean_over_folds, scored_rows
from riskfeat.sources.tables import CATALOG, clean
from testbed.feature_queries import _PAYMENT_CTES, _PAYMENT_STATS, _POS_STATS, block_sql, cleaned_sql
from testbed.registry import ORACLES, QUERIES, query, rounded, rounded_sql, with_ctes
from testbed.roles import BUREAU, load, role, role_sql
from testbed.row_queries import _MEAN, _TERM, ID, application

_APP = cleaned_sql("application_train")
_LABELLED_DOCS = "SELECT doc_id, quality, toxic, lang, source, n_chars FROM labels JOIN documents USING (doc_id)"


def labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "labels").join(
        load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id")


def fold_sql(source: str, key: str, label: str, k: int = 5, name: str = "fold_main") -> str:
    return (f"SELECT {key}, CAST((row_number() OVER (PARTITION BY {label} ORDER BY md5({key} || ':42')) - 1) % {k} "
            f"AS INT) AS {name} FROM {source}")


# ------------------------------------------------------------------- profiles


def _columns_sql(source: str, columns: list[str], measures: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", " + ", ".join(f"{e.format(c=c)} AS {m}" for m, e in measures.items())
        + f" FROM {source}" for c in columns
    )


_BUREAU_COLUMNS = list(BUREAU)


@query(with_ctes([("loans", role_sql("bureau"))], _columns_sql("loans", _BUREAU_COLUMNS, {
    "n_null": "CAST(count(*) FILTER ({c} IS NULL) AS BIGINT)",
    "null_rate": "round(avg(CAST({c} IS NULL AS INT)), 6) + 0.0"})))
def null_rate_of_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.null_rates(role(spark, sf_dir, "bureau")))


_BUREAU_NUMBERS = [c for c in _BUREAU_COLUMNS if not c.startswith(("SK_", "CREDIT_A", "CREDIT_T", "CREDIT_C"))]


@query(with_ctes([("loans", role_sql("bureau"))], _columns_sql("loans", _BUREAU_NUMBERS, {
    "relative": "round(var_samp({c}) / nullif(power(max(abs({c})), 2), 0), 6) + 0.0"})))
def variance_of_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans = role(spark, sf_dir, "bureau").select(*_BUREAU_NUMBERS)
    scale = loans.agg(*[F.max(F.abs(c)).alias(c) for c in _BUREAU_NUMBERS]).first()
    table = profile.variances(loans)
    largest = F.create_map(*[x for c in _BUREAU_NUMBERS for x in (F.lit(c), F.lit(scale[c]))])
    relative = F.try_divide("variance", F.pow(F.element_at(largest, F.col("column")), 2))
    return rounded(table.select("column", relative.alias("relative")))


@query(with_ctes([("prior", role_sql("previous_application"))], _columns_sql(
    "prior", ["DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE", "DAYS_TERMINATION"], {
        "n_sentinel": "CAST(count(*) FILTER ({c} = 365243) AS BIGINT)",
        "rate": "round(avg(CAST(coalesce({c} = 365243, false) AS INT)), 6) + 0.0"})))
def sentinel_rate_of_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.sentinel_rates(
        role(spark, sf_dir, "previous_application"),
        ["DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE", "DAYS_TERMINATION"], 365243))


_PRIOR_STRINGS = ["NAME_CONTRACT_STATUS", "NAME_CONTRACT_TYPE", "NAME_CASH_LOAN_PURPOSE", "CHANNEL_TYPE", "CODE_REJECT_REASON"]


@query(with_ctes([("prior", cleaned_sql("previous_application"))], _columns_sql("prior", _PRIOR_STRINGS, {
    "n_unique": "count(DISTINCT {c}) + max(CAST({c} IS NULL AS INT))"})))
def cardinality_of_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    prior = clean(role(spark, sf_dir, "previous_application"), CATALOG["previous_application"])
    return profile.cardinality(prior, _PRIOR_STRINGS)


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(load(spark, sf_dir, "events"), "event_type")


@query("SELECT " + ", ".join(rounded_sql(f"quantile_cont(l_extendedprice, {q})", f"q{i}") for i, q in enumerate((0.5, 0.95, 0.99)))
       + ", min(l_extendedprice) AS \"min\", max(l_extendedprice) AS \"max\", count(*) FILTER (l_extendedprice > 100000) AS n_outlier FROM lineitem")
def quantiles_and_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.quantile_report(load(spark, sf_dir, "lineitem"), "l_extendedprice", (0.5, 0.95, 0.99), 100000))


@query("SELECT l_returnflag, " + ", ".join(rounded_sql(f"quantile_cont(l_quantity, {q})", f"q{i}") for i, q in enumerate((0.25, 0.5, 0.9)))
       + " FROM lineitem GROUP BY l_returnflag")
def grouped_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rank.exact_quantiles(load(spark, sf_dir, "lineitem"), "l_quantity", (0.25, 0.5, 0.9), by="l_returnflag"))


_APP_NUMBERS = ["AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "DAYS_BIRTH", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "OWN_CAR_AGE"]


@query(with_ctes([("app", _APP)], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(corr({c}, TARGET), 6) + 0.0 AS corr, round(abs(corr({c}, TARGET)), 6) + 0.0 AS abs_corr FROM app"
    for c in _APP_NUMBERS)))
def correlation_with_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.label_correlations(application(spark, sf_dir), "TARGET", _APP_NUMBERS))


@query("SELECT count(*) AS n_keys, round(avg(n), 6) + 0.0 AS mean_rows, max(n) AS max_rows FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)")
def join_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.join_cardinality(load(spark, sf_dir, "orders"), "o_custkey"))


@query("SELECT CAST(CASE WHEN value < 0 THEN 0 WHEN value >= 200 THEN 21 ELSE floor(value / 10) + 1 END AS INT) AS bin, count(*) AS n FROM events GROUP BY 1")
def value_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.histogram(load(spark, sf_dir, "events"), "value", 0, 200, 20)


@query(with_ctes([("app", _APP)], "SELECT count(*) AS n, round(avg(TARGET), 6) + 0.0 AS pos_rate, round((1 - avg(TARGET)) / avg(TARGET), 6) + 0.0 AS balance_weight FROM app WHERE TARGET IS NOT NULL"))
def label_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.class_balance(application(spark, sf_dir), "TARGET"))


# --------------------------------------------------------- block-level aggregates


@query("SELECT user_id AS SK_ID_CURR, " + ", ".join(
    f"nullif(count(*) FILTER (event_type = '{t}'), 0) AS {t}_COUNT, round(avg(v) FILTER (event_type = '{t}'), 6) + 0.0 AS {t}_v_MEAN, "
    f"CASE WHEN count(*) FILTER (event_type = '{t}') > 0 THEN coalesce(sum(v) FILTER (event_type = '{t}'), 0) END AS {t}_v_SUM"
    for t in ("view", "click", "error"))
    + ", count(*) AS all_COUNT FROM (SELECT *, CASE WHEN value < 100 THEN floor(value) END AS v FROM events) GROUP BY user_id")
def stratified_event_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "events").select(
        F.col("user_id").alias(ID), "event_type", F.when(F.col("value") < 100, F.floor("value").cast("double")).alias("v"))
    blocks = [Block("all", (ROWS,))] + [
        Block(t, (ROWS, *stats_of("v", ("mean", "sum"))), F.col("event_type") == t) for t in ("view", "click", "error")]
    return rounded(aggregate_blocks(rows, ID, blocks))


@query("SELECT o_custkey, count(DISTINCT o_orderstatus) AS statuses, count(DISTINCT p) + max(CAST(p IS NULL AS INT)) AS priorities "
       "FROM (SELECT *, nullif(o_orderpriority, '4-NOT SPECIFIED') AS p FROM orders) GROUP BY o_custkey")
def null_counting_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").withColumn("p", F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")))
    return distinct_counts(orders, "o_custkey", {"statuses": "o_orderstatus", "priorities": "p"})


@query("SELECT user_id AS SK_ID_CURR, " + rounded_sql("avg(pred)", "EV_AUX_OOF_MEAN") + ", " + rounded_sql("max(pred)", "EV_AUX_OOF_MAX")
       + ", " + rounded_sql("min(pred)", "EV_AUX_OOF_MIN") + ", " + rounded_sql("avg(pred) FILTER (m >= -3)", "EV_AUX_OOF_LAST3M_MEAN")
       + " FROM (SELECT user_id, floor(value) AS pred, date_diff('day', DATE '2024-01-30', CAST(ts AS DATE)) AS m FROM events) GROUP BY user_id")
def event_prediction_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "events").select(
        F.col("user_id").alias(ID), F.floor("value").cast("double").alias("pred"),
        F.datediff("ts", F.lit("2024-01-30").cast("date")).alias("m"))
    return rounded(rollup_predictions(rows, "EV", "m"))


# ------------------------------------------------------------------ ranks and AUC

_RANK = "(rank() OVER (ORDER BY {v}) - 1 + (count(*) OVER (PARTITION BY {v}) - 1) / 2.0) / (count(*) OVER () - 1)"


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, " + rounded_sql(_RANK.format(v="l_quantity"), "rank") + " FROM lineitem")
def rank_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return rounded(rank.rank_normalize(lines, "l_quantity"))


_GROUP_RANK = ("(rank() OVER (PARTITION BY event_type ORDER BY value) - 1 + (count(*) OVER (PARTITION BY event_type, value) - 1) / 2.0)"
               " / (count(*) OVER (PARTITION BY event_type) - 1)")


@query("SELECT event_id, event_type, value, " + rounded_sql(_GROUP_RANK, "rank") + " FROM events")
def rank_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return rounded(rank.rank_normalize(events, "value", by="event_type"))


_NULL_EVENTS = "SELECT event_id, nullif(event_type, 'view') AS kind, value, CAST(floor(value) AS BIGINT) % 2 AS y FROM events"


def events_with_null_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        "event_id", F.nullif(F.col("event_type"), F.lit("view")).alias("kind"), "value", (F.floor("value") % 2).alias("y"))


@query("SELECT event_id, kind, value, " + rounded_sql(_GROUP_RANK.replace("event_type", "kind"), "rank") + f" FROM ({_NULL_EVENTS})")
def rank_with_null_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rank.rank_normalize(events_with_null_group(spark, sf_dir).drop("y"), "value", by="kind"))


@query("SELECT kind, round(quantile_cont(value, 0.25), 6) + 0.0 AS q0, round(quantile_cont(value, 0.9), 6) + 0.0 AS q1 "
       f"FROM ({_NULL_EVENTS}) GROUP BY kind")
def quantiles_with_null_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rank.exact_quantiles(events_with_null_group(spark, sf_dir), "value", (0.25, 0.9), by="kind"))


def auc_sql(source: str, score: str, label: str, by: str | None = None, exact: bool = False) -> str:
    part = f"PARTITION BY {by}" if by else ""
    tie = f"PARTITION BY {by}, {score}" if by else f"PARTITION BY {score}"
    head, tail = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    auc = "(sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / nullif(sum(y) * (count(*) - sum(y)), 0)"
    return (
        f"SELECT {head}count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, "
        f"{auc if exact else f'round({auc}, 6) + 0.0'} AS auc "
        f"FROM (SELECT {head}{label} AS y, rank() OVER ({part} ORDER BY {score}) + (count(*) OVER ({tie}) - 1) / 2.0 AS r FROM ({source})){tail}")


@query(auc_sql(_LABELLED_DOCS, "n_chars", "toxic"))
def roc_auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rank.roc_auc(labelled_docs(spark, sf_dir), "n_chars", "toxic"))


@query(auc_sql(_LABELLED_DOCS, "n_chars", "quality", "lang"))
def roc_auc_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rank.roc_auc(labelled_docs(spark, sf_dir), "n_chars", "quality", by="lang"))


@query(auc_sql(_NULL_EVENTS, "value", "y", "kind"))
def roc_auc_with_null_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rank.roc_auc(events_with_null_group(spark, sf_dir), "value", "y", by="kind"))


@query("SELECT \"column\", n, round(auc, 6) + 0.0 AS auc, CAST(auc > 0.65 AS INT) AS suspicious FROM ("
       "SELECT \"column\", n, CASE WHEN auc IS NOT NULL THEN greatest(auc, 1 - auc) ELSE 0.5 END AS auc FROM ("
       + auc_sql(with_ctes([("app", _APP)], " UNION ALL ".join(
           f"SELECT '{c}' AS \"column\", {c} AS value, TARGET FROM app WHERE TARGET IS NOT NULL AND {c} IS NOT NULL" for c in _APP_NUMBERS)),
           "value", "TARGET", "\"column\"", exact=True) + "))")
def univariate_auc_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.univariate_auc(application(spark, sf_dir), _APP_NUMBERS, "TARGET"))


# -------------------------------------------------------------------------- folds


@query(fold_sql("(SELECT c_custkey, CAST(c_acctbal < 0 AS INT) AS y FROM customer)", "c_custkey", "y"))
def stratified_fold_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") < 0).cast("int").alias("y"))
    return folds.stratified_folds(rows, "c_custkey", "y")


@query("SELECT o_custkey, CAST(CASE WHEN p < 5 THEN p ELSE 9 - p END AS INT) AS fold_group FROM (SELECT o_custkey, "
       "(row_number() OVER (ORDER BY n DESC, md5(o_custkey || ':42')) - 1) % 10 AS p FROM "
       "(SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey))")
def group_fold_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.group_folds(load(spark, sf_dir, "orders"), "o_custkey")


_TRAIN = f"SELECT {ID}, TARGET FROM ({_APP}) WHERE TARGET IS NOT NULL"


def folded_application(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    app = application(spark, sf_dir).select(ID, "TARGET", *columns)
    train, _ = folds.split_by_label(app, "TARGET")
    return app.join(folds.stratified_folds(train, ID, "TARGET"), ID, "left")


@query(with_ctes([("train", _TRAIN), ("f", fold_sql("train", ID, "TARGET"))],
       "SELECT fold_main, count(*) AS n, CAST(sum(TARGET) AS BIGINT) AS positives, round(avg(TARGET), 6) + 0.0 AS pos_rate, "
       "round(abs(avg(TARGET) - (SELECT avg(TARGET) FROM train)), 6) + 0.0 AS drift FROM train JOIN f USING (SK_ID_CURR) GROUP BY fold_main"))
def fold_class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = folded_application(spark, sf_dir).filter("TARGET IS NOT NULL")
    return rounded(folds.fold_balance(rows, "fold_main", "TARGET"))


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.duplicate_keys(load(spark, sf_dir, "orders"), "o_custkey")


@query("SELECT user_id AS k FROM events INTERSECT SELECT o_custkey FROM orders")
def key_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.key_overlap(load(spark, sf_dir, "events").select(F.col("user_id").alias("k")),
                             load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), "k")


@query("SELECT o_custkey, min(f) AS first_fold, max(f) AS last_fold FROM (SELECT o_custkey, CAST(o_orderkey % 5 AS INT) AS f FROM orders) "
       "GROUP BY o_custkey HAVING min(f) <> max(f)")
def keys_split_over_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "orders").select("o_custkey", (F.col("o_orderkey") % 5).cast("int").alias("f"))
    return folds.fold_overlap(rows, "o_custkey", "f")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey || ':42'), o_orderkey LIMIT 2000")
def seeded_row_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.seeded_sample(load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 2000)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_rows_by_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(
        F.col("o_totalprice").desc(), "o_orderkey").limit(20)


@query("SELECT DISTINCT o_custkey FROM orders")
def distinct_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select("o_custkey").distinct()


# --------------------------------------------------------------- target encoding


@query(with_ctes(
    [("train", f"SELECT {ID}, TARGET, ORGANIZATION_TYPE AS c FROM ({_APP}) WHERE TARGET IS NOT NULL"),
     ("f", fold_sql("train", ID, "TARGET")), ("t", f"SELECT * FROM train JOIN f USING ({ID})"),
     ("ctx", "SELECT fold_main AS g, (SELECT avg(TARGET) FROM t WHERE t.fold_main <> x.fold_main) AS mu FROM (SELECT DISTINCT fold_main FROM t) x"),
     ("enc", "SELECT g, c, (sum(TARGET) + 10 * any_value(mu)) / (count(*) + 10) AS e FROM t, ctx WHERE fold_main <> g GROUP BY g, c"),
     ("mine", f"SELECT {ID}, fold_main, c FROM (SELECT {ID}, ORGANIZATION_TYPE AS c FROM ({_APP})) LEFT JOIN f USING ({ID})"),
     ("each", f"SELECT {ID}, coalesce(e, mu) AS e FROM mine JOIN ctx ON fold_main IS NULL OR fold_main = ctx.g "
              "LEFT JOIN enc ON enc.g = ctx.g AND enc.c IS NOT DISTINCT FROM mine.c")],
    f"SELECT {ID}, " + rounded_sql("avg(e)", "ORGANIZATION_TYPE_TE") + f" FROM each GROUP BY {ID}"))
def target_encode_out_of_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = folded_application(spark, sf_dir, "ORGANIZATION_TYPE")
    return rounded(encode.target_encode(rows, ["ORGANIZATION_TYPE"], "TARGET", "fold_main").select(ID, "ORGANIZATION_TYPE_TE"))


@query(with_ctes(
    [("t", f"SELECT doc_id, toxic, source AS c FROM ({_LABELLED_DOCS})"), ("f", fold_sql("t", "doc_id", "toxic")),
     ("tf", "SELECT * FROM t JOIN f USING (doc_id)"), ("g", "SELECT DISTINCT fold_main AS g FROM tf"),
     ("enc", "SELECT c, g, (sum(toxic) + 10 * (SELECT avg(toxic) FROM tf z WHERE z.fold_main <> g)) / (count(*) + 10) AS e "
             "FROM tf, g WHERE fold_main <> g GROUP BY c, g")],
    "SELECT source, count(DISTINCT fold) AS folds, count(DISTINCT enc) AS encodings, CAST(count(DISTINCT enc) > 1 AS INT) AS varies FROM "
    "(SELECT c AS source, g AS fold, round(e, 9) AS enc FROM enc) GROUP BY source"))
def encodings_vary_over_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = labelled_docs(spark, sf_dir).select("doc_id", "toxic", "source")
    rows = docs.join(folds.stratified_folds(docs, "doc_id", "toxic"), "doc_id")
    seen = rows.groupBy("source").agg(F.collect_set("fold_main").alias("in_folds"))
    table = encode.target_encodings(rows, "source", "toxic", "fold_main", 5)
    long = table.join(seen, "source").select("source", "in_folds", F.posexplode("enc").alias("fold", "enc"))
    # a fold context counts where the category occurs outside the fold
    long = long.filter((F.size("in_folds") > 1) | ~F.array_contains("in_folds", F.col("fold")))
    return checks.encoding_varies(long.withColumn("enc", F.round("enc", 9)), "source", "fold", "enc")


# --------------------------------------------------------------------- neighbours

_K = 50
_POINTS = "SELECT vec_id, CAST(label = 3 AS INT) AS y, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in range(4)) + " FROM embeddings"


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "embeddings")
    rows = e.select("vec_id", (F.col("label") == 3).cast("int").alias("y"),
                    *[F.element_at("embedding", i + 1).cast("double").alias(f"x{i}") for i in range(4)])
    return rows.join(folds.stratified_folds(rows, "vec_id", "y"), "vec_id")


_KNN = with_ctes(
    [("p", _POINTS), ("f", fold_sql("p", "vec_id", "y")), ("t", "SELECT * FROM p JOIN f USING (vec_id)"),
     ("d", "SELECT q.vec_id, r.y, power(q.x0 - r.x0, 2) + power(q.x1 - r.x1, 2) + power(q.x2 - r.x2, 2) + power(q.x3 - r.x3, 2) AS dist "
           "FROM t q JOIN t r ON q.fold_main <> r.fold_main"),
     ("w", "SELECT vec_id, dist, count(*) AS n, sum(y) AS pos FROM d GROUP BY vec_id, dist"),
     ("c", "SELECT *, sum(n) OVER (PARTITION BY vec_id ORDER BY dist) AS cum, sum(n) OVER (PARTITION BY vec_id) AS total FROM w")],
    "SELECT vec_id, " + rounded_sql(
        f"sum(CASE WHEN cum <= {_K} THEN pos WHEN cum - n < {_K} THEN pos * ({_K} - (cum - n)) / n ELSE 0 END) / least({_K}, any_value(total))",
        "neighbour_mean") + " FROM c GROUP BY vec_id")


@query(_KNN)
def neighbour_label_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embedding_points(spark, sf_dir)
    near = knn.neighbour_means(rows, "vec_id", "y", "fold_main", 5, [f"x{i}" for i in range(4)], _K,
                               out="neighbour_mean", every_context=False)
    return rounded(near.drop("context"))


# -------------------------------------------------------------- pruning decisions


@query(with_ctes([("prior", cleaned_sql("previous_application"))], "SELECT \"column\" FROM (" + _columns_sql(
    "prior", ["AMT_ANNUITY", "AMT_DOWN_PAYMENT", "RATE_INTEREST_PRIMARY", "RATE_INTEREST_PRIVILEGED", "DAYS_DECISION"],
    {"r": "avg(CAST({c} IS NULL AS INT))"}) + ") WHERE r > 0.9"))
def pruned_for_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prior = role(spark, sf_dir, "previous_application").select(
        "AMT_ANNUITY", "AMT_DOWN_PAYMENT", "RATE_INTEREST_PRIMARY", "RATE_INTEREST_PRIVILEGED", "DAYS_DECISION")
    return spark.createDataFrame([(c,) for c in prune.missing_columns(prior, 0.9)], "column string")


@query("SELECT \"column\" FROM (" + _columns_sql("(SELECT l_quantity, l_discount, l_tax, l_linenumber FROM lineitem)",
       ["l_quantity", "l_discount", "l_tax", "l_linenumber"], {"v": "var_samp({c})"}) + ") WHERE v < 0.01")
def pruned_for_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_linenumber")
    return spark.createDataFrame([(c,) for c in prune.flat_columns(lines, 0.01)], "column string")


_CORR = [f"INS_{s}" for s in ("COUNT", "DPD_SUM", "DPD_MEAN", "AMT_INSTALMENT_SUM", "AMT_PAYMENT_SUM", "LATE_COUNT", "LATE_RATE", "PAYMENT_DIFF_SUM")]


@query(with_ctes(
    [*_PAYMENT_CTES, ("b", block_sql("pay", "INS", _PAYMENT_STATS))],
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(abs(corr({a}, {b})), 6) + 0.0 AS corr FROM b"
                       for i, a in enumerate(_CORR) for b in _CORR[i + 1:])))
def column_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = installments_features(role(spark, sf_dir, "installments_payments")).select(*_CORR)
    corr = prune.correlation_matrix(table, _CORR)
    rows = [(a, _CORR[j], float(corr[i, j])) for i, a in enumerate(_CORR) for j in range(i + 1, len(_CORR))]
    return rounded(spark.createDataFrame(rows, "a string, b string, corr double"))


_PAIRED = [f"{p}_{s.suffix}" for p in ("INS", *(f"INS_{w}" for w in names.PAYMENT_WINDOWS)) for s in PAYMENT_STATS] + [
    "INS_DAYS_INSTALMENT_MIN", "INS_DAYS_INSTALMENT_MAX", "INS_NUM_VERSION_NUNIQUE"]


@query(with_ctes(
    [("ins", ORACLES["installments_table"]),
     ("l", f"SELECT {ID}, name, value FROM (SELECT {ID}, " + ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in _PAIRED)
      + f" FROM ins) UNPIVOT INCLUDE NULLS (value FOR name IN ({', '.join(chr(34) + c + chr(34) for c in _PAIRED)}))"),
     ("o", "SELECT * FROM (VALUES " + ", ".join(f"('{c}', {i})" for i, c in enumerate(_PAIRED)) + ") t(name, place)"),
     ("m", "SELECT name, coalesce(quantile_disc(value, 0.5), 0) AS m FROM l GROUP BY name"),
     ("f", f"SELECT {ID}, name, place, coalesce(value, m) AS v FROM l JOIN m USING (name) JOIN o USING (name)"),
     ("c", f"SELECT a.name AS a, b.name AS b, abs(corr(a.v, b.v)) AS corr FROM f a JOIN f b USING ({ID}) WHERE a.place < b.place GROUP BY 1, 2")],
    "SELECT a, b, round(corr, 6) + 0.0 AS corr FROM c WHERE NOT isnan(corr) AND corr > 0.98"))
def correlated_payment_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of the payment features that are too similar to keep both."""
    table = stored(QUERIES["installments_table"](spark, sf_dir))  # medians, moments and products each read it
    return rounded(prune.correlated_pairs(table, _PAIRED, 0.98))


@query()
def pruned_for_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weaker column of every too similar pair among all columns of the six feature tables."""
    joined = stored(QUERIES["joined_features"](spark, sf_dir))
    table = joined if "TARGET" in joined.columns else joined.join(application(spark, sf_dir).select(ID, "TARGET"), ID)
    return spark.createDataFrame([(c,) for c in prune.correlated_columns(table, ID, "TARGET", 0.98)], "column string")


_F_COLUMNS = ["INS_COUNT", "INS_DPD_MEAN", "INS_DPD_MAX", "INS_AMT_PAYMENT_SUM", "INS_LATE_RATE", "INS_3M_COUNT", "INS_12M_COUNT",
              "INS_12M_DPD_MEAN", "INS_6M_DPD_MAX", "INS_AMT_PAYMENT_MEAN"]
_F_OF = ("SELECT '{c}' AS \"column\", {i} AS place, round((sum(n * power(m - whole, 2)) / (count(*) - 1)) / "
         "nullif(sum(n * v) / (sum(n) - count(*)), 0), 6) AS f FROM (SELECT TARGET, count(*) AS n, avg(x) AS m, var_pop(x) AS v, "
         "any_value(whole) AS whole FROM (SELECT TARGET, x, avg(x) OVER () AS whole FROM (SELECT TARGET, coalesce({c}, "
         "(SELECT quantile_disc({c}, 0.5) FROM lab)) AS x FROM lab)) GROUP BY TARGET)")


@query(with_ctes([("ins", ORACLES["installments_table"]), ("app", _APP),
                  ("lab", f"SELECT app.TARGET, ins.* FROM ins JOIN app USING ({ID}) WHERE TARGET IS NOT NULL"),
                  ("f", " UNION ALL ".join(_F_OF.format(c=c, i=i) for i, c in enumerate(_F_COLUMNS)))],
                 'SELECT "column" FROM f ORDER BY coalesce(f, 0) DESC, place LIMIT 4'))
def selected_by_f_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = installments_features(role(spark, sf_dir, "installments_payments"))
    labelled = table.join(application(spark, sf_dir).select(ID, "TARGET"), ID).filter("TARGET IS NOT NULL")
    chosen = prune.select_k_best(labelled, _F_COLUMNS, "TARGET", 4)
    return spark.createDataFrame([(c,) for c in chosen], "column string")


_DEALT = "SELECT {c}, row_number() OVER (ORDER BY md5(doc_id || ':{s}')) AS r FROM labels"


@query(f"SELECT a.doc_id, b.toxic FROM ({_DEALT.format(c='doc_id', s=7)}) a JOIN ({_DEALT.format(c='toxic', s=8)}) b USING (r)")
def permuted_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "labels").select("doc_id", "toxic")
    return prune.permute_label(docs, "doc_id", "toxic", 7)


@query()
def rank_gauss_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = folded_application(spark, sf_dir, "EXT_SOURCE_1", "EXT_SOURCE_2", "AMT_CREDIT", "DAYS_BIRTH")
    return encode.rank_gauss(rows, train=F.col("fold_main") != 0, exclude=(ID, "TARGET", "fold_main"))


# ---------------------------------------------------------------- checks and joins


@query("SELECT c_custkey, CAST(len(list_distinct([a, b, c])) AS INT) AS n_distinct FROM (SELECT c_custkey, CAST(c_custkey % 2 AS INT) AS a, CAST(c_custkey % 3 AS INT) AS b, c_nationkey % 2 AS c FROM customer)")
def distinct_values_per_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "cast(c_custkey % 2 as int) a", "cast(c_custkey % 3 as int) b", "c_nationkey % 2 c")
    return checks.distinct_per_row(rows, ["a", "b", "c"]).select("c_custkey", "n_distinct")


@query("SELECT round(avg(CAST(a = b AS INT)), 6) + 0.0 AS identical_share, CAST(avg(CAST(a = b AS INT)) >= 0.01 AS INT) AS leaks FROM (SELECT c_custkey % 2 AS a, c_custkey % 3 AS b FROM customer)")
def identical_row_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "customer").selectExpr("c_custkey % 2 a", "c_custkey % 3 b")
    return rounded(checks.identical_share(rows, ["a", "b"]))


@query("SELECT count(*) FILTER (e IS NULL) AS only_left, count(*) FILTER (c IS NULL) AS only_right FROM "
       "(SELECT DISTINCT c_custkey AS c FROM customer) FULL JOIN (SELECT DISTINCT user_id AS e FROM events) ON c = e")
def stage_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.alignment(load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")),
                            load(spark, sf_dir, "events").select(F.col("user_id").alias("k")), "k")


@query("SELECT max(o_totalprice) / 1e6 AS oof_auc, CAST(max(o_totalprice) / 1e6 >= 0.45 AS INT) AS passed FROM orders "
       "WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def metric_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = load(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("timestamp"), (F.col("o_totalprice") / 1e6).alias("oof_auc"))
    return checks.gate(ledger, 0.45)


@query("SELECT round(avg(auc), 6) + 0.0 AS fold_mean, round(stddev_pop(auc), 2) + 0.0 AS \"fold_STD\" FROM "
       f"({auc_sql(_LABELLED_DOCS, 'n_chars', 'quality', 'lang')})")
def metric_over_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    aucs = rounded(rank.roc_auc(labelled_docs(spark, sf_dir), "n_chars", "quality", by="lang"))
    return rounded(checks.fold_metrics(aucs).withColumnRenamed("fold_std", "fold_STD"))


_JOIN_COLUMNS = ["INS_COUNT", "INS_DPD_MEAN", "INS_3M_COUNT", "POS_COUNT", "POS_SK_DPD_MAX"]


@query(f"SELECT a.{ID}, " + rounded_sql("a.AMT_CREDIT", "AMT_CREDIT") + ", INS_COUNT, INS_DPD_MEAN, INS_3M_COUNT, POS_COUNT, POS_SK_DPD_MAX "
       f"FROM ({_APP}) a LEFT JOIN ({ORACLES['installments_table']}) i ON a.{ID} = i.{ID} LEFT JOIN ({ORACLES['pos_table']}) p ON a.{ID} = p.{ID}")
def feature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    app = application(spark, sf_dir).select(ID, "AMT_CREDIT")
    joined = join_features(app, app, [
        installments_features(role(spark, sf_dir, "installments_payments")),
        pos_features(role(spark, sf_dir, "pos_cash_balance"))])
    return rounded(joined.select(ID, "AMT_CREDIT", *_JOIN_COLUMNS))


# ----------------------------------------------------------- blends and scored rows

# three stand-in models over every order: price, recency, key hash
_MODELS = ("price", "recent", "hash")
_PRED_SQL = ("SELECT o_orderkey, 'price' AS model, o_totalprice / 499979 AS pred FROM orders UNION ALL "
             "SELECT o_orderkey, 'recent', date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE)) / 5000 FROM orders UNION ALL "
             "SELECT o_orderkey, 'hash', (o_orderkey * 7919 % 1009) / 1009 FROM orders")


def order_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    made = {
        "price": F.col("o_totalprice") / 499979,
        "recent": F.datediff("o_orderdate", F.lit("1990-01-01").cast("date")) / 5000,
        "hash": (F.col("o_orderkey") * 7919 % 1009) / 1009,
    }
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), e.cast("double").alias("pred")) for m, e in made.items()])
    return orders.select("o_orderkey", F.explode(pairs).alias("p")).select("o_orderkey", "p.model", "p.pred")


@query(with_ctes([("p", _PRED_SQL), ("r", "SELECT o_orderkey, model, (rank() OVER (PARTITION BY model ORDER BY pred) - 1 + "
       "(count(*) OVER (PARTITION BY model, pred) - 1) / 2.0) / (count(*) OVER (PARTITION BY model) - 1) AS r FROM p")],
       "SELECT o_orderkey, " + rounded_sql("0.5 * max(r) FILTER (model = 'price') + 0.3 * max(r) FILTER (model = 'recent') + 0.2 * max(r) FILTER (model = 'hash')", "blend")
       + " FROM r GROUP BY o_orderkey"))
def weighted_rank_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rank_blend(order_predictions(spark, sf_dir), _MODELS, (0.5, 0.3, 0.2), "o_orderkey"))


@query(with_ctes([("p", _PRED_SQL)], "SELECT o_orderkey, " + ", ".join(
    rounded_sql(f"max(pred) FILTER (model = '{m}')", m) for m in _MODELS) + " FROM p GROUP BY o_orderkey"))
def predictions_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(wide_predictions(order_predictions(spark, sf_dir), _MODELS, "o_orderkey"))


_LINE_PRED = "SELECT l_orderkey, 'm' AS model, l_linenumber AS fold, floor(l_extendedprice) AS pred FROM lineitem"


@query(f"SELECT l_orderkey, model, round(avg(pred), 6) + 0.0 AS pred FROM ({_LINE_PRED}) GROUP BY l_orderkey, model")
def mean_prediction_over_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.lit("m").alias("model"), F.floor("l_extendedprice").cast("double").alias("pred"))
    return rounded(mean_over_folds(lines, "l_orderkey"))


@query("SELECT l_orderkey, " + ", ".join(f"max(l_quantity) FILTER (l_linenumber - 1 = {f}) AS fold_{f}" for f in range(5)) + " FROM lineitem GROUP BY l_orderkey")
def values_by_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = load(spark, sf_dir, "lineitem").withColumn("fold", F.col("l_linenumber") - 1)
    return fold_table(lines, "l_orderkey", "fold", "l_quantity", 5)


@query("SELECT o_orderkey AS SK_ID_CURR, o_totalprice / 499979 AS TARGET FROM orders")
def scored_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", ID)
    return scored_rows(orders.select(ID), orders.select(ID, (F.col("o_totalprice") / 499979).alias("pred")))


@query("SELECT c_custkey AS SK_ID_CURR, 0.0807 :: DOUBLE AS TARGET FROM customer WHERE c_custkey % 7 = 0")
def constant_score_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, score = folds.split_by_label(application(spark, sf_dir), "TARGET")
    return constant_scores(score, 0.0807)


# ----------------------------------------------------- drift, calibration, recency


@query("WITH d AS (SELECT n_chars AS v, doc_id NOT IN (SELECT doc_id FROM labels) AS fresh FROM documents), "
       "c AS (SELECT " + ", ".join(f"quantile_disc(v, {i / 10}) AS c{i}" for i in range(1, 10)) + " FROM d WHERE NOT fresh), "
       "b AS (SELECT CAST(" + " + ".join(f"CAST(c{i} < v AS INT)" for i in range(1, 10)) + " AS INT) AS bin, "
       "greatest(count(*) FILTER (NOT fresh) / sum(count(*) FILTER (NOT fresh)) OVER (), 1e-4) AS old, "
       "greatest(count(*) FILTER (fresh) / sum(count(*) FILTER (fresh)) OVER (), 1e-4) AS new FROM d, c GROUP BY 1) "
       "SELECT bin, round(old, 6) + 0.0 AS old, round(new, 6) + 0.0 AS new, round((new - old) * ln(new / old), 6) + 0.0 AS part FROM b")
def drift_of_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = load(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("known"))
    docs = load(spark, sf_dir, "documents").select("doc_id", "n_chars").join(labels, "doc_id", "left")
    return rounded(profile.population_stability(docs, "n_chars", F.col("known").isNull()))


@query("SELECT CAST(least(floor(s * 10), 9) AS INT) AS bin, count(*) AS n, round(avg(s), 6) + 0.0 AS mean_score, "
       "round(avg(y), 6) + 0.0 AS pos_rate FROM (SELECT o_totalprice / 499979 AS s, CAST(o_orderstatus = 'F' AS INT) AS y FROM orders) GROUP BY 1")
def score_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "orders").select(
        (F.col("o_totalprice") / 499979).alias("s"), (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    return rounded(profile.calibration(rows, "s", "y"))


@query(with_ctes([("pos", role_sql("pos_cash_balance"))], f"SELECT {ID}, " + rounded_sql(
    "sum(SK_DPD / (1 - MONTHS_BALANCE)) / nullif(sum(1 / (1 - MONTHS_BALANCE)), 0)", "POS_SK_DPD_RECENCY_WEIGHTED")
    + f" FROM pos GROUP BY {ID}"))
def recency_weighted_dpd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(recency_weighted_lateness(role(spark, sf_dir, "pos_cash_balance")))


# ---------------------------------------------------------------- all feature tables

_SIX = ("application_table", "bureau_table", "previous_table", "installments_table", "pos_table", "card_table")


@query(f"SELECT * FROM (SELECT {ID}, TARGET FROM ({_APP})) " + " ".join(f"LEFT JOIN ({ORACLES[n]}) USING ({ID})" for n in _SIX))
def joined_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label and all columns of all six builders, one row per entity."""
    application_, *others = (stored(QUERIES[n](spark, sf_dir)) for n in _SIX)
    return join_features(application(spark, sf_dir).select(ID, "TARGET"), application_, others)


# ------------------------------------------------------- groups beyond the builders

_STATUSES = ("Active", "Completed", "Signed")


@query(with_ctes([("card", role_sql("credit_card_balance"))], f"SELECT {ID}, " + ", ".join(rounded_sql(
    f"avg(CAST(coalesce(NAME_CONTRACT_STATUS = '{v}', false) AS INT))", f"CC_NAME_CONTRACT_STATUS_{v}_RATE") for v in _STATUSES)
    + f" FROM card GROUP BY {ID}"))
def card_category_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(extras.category_shares(role(spark, sf_dir, "credit_card_balance"), "NAME_CONTRACT_STATUS", _STATUSES, "CC"))


_CROSS = [*_PAYMENT_CTES, ("pos", role_sql("pos_cash_balance")), ("i", block_sql("pay", "INS", _PAYMENT_STATS)), ("p", block_sql("pos", "POS", _POS_STATS)),
          ("a", f"SELECT *, {_TERM} AS APP_CREDIT_TERM, {_MEAN} AS APP_EXT_MEAN FROM ({_APP})")]


@query(with_ctes(_CROSS, f"SELECT {ID}, " + ", ".join(rounded_sql(e, n) for n, e in {
    "X_INS_PAYMENT_TO_ANNUITY": "INS_AMT_PAYMENT_MEAN / nullif(AMT_ANNUITY, 0)", "X_INS_PAYMENT_TO_INCOME": "INS_AMT_PAYMENT_SUM / nullif(AMT_INCOME_TOTAL, 0)",
    "X_INS_LATE_BY_EXT_MEAN": "INS_LATE_RATE / nullif(APP_EXT_MEAN, 0)", "X_INS_DPD_BY_CREDIT_TERM": "INS_DPD_MEAN / nullif(APP_CREDIT_TERM, 0)",
    "X_INS_DPD_POS_DPD": "INS_DPD_MEAN * POS_SK_DPD_MEAN", "X_POS_DPD_BY_EXT_MEAN": "POS_SK_DPD_MEAN / nullif(APP_EXT_MEAN, 0)",
    "X_POS_COUNT_TO_INS_COUNT": "POS_COUNT / nullif(INS_COUNT, 0)"}.items())
    + f" FROM a LEFT JOIN i USING ({ID}) LEFT JOIN p USING ({ID})"))
def cross_table_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All terms for every customer, NULL where a table has no rows of theirs."""
    app = application_rows(application(spark, sf_dir))
    joined = app.join(installments_features(role(spark, sf_dir, "installments_payments")), ID, "left").join(
        pos_features(role(spark, sf_dir, "pos_cash_balance")), ID, "left")
    return rounded(joined.select(ID, *[e.alias(n) for n, e in extras.cross_terms(joined).items()]))


_SIDE_RANK = ("(rank() OVER (PARTITION BY fresh ORDER BY v) - 1 + (count(*) OVER (PARTITION BY fresh, v) - 1) / 2.0)"
              " / (count(*) OVER (PARTITION BY fresh) - 1)")


@query("SELECT event_id, fresh, " + rounded_sql(_SIDE_RANK, "v") + " FROM (SELECT event_id, CAST(event_id % 4 = 0 AS INT) AS fresh, "
       "CASE WHEN event_id % 4 = 0 THEN value + 500 ELSE value END AS v FROM events)")
def drift_rank_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column shifted on one side is found to drift and replaced by its rank."""
    rows = load(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 4 == 0).cast("int").alias("fresh"), F.when(
        F.col("event_id") % 4 == 0, F.col("value") + 500).otherwise(F.col("value")).alias("v"))
    return rounded(extras.rank_transform(rows, extras.drifting_columns(rows, ["v"], "fresh"), "fresh"))
