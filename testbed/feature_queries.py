"""The table builders on the given tables, with SQL written as filter, group, left join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskfeat.plans import columns as names
from riskfeat.plans.balances import card_features, pos_features
from riskfeat.plans.bureau import balance_per_loan, bureau_features, recency_gaps
from riskfeat.plans.installments import installments_features
from riskfeat.plans.previous import previous_features
from riskfeat.sources.tables import CATALOG, clean
from testbed.registry import query, rounded, with_ctes
from testbed.roles import role, role_sql

_FN = {"mean": "avg({c})", "max": "max({c})", "min": "min({c})", "std": "stddev_samp({c})",
       "sum": "coalesce(sum({c}), 0)"}
ID = "SK_ID_CURR"


def agg_sql(c: str, fns: tuple[str, ...], label: str | None = None) -> dict[str, str]:
    return {f"{label or c}_{fn.upper()}": _FN[fn].format(c=c) for fn in fns}


def flag_sql(condition: str, total: str, rate: str) -> dict[str, str]:
    return {
        total: f"CAST(coalesce(sum(CAST({condition} AS INT)), 0) AS BIGINT)",
        rate: f"avg(CAST({condition} AS INT))",
    }


def block_sql(source: str, prefix: str, stats: dict[str, str], where: str = "true", key: str = ID) -> str:
    """One block the plain way: filter, then group."""
    outs = ", ".join(f'{e} AS "{prefix}_{s}"' for s, e in stats.items())
    return f"SELECT {key}, {outs} FROM {source} WHERE {where} GROUP BY {key}"


def distinct_sql(source: str, outs: dict[str, str]) -> str:
    cols = ", ".join(
        f'count(DISTINCT {c}) + max(CAST({c} IS NULL AS INT)) AS "{o}"' for o, c in outs.items()
    )
    return f"SELECT {ID}, {cols} FROM {source} GROUP BY {ID}"


def report_sql(ctes: list[tuple[str, str]], blocks: list[str], doubles: set[str] | None = None,
               extra: dict[str, str] | None = None) -> str:
    """Left-join the blocks onto the first and round doubles like the Spark side.

    Column kinds are told by name: counts and flag totals are whole numbers.
    """
    named = [(f"b{i}", b) for i, b in enumerate(blocks)]
    joins = "b0" + "".join(f" LEFT JOIN {n} USING ({ID})" for n, _ in named[1:])
    inner = f"SELECT *{''.join(f', {e} AS {c}' for c, e in (extra or {}).items())} FROM {joins}"
    whole = r"^(?:.*_COUNT|.*_CNT|.*_NUNIQUE|BUR_BB_.*(?:COUNT|CNT)_(?:MAX|SUM)|POS_.*FLAG_SUM|CC_(?:[0-9]+M_)?(?:OVERLIMIT|DRAWING|DPD|DPD_DEF)_SUM)$"
    std = r".*_STD.*"
    return with_ctes([*ctes, *named, ("joined", inner)], (
        f"SELECT {ID}, "
        f"CAST(COLUMNS('{whole}') AS BIGINT), "
        f"round(CAST(COLUMNS(lambda c: regexp_matches(c, '{std}')) AS DOUBLE), 2) + 0.0, "
        f"round(CAST(COLUMNS(lambda c: c <> '{ID}' AND NOT regexp_matches(c, '{whole}') "
        f"AND NOT regexp_matches(c, '{std}')) AS DOUBLE), 6) + 0.0 FROM joined"
    ))


# ------------------------------------------------------------ payments (D04)

_PAYMENT_ROWS = (
    "SELECT *, greatest(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT, 0) AS DPD, "
    "greatest(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT, 0) AS DBD, "
    "AMT_PAYMENT / nullif(AMT_INSTALMENT, 0) AS PAYMENT_PERC, "
    "AMT_INSTALMENT - AMT_PAYMENT AS PAYMENT_DIFF FROM ins"
)
_PAYMENT_STATS = {
    "COUNT": "count(*)", **agg_sql("DPD", ("mean", "max", "sum", "std")),
    **agg_sql("DBD", ("mean", "max")), **agg_sql("PAYMENT_PERC", ("mean", "min", "max")),
    **agg_sql("PAYMENT_DIFF", ("mean", "sum", "max")), **flag_sql("(DPD > 0)", "LATE_COUNT", "LATE_RATE"),
    **agg_sql("AMT_INSTALMENT", ("mean", "sum")), **agg_sql("AMT_PAYMENT", ("mean", "sum")),
}
_PAYMENT_CTES = [("ins", role_sql("installments_payments")), ("pay", _PAYMENT_ROWS)]


@query(report_sql(_PAYMENT_CTES, [
    block_sql("pay", "INS", {**_PAYMENT_STATS, **agg_sql("DAYS_INSTALMENT", ("min", "max"))}),
    distinct_sql("pay", {"INS_NUM_VERSION_NUNIQUE": "NUM_INSTALMENT_VERSION"}),
    *[block_sql("pay", f"INS_{w}", _PAYMENT_STATS, f"DAYS_INSTALMENT > {t}")
      for w, t in names.PAYMENT_WINDOWS.items()],
]))
def installments_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(installments_features(role(spark, sf_dir, "installments_payments")))


# -------------------------------------------------------------- bureau (D02)

_BALANCE_STATS = {
    "COUNT": "count(*)", **agg_sql("MONTHS_BALANCE", ("min", "max", "mean"), "MONTHS"),
}
for _s in names.BALANCE_STATUSES:
    _BALANCE_STATS.update(flag_sql(f"(STATUS = '{_s}')", f"STATUS_{_s}_CNT", f"STATUS_{_s}_PCT"))
_BB = block_sql("balance", "BUR_BB", _BALANCE_STATS, key="SK_ID_BUREAU")
_BB_COLUMNS = [f"BB_{s}" for s in _BALANCE_STATS]


@query(with_ctes(
    [("balance", role_sql("bureau_balance")), ("b", _BB)],
    "SELECT SK_ID_BUREAU, CAST(COLUMNS('.*_(COUNT|CNT)') AS BIGINT), "
    "round(CAST(COLUMNS('.*_(PCT|MIN|MAX|MEAN)') AS DOUBLE), 6) + 0.0 FROM b",
))
def balance_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(balance_per_loan(role(spark, sf_dir, "bureau_balance")))


_SHORT = ("mean", "max", "sum")
_FULL = ("mean", "max", "min", "sum", "std")


def _numeric(cols: tuple[str, ...], fns: tuple[str, ...]) -> dict[str, str]:
    return {k: v for c in cols for k, v in agg_sql(c, fns).items()}


_GAPS = (
    f"SELECT {ID}, max(DAYS_CREDIT) AS BUR_RECENCY_DAYS_CREDIT_MAX, "
    "min(DAYS_CREDIT) AS BUR_RECENCY_DAYS_CREDIT_MIN, "
    "max(DAYS_CREDIT) - min(DAYS_CREDIT) AS BUR_RECENCY_DAYS_CREDIT_RANGE, "
    "avg(gap) AS BUR_RECENCY_AVG_CREDIT_GAP, stddev_samp(gap) AS BUR_RECENCY_STD_CREDIT_GAP "
    "FROM (SELECT *, DAYS_CREDIT - lag(DAYS_CREDIT) OVER (PARTITION BY SK_ID_CURR "
    "ORDER BY DAYS_CREDIT DESC, SK_ID_BUREAU) AS gap FROM loans) GROUP BY SK_ID_CURR"
)


@query(with_ctes(
    [("loans", role_sql("bureau")), ("gaps", _GAPS)],
    f"SELECT {ID}, round(COLUMNS('.*_(MAX|MIN|RANGE|AVG_CREDIT_GAP)'), 6) + 0.0, "
    "round(BUR_RECENCY_STD_CREDIT_GAP, 2) + 0.0 AS BUR_RECENCY_STD_CREDIT_GAP FROM gaps",
))
def loan_recency_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(recency_gaps(role(spark, sf_dir, "bureau")))


@query(report_sql(
    [("balance", role_sql("bureau_balance")), ("bb", _BB), ("loans", role_sql("bureau")),
     ("enriched", "SELECT * FROM loans LEFT JOIN bb USING (SK_ID_BUREAU)")],
    [
        block_sql("enriched", "BUR", {
            "COUNT": "count(*)", **_numeric(names.BUREAU_NUMERICS, _FULL),
            **{k: v for c in _BB_COLUMNS
               for k, v in agg_sql(f"BUR_{c}", _SHORT, c).items()},
        }),
        *[block_sql("enriched", f"BUR_{v.upper()}",
                    {"COUNT": "count(*)", **_numeric(names.BUREAU_NUMERICS, _SHORT)}, f"CREDIT_ACTIVE = '{v}'")
          for v in ("Active", "Closed")],
        *[block_sql("enriched", f"BUR_TYPE_{names.tag(t)}",
                    {"COUNT": "count(*)", **_numeric(names.CREDIT_TYPE_NUMERICS, ("mean", "max"))},
                    f"CREDIT_TYPE = '{t}'") for t in names.CREDIT_TYPES],
        distinct_sql("enriched", {f"BUR_CAT_{c}_NUNIQUE": c for c in names.BUREAU_CATEGORIES}),
        _GAPS,
    ],
    extra={
        "BUR_DEBT_TO_CREDIT_RATIO": "BUR_AMT_CREDIT_SUM_DEBT_SUM / nullif(BUR_AMT_CREDIT_SUM_SUM, 0)",
        "BUR_ACTIVE_RATIO": "BUR_ACTIVE_COUNT / nullif(BUR_COUNT, 0)",
        "BUR_OVERDUE_TO_DEBT_RATIO":
            "BUR_AMT_CREDIT_SUM_OVERDUE_SUM / nullif(BUR_AMT_CREDIT_SUM_DEBT_SUM, 0)",
    },
))
def bureau_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(bureau_features(role(spark, sf_dir, "bureau"), role(spark, sf_dir, "bureau_balance")))


# ------------------------------------------------------------ previous (D03)


def cleaned_sql(name: str) -> str:
    spec = CATALOG[name]
    days = ", ".join(f"nullif({c}, 365243) AS {c}" for c in spec.day_columns)
    tokens = ", ".join(
        f"CASE WHEN {c} IN ('XNA', 'XAP') THEN NULL ELSE {c} END AS {c}" for c in spec.token_columns
    )
    return f"SELECT * REPLACE ({days}, {tokens}) FROM ({role_sql('application' if name.startswith('application') else name)})"


_PRIOR_ROWS = (
    "SELECT *, AMT_APPLICATION / nullif(AMT_CREDIT, 0) AS granted, "
    "AMT_DOWN_PAYMENT / nullif(AMT_CREDIT, 0) AS down FROM prior"
)


@query(report_sql(
    [("prior", cleaned_sql("previous_application")), ("rows_", _PRIOR_ROWS)],
    [
        block_sql("rows_", "PREV", {
            "COUNT": "count(*)", **_numeric(names.PREVIOUS_NUMERICS, _FULL),
            **agg_sql("granted", ("mean", "max", "min"), "APP_CREDIT_PERC"),
            **agg_sql("down", ("mean", "max"), "DOWNPAYMENT_RATIO"),
            "REFUSAL_RATE": "avg(CAST(NAME_CONTRACT_STATUS = 'Refused' AS INT))",
            "APPROVAL_RATE": "avg(CAST(NAME_CONTRACT_STATUS = 'Approved' AS INT))",
        }),
        *[block_sql("rows_", f"PREV_{v.upper()}",
                    {"COUNT": "count(*)", **_numeric(names.PREVIOUS_NUMERICS, _SHORT)},
                    f"NAME_CONTRACT_STATUS = '{v}'") for v in ("Approved", "Refused")],
        *[block_sql("rows_", p,
                    {"COUNT": "count(*)", **_numeric(names.CONTRACT_TYPE_NUMERICS, ("mean", "max"))},
                    f"NAME_CONTRACT_TYPE = '{v}'") for v, p in names.CONTRACT_TYPES.items()],
        distinct_sql("rows_", {f"PREV_CAT_{c}_NUNIQUE": c for c in names.PREVIOUS_CATEGORIES}),
    ],
    extra={"PREV_APPROVED_TO_REFUSED_RATIO": "PREV_APPROVED_COUNT / (PREV_REFUSED_COUNT + 1)"},
))
def previous_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    prior = clean(role(spark, sf_dir, "previous_application"), CATALOG["previous_application"])
    return rounded(previous_features(prior))


# --------------------------------------------------------- POS, card (D05, D06)

_POS_STATS = {
    "COUNT": "count(*)", **_numeric(names.POS_NUMERICS, _FULL),
    **flag_sql("(SK_DPD > 0)", "DPD_FLAG_SUM", "DPD_FLAG_RATE"),
    **flag_sql("(SK_DPD_DEF > 0)", "DPD_DEF_FLAG_SUM", "DPD_DEF_FLAG_RATE"),
}
_POS_SHARES: dict[str, str] = {}
for _s in names.POS_STATUSES:
    _t = f"STATUS_{_s.upper().replace(' ', '_')}"
    _POS_SHARES.update(flag_sql(f"(NAME_CONTRACT_STATUS = '{_s}')", f"{_t}_CNT", f"{_t}_RATE"))


@query(report_sql([("pos", role_sql("pos_cash_balance"))], [
    block_sql("pos", "POS", {**_POS_STATS, **_POS_SHARES}),
    distinct_sql("pos", {"POS_STATUS_NUNIQUE": "NAME_CONTRACT_STATUS"}),
    *[block_sql("pos", f"POS_{w}", _POS_STATS, f"MONTHS_BALANCE >= {t}")
      for w, t in names.MONTH_WINDOWS.items()],
]))
def pos_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pos_features(role(spark, sf_dir, "pos_cash_balance")))


_CARD_STATS = {
    "COUNT": "count(*)", **_numeric(names.CARD_NUMERICS, _FULL),
    **agg_sql("utilisation", ("mean", "max", "min"), "UTILIZATION"),
    **flag_sql("(AMT_BALANCE > AMT_CREDIT_LIMIT_ACTUAL)", "OVERLIMIT_SUM", "OVERLIMIT_RATE"),
    **flag_sql("(CNT_DRAWINGS_CURRENT > 0)", "DRAWING_SUM", "DRAWING_RATE"),
    **flag_sql("(SK_DPD > 0)", "DPD_SUM", "DPD_RATE"),
    **flag_sql("(SK_DPD_DEF > 0)", "DPD_DEF_SUM", "DPD_DEF_RATE"),
}


@query(report_sql(
    [("raw", role_sql("credit_card_balance")),
     ("card", "SELECT *, AMT_BALANCE / nullif(AMT_CREDIT_LIMIT_ACTUAL, 0) AS utilisation FROM raw")],
    [block_sql("card", "CC", _CARD_STATS),
     *[block_sql("card", f"CC_{w}", _CARD_STATS, f"MONTHS_BALANCE >= {t}")
       for w, t in names.MONTH_WINDOWS.items()]],
))
def card_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(card_features(role(spark, sf_dir, "credit_card_balance")))
