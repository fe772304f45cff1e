"""The given test tables read in the roles of the risk-data model.

Every role is a projection of whole given tables, written once as SQL
expressions both engines understand; ``DAYS(x)`` and ``MONTHS(x)`` stand for
the day offsets, whose functions differ by engine. Amounts are whole numbers
so that sums are exact in any order.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from riskfeat.plans import columns as names

LAST_SHIP_DAY = "2001-11-05"
LAST_EVENT_DAY = "2024-01-30"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _num(expr: str) -> str:
    return f"cast({expr} as double)"


def _unless(cond: str, expr: str) -> str:
    """The value, missing where ``cond`` holds."""
    return _num(f"case when {cond} then null else {expr} end")


_PRICE = "o_totalprice"
_K = "cast(regexp_extract(props, '[0-9]+', 0) as int)"

INSTALLMENTS = {
    "SK_ID_PREV": "l_orderkey",
    "SK_ID_CURR": "o_custkey",
    "NUM_INSTALMENT_VERSION": _num("nullif(l_linenumber, 3)"),
    "DAYS_INSTALMENT": _num("DAYS(l_shipdate)"),
    "DAYS_ENTRY_PAYMENT": _unless("l_quantity = 50", "DAYS(l_shipdate) + l_quantity - 25"),
    "AMT_INSTALMENT": _num("case when l_quantity = 1 then 0 else floor(l_extendedprice) end"),
    "AMT_PAYMENT": _num("floor(l_extendedprice * (1 - l_discount))"),
}

BUREAU_BALANCE = {
    "SK_ID_BUREAU": "l_orderkey",
    "MONTHS_BALANCE": _num("ceil(DAYS(l_shipdate) / 30)"),
    "STATUS": "nullif(substr('012345CXN', 1 + cast(l_quantity as int) % 9, 1), 'N')",
}

BUREAU = {
    "SK_ID_CURR": "o_custkey",
    "SK_ID_BUREAU": "o_orderkey",
    "CREDIT_ACTIVE": "case o_orderstatus when 'F' then 'Closed' when 'O' then 'Active' else 'Sold' end",
    "CREDIT_TYPE": "case o_orderpriority when '1-URGENT' then 'Consumer credit' "
                   "when '2-HIGH' then 'Credit card' when '3-MEDIUM' then 'Mortgage' "
                   "when '5-LOW' then 'Car loan' end",
    "CREDIT_CURRENCY": "case when o_orderkey % 4 = 0 then null else concat('currency ', o_orderkey % 4) end",
    "AMT_CREDIT_SUM": _num(f"floor({_PRICE})"),
    "AMT_CREDIT_SUM_DEBT": _num(
        f"case o_orderstatus when 'F' then 0 when 'O' then floor({_PRICE} * 0.4) end"),
    "AMT_CREDIT_SUM_LIMIT": _unless("o_orderpriority <> '2-HIGH'", f"floor({_PRICE} * 0.1)"),
    "AMT_CREDIT_SUM_OVERDUE": _num(f"case when o_orderkey % 10 = 0 then floor({_PRICE} * 0.01) else 0 end"),
    "AMT_CREDIT_MAX_OVERDUE": _unless("o_orderkey % 3 > 0", f"floor({_PRICE} * 0.02)"),
    "AMT_ANNUITY": _unless("o_orderkey % 5 = 0", f"floor({_PRICE} / 12)"),
    "DAYS_CREDIT": _num("DAYS(o_orderdate)"),
    "DAYS_CREDIT_ENDDATE": _num("DAYS(o_orderdate) + 365 * (1 + o_orderkey % 5)"),
    "DAYS_ENDDATE_FACT": _unless("o_orderstatus <> 'F'", "DAYS(o_orderdate) + 180 + o_orderkey % 90"),
    "DAYS_CREDIT_UPDATE": _num("DAYS(o_orderdate) + 30"),
    "CREDIT_DAY_OVERDUE": _num("greatest(o_orderkey % 23 - 20, 0)"),
    "CNT_CREDIT_PROLONG": _num("o_orderkey % 2"),
}

PREVIOUS = {
    "SK_ID_PREV": "o_orderkey",
    "SK_ID_CURR": "o_custkey",
    "AMT_ANNUITY": _unless("o_orderkey % 9 = 0", f"floor({_PRICE} / 12)"),
    "AMT_APPLICATION": _num(f"floor({_PRICE})"),
    "AMT_CREDIT": _num(f"case when o_orderkey % 50 = 0 then 0 else floor({_PRICE} * 0.9) end"),
    "AMT_DOWN_PAYMENT": _unless("o_orderkey % 3 > 0", f"floor({_PRICE} * 0.1)"),
    "AMT_GOODS_PRICE": _num(f"floor({_PRICE} * 0.85)"),
    "HOUR_APPR_PROCESS_START": _num("o_orderkey % 24"),
    "RATE_DOWN_PAYMENT": _unless("o_orderkey % 3 > 0", "o_orderkey % 100"),
    "RATE_INTEREST_PRIMARY": _unless("o_orderkey % 17 > 0", "o_orderkey % 13"),
    "RATE_INTEREST_PRIVILEGED": _unless("o_orderkey % 19 > 0", "o_orderkey % 11"),
    "DAYS_DECISION": _num("DAYS(o_orderdate)"),
    "CNT_PAYMENT": _num("6 * (1 + o_orderkey % 10)"),
    "DAYS_FIRST_DRAWING": _num("case when o_orderkey % 4 = 0 then 365243 else DAYS(o_orderdate) + 10 end"),
    "DAYS_FIRST_DUE": _num("DAYS(o_orderdate) + 30"),
    "DAYS_LAST_DUE_1ST_VERSION": _num("DAYS(o_orderdate) + 360"),
    "DAYS_LAST_DUE": _num("case when o_orderkey % 6 = 0 then 365243 else DAYS(o_orderdate) + 330 end"),
    "DAYS_TERMINATION": _num("case when o_orderkey % 6 = 0 then 365243 else DAYS(o_orderdate) + 340 end"),
    "NFLAG_INSURED_ON_APPROVAL": _num("o_orderkey % 2"),
    "NAME_CONTRACT_STATUS": "case when o_orderstatus = 'F' then 'Approved' when o_orderstatus = 'O' "
                            "then 'Refused' when o_orderkey % 7 = 0 then 'XNA' else 'Canceled' end",
    "NAME_CONTRACT_TYPE": "case o_orderpriority when '3-MEDIUM' then 'Consumer loans' "
                          "when '4-NOT SPECIFIED' then 'Revolving loans' when '5-LOW' then 'XNA' "
                          "else 'Cash loans' end",
    "NAME_PRODUCT_TYPE": "concat('product ', o_orderkey % 3)",
    "NAME_CASH_LOAN_PURPOSE": "case when o_orderkey % 5 = 0 then 'XAP' else concat('purpose ', o_orderkey % 8) end",
    "CHANNEL_TYPE": "concat('channel ', o_orderkey % 8)",
    "NAME_PORTFOLIO": "o_orderpriority",
    "NAME_YIELD_GROUP": "concat('yield ', o_orderkey % 4)",
    "CODE_REJECT_REASON": "case when o_orderkey % 2 = 0 then 'XAP' else concat('reason ', o_orderkey % 6) end",
}

_DPD = "case when event_type = 'error' then floor(value) else 0 end"
_DPD_DEF = "case when event_type = 'error' and value > 60 then floor(value) - 60 else 0 end"

POS = {
    "SK_ID_PREV": "user_id",
    "SK_ID_CURR": "user_id",
    "MONTHS_BALANCE": _num("MONTHS(ts)"),
    "CNT_INSTALMENT": _num("6 + event_id % 43"),
    "CNT_INSTALMENT_FUTURE": _unless("event_id % 10 = 0", "event_id % 37"),
    "SK_DPD": _num(_DPD),
    "SK_DPD_DEF": _num(_DPD_DEF),
    "NAME_CONTRACT_STATUS": "case event_type when 'view' then 'Active' when 'click' then 'Completed' "
                            "when 'signup' then 'Signed' when 'error' then 'Demand' end",
}

CARD = {
    "SK_ID_PREV": "user_id",
    "SK_ID_CURR": "user_id",
    "NAME_CONTRACT_STATUS": "case event_type when 'view' then 'Active' when 'click' then 'Completed' when 'error' then 'Signed' end",
    "MONTHS_BALANCE": _num("MONTHS(ts)"),
    "AMT_BALANCE": _num("floor(value * 50)"),
    "AMT_CREDIT_LIMIT_ACTUAL": _num(f"{_K} * 100"),
    **{
        c: _unless(f"event_id % {i + 5} = 0", f"floor(value * {i}) + {i}")
        for i, c in enumerate(names.CARD_NUMERICS[3:13], 1)
    },
    **{
        c: _unless(f"event_id % {i + 11} = 0", f"event_id % {i + 2}")
        for i, c in enumerate(names.CARD_NUMERICS[13:18], 1)
    },
    "SK_DPD": _num(_DPD),
    "SK_DPD_DEF": _num(_DPD_DEF),
}

_KEY = "c_custkey"
APPLICATION = {
    "SK_ID_CURR": _KEY,
    "TARGET": f"case when {_KEY} % 7 = 0 then null when c_acctbal < 0 then 1 else 0 end",
    "AMT_INCOME_TOTAL": _num(f"991 * (20 + {_KEY} % 97)"),
    "AMT_CREDIT": _num(f"case when {_KEY} % 53 = 0 then 0 else 997 * (50 + ({_KEY} * 31) % 503) end"),
    "AMT_ANNUITY": _unless(f"{_KEY} % 41 = 0", f"500 + ({_KEY} * 17) % 9973"),
    "AMT_GOODS_PRICE": _unless(f"{_KEY} % 43 = 0", f"887 * (50 + ({_KEY} * 31) % 503)"),
    "CNT_FAM_MEMBERS": _num(f"{_KEY} % 5"),
    "CNT_CHILDREN": _num(f"{_KEY} % 3"),
    "DAYS_BIRTH": _num(f"0 - 7000 - ({_KEY} * 37) % 18000"),
    "DAYS_EMPLOYED": _num(f"case when {_KEY} % 6 = 0 then 365243 else 0 - ({_KEY} * 53) % 9000 end"),
    "DAYS_REGISTRATION": _num(f"0 - ({_KEY} * 59) % 8000"),
    "DAYS_ID_PUBLISH": _num(f"0 - ({_KEY} * 61) % 6000"),
    "OWN_CAR_AGE": _unless(f"{_KEY} % 3 > 0", f"{_KEY} % 30"),
    "EXT_SOURCE_1": _unless(f"{_KEY} % 2 = 0", f"cast(100 + ({_KEY} * 7919) % 907 as double) / 1009"),
    "EXT_SOURCE_2": _unless(f"{_KEY} % 29 = 0", f"cast(100 + ({_KEY} * 104729) % 911 as double) / 1013"),
    "EXT_SOURCE_3": _unless(f"{_KEY} % 5 = 0", f"cast(100 + ({_KEY} * 1299709) % 919 as double) / 1019"),
    **{f"FLAG_DOCUMENT_{i}": f"cast(case when {_KEY} % {i + 1} = 0 then 1 else 0 end as int)" for i in range(2, 22)},
    **{
        f"FLAG_{c}": f"cast(case when {_KEY} % {i} = 0 then 0 else 1 end as int)"
        for i, c in enumerate(("MOBIL", "EMP_PHONE", "WORK_PHONE", "CONT_MOBILE", "PHONE", "EMAIL"), 2)
    },
    **{
        p + s: _unless(f"({_KEY} + {i}) % {j + 2} = 0", f"({_KEY} * {i + 3}) % 64")
        for i, p in enumerate(names.BUILDING_PREFIXES, 1)
        for j, s in enumerate(names.BUILDING_SUFFIXES)
    },
    "CODE_GENDER": f"case when {_KEY} % 50 = 0 then 'XNA' when {_KEY} % 3 = 0 then 'M' else 'F' end",
    "FLAG_OWN_CAR": f"case when {_KEY} % 3 = 0 then 'Y' else 'N' end",
    "FLAG_OWN_REALTY": f"case when {_KEY} % 4 = 0 then 'N' else 'Y' end",
    "NAME_CONTRACT_TYPE": f"case when {_KEY} % 10 = 0 then 'Revolving loans' else 'Cash loans' end",
    "NAME_TYPE_SUITE": f"case when {_KEY} % 13 = 0 then null else concat('suite ', {_KEY} % 4) end",
    "NAME_INCOME_TYPE": "c_mktsegment",
    "NAME_EDUCATION_TYPE": f"concat('education ', {_KEY} % 5)",
    "NAME_FAMILY_STATUS": f"case when {_KEY} % 31 = 0 then 'XNA' else concat('status ', {_KEY} % 4) end",
    "NAME_HOUSING_TYPE": f"concat('housing ', {_KEY} % 6)",
    "WEEKDAY_APPR_PROCESS_START": f"concat('day ', {_KEY} % 7)",
    "FONDKAPREMONT_MODE": f"case when {_KEY} % 2 = 0 then null else concat('fund ', {_KEY} % 3) end",
    "HOUSETYPE_MODE": "r_name",
    "WALLSMATERIAL_MODE": f"case when {_KEY} % 2 = 1 then null else concat('wall ', {_KEY} % 6) end",
    "EMERGENCYSTATE_MODE": f"case when {_KEY} % 40 = 0 then 'Yes' else 'No' end",
    "ORGANIZATION_TYPE": f"case when {_KEY} % 6 = 0 then 'XNA' else n_name end",
    "OCCUPATION_TYPE": f"case when {_KEY} % 9 = 0 then null else concat('occupation ', ({_KEY} * 7) % 18) end",
}

_LINES = ("lineitem", "orders", "l_orderkey = o_orderkey")
ROLES: dict[str, tuple[tuple[str, ...], dict[str, str]]] = {
    "installments_payments": (_LINES, INSTALLMENTS),
    "bureau_balance": (("lineitem",), BUREAU_BALANCE),
    "bureau": (("orders",), BUREAU),
    "previous_application": (("orders",), PREVIOUS),
    "pos_cash_balance": (("events",), POS),
    "credit_card_balance": (("events",), CARD),
    "application": (
        ("customer", "nation", "c_nationkey = n_nationkey", "region", "n_regionkey = r_regionkey"),
        APPLICATION,
    ),
}


def _days(expr: str, engine: str) -> str:
    # written for each engine's own date difference: both count later minus earlier
    for macro, day in (("DAYS", LAST_SHIP_DAY), ("MONTHS", LAST_EVENT_DAY)):
        text = (
            rf"datediff(\1, DATE '{day}')" if engine == "spark"
            else rf"date_diff('day', DATE '{day}', CAST(\1 AS DATE))"
        )
        expr = re.sub(rf"\b{macro}\((\w+)\)", text, expr)
    return expr


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables, columns = ROLES[name]
    df = load(spark, sf_dir, tables[0])
    for table, condition in zip(tables[1::2], tables[2::2]):
        left, right = condition.split(" = ")
        other = load(spark, sf_dir, table)
        df = df.join(other, df[left] == other[right])
    return df.selectExpr(*[f"{_days(e, 'spark')} AS {c}" for c, e in columns.items()])


def role_sql(name: str) -> str:
    tables, columns = ROLES[name]
    source = tables[0] + "".join(
        f" JOIN {t} ON {c}" for t, c in zip(tables[1::2], tables[2::2])
    )
    body = ", ".join(f"{_days(e, 'duckdb')} AS {c}" for c, e in columns.items())
    return f"SELECT {body} FROM {source}"
