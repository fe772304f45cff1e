"""Column lists, category values and windows the table builders work on.

Everything in this file is a fixed value of the data model: the names and
codes must be exactly these for the feature names and values to come out right.
"""

# ---- application ----
LOW_CARD_CATEGORIES = (
    "CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY", "NAME_CONTRACT_TYPE", "NAME_TYPE_SUITE",
    "NAME_INCOME_TYPE", "NAME_EDUCATION_TYPE", "NAME_FAMILY_STATUS", "NAME_HOUSING_TYPE",
    "WEEKDAY_APPR_PROCESS_START", "FONDKAPREMONT_MODE", "HOUSETYPE_MODE", "WALLSMATERIAL_MODE",
    "EMERGENCYSTATE_MODE",
)
HIGH_CARD_CATEGORIES = ("ORGANIZATION_TYPE", "OCCUPATION_TYPE")
CATEGORIES = LOW_CARD_CATEGORIES + HIGH_CARD_CATEGORIES
BUILDING_SUFFIXES = ("_AVG", "_MEDI", "_MODE")
BUILDING_PREFIXES = (
    "APARTMENTS", "BASEMENTAREA", "YEARS_BEGINEXPLUATATION", "YEARS_BUILD", "COMMONAREA",
    "ELEVATORS", "ENTRANCES", "FLOORSMAX", "FLOORSMIN", "LANDAREA", "LIVINGAPARTMENTS",
    "LIVINGAREA", "NONLIVINGAPARTMENTS", "NONLIVINGAREA",
)
EXTERNAL_SCORES = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")

# ---- bureau ----
BUREAU_NUMERICS = (
    "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE",
    "AMT_CREDIT_MAX_OVERDUE", "AMT_ANNUITY", "DAYS_CREDIT", "DAYS_CREDIT_ENDDATE",
    "DAYS_ENDDATE_FACT", "DAYS_CREDIT_UPDATE", "CREDIT_DAY_OVERDUE", "CNT_CREDIT_PROLONG",
)
BALANCE_STATUSES = ("0", "1", "2", "3", "4", "5", "C", "X")
CREDIT_TYPES = ("Consumer credit", "Credit card", "Mortgage", "Car loan", "Microloan")
CREDIT_TYPE_NUMERICS = ("AMT_CREDIT_SUM", "DAYS_CREDIT", "AMT_CREDIT_SUM_DEBT")
BUREAU_CATEGORIES = ("CREDIT_TYPE", "CREDIT_CURRENCY", "CREDIT_ACTIVE")

# ---- previous applications ----
PREVIOUS_NUMERICS = (
    "AMT_ANNUITY", "AMT_APPLICATION", "AMT_CREDIT", "AMT_DOWN_PAYMENT", "AMT_GOODS_PRICE",
    "HOUR_APPR_PROCESS_START", "RATE_DOWN_PAYMENT", "RATE_INTEREST_PRIMARY",
    "RATE_INTEREST_PRIVILEGED", "DAYS_DECISION", "CNT_PAYMENT", "DAYS_FIRST_DRAWING",
    "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION",
    "NFLAG_INSURED_ON_APPROVAL",
)
CONTRACT_TYPES = {
    "Cash loans": "PREV_CASH", "Revolving loans": "PREV_REVOLV", "Consumer loans": "PREV_CONSUMER",
}
CONTRACT_TYPE_NUMERICS = ("AMT_CREDIT", "AMT_ANNUITY", "DAYS_DECISION")
PREVIOUS_CATEGORIES = (
    "NAME_CONTRACT_TYPE", "NAME_PRODUCT_TYPE", "NAME_CASH_LOAN_PURPOSE", "CHANNEL_TYPE",
    "NAME_PORTFOLIO", "NAME_YIELD_GROUP", "CODE_REJECT_REASON",
)

# ---- payments: day windows are open at the threshold ----
PAYMENT_WINDOWS = {"1M": -30, "3M": -90, "6M": -180, "12M": -365}

# ---- monthly balances: month windows include the threshold ----
MONTH_WINDOWS = {"3M": -3, "6M": -6, "12M": -12}
POS_NUMERICS = (
    "MONTHS_BALANCE", "CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE", "SK_DPD", "SK_DPD_DEF",
)
POS_STATUSES = ("Active", "Completed", "Signed", "Demand", "Returned to the store")
CARD_NUMERICS = (
    "MONTHS_BALANCE", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_DRAWINGS_ATM_CURRENT",
    "AMT_DRAWINGS_CURRENT", "AMT_DRAWINGS_OTHER_CURRENT", "AMT_DRAWINGS_POS_CURRENT",
    "AMT_INST_MIN_REGULARITY", "AMT_PAYMENT_CURRENT", "AMT_PAYMENT_TOTAL_CURRENT",
    "AMT_RECEIVABLE_PRINCIPAL", "AMT_RECIVABLE", "AMT_TOTAL_RECEIVABLE",
    "CNT_DRAWINGS_ATM_CURRENT", "CNT_DRAWINGS_CURRENT", "CNT_DRAWINGS_OTHER_CURRENT",
    "CNT_DRAWINGS_POS_CURRENT", "CNT_INSTALMENT_MATURE_CUM", "SK_DPD", "SK_DPD_DEF",
)

# ---- training ----
NEIGHBOUR_COLUMNS = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "APP_CREDIT_TERM")
STACK_COLUMNS = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3", "DAYS_BIRTH", "DAYS_EMPLOYED")
POSITIVE_WEIGHT = 11.39


def tag(value: str) -> str:
    """Category value as it appears inside a column name."""
    return value.upper().replace(" ", "_")
