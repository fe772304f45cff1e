"""Raw tables: schemas, cleaning rules, CSV and parquet readers, ingest job.

Schemas are explicit: inference would read every file twice and could give
each file another type. Columns a schema does not name can still be read with
``infer=True``.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from riskfeat.functions.columns import numeric_columns, present, string_columns
from riskfeat.functions.rows import finite_or_null
from riskfeat.operators.lookup import attach

ENTITY = "SK_ID_CURR"
LABEL = "TARGET"
LOAN = "SK_ID_BUREAU"
PRIOR = "SK_ID_PREV"

# ---- fixed values: sentinel, missing tokens and the columns they apply to ----
DAY_SENTINEL = 365243
MISSING_TOKENS = ("XNA", "XAP")
APPLICATION_DAY_COLUMNS = ("DAYS_EMPLOYED",)
APPLICATION_TOKEN_COLUMNS = ("CODE_GENDER", "ORGANIZATION_TYPE", "NAME_FAMILY_STATUS")
PREVIOUS_DAY_COLUMNS = (
    "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE",
    "DAYS_TERMINATION",
)
PREVIOUS_TOKEN_COLUMNS = ("NAME_CONTRACT_STATUS", "NAME_CASH_LOAN_PURPOSE", "CODE_REJECT_REASON")


HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class Table:
    """One raw table: where it lies, its key types and its cleaning rules."""

    file: str
    longs: tuple[str, ...]
    strings: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    day_columns: tuple[str, ...] = ()
    token_columns: tuple[str, ...] = ()
    partition_key: str = ENTITY

    def schema(self) -> StructType:
        kinds = [(self.longs, LongType()), (self.strings, StringType()), (self.doubles, DoubleType())]
        return StructType([StructField(n, t) for names, t in kinds for n in names])


_APPLICATION = dict(
    longs=(ENTITY,), day_columns=APPLICATION_DAY_COLUMNS, token_columns=APPLICATION_TOKEN_COLUMNS
)

CATALOG: dict[str, Table] = {
    "application_train": Table("application_train.csv", **_APPLICATION),
    "application_test": Table("application_test.csv", **_APPLICATION),
    "bureau": Table("bureau.csv", longs=(ENTITY, LOAN)),
    "bureau_balance": Table(
        "bureau_balance.csv", longs=(LOAN, "MONTHS_BALANCE"), strings=("STATUS",),
        partition_key=LOAN,
    ),
    "previous_application": Table(
        "previous_application.csv", longs=(PRIOR, ENTITY), day_columns=PREVIOUS_DAY_COLUMNS,
        token_columns=PREVIOUS_TOKEN_COLUMNS,
    ),
    "installments_payments": Table(
        "installments_payments.csv", longs=(PRIOR, ENTITY),
        doubles=("NUM_INSTALMENT_VERSION", "NUM_INSTALMENT_NUMBER", "DAYS_INSTALMENT",
                 "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT"),
    ),
    "pos_cash_balance": Table(
        "POS_CASH_balance.csv", longs=(PRIOR, ENTITY, "MONTHS_BALANCE"),
        doubles=("CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE", "SK_DPD", "SK_DPD_DEF"),
        strings=("NAME_CONTRACT_STATUS",),
    ),
    "credit_card_balance": Table(
        "credit_card_balance.csv", longs=(PRIOR, ENTITY, "MONTHS_BALANCE")
    ),
}


def table(name: str) -> Table:
    if name not in CATALOG:
        raise KeyError(f"unknown table {name!r}; known: {sorted(CATALOG)}")
    return CATALOG[name]


# ---------------------------------------------------------------- cleaning


def sentinel_to_null(df: DataFrame, columns: Iterable[str], sentinel: float = DAY_SENTINEL) -> DataFrame:
    fixes = {c: F.nullif(F.col(c), F.lit(sentinel)) for c in present(df, columns)}
    return df.withColumns(fixes) if fixes else df


def tokens_to_null(
    df: DataFrame, columns: Iterable[str], tokens: Iterable[str] = MISSING_TOKENS
) -> DataFrame:
    tokens = list(tokens)
    fixes = {
        c: F.when(F.col(c).isin(tokens), F.lit(None)).otherwise(F.col(c))
        for c in present(df, columns)
    }
    return df.withColumns(fixes) if fixes else df


def scrub_non_finite(df: DataFrame) -> DataFrame:
    """NaN and infinities of every floating column become NULL."""
    fixes = {
        f.name: finite_or_null(f.name) for f in df.schema.fields
        if f.dataType.typeName() in ("double", "float")
    }
    return df.withColumns(fixes) if fixes else df


def fill_missing_category(
    df: DataFrame, columns: Iterable[str] | None = None, token: str = "__missing__"
) -> DataFrame:
    names = string_columns(df) if columns is None else present(df, columns)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(token)) for c in names}) if names else df


def clean(df: DataFrame, spec: Table) -> DataFrame:
    out = sentinel_to_null(df, spec.day_columns)
    out = tokens_to_null(out, spec.token_columns)
    return scrub_non_finite(out)


# Largest magnitude each narrow type holds.
_INTEGER_TYPES = (("tinyint", -128, 127), ("smallint", -32768, 32767),
                  ("int", -2147483648, 2147483647))
_FLOAT_MAX = 3.4028234663852886e38


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast every numeric column to the smallest type its range fits.

    One min/max pass over the table decides; the ranges are the only thing
    that reaches the driver.
    """
    names = numeric_columns(df)
    if not names:
        return df
    row = df.agg(
        *[F.min(c).alias(f"lo_{i}") for i, c in enumerate(names)],
        *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(names)],
    ).first()
    kinds = dict(df.dtypes)
    casts = {}
    for i, c in enumerate(names):
        lo, hi = row[f"lo_{i}"], row[f"hi_{i}"]
        if kinds[c] in ("tinyint", "smallint", "int", "bigint"):
            fit = next((t for t, a, b in _INTEGER_TYPES if lo is not None and a <= lo and hi <= b), None)
            if fit and fit != kinds[c]:
                casts[c] = F.col(c).cast(fit)
        elif kinds[c] == "double" and lo is not None and -_FLOAT_MAX <= lo and hi <= _FLOAT_MAX:
            casts[c] = F.col(c).cast("float")
    return df.withColumns(casts) if casts else df


# ----------------------------------------------------------------- sources


def read_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, infer: bool = False
) -> DataFrame:
    """CSV with a header; either a schema or an explicit wish to infer one."""
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    if not infer:
        raise ValueError("give a schema, or infer=True to pay a second pass over the file")
    return reader.option("inferSchema", True).csv(path)


def read_raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A raw table, cleaned.

    The three wide tables carry columns beyond those their spec names; their
    types are inferred, keys are fixed to long.
    """
    spec = table(name)
    path = f"{folder}/{spec.file}"
    if spec.doubles or spec.strings:
        return clean(read_csv(spark, path, spec.schema()), spec)
    df = read_csv(spark, path, infer=True)
    return clean(df.withColumns({c: F.col(c).cast("bigint") for c in spec.longs}), spec)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table written by ``write_table``; a clear message when it is missing."""
    path = f"{folder}/{name}.parquet"
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path):
        raise FileNotFoundError(f"no table at {path}: run the ingest or feature job first")
    return spark.read.parquet(path)


def write_table(df: DataFrame, folder: str, name: str) -> str:
    """Parquet, snappy, overwriting what an earlier run left."""
    path = f"{folder}/{name}.parquet"
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def cluster_rows(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows of a key next to each other, so later aggregates combine before shuffling.

    Scattered rows leave map-side combine nothing to combine, and a wide
    aggregate would then shuffle one accumulator row per input row. A key with
    more than ``hot_rows`` rows is spread over several partitions instead of
    filling one.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > hot_rows)
    spread = attach(df, counts, key, weight="_rows")
    pieces = F.ceil(F.coalesce(F.col("_rows"), F.lit(1)) / F.lit(hot_rows)).cast("bigint")
    salted = spread.withColumn("_piece", F.pmod(F.monotonically_increasing_id(), pieces))  # equal rows part too
    return salted.repartition(key, "_piece").sortWithinPartitions(key).drop("_rows", "_piece")


def ingest(
    spark: SparkSession, raw: str, out: str, names: Iterable[str] = tuple(CATALOG), cluster: bool = True
) -> list[str]:
    """Read, clean, cluster by key and write every raw table; running it again overwrites."""
    written = []
    for name in names:
        df = read_raw(spark, raw, name)
        written.append(write_table(cluster_rows(df, table(name).partition_key) if cluster else df, out, name))
    return written
