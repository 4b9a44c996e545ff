"""Raw table schemas and readers.

Schemas are declared, so no inference job runs and the month status stays a string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# File names and column names of the raw tables.
FILES = {
    "train": "application_train.csv",
    "test": "application_test.csv",
    "bureau": "bureau.csv",
    "bureau_bal": "bureau_balance.csv",
    "prev": "previous_application.csv",
    "pos_cash": "POS_CASH_balance.csv",
    "credit_card": "credit_card_balance.csv",
    "installments": "installments_payments.csv",
    "description": "columns_description.csv",
    "submission": "sample_submission.csv",
}

# Columns the feature definitions read, as DDL. Columns found only in the file header are
# typed by ``extend_schema``.
SCHEMAS = {
    "train": """SK_ID_CURR long, TARGET int, NAME_CONTRACT_TYPE string, CODE_GENDER string,
        FLAG_OWN_CAR string, FLAG_OWN_REALTY string, CNT_CHILDREN int, AMT_INCOME_TOTAL double,
        AMT_CREDIT double, AMT_ANNUITY double, AMT_GOODS_PRICE double, NAME_INCOME_TYPE string,
        NAME_EDUCATION_TYPE string, NAME_FAMILY_STATUS string, NAME_HOUSING_TYPE string,
        DAYS_BIRTH int, DAYS_EMPLOYED int, DAYS_REGISTRATION double, DAYS_ID_PUBLISH double,
        FLAG_MOBIL int, FLAG_EMP_PHONE int, FLAG_WORK_PHONE int, FLAG_CONT_MOBILE int,
        FLAG_PHONE int, FLAG_EMAIL int, CNT_FAM_MEMBERS double, EXT_SOURCE_1 double,
        EXT_SOURCE_2 double, EXT_SOURCE_3 double, DAYS_LAST_PHONE_CHANGE double""",
    "bureau": """SK_ID_CURR long, SK_ID_BUREAU long, CREDIT_ACTIVE string, DAYS_CREDIT int,
        CREDIT_DAY_OVERDUE int, AMT_CREDIT_SUM double, AMT_CREDIT_SUM_DEBT double,
        AMT_CREDIT_SUM_OVERDUE double""",
    "bureau_bal": "SK_ID_BUREAU long, MONTHS_BALANCE int, STATUS string",
    "prev": """SK_ID_PREV long, SK_ID_CURR long, NAME_CONTRACT_STATUS string,
        AMT_APPLICATION double, AMT_CREDIT double, AMT_ANNUITY double, AMT_DOWN_PAYMENT double,
        RATE_INTEREST_PRIMARY double, DAYS_FIRST_DRAWING double, DAYS_DECISION int""",
    "pos_cash": """SK_ID_PREV long, SK_ID_CURR long, MONTHS_BALANCE int, CNT_INSTALMENT double,
        CNT_INSTALMENT_FUTURE double, NAME_CONTRACT_STATUS string, SK_DPD int, SK_DPD_DEF int""",
    "credit_card": """SK_ID_PREV long, SK_ID_CURR long, AMT_BALANCE double,
        AMT_CREDIT_LIMIT_ACTUAL double, AMT_DRAWINGS_ATM_CURRENT double,
        AMT_DRAWINGS_CURRENT double, AMT_INST_MIN_REGULARITY double, AMT_PAYMENT_CURRENT double,
        SK_DPD int, SK_DPD_DEF int""",
    "installments": """SK_ID_PREV long, SK_ID_CURR long, DAYS_INSTALMENT double,
        DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double""",
    "description": "id int, `Table` string, `Row` string, Description string, Special string",
    "submission": "SK_ID_CURR long, TARGET double",
}

# Name patterns of numeric columns outside the declared ones.
NUMERIC_PREFIXES = ("AMT_", "CNT_", "DAYS_", "FLAG_", "REGION_", "REG_", "LIVE_", "OBS_", "DEF_",
                    "EXT_", "HOUR_", "SK_", "TARGET", "OWN_CAR_AGE")
NUMERIC_SUFFIXES = ("_AVG", "_MODE", "_MEDI")
TEXT_COLUMNS = {"FONDKAPREMONT_MODE", "HOUSETYPE_MODE", "WALLSMATERIAL_MODE",
                "EMERGENCYSTATE_MODE", "FLAG_OWN_CAR", "FLAG_OWN_REALTY",
                "FLAG_LAST_APPL_PER_CONTRACT"}

# Tables whose whole header is kept, typed by name; the others keep their declared columns.
OPEN_TABLES = {"train", "test"}

# Spellings of a missing cell.
NULL_SPELLINGS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                  "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


def struct(columns: str) -> T.StructType:
    """A schema from ``name type, ...``; unlike the DDL parser it needs no session."""
    pairs = [c.replace("`", "").split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


def declared_schema(name: str) -> T.StructType:
    schema = struct(SCHEMAS["train" if name == "test" else name])
    if name == "test":
        schema = T.StructType([f for f in schema.fields if f.name != "TARGET"])
    return schema


def column_type(name: str) -> T.DataType:
    numeric = name.startswith(NUMERIC_PREFIXES) or name.endswith(NUMERIC_SUFFIXES)
    return T.DoubleType() if numeric and name not in TEXT_COLUMNS else T.StringType()


def extend_schema(name: str, header: list[str]) -> T.StructType:
    """The file's own column order with declared types, name-based types elsewhere."""
    declared = {f.name: f for f in declared_schema(name).fields}
    return T.StructType(
        [declared.get(c) or T.StructField(c, column_type(c)) for c in header]
    )


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names: the reader takes one row, not the file."""
    return spark.read.option("header", True).csv(path).columns


def checked_cell(name: str, kind: T.DataType) -> Column:
    """A text cell as ``kind``: null spellings and NaN become null, other misfits an error."""
    text = F.trim(F.col(f"`{name}`"))
    given = F.when(~text.isin(*NULL_SPELLINGS), text)
    if isinstance(kind, T.StringType):
        return F.when(~text.isin(*NULL_SPELLINGS), F.col(f"`{name}`")).alias(name)
    number = given.try_cast("double")
    # whole numbers beyond 2^53 are exact only when read as such
    value = F.coalesce(given.try_cast(kind), number.try_cast(kind)) if isinstance(kind, T.IntegralType) else number
    fits = value.isNotNull() & ((value.cast("double") == number) | ~F.lit(isinstance(kind, T.IntegralType)))
    message = F.concat(F.lit(f"column {name}: not of type {kind.simpleString()}: "), given)
    return F.when(given.isNull() | F.isnan(number), F.lit(None).cast(kind)).when(fits, value).otherwise(
        F.raise_error(message).cast(kind)
    ).alias(name)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> DataFrame:
    """A CSV file with a header; a cell that does not fit its column stops the read."""
    schema = struct(schema) if isinstance(schema, str) else schema
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    reader = spark.read.schema(texts).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.csv(path).select(*[checked_cell(f.name, f.dataType) for f in schema.fields])


def load_table(spark: SparkSession, name: str, folder: str, file: str | None = None) -> DataFrame:
    """One raw table by its logical name."""
    if name not in FILES:
        raise KeyError(f"unknown table {name!r}; known: {sorted(FILES)}")
    path = f"{folder.rstrip('/')}/{file or FILES[name]}"
    if name == "description":
        # the first column has no name in the file, so columns go by their place
        return read_csv(spark, path, SCHEMAS[name], encoding="ISO-8859-1", enforceSchema=True)
    header = csv_header(spark, path)
    table = read_csv(spark, path, extend_schema(name, header))
    if name in OPEN_TABLES:
        return table
    return table.select(*[f.name for f in declared_schema(name).fields if f.name in header])


def load_all(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The eight data tables, lazily."""
    return {
        name: load_table(spark, name, folder)
        for name in FILES
        if name not in ("description", "submission")
    }


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows, n_columns) of a set of tables."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            "n_rows",
            F.lit(len(df.columns)).cast("long").alias("n_columns"),
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
