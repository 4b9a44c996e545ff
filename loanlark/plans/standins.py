"""The given tables shaped like the raw risk tables, so that the library code runs on them.

Amounts are whole cents as doubles: their sums do not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
TODAY = "2001-08-02"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100)


def day(c: str) -> Column:
    """Days before the reference date, negative."""
    return F.datediff(F.col(c), F.lit(TODAY).cast("date"))


def whole(c: Column) -> Column:
    return F.floor(c).cast("double")


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One application per customer; amounts and dates from the customer's orders."""
    customer, nation = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    per_customer = (
        read(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count("*").alias("cnt"),
            F.sum(cents("o_totalprice")).alias("total"),
            F.max(cents("o_totalprice")).alias("top"),
            F.datediff(F.max("o_orderdate"), F.min("o_orderdate")).alias("span"),
        )
    )
    k = F.col("c_custkey")
    joined = customer.join(per_customer, k == F.col("o_custkey"), "left").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )

    def unless(condition: Column, value: Column) -> Column:
        return F.when(~condition, value)

    return joined.select(
        k.alias("SK_ID_CURR"),
        (F.col("c_acctbal") < 0).cast("int").alias("TARGET"),
        F.col("total").alias("AMT_INCOME_TOTAL"),
        F.col("top").alias("AMT_CREDIT"),
        whole(F.col("total") / (F.col("cnt") * 12)).alias("AMT_ANNUITY"),
        unless(F.col("c_mktsegment") == "BUILDING", whole(F.col("top") * 0.9)).alias(
            "AMT_GOODS_PRICE"
        ),
        (k % 4).cast("int").alias("CNT_CHILDREN"),
        F.nullif(k % 7, F.lit(0)).cast("double").alias("CNT_FAM_MEMBERS"),
        (-(F.lit(7300) + (k * 37) % 18250)).cast("int").alias("DAYS_BIRTH"),
        F.when(k % 11 == 0, 365243).otherwise(100 - (k * 13) % 9000).cast("int").alias(
            "DAYS_EMPLOYED"
        ),
        (-F.col("span")).cast("double").alias("DAYS_REGISTRATION"),
        (-((k * 17) % 6000)).cast("double").alias("DAYS_ID_PUBLISH"),
        F.nullif(-((k * 29) % 4000), F.lit(0)).cast("double").alias("DAYS_LAST_PHONE_CHANGE"),
        unless(k % 3 == 0, ((k * 7919) % 1000) / 1000.0).alias("EXT_SOURCE_1"),
        unless(k % 10 == 0, ((k * 104729) % 997) / 997.0).alias("EXT_SOURCE_2"),
        unless(k % 4 == 0, ((F.col("n_nationkey") * 41 + F.col("cnt") * 13) % 100) / 100.0).alias(
            "EXT_SOURCE_3"
        ),
        (k % 2).cast("int").alias("FLAG_DOCUMENT_2"),
        F.nullif(k % 5, F.lit(3)).cast("int").alias("FLAG_DOCUMENT_3"),
        F.lit(1).alias("FLAG_MOBIL"),
        (k % 3 == 0).cast("int").alias("FLAG_EMP_PHONE"),
        (k % 9 == 0).cast("int").alias("FLAG_EMAIL"),
        F.nullif(k % 6, F.lit(0)).cast("double").alias("AMT_REQ_CREDIT_BUREAU_DAY"),
        (k % 8).cast("double").alias("AMT_REQ_CREDIT_BUREAU_YEAR"),
        (F.col("n_regionkey") + 1).cast("int").alias("REGION_RATING_CLIENT"),
        F.nullif(F.col("n_nationkey") % 3, F.lit(0)).cast("int").alias(
            "REGION_RATING_CLIENT_W_CITY"
        ),
        F.col("c_mktsegment").alias("NAME_CONTRACT_TYPE"),
        unless(k % 13 == 0, F.col("n_name")).alias("NAME_NATION"),
    )


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, price = F.col("o_orderkey"), cents("o_totalprice")
    status = F.col("o_orderstatus")
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        k.alias("SK_ID_BUREAU"),
        F.when(status == "F", "Closed").when(status == "O", "Active").otherwise("Bad debt").alias(
            "CREDIT_ACTIVE"
        ),
        day("o_orderdate").alias("DAYS_CREDIT"),
        (k % 30).cast("int").alias("CREDIT_DAY_OVERDUE"),
        price.alias("AMT_CREDIT_SUM"),
        F.when(status != "F", whole(price / 2)).alias("AMT_CREDIT_SUM_DEBT"),
        F.when(k % 5 != 0, (k % 1000).cast("double")).alias("AMT_CREDIT_SUM_OVERDUE"),
    )


def bureau_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = F.concat("l_returnflag", "l_linestatus")
    status = F.when(F.col("l_tax") == 0, None)
    for key, value in {"AF": "0", "AO": "1", "NF": "3", "NO": "C", "RF": "X", "RO": "5"}.items():
        status = status.when(pair == key, value)
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        (-F.col("l_linenumber")).alias("MONTHS_BALANCE"),
        status.alias("STATUS"),
    )


def previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, price = F.col("o_orderkey"), cents("o_totalprice")
    status = F.col("o_orderstatus")
    named = F.when(status == "F", "Approved").when(status == "O", "Refused").otherwise("Canceled")
    return read(spark, sf_dir, "orders").select(
        k.alias("SK_ID_PREV"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.when(k % 17 != 0, named).alias("NAME_CONTRACT_STATUS"),
        price.alias("AMT_APPLICATION"),
        F.when(k % 9 == 0, 0.0).when(k % 7 != 0, whole(price * 9 / 10)).alias("AMT_CREDIT"),
        whole(price / 12).alias("AMT_ANNUITY"),
        F.when(status != "O", whole(price / 10)).alias("AMT_DOWN_PAYMENT"),
        F.when(k % 4 == 0, (k % 20).cast("double")).alias("RATE_INTEREST_PRIMARY"),
        F.nullif(k % 365, F.lit(0)).cast("double").alias("DAYS_FIRST_DRAWING"),
        day("o_orderdate").alias("DAYS_DECISION"),
    )


def pos_cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, kind = F.col("event_id"), F.col("event_type")
    return read(spark, sf_dir, "events").select(
        k.alias("SK_ID_PREV"),
        F.col("user_id").alias("SK_ID_CURR"),
        (-(k % 24)).cast("int").alias("MONTHS_BALANCE"),
        whole(F.col("value")).alias("CNT_INSTALMENT"),
        F.when(kind != "error", whole(F.col("value") / 2)).alias("CNT_INSTALMENT_FUTURE"),
        F.when(kind == "view", "Active").when(kind == "purchase", "Completed").alias(
            "NAME_CONTRACT_STATUS"
        ),
        (k % 15 - 5).cast("int").alias("SK_DPD"),
        (k % 7 - 3).cast("int").alias("SK_DPD_DEF"),
    )


def credit_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    return read(spark, sf_dir, "events").select(
        k.alias("SK_ID_PREV"),
        F.col("user_id").alias("SK_ID_CURR"),
        cents("value").alias("AMT_BALANCE"),
        ((k % 1000) * 100).cast("double").alias("AMT_CREDIT_LIMIT_ACTUAL"),
        whole(F.col("value") * 3).alias("AMT_DRAWINGS_ATM_CURRENT"),
        whole(F.col("value") * 10).alias("AMT_DRAWINGS_CURRENT"),
        F.nullif(k % 50, F.lit(0)).cast("double").alias("AMT_INST_MIN_REGULARITY"),
        whole(F.col("value") * 7).alias("AMT_PAYMENT_CURRENT"),
        (k % 9 - 4).cast("int").alias("SK_DPD"),
        (k % 5).cast("int").alias("SK_DPD_DEF"),
    )


def installments(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    price = cents("l_extendedprice")
    paid = F.col("l_discount") != 0
    return (
        read(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_orderkey").alias("SK_ID_PREV"),
            F.col("o_custkey").alias("SK_ID_CURR"),
            day("o_orderdate").cast("double").alias("DAYS_INSTALMENT"),
            F.when(paid, day("l_shipdate").cast("double")).alias("DAYS_ENTRY_PAYMENT"),
            price.alias("AMT_INSTALMENT"),
            F.when(paid, whole(price * (1 - F.col("l_discount")))).alias("AMT_PAYMENT"),
        )
    )


def histories(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "bureau": bureau(spark, sf_dir),
        "bureau_bal": bureau_balance(spark, sf_dir),
        "prev": previous(spark, sf_dir),
        "pos_cash": pos_cash(spark, sf_dir),
        "credit_card": credit_card(spark, sf_dir),
        "installments": installments(spark, sf_dir),
    }


def coarse_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p, y) per order line: fifty tied scores with real signal."""
    return read(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity") / 50).alias("p"), _outcome().alias("y")
    )


def fine_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p, y) per order line with almost as many scores as rows."""
    jitter = (
        F.col("l_partkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_orderkey") * 31
    ) % 10007
    return read(spark, sf_dir, "lineitem").select(
        ((F.col("l_quantity") + jitter / 10007) / 51).alias("p"), _outcome().alias("y")
    )


def _outcome() -> Column:
    draw = (F.col("l_partkey") * 31 + F.col("l_linenumber") * 17) % 100
    return (draw < F.col("l_quantity")).cast("int")


def labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, y, embedding): one embedding label is the minority class."""
    return read(spark, sf_dir, "embeddings").select(
        "vec_id",
        (F.col("label") == 1).cast("int").alias("y"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return read(spark, sf_dir, "labels").join(documents, "doc_id")
