"""One row per applicant from the one-to-many history tables.

Each summary is a single grouped aggregation of plain aggregates, so Spark combines on the
map side first: an applicant with a third of all rows still shuffles one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlark import settings as S
from loanlark.functions import expr as X

AGGREGATES = {
    "mean": F.avg,
    "max": F.max,
    "min": F.min,
    "sum": X.sum_or_zero,
    "std": F.stddev_samp,
}


def aggregate_matrix(
    df: DataFrame, key: str, prefix: str, cols: list[str], names: list[str] | None = None
) -> DataFrame:
    """Every column by every aggregate, named PREFIX_COLUMN_AGGREGATE."""
    names = names or list(AGGREGATES)
    exprs = [
        AGGREGATES[n](F.col(c)).alias(f"{prefix}_{c}_{n}".upper()) for c in cols for n in names
    ]
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*exprs)


def _per_applicant(df: DataFrame, features: dict[str, Column]) -> DataFrame:
    return (
        df.filter(F.col(S.ID).isNotNull())
        .groupBy(S.ID)
        .agg(*[e.alias(n) for n, e in features.items()])
    )


def balance_summary(balance: DataFrame) -> DataFrame:
    """Monthly statuses of one bureau credit."""
    status = F.col("STATUS")
    return (
        balance.filter(F.col("SK_ID_BUREAU").isNotNull())
        .groupBy("SK_ID_BUREAU")
        .agg(
            F.count("MONTHS_BALANCE").alias("BB_MONTHS_COUNT"),
            F.avg(X.mapped(status, S.STATUS_LEVELS)).alias("BB_STATUS_MEAN"),
            F.avg(X.flag(status.isin(S.OVERDUE_STATUSES))).alias("BB_OVERDUE_RATIO"),
            F.avg(X.flag(status == "C")).alias("BB_CLOSED_RATIO"),
        )
    )


def bureau_summary(bureau: DataFrame, balance: DataFrame) -> DataFrame:
    """Bureau credits of an applicant, each joined with its monthly summary first."""
    months = balance_summary(balance).select("SK_ID_BUREAU", "BB_STATUS_MEAN", "BB_OVERDUE_RATIO")
    active = F.col("CREDIT_ACTIVE")
    bad = F.sum(X.flag(active == "Bad debt"))
    loans = F.count("SK_ID_BUREAU")
    return _per_applicant(
        bureau.join(months, "SK_ID_BUREAU", "left"),
        {
            "BUREAU_LOAN_COUNT": loans,
            "BUREAU_ACTIVE_COUNT": F.sum(X.flag(active == "Active")),
            "BUREAU_CLOSED_COUNT": F.sum(X.flag(active == "Closed")),
            "BUREAU_BAD_COUNT": bad,
            "BUREAU_ACTIVE_RATIO": F.avg(X.flag(active == "Active")),
            "BUREAU_DAYS_CREDIT_MEAN": F.avg("DAYS_CREDIT"),
            "BUREAU_DAYS_CREDIT_MIN": F.min("DAYS_CREDIT"),
            "BUREAU_OVERDUE_MEAN": F.avg("CREDIT_DAY_OVERDUE"),
            "BUREAU_OVERDUE_MAX": F.max("CREDIT_DAY_OVERDUE"),
            "BUREAU_AMT_SUM_MEAN": F.avg("AMT_CREDIT_SUM"),
            "BUREAU_AMT_SUM_MAX": F.max("AMT_CREDIT_SUM"),
            "BUREAU_AMT_DEBT_MEAN": F.avg("AMT_CREDIT_SUM_DEBT"),
            "BUREAU_AMT_OVERDUE_MEAN": F.avg("AMT_CREDIT_SUM_OVERDUE"),
            "BUREAU_BB_OVERDUE_RATIO": F.avg("BB_OVERDUE_RATIO"),
            "BUREAU_BB_STATUS_MEAN": F.avg("BB_STATUS_MEAN"),
            "BUREAU_BAD_RATIO": X.ratio(bad, loans),
        },
    )


def previous_summary(previous: DataFrame) -> DataFrame:
    """Earlier applications; the latest one rides in the same aggregation, without a join."""
    status = F.col("NAME_CONTRACT_STATUS")
    credit = F.nullif(F.col("AMT_CREDIT"), F.lit(0.0))

    def newest(value: Column) -> Column:
        return X.latest(value, "DAYS_DECISION", "SK_ID_PREV")

    # null stays null here, so that the latest *known* status decides
    approved = (status == "Approved").cast("int")
    return _per_applicant(
        previous,
        {
            "PREV_COUNT": F.count("SK_ID_PREV"),
            "PREV_APPROVED_COUNT": F.sum(X.flag(status == "Approved")),
            "PREV_REFUSED_COUNT": F.sum(X.flag(status == "Refused")),
            "PREV_CANCELLED_COUNT": F.sum(X.flag(status == "Canceled")),
            "PREV_APPROVED_RATIO": F.avg(X.flag(status == "Approved")),
            "PREV_REFUSED_RATIO": F.avg(X.flag(status == "Refused")),
            "PREV_AMT_APPLICATION_MEAN": F.avg("AMT_APPLICATION"),
            "PREV_AMT_APPLICATION_MAX": F.max("AMT_APPLICATION"),
            "PREV_AMT_CREDIT_MEAN": F.avg(credit),
            "PREV_AMT_CREDIT_MAX": F.max(credit),
            "PREV_AMT_ANNUITY_MEAN": F.avg("AMT_ANNUITY"),
            "PREV_AMT_DOWN_MEAN": F.avg("AMT_DOWN_PAYMENT"),
            "PREV_DAYS_DECISION_MEAN": F.avg("DAYS_DECISION"),
            "PREV_DAYS_DECISION_MIN": F.min("DAYS_DECISION"),
            "PREV_CREDIT_RATIO_MEAN": F.avg(X.ratio("AMT_APPLICATION", credit)),
            "PREV_DOWN_RATIO_MEAN": F.avg(X.ratio("AMT_DOWN_PAYMENT", "AMT_APPLICATION")),
            "PREV_RATE_INTEREST_MEAN": F.avg("RATE_INTEREST_PRIMARY"),
            "PREV_DAYS_FIRST_DRAWING": F.avg("DAYS_FIRST_DRAWING"),
            "PREV_RECENT_AMT_APPLICATION": newest(F.col("AMT_APPLICATION")),
            "PREV_RECENT_AMT_CREDIT": newest(credit),
            "PREV_RECENT_NAME_CONTRACT_STATUS": F.coalesce(newest(approved), F.lit(0)),
        },
    )


def pos_cash_summary(pos: DataFrame) -> DataFrame:
    overdue = X.clip0("SK_DPD")
    return _per_applicant(
        pos,
        {
            "POS_COUNT": F.count("SK_ID_PREV"),
            "POS_COMPLETED_RATIO": F.avg(X.flag(F.col("NAME_CONTRACT_STATUS") == "Completed")),
            "POS_MONTHS_MEAN": F.avg("MONTHS_BALANCE"),
            "POS_MONTHS_MIN": F.min("MONTHS_BALANCE"),
            "POS_CNT_INSTALMENT_MEAN": F.avg("CNT_INSTALMENT"),
            "POS_CNT_FUTURE_MEAN": F.avg("CNT_INSTALMENT_FUTURE"),
            "POS_DPD_MEAN": F.avg(overdue),
            "POS_DPD_MAX": F.max(overdue),
            "POS_DPD_DEF_MEAN": F.avg("SK_DPD_DEF"),
            "POS_DPD_DEF_MAX": F.max("SK_DPD_DEF"),
        },
    )


def credit_card_summary(cards: DataFrame) -> DataFrame:
    overdue = X.clip0("SK_DPD")
    limit = "AMT_CREDIT_LIMIT_ACTUAL"
    return _per_applicant(
        cards,
        {
            "CC_COUNT": F.count("SK_ID_PREV"),
            "CC_AMT_BALANCE_MEAN": F.avg("AMT_BALANCE"),
            "CC_AMT_BALANCE_MAX": F.max("AMT_BALANCE"),
            "CC_LIMIT_MEAN": F.avg(limit),
            "CC_DRAWINGS_MEAN": F.avg("AMT_DRAWINGS_CURRENT"),
            "CC_DRAWINGS_RATIO_MEAN": F.avg(X.ratio("AMT_DRAWINGS_CURRENT", limit)),
            "CC_BALANCE_LIMIT_MEAN": F.avg(X.ratio("AMT_BALANCE", limit)),
            "CC_PAYMENT_RATIO_MEAN": F.avg(
                X.ratio("AMT_PAYMENT_CURRENT", "AMT_INST_MIN_REGULARITY")
            ),
            "CC_DPD_MEAN": F.avg(overdue),
            "CC_DPD_MAX": F.max(overdue),
            "CC_DPD_DEF_MEAN": F.avg("SK_DPD_DEF"),
            "CC_DPD_DEF_MAX": F.max("SK_DPD_DEF"),
        },
    )


def installments_summary(payments: DataFrame) -> DataFrame:
    late_by = F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")
    past_due = X.clip0(late_by)
    before_due = X.clip0(F.col("DAYS_INSTALMENT") - F.col("DAYS_ENTRY_PAYMENT"))
    paid = X.ratio("AMT_PAYMENT", "AMT_INSTALMENT")
    short = F.col("AMT_INSTALMENT") - F.col("AMT_PAYMENT")
    return _per_applicant(
        payments,
        {
            "INSTAL_COUNT": F.count("SK_ID_PREV"),
            "INSTAL_DPD_MEAN": F.avg(past_due),
            "INSTAL_DPD_MAX": F.max(past_due),
            "INSTAL_DPD_STD": F.stddev_samp(past_due),
            "INSTAL_DBD_MEAN": F.avg(before_due),
            "INSTAL_DBD_MAX": F.max(before_due),
            "INSTAL_PAYMENT_RATIO_MEAN": F.avg(paid),
            "INSTAL_PAYMENT_RATIO_MIN": F.min(paid),
            "INSTAL_PAYMENT_DIFF_MEAN": F.avg(short),
            "INSTAL_PAYMENT_DIFF_MAX": F.max(short),
            "INSTAL_LATE_RATIO": F.avg(X.flag(late_by > 0)),
            "INSTAL_AMT_PAYMENT_MEAN": F.avg("AMT_PAYMENT"),
            "INSTAL_AMT_PAYMENT_SUM": X.sum_or_zero("AMT_PAYMENT"),
        },
    )


def history_summaries(tables: dict[str, DataFrame]) -> list[DataFrame]:
    """The five applicant summaries of a set of raw tables."""
    return [
        bureau_summary(tables["bureau"], tables["bureau_bal"]),
        previous_summary(tables["prev"]),
        pos_cash_summary(tables["pos_cash"]),
        credit_card_summary(tables["credit_card"]),
        installments_summary(tables["installments"]),
    ]


def widen(spine: DataFrame, summaries: list[DataFrame]) -> DataFrame:
    """Left-join every summary to the spine; an applicant without history keeps nulls.

    No broadcast hint: summary sizes follow the data, so the choice is left to AQE. All
    joins use one key, so the spine is shuffled once.
    """
    out = spine
    for summary in summaries:
        out = out.join(summary, S.ID, "left")
    return out
