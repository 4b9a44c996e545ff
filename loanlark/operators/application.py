"""Features of one application row: ratios, years, external scores, flag counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlark import settings as S
from loanlark.functions import expr as X

EXTERNAL = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]


def ratios() -> dict[str, Column]:
    pairs = {
        "CREDIT_INCOME_RATIO": ("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        "ANNUITY_INCOME_RATIO": ("AMT_ANNUITY", "AMT_INCOME_TOTAL"),
        "CREDIT_TERM": ("AMT_CREDIT", "AMT_ANNUITY"),
        "GOODS_CREDIT_RATIO": ("AMT_GOODS_PRICE", "AMT_CREDIT"),
        "ANNUITY_CREDIT_RATIO": ("AMT_ANNUITY", "AMT_CREDIT"),
        "INCOME_PER_PERSON": ("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
        "CHILDREN_RATIO": ("CNT_CHILDREN", "CNT_FAM_MEMBERS"),
    }
    return {name: X.ratio(a, b) for name, (a, b) in pairs.items()}


def durations() -> dict[str, Column]:
    """Years from day offsets; the employment sentinel becomes a flag and then null."""
    employed = F.nullif(F.col("DAYS_EMPLOYED"), F.lit(S.EMPLOYED_SENTINEL))
    return {
        "AGE_YEARS": X.years("DAYS_BIRTH"),
        "REGISTRATION_YEARS": X.years("DAYS_REGISTRATION"),
        "ID_PUBLISH_YEARS": X.years("DAYS_ID_PUBLISH"),
        "PHONE_CHANGE_YEARS": X.years("DAYS_LAST_PHONE_CHANGE"),
        "IS_UNEMPLOYED": X.flag(F.col("DAYS_EMPLOYED") == S.EMPLOYED_SENTINEL),
        "DAYS_EMPLOYED": employed,
        "EMPLOYED_YEARS": X.clip0(-employed) / F.lit(float(S.DAYS_PER_YEAR)),
    }


def external_scores() -> dict[str, Column]:
    one, two, three = (F.col(c) for c in EXTERNAL)
    return {
        "EXT_SOURCE_MEAN": X.row_mean(EXTERNAL),
        "EXT_SOURCE_STD": X.row_std(EXTERNAL),
        "EXT_SOURCE_MIN": X.row_min(EXTERNAL),
        "EXT_SOURCE_MAX": X.row_max(EXTERNAL),
        "EXT_SOURCE_WEIGHTED": X.weighted_mean(dict(zip(EXTERNAL, (2, 3, 1)))),
        "EXT_SRC_1x2": one * two,
        "EXT_SRC_2x3": two * three,
        "EXT_SRC_1x3": one * three,
    }


def flag_counts(columns: list[str]) -> dict[str, Column]:
    """Sums over column families picked by name."""
    families = {
        "DOCUMENT_COUNT": [c for c in columns if c.startswith("FLAG_DOCUMENT_")],
        "CONTACT_COUNT": [c for c in S.CONTACT_FLAGS if c in columns],
        "AMT_REQ_BUREAU_TOTAL": [c for c in columns if c.startswith("AMT_REQ_CREDIT_BUREAU_")],
        "REGION_RATING_SUM": [c for c in columns if "REGION_RATING" in c],
    }
    always = ("DOCUMENT_COUNT", "CONTACT_COUNT")
    return {n: X.row_sum(cs) for n, cs in families.items() if cs or n in always}


def application_features(applications: DataFrame) -> DataFrame:
    """Every application column plus its derived features; one projection, no shuffle."""
    with_years = applications.withColumns(durations())
    return with_years.withColumns(
        {
            **ratios(),
            "EMPLOYED_TO_AGE_RATIO": X.ratio("EMPLOYED_YEARS", "AGE_YEARS"),
            "CREDIT_TO_AGE_RATIO": X.ratio("AMT_CREDIT", "AGE_YEARS"),
            **external_scores(),
            **flag_counts(applications.columns),
            "NON_CHILDREN": F.col("CNT_FAM_MEMBERS") - F.col("CNT_CHILDREN"),
        }
    )
