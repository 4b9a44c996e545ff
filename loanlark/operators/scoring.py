"""Scoring of applications with fitted state: validation, features, model, record."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlark import settings as S
from loanlark.operators import evaluation, learner, shaping
from loanlark.operators.application import application_features
from loanlark.operators.encoding import EncodingState, apply_encoding
from loanlark.sources.tables import struct

# The request record, its defaults and its range rules.
REQUEST_SCHEMA = struct(
    """id long, AMT_INCOME_TOTAL double, AMT_CREDIT double, AMT_ANNUITY double,
    AMT_GOODS_PRICE double, DAYS_BIRTH int, DAYS_EMPLOYED int, EXT_SOURCE_1 double,
    EXT_SOURCE_2 double, EXT_SOURCE_3 double, CNT_CHILDREN int, CNT_FAM_MEMBERS double,
    NAME_CONTRACT_TYPE string, CODE_GENDER string, FLAG_OWN_CAR string, FLAG_OWN_REALTY string,
    NAME_INCOME_TYPE string, NAME_EDUCATION_TYPE string, NAME_FAMILY_STATUS string,
    NAME_HOUSING_TYPE string, REGION_POPULATION_RELATIVE double, DAYS_REGISTRATION double"""
)
REQUEST_DEFAULTS = {
    "CNT_CHILDREN": 0,
    "CNT_FAM_MEMBERS": 2.0,
    "NAME_CONTRACT_TYPE": "Cash loans",
    "CODE_GENDER": "M",
    "FLAG_OWN_CAR": "N",
    "FLAG_OWN_REALTY": "Y",
    "NAME_INCOME_TYPE": "Working",
    "NAME_EDUCATION_TYPE": "Secondary / secondary special",
    "NAME_FAMILY_STATUS": "Married",
    "NAME_HOUSING_TYPE": "House / apartment",
}
# Columns the features read that a request does not carry.
REQUEST_ABSENT = {"DAYS_ID_PUBLISH": "double", "DAYS_LAST_PHONE_CHANGE": "double"}


def range_rules() -> dict[str, Column]:
    """Name of each rule and its condition; a condition that is not true breaks the rule."""
    positive = {f"{c} > 0": F.col(c) > 0 for c in ("AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY")}
    scores = {
        f"{c} in [0, 1]": F.col(c).isNull() | F.col(c).between(0, 1)
        for c in ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")
    }
    return {
        **positive,
        "DAYS_BIRTH < 0": F.col("DAYS_BIRTH") < 0,
        "DAYS_EMPLOYED given": F.col("DAYS_EMPLOYED").isNotNull(),
        **scores,
        "CNT_CHILDREN >= 0": F.col("CNT_CHILDREN") >= 0,
        "CNT_FAM_MEMBERS > 0": F.col("CNT_FAM_MEMBERS") > 0,
    }


def with_defaults(df: DataFrame) -> DataFrame:
    present = {c: v for c, v in REQUEST_DEFAULTS.items() if c in df.columns}
    absent = {c: v for c, v in REQUEST_DEFAULTS.items() if c not in df.columns}
    filled = df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in present.items()})
    return filled.withColumns({c: F.lit(v) for c, v in absent.items()})


def validated(df: DataFrame) -> DataFrame:
    """Defaults filled in, plus ``broken_rules`` (empty for a valid row)."""
    broken = F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))
                for name, ok in range_rules().items()
            ]
        )
    )
    return with_defaults(df).withColumn("broken_rules", broken)


def valid_rows(df: DataFrame) -> DataFrame:
    return validated(df).filter(F.size("broken_rules") == 0).drop("broken_rules")


def rejected_rows(df: DataFrame) -> DataFrame:
    return validated(df).filter(F.size("broken_rules") > 0)


def fallback_probability(score: str = "EXT_SOURCE_2") -> Column:
    """Probability without a model: 1.05 minus the external score, within [0.01, 0.99].

    A missing or zero score counts as 0.5.
    """
    known = F.coalesce(F.nullif(F.col(score), F.lit(0.0)), F.lit(0.5))
    p = F.lit(1.0) - known + F.lit(0.05)
    return F.round(F.greatest(F.lit(0.01), F.least(F.lit(0.99), p)), 4)


def applicant_profile(df: DataFrame) -> DataFrame:
    """Ratios shown beside a single decision; no employment gives null."""
    annuity = F.coalesce(F.nullif(F.col("AMT_ANNUITY"), F.lit(0.0)), F.lit(1.0))

    def whole_years(days: str) -> Column:
        return F.abs(F.floor(F.col(days) / 365 + 0.5)).cast("long")

    return df.select(
        S.ID,
        F.round(F.col("AMT_CREDIT") / F.col("AMT_INCOME_TOTAL"), 2).alias("credit_income"),
        F.floor(F.col("AMT_CREDIT") / annuity + 0.5).cast("long").alias("credit_term"),
        whole_years("DAYS_BIRTH").alias("age_years"),
        F.when(F.col("DAYS_EMPLOYED") < 0, whole_years("DAYS_EMPLOYED")).alias("employed_years"),
    )


@dataclass
class RiskModel:
    """Everything scoring needs: fitted encoding, trees, calibrator, threshold, features."""

    encoding: EncodingState
    trees: GBTClassificationModel
    calibrator: Model
    threshold: float
    features: T.StructType

    def save(self, path: str) -> None:
        spark = self.encoding.codes.sparkSession
        self.encoding.save(f"{path}/encoding")
        self.trees.write().overwrite().save(f"{path}/trees")
        self.calibrator.write().overwrite().save(f"{path}/calibrator")
        method = "isotonic" if hasattr(self.calibrator, "boundaries") else "sigmoid"
        spark.createDataFrame(
            [(float(self.threshold), method, self.features.json())],
            "threshold double, method string, features string",
        ).coalesce(1).write.mode("overwrite").json(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> RiskModel:
        row = spark.read.schema("threshold double, method string, features string").json(
            f"{path}/settings"
        ).first()
        kind = IsotonicRegressionModel if row["method"] == "isotonic" else LogisticRegressionModel
        return cls(
            EncodingState.load(spark, f"{path}/encoding"),
            GBTClassificationModel.load(f"{path}/trees"),
            kind.load(f"{path}/calibrator"),
            row["threshold"],
            T.StructType.fromJson(json.loads(row["features"])),
        )

    def probabilities(self, encoded: DataFrame) -> DataFrame:
        """Add ``probability`` to rows that carry every feature column."""
        packed = learner.as_array(encoded, self.features.fieldNames())
        scored = learner.raw_scores(self.trees, packed)
        return learner.calibrated(self.calibrator, scored, "raw_probability").drop(
            "x", "raw_probability"
        )

    def score(self, applications: DataFrame, keep: tuple[str, ...] = (S.ID,)) -> DataFrame:
        """Score raw applications, bounded or streaming.

        Features, alignment and filling use the state of the training run, never the rows
        at hand; history features an application does not bring are filled with medians.
        """
        absent = {
            c: F.lit(None).cast(t) for c, t in REQUEST_ABSENT.items() if c not in applications.columns
        }
        featured = application_features(applications.withColumns(absent) if absent else applications)
        kept = T.StructType([f for f in featured.schema.fields if f.name in keep])
        wanted = [f for f in self.features.fields if f.name not in keep]
        aligned = shaping.align_columns(featured, T.StructType([*kept.fields, *wanted]))
        scored = self.probabilities(apply_encoding(aligned, self.encoding, keep))
        return evaluation.score_records(scored, "probability", self.threshold).select(
            *keep,
            "probability",
            "risk_score",
            "risk_label",
            "default_probability",
            "threshold",
            "predicted_default",
        )

