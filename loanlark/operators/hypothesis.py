"""Feature screening: Kolmogorov-Smirnov and chi-square tests against the label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlark import settings as S
from loanlark.functions import ordering as O
from loanlark.functions import tails
from loanlark.operators import shaping


def ks_tests(
    df: DataFrame, target: str = S.TARGET, alpha: float = S.ALPHA, cols: list[str] | None = None
) -> DataFrame:
    """Two-sample KS of every numeric column between the classes, all columns in one job.

    Columns need more than two distinct values overall and ten values in each class. Rows
    without a label count towards the distinct gate only, as they belong to no class.
    """
    cols = cols or shaping.numeric_columns(df, (target,))
    curve = O.class_counts(df, cols, target)
    n0, n1 = F.first("all_n0"), F.first("all_n1")
    gap = F.abs(F.col("run_n0") / F.col("all_n0") - F.col("run_n1") / F.col("all_n1"))
    tested = (
        curve.filter((F.col("all_n0") >= S.KS_MIN_ROWS) & (F.col("all_n1") >= S.KS_MIN_ROWS))
        .groupBy("feature")
        .agg(
            F.max(gap).alias("d"),
            F.first("all_one").alias("n_distinct"),
            n0.alias("n0"),
            n1.alias("n1"),
            (F.sum(F.col("value") * F.col("n0")) / n0).alias("mean0"),
            (F.sum(F.col("value") * F.col("n1")) / n1).alias("mean1"),
        )
        .filter(F.col("n_distinct") >= S.KS_MIN_DISTINCT)
    )
    p = tails.ks_p_value(F.col("d"), F.col("n0"), F.col("n1"))
    return tested.select(
        "feature",
        F.round("d", 4).alias("ks_statistic"),
        F.round(p, 6).alias("p_value"),
        (p < alpha).alias("significant"),
        F.round("mean0", 4).alias("mean_target0"),
        F.round("mean1", 4).alias("mean_target1"),
    ).orderBy(F.desc("ks_statistic"), "feature")


def chi2_tests(
    df: DataFrame, target: str = S.TARGET, alpha: float = S.ALPHA, cols: list[str] | None = None
) -> DataFrame:
    """Chi-square of independence of text and low-cardinality numeric columns.

    Both class counts of a value sit in one row, so empty cells need no filling. With one
    degree of freedom the continuity correction applies.
    """
    if cols is None:
        numbers = shaping.numeric_columns(df, (target,))
        cols = shaping.text_columns(df, (target,)) + shaping.few_distinct(df, numbers)
    cells = shaping.crosstab(df, cols, target)
    totals = cells.groupBy("feature").agg(
        F.sum("n0").alias("c0"), F.sum("n1").alias("c1"), F.count("*").alias("n_values")
    )
    # one row per tested column
    joined = cells.join(F.broadcast(totals), "feature").filter("n_values > 1 and c0 > 0 and c1 > 0")
    total = F.col("c0") + F.col("c1")
    size = F.col("n0") + F.col("n1")

    def part(observed: str, column_total: str):
        expected = size.cast("double") * F.col(column_total) / total
        gap = F.abs(F.col(observed) - expected)
        gap = F.when(F.col("n_values") == 2, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
        return gap * gap / expected

    result = joined.groupBy("feature").agg(
        F.sum(part("n0", "c0") + part("n1", "c1")).alias("x"),
        (F.first("n_values") - 1).cast("int").alias("degrees_of_freedom"),
    )
    p = F.col("p")
    return (
        result.withColumn("p", tails.chi2_p_value("x", "degrees_of_freedom"))
        .select(
            "feature",
            F.round("x", 4).alias("chi2_statistic"),
            F.round(p, 6).alias("p_value"),
            "degrees_of_freedom",
            (p < alpha).alias("significant"),
        )
        .orderBy(F.desc("chi2_statistic"), "feature")
    )


def statistical_report(
    ks: DataFrame, chi2: DataFrame, rows: int = S.REPORT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(top tests in long form, counts of significant and tested features)."""

    def top(df: DataFrame, test: str, statistic: str) -> DataFrame:
        return (
            df.orderBy(F.desc(statistic), "feature")
            .limit(rows)
            .select(
                F.lit(test).alias("test"),
                "feature",
                F.col(statistic).alias("statistic"),
                "p_value",
                "significant",
            )
        )

    tests = top(ks, "ks", "ks_statistic").unionByName(top(chi2, "chi2", "chi2_statistic"))
    both = ks.select(F.lit("ks").alias("test"), "significant").unionByName(
        chi2.select(F.lit("chi2").alias("test"), "significant")
    )
    counts = both.agg(
        F.count_if((F.col("test") == "ks") & F.col("significant")).alias(
            "ks_tests_significant_count"
        ),
        F.count_if((F.col("test") == "chi2") & F.col("significant")).alias(
            "chi2_tests_significant_count"
        ),
        F.count("*").alias("total_features_tested"),
    )
    return tests, counts
