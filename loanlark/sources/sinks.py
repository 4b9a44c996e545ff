"""Table, report, state and run-log sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlark import settings as S


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_submission(scores: DataFrame, path: str, probability: str = "probability") -> None:
    """CSV with header: applicant id and probability."""
    scores.select(F.col(S.ID), F.col(probability).cast("double").alias(S.TARGET)).write.mode(
        "overwrite"
    ).option("header", True).csv(path)


def report_lines(report: DataFrame, name: str, order: str | None = None) -> DataFrame:
    """(report, payload): the whole report as one JSON array.

    For bounded reports only (curves, top-k tables, metric rows), never for row data.
    """
    row = F.struct(F.col(order), F.struct("*")) if order else F.struct(F.lit(0), F.struct("*"))
    items = F.array_sort(F.collect_list(row.cast(row_type(report, order))))
    return report.agg(
        F.to_json(F.transform(items, lambda r: r["body"])).alias("payload")
    ).select(F.lit(name).alias("report"), "payload")


def row_type(report: DataFrame, order: str | None):
    from pyspark.sql import types as T

    key = report.schema[order].dataType if order else T.IntegerType()
    return T.StructType([T.StructField("key", key), T.StructField("body", report.schema)])


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_run(
    spark: SparkSession, path: str, run_id: str, params: dict, metrics: dict
) -> None:
    """Append one run's parameters and metrics as (run_id, kind, key, value) rows."""
    rows = [(run_id, "param", k, str(v)) for k, v in params.items()]
    rows += [(run_id, "metric", k, repr(float(v))) for k, v in metrics.items()]
    spark.createDataFrame(rows, "run_id string, kind string, key string, value string").coalesce(
        1
    ).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("run_id string, kind string, key string, value string").parquet(path)
