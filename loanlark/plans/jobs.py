"""The four batch stages over raw CSV tables.

    python -m loanlark.plans.jobs --stage all --raw RAW_DIR --work WORK_DIR
"""

from __future__ import annotations

import argparse
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlark import settings as S
from loanlark.operators import (
    bootstrap,
    encoding,
    evaluation,
    history,
    hypothesis,
    importance,
    learner,
    shaping,
)
from loanlark.operators.application import application_features
from loanlark.operators.scoring import RiskModel
from loanlark.plans.training import TrainingOptions, train
from loanlark.session import build_session
from loanlark.sources import sinks, tables

PART = "_part"


def stage_features(spark: SparkSession, raw: str, work: str) -> None:
    """Wide, encoded train and test tables plus the fitted encoding state.

    Both application tables go through one star join, so every history table is read and
    aggregated once.
    """
    data = tables.load_all(spark, raw)
    both = data["train"].withColumn(PART, F.lit("train")).unionByName(
        data["test"].withColumn(PART, F.lit("test")), allowMissingColumns=True
    )
    wide = history.widen(application_features(both), history.history_summaries(data))
    counted, seen = shaping.counting_nulls(wide, F.col(PART) == "train")
    counted.write.mode("overwrite").partitionBy(PART).parquet(f"{work}/wide")
    dense = [c for c in shaping.dense_columns(seen, wide.columns) if c != PART]
    wide = spark.read.parquet(f"{work}/wide")
    train_rows = wide.filter(F.col(PART) == "train").select(*dense)
    inputs = train_rows.drop(S.ID, S.TARGET)
    # train decides the columns; a test column that train dropped goes with it
    test_rows = shaping.align_columns(
        wide.filter(F.col(PART) == "test"), train_rows, (S.TARGET,)
    )
    encoding.fit_encoding(inputs).save(f"{work}/encoding")
    state = encoding.EncodingState.load(spark, f"{work}/encoding")
    keep = (S.ID, S.TARGET)
    sinks.write_parquet(encoding.apply_encoding(train_rows, state, keep), f"{work}/train_features")
    sinks.write_parquet(encoding.apply_encoding(test_rows, state, keep), f"{work}/test_features")
    spark.createDataFrame([(inputs.schema.json(),)], "features string").coalesce(1).write.mode(
        "overwrite"
    ).json(f"{work}/feature_fields")
    train_out = spark.read.parquet(f"{work}/train_features")
    sinks.write_json(
        sinks.report_lines(shaping.target_distribution(train_out), "target_distribution", "target"),
        f"{work}/reports/target_distribution",
    )
    overview = shaping.dataset_overview(train_out, spark.read.parquet(f"{work}/test_features"), data["train"])
    sinks.write_json(sinks.report_lines(overview, "dataset_overview"), f"{work}/reports/dataset_overview")


def feature_schema(spark: SparkSession, work: str) -> T.StructType:
    row = spark.read.schema("features string").json(f"{work}/feature_fields").first()
    return T.StructType.fromJson(json.loads(row["features"]))


def _kept(df: DataFrame, path: str) -> DataFrame:
    sinks.write_parquet(df, path)
    return sinks.read_parquet(df.sparkSession, path)


def stage_stats(spark: SparkSession, work: str) -> None:
    """Screening tests and the dataset summary as JSON reports."""
    rows = spark.read.parquet(f"{work}/train_features")
    # every test is kept; the reports show the first
    ks = _kept(hypothesis.ks_tests(rows), f"{work}/tables/ks_tests")
    chi2 = _kept(hypothesis.chi2_tests(rows), f"{work}/tables/chi2_tests")
    tests, counts = hypothesis.statistical_report(ks, chi2)
    reports = {
        "ks_tests": ks.orderBy(F.desc("ks_statistic"), "feature").limit(S.REPORT_ROWS),
        "chi2_tests": chi2.orderBy(F.desc("chi2_statistic"), "feature").limit(S.REPORT_ROWS),
        "statistical_report": tests,
        "statistical_counts": counts,
        "dataset_summary": shaping.dataset_summary(rows),
    }
    _write_reports(reports, work)


def _write_reports(reports: dict[str, DataFrame], work: str) -> None:
    order = {"roc_curve": "idx", "pr_curve": "idx", "calibration_curve": "idx",
             "score_distribution": "bin"}
    for name, part in reports.items():
        sinks.write_json(sinks.report_lines(part, name, order.get(name)), f"{work}/reports/{name}")


def stage_train(spark: SparkSession, work: str, options: TrainingOptions | None = None) -> dict:
    """Fit and save the model, log the run, write the evaluation reports."""
    o = options or TrainingOptions()
    rows = spark.read.parquet(f"{work}/train_features")
    state = encoding.EncodingState.load(spark, f"{work}/encoding")
    result = train(rows, state, feature_schema(spark, work), o)
    result.model.save(f"{work}/model")
    threshold = result.model.threshold
    scored = result.validation
    reports = evaluation.evaluation_report(scored, "probability", S.TARGET, threshold)
    reports["bootstrap_ci"] = bootstrap.bootstrap_intervals(
        scored, "probability", S.TARGET, threshold
    )
    importances = _kept(
        importance.permutation_importance(result.model.trees, scored, result.model.features.fieldNames()),
        f"{work}/tables/feature_importance",
    )
    reports["feature_importance"] = importances.orderBy(F.desc(importances.columns[1]), "feature").limit(S.IMPORTANCE_STORED)
    _write_reports(reports, work)
    sinks.write_json(evaluation.report_document(scored, "probability", S.TARGET, threshold), f"{work}/reports/evaluation")
    metrics = {
        **reports["ranking"].first().asDict(),
        **reports["threshold_metrics"].first().asDict(),
        "optimal_threshold": threshold,
    }
    params = {
        **result.params, "sampling_method": o.resampling, "n_trials": o.trials, "search_auc": result.search_auc,
        "n_trees": result.rounds, "calibration_blocks": learner.block_count(result.model.calibrator) if o.calibration == "isotonic" else None,
    }
    sinks.append_run(spark, f"{work}/runs", uuid.uuid4().hex, params, metrics)
    return metrics


def stage_predict(spark: SparkSession, work: str) -> None:
    """Score the test features into a submission CSV."""
    model = RiskModel.load(spark, f"{work}/model")
    scored = model.probabilities(spark.read.parquet(f"{work}/test_features"))
    sinks.write_submission(scored, f"{work}/submission")


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument(
        "--stage", choices=["features", "stats", "train", "predict", "all"], default="all"
    )
    parser.add_argument("--raw", required=True, help="folder of the raw CSV tables")
    parser.add_argument("--work", required=True, help="shared folder for results")
    parser.add_argument("--trials", type=int, default=S.SEARCH_TRIALS)
    args = parser.parse_args()
    spark = build_session()
    if args.stage in ("features", "all"):
        stage_features(spark, args.raw, args.work)
    if args.stage in ("stats", "all"):
        stage_stats(spark, args.work)
    if args.stage in ("train", "all"):
        stage_train(spark, args.work, TrainingOptions(trials=args.trials))
    if args.stage in ("predict", "all"):
        stage_predict(spark, args.work)


if __name__ == "__main__":
    main()
