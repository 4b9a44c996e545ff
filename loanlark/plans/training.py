"""Training run: split, resample, search, fit, calibrate, choose the threshold, evaluate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlark import settings as S
from loanlark.operators import (
    encoding,
    evaluation,
    history,
    learner,
    resampling,
    sampling,
    shaping,
)
from loanlark.operators.application import application_features
from loanlark.operators.scoring import RiskModel
from loanlark.plans import standins
from loanlark.session import through_storage


@dataclass
class TrainingOptions:
    """The budget and the order of a training run; the defaults are the published workload's.

    Resampling before the folds and one validation part for early stopping, calibration,
    threshold and metrics are the original order. ``resample_in_folds`` resamples the training
    part of each fold by itself; ``calibration_share`` sets that share of the validation rows
    apart for early stopping, calibration and threshold, and leaves the rest to the metrics.
    """

    resampling: str = "smote"
    ratio: float = S.RESAMPLE_RATIO
    neighbours: int = S.NEIGHBOURS
    trials: int = S.SEARCH_TRIALS
    ranges: dict = field(default_factory=lambda: dict(S.SEARCH_RANGES))
    folds: int = S.SEARCH_FOLDS
    parallelism: int = 2
    params: dict = field(default_factory=dict)
    patience: int = S.EARLY_STOPPING_ROUNDS
    calibration: str = "isotonic"
    threshold_metric: str = "f1"
    resample_in_folds: bool = False
    calibration_share: float = 0.0


#: What ``gbt_fit_score`` and the queries that score with its model spend; every step of the full
#: run is in it. ``cv_search`` and ``model_submission`` spend the whole budget.
QUERY_BUDGET = TrainingOptions(
    trials=2,
    folds=2,
    patience=4,
    ranges={
        "n_estimators": (6, 12, False),
        "learning_rate": (0.05, 0.3, True),
        "max_depth": (2, 4, False),
        "min_child_samples": (10, 100, False),
        "subsample": (0.5, 1.0, False),
        "colsample_bytree": (0.4, 1.0, False),
    },
)


@dataclass
class Trained:
    model: RiskModel
    params: dict
    validation: DataFrame
    threshold_value: float
    test_features: DataFrame | None = None
    search_auc: float | None = None
    rounds: int = 0


def feature_fields(encoded: DataFrame) -> T.StructType:
    """The model's inputs with the types the raw features have before encoding."""
    return T.StructType([f for f in encoded.schema.fields if f.name not in (S.ID, S.TARGET)])


def train(
    features: DataFrame,
    state: encoding.EncodingState,
    raw_fields: T.StructType,
    options: TrainingOptions | None = None,
) -> Trained:
    """Train on encoded features (id, label, numbers).

    ``raw_fields`` are the same columns before encoding: scoring aligns to them. The
    packed rows, the resampled rows and the scored validation rows are written once and
    read back, as the fits pass over them many times.
    """
    o = options or TrainingOptions()
    names = raw_fields.fieldNames()
    packed = learner.as_array(features, names).select(S.ID, S.TARGET, "x", *names)
    split = through_storage(sampling.stratified_split(packed, S.TARGET, S.ID), "split")
    train_rows = split.filter("split = 'train'").select(S.ID, S.TARGET, "x")
    validation = split.filter("split = 'test'").drop("split")
    extra = {"ratio": o.ratio, "k": o.neighbours} if o.resampling in ("smote", "adasyn") else {}

    def resampled_rows(rows: DataFrame) -> DataFrame:
        return resampling.resample(rows, S.TARGET, S.ID, "x", o.resampling, **extra)

    # a stable row key for the folds
    resampled = through_storage(resampled_rows(train_rows).withColumn(S.ID, F.xxhash64(S.TARGET, "x")), "resampled")
    params, search_auc = dict(o.params), None
    if o.trials:
        found = learner.search(
            train_rows if o.resample_in_folds else resampled,
            learner.random_trials(o.trials, ranges=o.ranges),
            S.ID,
            folds=o.folds,
            parallelism=o.parallelism,
            resample=resampled_rows if o.resample_in_folds else None,
        )
        params.update(found[0][0])
        search_auc = found[0][1]
    tuning = validation
    if o.calibration_share:
        parted = through_storage(sampling.stratified_split(validation, S.TARGET, S.ID, 1 - o.calibration_share), "parted")
        tuning, validation = (parted.filter(F.col("split") == part).drop("split") for part in ("train", "test"))
    trees = learner.fit_trees(resampled, tuning, params, patience=o.patience)

    def scored(rows: DataFrame, name: str) -> DataFrame:
        return through_storage(learner.raw_scores(trees, rows), name)

    judged = scored(validation, "validation")
    tuned = scored(tuning, "tuning") if o.calibration_share else judged
    calibrator = learner.fit_calibrator(tuned, "raw_probability", S.TARGET, o.calibration)
    best = evaluation.optimal_threshold(
        learner.calibrated(calibrator, tuned, "raw_probability"), "probability", S.TARGET, o.threshold_metric
    ).first()
    model = RiskModel(state, trees, calibrator, best["threshold"], raw_fields)
    calibrated = learner.calibrated(calibrator, judged, "raw_probability")
    return Trained(model, params, calibrated, best["value"], search_auc=search_auc, rounds=trees.getNumTrees)


def encoded_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, encoding.EncodingState, T.StructType]:
    """All columns of the stand-in features, encoded and imputed, with the fitted state and the
    types before."""
    summaries = history.history_summaries(standins.histories(spark, sf_dir))
    featured = application_features(standins.applications(spark, sf_dir))
    wide = shaping.stored_dense(history.widen(featured, summaries), "wide")
    inputs = wide.drop(S.ID, S.TARGET)
    state = encoding.fit_encoding(inputs)
    encoded = through_storage(encoding.apply_encoding(wide, state, (S.ID, S.TARGET)), "encoded")
    return encoded, state, inputs.schema


_FITTED: dict[tuple[str, str, str], Trained] = {}


def fitted(spark: SparkSession, sf_dir: str, options: TrainingOptions = QUERY_BUDGET) -> Trained:
    """A model trained on all stand-in tables, kept for the session's further queries with the
    same options."""
    key = (spark.sparkContext.applicationId, sf_dir, repr(options))
    if key not in _FITTED:
        encoded, state, fields = encoded_table(spark, sf_dir)
        result = train(encoded, state, fields, options)
        result.test_features = encoded.drop(S.TARGET)
        _FITTED[key] = result
    return _FITTED[key]
