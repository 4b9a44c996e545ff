"""Boosted trees, parameter search and probability calibration on MLlib."""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlark import settings as S
from loanlark.functions import ordering as O
from loanlark.functions import ranges as R
from loanlark.operators import sampling
from loanlark.session import scratch_path, shared_dir, through_storage

# Learner parameters that MLlib's boosted trees share with the searched ones.
PARAM_NAMES = {
    "n_estimators": "maxIter",
    "learning_rate": "stepSize",
    "max_depth": "maxDepth",
    "min_child_samples": "minInstancesPerNode",
    "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy",
}


def as_array(df: DataFrame, features: list[str], name: str = "x") -> DataFrame:
    """Pack numeric columns into one array column."""
    return df.withColumn(name, F.array(*[F.col(c).cast("double") for c in features]))


def with_vector(df: DataFrame, array: str = "x") -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(array)))


def learner(params: dict | None = None, label: str = S.TARGET) -> GBTClassifier:
    """A GBT classifier from learner-neutral parameter names."""
    gbt = GBTClassifier(featuresCol="features", labelCol=label, seed=S.SEED)
    return gbt.copy({gbt.getParam(k): v for k, v in mapped_params(params or {}).items()})


def mapped_params(params: dict) -> dict:
    unknown = sorted(set(params) - set(PARAM_NAMES))
    if unknown:
        raise ValueError(f"no such learner parameters: {unknown}; known: {sorted(PARAM_NAMES)}")
    out = {PARAM_NAMES[k]: v for k, v in params.items()}
    if "featureSubsetStrategy" in out:
        out["featureSubsetStrategy"] = str(float(out["featureSubsetStrategy"]))
    return out


def best_prefix(losses: list[float], patience: int) -> tuple[int, bool]:
    """(how many first trees have the least loss, whether the loss then stayed above it for
    ``patience`` trees); what comes after such a stretch is not looked at."""
    least, at = math.inf, 0
    for n, loss in enumerate(losses, 1):
        if loss < least:
            least, at = loss, n
        elif n - at >= patience:
            return at, True
    return max(at, 1), False


def fit_trees(
    train: DataFrame,
    validation: DataFrame | None = None,
    params: dict | None = None,
    label: str = S.TARGET,
    array: str = "x",
    patience: int = S.EARLY_STOPPING_ROUNDS,
) -> GBTClassificationModel:
    """Fit; with validation rows, as many trees as have the least log loss on them before it
    fails to fall for ``patience`` trees.

    Boosting is staged: the first ``2 * patience`` trees, then twice as many while the loss still
    falls, one pass over the validation rows giving the loss after every tree of a stage. The
    best first trees are then fitted again: the seed of a tree depends on its number only, so
    they are the same trees.
    """
    session = train.sparkSession
    if session.sparkContext.getCheckpointDir() is None:
        # MLlib then cuts the growing lineage of the residuals every few trees
        session.sparkContext.setCheckpointDir(shared_dir(session))

    def rows(df: DataFrame) -> DataFrame:
        return with_vector(
            df.select(F.col(label).cast("double").alias(label), F.col(array).alias("x"))
        ).select(label, "features")

    gbt, given = learner(params, label), rows(train)
    if validation is None:
        return gbt.fit(given)
    held_out, most = rows(validation), gbt.getMaxIter()
    trees = min(most, max(1, 2 * patience))
    while True:
        model = gbt.copy({gbt.maxIter: trees}).fit(given)
        best, stopped = best_prefix(list(model.evaluateEachIteration(held_out)), patience)
        if stopped or trees == most:
            return model if best == trees else gbt.copy({gbt.maxIter: best}).fit(given)
        trees = min(most, 2 * trees)


def raw_scores(
    model: GBTClassificationModel, df: DataFrame, array: str = "x", name: str = "raw_probability"
) -> DataFrame:
    """Add the positive-class probability."""
    return (
        model.transform(with_vector(df, array))
        .withColumn(name, vector_to_array("probability")[1])
        .drop("features", "rawPrediction", "probability", "prediction")
    )


def random_trials(n: int, seed: int = S.SEED, ranges: dict | None = None) -> list[dict]:
    """Seeded draws from the search ranges, integers kept whole, log scales respected."""
    rng = random.Random(seed)
    trials = []
    for _ in range(n):
        trial = {}
        for name, (low, high, log) in (ranges or S.SEARCH_RANGES).items():
            if log:
                trial[name] = math.exp(rng.uniform(math.log(low), math.log(high)))
            elif isinstance(low, int):
                trial[name] = rng.randint(low, high)
            else:
                trial[name] = rng.uniform(low, high)
        trials.append(trial)
    return trials


def search(
    df: DataFrame,
    trials: list[dict],
    key: str,
    label: str = S.TARGET,
    array: str = "x",
    folds: int = S.SEARCH_FOLDS,
    parallelism: int = 2,
    seed: int = S.SEED,
    resample: Callable[[DataFrame], DataFrame] | None = None,
) -> list[tuple[dict, float]]:
    """(trial, mean AUC over stratified folds), best first; one result per trial.

    The folds are stored once and shared by all trials. With ``resample``, which maps rows of
    (key, label, array) to rows of (label, array), the training part of every fold is resampled
    by itself and stored, so no synthetic row descends from a row it is judged on; without,
    the rows are taken as given. Only folds are fitted, never all rows.
    """
    split = sampling.stratified_folds(df.select(key, label, array), label, key, folds, seed)
    split = through_storage(split, "folds")
    parts = []
    for fold in range(folds):
        train = split.filter(F.col("fold") != fold).drop("fold")
        if resample is not None:
            train = through_storage(resample(train), f"fold-{fold}")
        parts.append((train, split.filter(F.col("fold") == fold)))
    judge = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="raw_probability", numBins=0)

    def auc(task: tuple[dict, int]) -> float:
        params, fold = task
        train, held_out = parts[fold]
        scored = raw_scores(fit_trees(train, None, params, label, array), held_out, array)
        return judge.evaluate(scored.select(F.col(label).cast("double").alias(label), "raw_probability"))

    tasks = [(t, fold) for t in trials for fold in range(folds)]
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        found = list(pool.map(auc, tasks))
    means = [sum(found[i * folds : (i + 1) * folds]) / folds for i in range(len(trials))]
    return sorted(zip(trials, means), key=lambda r: -r[1])


def _by_score(df: DataFrame, score: str, label: str) -> DataFrame:
    """Distinct scores with class counts: both calibrators need no more."""
    return df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(label) == 0).cast("double").alias("n0"),
        F.count_if(F.col(label) == 1).cast("double").alias("n1"),
    )


def pool(low: list[float], high: list[float], ones: list[float], weight: list[float]) -> list[tuple]:
    """Neighbouring blocks (low, high, ones, weight), pooled until their rates rise strictly.

    Pooling parts of a sequence and then their blocks gives what pooling all at once does.
    """
    blocks: list[list[float]] = []
    for block in zip(low, high, ones, weight):
        blocks.append(list(block))
        # a / b >= c / d without division
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, top, more, heavier = blocks.pop()
            blocks[-1][1:] = [top, blocks[-1][2] + more, blocks[-1][3] + heavier]
    return [tuple(b) for b in blocks]


#: Ranges whose blocks one task pools.
RANGES_AT_ONCE = 64


def pooled_blocks(df: DataFrame, score: str, label: str, rows_per_range: int = R.ROWS_PER_RANGE) -> DataFrame:
    """(bucket, low, high, ones, weight): blocks of scores of rising rates, range by range, then
    over ``RANGES_AT_ONCE`` neighbouring ranges."""
    columns = ["low", "high", "ones", "weight"]

    def pooled(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("low")
        made = pd.DataFrame(pool(*[rows[c].tolist() for c in columns]), columns=columns)
        made.insert(0, "bucket", int(rows["bucket"].iloc[0]))
        return made

    schema = "bucket int, low double, high double, ones double, weight double"
    labelled = df.filter(F.col(label).isin(0, 1))
    counted = (
        O.long_values(labelled, [score], [label], rows_per_range).groupBy("bucket", "value")
        .agg(F.count("*").cast("double").alias("weight"), F.count_if(F.col(label) == 1).cast("double").alias("ones"))
        .select("bucket", F.col("value").alias("low"), F.col("value").alias("high"), "ones", "weight")
    )
    ranges = counted.groupBy("bucket").applyInPandas(pooled, schema)
    wide = ranges.withColumn("bucket", F.floor(F.col("bucket") / RANGES_AT_ONCE).cast("int"))
    return wide.groupBy("bucket").applyInPandas(pooled, schema)


def fit_isotonic(df: DataFrame, score: str, label: str, rows_per_range: int = R.ROWS_PER_RANGE) -> Model:
    """Monotone map from score to observed rate; tied scores are averaged first.

    Scores are pooled range by range. One row for each pooled block reaches the driver, and the
    model is fitted to the blocks' ends, which it has to leave as they are.
    """
    found = sorted(tuple(r)[1:] for r in pooled_blocks(df, score, label, rows_per_range).collect())
    blocks = pool(*map(list, zip(*found))) if found else []
    ends = [(s, ones / weight, weight) for low, high, ones, weight in blocks for s in sorted({low, high})]
    rows = df.sparkSession.createDataFrame(ends, "s double, y double, w double")
    return IsotonicRegression(featuresCol="s", labelCol="y", weightCol="w").fit(rows.coalesce(1))


def block_count(model: Model) -> int:
    """Distinct rates of an isotonic model: its pooled blocks."""
    return len(set(model.predictions.toArray().tolist()))


def fit_sigmoid(df: DataFrame, score: str, label: str) -> Model:
    """Logistic map of the score with smoothed targets.

    The target of a positive is (N1 + 1) / (N1 + 2) and of a negative 1 / (N0 + 2); each
    score becomes two weighted rows, one per class.

    The model is stored and loaded: a fitted one holds its summary and through it the session,
    which no task can be sent once an Observation was used in it.
    """
    counts = _by_score(df, score, label)
    n0, n1 = counts.agg(F.sum("n0"), F.sum("n1")).first()
    high, low = (n1 + 1.0) / (n1 + 2.0), 1.0 / (n0 + 2.0)
    ones = F.col("n1") * high + F.col("n0") * low
    zeros = F.col("n1") * (1 - high) + F.col("n0") * (1 - low)
    rows = counts.select(
        array_to_vector(F.array("s")).alias("features"),
        F.inline(
            F.array(
                F.struct(F.lit(1.0).alias("y"), ones.alias("w")),
                F.struct(F.lit(0.0).alias("y"), zeros.alias("w")),
            )
        ),
    )
    model = LogisticRegression(
        featuresCol="features", labelCol="y", weightCol="w", standardization=False, tol=1e-10
    ).fit(rows)
    path = scratch_path(df.sparkSession, "sigmoid")
    model.save(path)
    return LogisticRegressionModel.load(path)


def fit_calibrator(df: DataFrame, score: str, label: str, method: str = "isotonic") -> Model:
    if method == "isotonic":
        return fit_isotonic(df, score, label)
    if method == "sigmoid":
        return fit_sigmoid(df, score, label)
    raise ValueError(f"unknown calibration method: {method}")


def calibrated(model: Model, df: DataFrame, score: str, name: str = "probability") -> DataFrame:
    """Add the calibrated probability; scores outside the fitted range take its ends."""
    work = df.withColumn("s", F.col(score).cast("double"))
    if hasattr(model, "boundaries"):
        out = model.setPredictionCol(name).transform(work)
        return out.drop("s")
    work = work.withColumn("features", array_to_vector(F.array("s")))
    return (
        model.setProbabilityCol("_p")
        .transform(work)
        .withColumn(name, vector_to_array("_p")[1])
        .drop("s", "features", "rawPrediction", "_p", "prediction")
    )
