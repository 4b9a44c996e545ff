"""Bootstrap intervals of classifier metrics.

Each resample gives a row a Poisson(1) weight, the standard distributed form of drawing
with replacement; rows with equal score and class are one entry with a Poisson(n) weight.
A weight is a function of (seed, score, class, iteration) only, so a retried task or
another partitioning draws the same. Scores are cut into ranges; a task holds one range and
returns one row per iteration, so rows x iterations never reaches a shuffle.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlark import settings as S
from loanlark.functions import ordering as O
from loanlark.operators import evaluation

SCORES_PER_RANGE = 50_000
CELLS_AT_ONCE = 1_000_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _uniforms(scores: np.ndarray, stream: int, iterations: np.ndarray) -> np.ndarray:
    """Uniforms in [0, 1): one row per score, one column per iteration."""
    key = _mix(scores.view(np.uint64) + _mix(np.array([stream], dtype=np.uint64)))
    counter = (iterations.astype(np.uint64) + np.uint64(1)) * _STEP
    return (_mix(key[:, None] + counter[None, :]) >> np.uint64(11)).astype(np.float64) * 2.0**-53


@lru_cache(maxsize=256)
def _poisson_cdf(n: int) -> tuple[int, np.ndarray]:
    """First support point and cumulative probabilities; the cut tails weigh below 1e-15."""
    spread = 12.0 * math.sqrt(n) + 30.0
    low, high = max(0, int(n - spread)), int(n + spread)
    logs = np.array([k * math.log(n) - n - math.lgamma(k + 1.0) for k in range(low, high + 1)])
    return low, np.cumsum(np.exp(logs))


def _weights(
    scores: np.ndarray, counts: np.ndarray, stream: int, iterations: np.ndarray
) -> np.ndarray:
    out = np.zeros((len(scores), len(iterations)))
    for n in np.unique(counts):
        if n > 0:
            rows = np.flatnonzero(counts == n)
            low, cdf = _poisson_cdf(int(n))
            drawn = np.searchsorted(cdf, _uniforms(scores[rows], stream, iterations), side="right")
            out[rows] = low + np.minimum(drawn, len(cdf) - 1)
    return out


def _draws(pdf: pd.DataFrame, seed: int, iterations: int):
    """(iterations, scores, class-0 weights, class-1 weights) in memory-sized portions."""
    pdf = pdf.sort_values("value")
    scores = np.ascontiguousarray(pdf["value"].to_numpy(np.float64))
    n0, n1 = pdf["n0"].to_numpy(np.int64), pdf["n1"].to_numpy(np.int64)
    width = max(1, CELLS_AT_ONCE // max(1, len(scores)))
    for start in range(0, iterations, width):
        its = np.arange(start, min(iterations, start + width))
        yield (
            its,
            scores,
            _weights(scores, n0, 2 * seed, its),
            _weights(scores, n1, 2 * seed + 1, its),
        )


def resampled_metrics(
    df: DataFrame, score: str, label: str, threshold: float, iterations: int, seed: int
) -> DataFrame:
    """(iteration, auc_roc, auc_pr, precision, recall, f1); one-class resamples left out."""
    labelled = df.filter(F.col(label).isin(0, 1))
    # a range holds so many rows at most or one score, so never more scores
    counts = (
        O.long_values(labelled, [score], [label], SCORES_PER_RANGE)
        .groupBy("bucket", "value")
        .agg(
            F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")
        )
    )

    def range_totals(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for its, scores, w0, w1 in _draws(pdf, seed, iterations):
            below = np.cumsum(w0, axis=0) - w0
            hit = scores >= threshold
            parts.append(
                pd.DataFrame(
                    {
                        "iteration": its,
                        "bucket": int(pdf["bucket"].iloc[0]),
                        "pos": w1.sum(axis=0),
                        "neg": w0.sum(axis=0),
                        "wins": (w1 * (below + w0 / 2)).sum(axis=0),
                        "tp": w1[hit].sum(axis=0),
                        "fp": w0[hit].sum(axis=0),
                    }
                )
            )
        return pd.concat(parts)

    totals = counts.groupBy("bucket").applyInPandas(
        range_totals,
        "iteration int, bucket int, pos double, neg double, wins double, tp double, fp double",
    )
    ordered = Window.partitionBy("iteration").orderBy("bucket")
    lower = ordered.rowsBetween(Window.unboundedPreceding, -1)
    upper = ordered.rowsBetween(1, Window.unboundedFollowing)
    placed = totals.select(
        "*",
        F.coalesce(F.sum("neg").over(lower), F.lit(0.0)).alias("neg_below"),
        F.coalesce(F.sum("pos").over(upper), F.lit(0.0)).alias("pos_above"),
        F.coalesce(F.sum("neg").over(upper), F.lit(0.0)).alias("neg_above"),
    )

    def precision_sums(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        above = above.sort_values("iteration")
        pos_above, neg_above = above["pos_above"].to_numpy(), above["neg_above"].to_numpy()
        parts = []
        for its, _, w0, w1 in _draws(rows, seed, iterations):
            tp = pos_above[its] + np.cumsum(w1[::-1], axis=0)[::-1]
            fp = neg_above[its] + np.cumsum(w0[::-1], axis=0)[::-1]
            precision = np.divide(tp, tp + fp, out=np.zeros_like(tp), where=(tp + fp) > 0)
            parts.append(
                pd.DataFrame({"iteration": its, "ap_sum": (w1 * precision).sum(axis=0)})
            )
        return pd.concat(parts)

    precision = (
        counts.groupBy("bucket")
        .cogroup(placed.select("bucket", "iteration", "pos_above", "neg_above").groupBy("bucket"))
        .applyInPandas(precision_sums, "iteration int, ap_sum double")
        .groupBy("iteration")
        .agg(F.sum("ap_sum").alias("ap_sum"))
    )
    sums = placed.groupBy("iteration").agg(
        *[F.sum(c).alias(c) for c in ("pos", "neg", "tp", "fp")],
        F.sum(F.col("wins") + F.col("pos") * F.col("neg_below")).alias("wins"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("pos") - F.col("tp")
    return (
        sums.filter("pos > 0 and neg > 0")
        .join(precision, "iteration")
        .select(
            "iteration",
            (F.col("wins") / (F.col("pos") * F.col("neg"))).alias("auc_roc"),
            (F.col("ap_sum") / F.col("pos")).alias("auc_pr"),
            evaluation.precision_of(tp, fp).alias("precision"),
            evaluation.recall_of(tp, fn).alias("recall"),
            evaluation.f1_of(tp, fp, fn).alias("f1"),
        )
    )


METRICS = ["auc_roc", "auc_pr", "precision", "recall", "f1"]


def _by_metric(df: DataFrame, value: str) -> DataFrame:
    return df.select(
        F.inline(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias(value)) for m in METRICS])
        )
    )


def bootstrap_intervals(
    df: DataFrame,
    score: str,
    label: str,
    threshold: float = 0.5,
    iterations: int = S.BOOTSTRAP_ITERATIONS,
    ci: float = S.BOOTSTRAP_CI,
    seed: int = S.SEED,
) -> DataFrame:
    """(metric, point, lower, upper, ci, width): percentile intervals of the five metrics."""
    tail = (1 - ci) / 2
    resampled = resampled_metrics(df, score, label, threshold, iterations, seed)
    # at most ``iterations`` values per metric
    bounds = _by_metric(resampled, "v").groupBy("metric").agg(
        F.percentile("v", F.lit(tail)).alias("lower"),
        F.percentile("v", F.lit(1 - tail)).alias("upper"),
    )
    ranking = evaluation.ranking_metrics(df, score, label).withColumn("k", F.lit(1))
    decided = evaluation.threshold_metrics(df, score, label, threshold).withColumn("k", F.lit(1))
    # one row each
    points = _by_metric(ranking.join(decided, "k"), "point")
    return points.join(bounds, "metric").select(
        "metric",
        F.round("point", 4).alias("point"),
        F.round("lower", 4).alias("lower"),
        F.round("upper", 4).alias("upper"),
        F.lit(ci).alias("ci"),
        F.round(F.round("upper", 4) - F.round("lower", 4), 4).alias("width"),
    )
