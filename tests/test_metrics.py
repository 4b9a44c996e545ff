"""Distributed metrics against plain definitions on small samples."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from loanlark import settings as S
from loanlark.functions import ordering as O
from loanlark.operators import bootstrap, evaluation, hypothesis, importance, learner, sampling


@pytest.fixture(scope="module")
def sample():
    rng = random.Random(5)
    rows = []
    for i in range(300):
        p = round(rng.random(), 2)
        rows.append((i, p, int(rng.random() < 0.2 + 0.5 * p)))
    return rows


@pytest.fixture(scope="module")
def scored(spark, sample):
    return spark.createDataFrame(sample, "id long, p double, y int")


def pairwise_auc(rows):
    pos = [p for _, p, y in rows if y == 1]
    neg = [p for _, p, y in rows if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def step_precision(rows):
    total, last, n1 = 0.0, 0.0, sum(y for *_, y in rows)
    for t in sorted({p for _, p, _ in rows}, reverse=True):
        tp = sum(y for _, p, y in rows if p >= t)
        n = sum(1 for _, p, _ in rows if p >= t)
        total += (tp / n1 - last) * tp / n
        last = tp / n1
    return total


def test_ranking_metrics(scored, sample):
    got = evaluation.ranking_metrics(scored, "p", "y").first()
    assert got["auc_roc"] == pytest.approx(pairwise_auc(sample))
    assert got["auc_pr"] == pytest.approx(step_precision(sample))
    gaps = [
        abs(
            np.mean([p <= t for _, p, y in sample if y == 0])
            - np.mean([p <= t for _, p, y in sample if y == 1])
        )
        for _, t, _ in sample
    ]
    assert got["ks_statistic"] == pytest.approx(max(gaps))


def test_reversed_score_mirrors_auc(scored, sample):
    flipped = scored.withColumn("p", -F.col("p"))
    got = evaluation.ranking_metrics(flipped, "p", "y").first()
    assert got["auc_roc"] == pytest.approx(1 - pairwise_auc(sample))


def test_one_hot_score_does_not_change_results(spark, sample):
    """A third of all rows on one score."""
    rows = sample + [(1000 + i, 0.37, i % 2) for i in range(150)]
    got = evaluation.ranking_metrics(
        spark.createDataFrame(rows, "id long, p double, y int"), "p", "y"
    ).first()
    assert got["auc_roc"] == pytest.approx(pairwise_auc(rows))
    assert got["auc_pr"] == pytest.approx(step_precision(rows))


def test_running_sums_equal_one_window(spark):
    df = spark.createDataFrame([(float(i % 97), i % 2) for i in range(1000)], "x double, y int")
    rows = O.class_counts(df, ["x"], "y").orderBy("value").collect()
    assert [r["run_one"] for r in rows] == list(range(1, 98))
    total = 0
    for r in rows:
        total += r["n1"]
        assert r["run_n1"] == total and r["all_n1"] == 500


@pytest.mark.parametrize("shape", ["spread", "hot", "constant", "tiny"])
def test_exact_quantiles(spark, shape):
    rng = random.Random(3)
    data = {
        "spread": [rng.gauss(0, 5) for _ in range(501)],
        "hot": [0.0] * 200 + [rng.random() for _ in range(301)] + [-1.0] * 10,
        "constant": [4.0] * 9,
        "tiny": [2.0, 1.0],
    }[shape]
    df = spark.createDataFrame([(x,) for x in data] + [(None,)], "x double")
    probabilities = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = {r["probability"]: r["value"] for r in O.exact_quantiles(df, ["x"], probabilities).collect()}
    for p in probabilities:
        assert got[p] == pytest.approx(np.quantile(data, p))


def reference_curve(rows):
    """Descending distinct scores with cumulative counts."""
    points = []
    for t in sorted({p for _, p, _ in rows}, reverse=True):
        points.append(
            (sum(1 for _, p, y in rows if p >= t and y == 0), sum(1 for _, p, y in rows if p >= t and y == 1))
        )
    return points


@pytest.mark.parametrize("points", [7, 200])
def test_roc_curve(scored, sample, points):
    curve = reference_curve(sample)
    fps, tps = [c[0] for c in curve], [c[1] for c in curve]
    bends = np.logical_or(np.diff(fps, 2), np.diff(tps, 2))
    keep = np.where(np.r_[True, bends, True])[0]
    fpr = np.r_[0, np.array(fps)[keep] / fps[-1]]
    tpr = np.r_[0, np.array(tps)[keep] / tps[-1]]
    idx = np.linspace(0, len(fpr) - 1, min(points, len(fpr))).astype(int)
    got = evaluation.roc_curve(scored, "p", "y", points).orderBy("idx").collect()
    assert [r["idx"] for r in got] == list(range(len(idx)))
    assert [r["fpr"] for r in got] == pytest.approx(list(fpr[idx]))
    assert [r["tpr"] for r in got] == pytest.approx(list(tpr[idx]))


@pytest.mark.parametrize("points", [7, 200])
def test_pr_curve(scored, sample, points):
    curve = reference_curve(sample)[::-1]
    precision = np.r_[[tp / (tp + fp) for fp, tp in curve], 1.0]
    recall = np.r_[[tp / curve[0][1] for _, tp in curve], 0.0]
    idx = np.linspace(0, len(recall) - 1, min(points, len(recall))).astype(int)
    got = evaluation.pr_curve(scored, "p", "y", points).orderBy("idx").collect()
    assert [r["precision"] for r in got] == pytest.approx(list(precision[idx]))
    assert [r["recall"] for r in got] == pytest.approx(list(recall[idx]))


def test_calibration_curve(scored, sample):
    p = np.array([r[1] for r in sample])
    y = np.array([r[2] for r in sample])
    edges = np.percentile(p, np.linspace(0, 1, 11) * 100)
    bins = np.searchsorted(edges[1:-1], p)
    want = [(p[bins == b].mean(), y[bins == b].mean()) for b in range(10) if (bins == b).any()]
    got = evaluation.calibration_curve(scored, "p", "y").orderBy("idx").collect()
    assert [r["mean_predicted"] for r in got] == pytest.approx([w[0] for w in want])
    assert [r["fraction_pos"] for r in got] == pytest.approx([w[1] for w in want])


def test_histogram_matches_equal_bins(scored, sample):
    want0, _ = np.histogram([p for _, p, y in sample if y == 0], bins=30, range=(0, 1))
    got = evaluation.score_histogram(scored, "p", "y").orderBy("bin").collect()
    assert [r["non_default"] for r in got] == list(want0)
    assert sum(r["non_default"] + r["default"] for r in got) == len(sample)


@pytest.mark.parametrize("metric", ["f1", "precision", "recall", "ks"])
def test_threshold_search(scored, sample, metric):
    best, best_t = -1.0, None
    for t in np.linspace(0.01, 0.99, 200):
        tp = sum(1 for _, p, y in sample if p >= t and y == 1)
        fp = sum(1 for _, p, y in sample if p >= t and y == 0)
        fn = sum(1 for _, p, y in sample if p < t and y == 1)
        v = {
            "f1": 2 * tp / (2 * tp + fp + fn),
            "precision": tp / (tp + fp) if tp + fp else 0.0,
            "recall": tp / (tp + fn),
            "ks": 0.0,
        }[metric]
        if v > best:
            best, best_t = v, t
    got = evaluation.optimal_threshold(scored, "p", "y", metric).first()
    assert got["threshold"] == pytest.approx(round(best_t, 4))
    if metric != "ks":
        assert got["value"] == pytest.approx(round(best, 4))


def test_threshold_tie_takes_the_lower(spark):
    df = spark.createDataFrame([(0.2, 0), (0.8, 1)], "p double, y int")
    got = evaluation.optimal_threshold(df, "p", "y").first()
    grid = [t for t in np.linspace(0.01, 0.99, 200) if 0.2 < t]
    assert got["threshold"] == pytest.approx(round(grid[0], 4)) and got["value"] == 1.0


def test_empty_cells_of_the_confusion_matrix(spark):
    df = spark.createDataFrame([(0.9, 1)], "p double, y int")
    got = evaluation.confusion(df, "p", "y", 0.5).first()
    assert tuple(got) == (0, 0, 0, 1)
    none = spark.createDataFrame([(0.1, 1)], "p double, y int")
    assert tuple(evaluation.threshold_metrics(none, "p", "y", 0.5).first()) == (0.0, 0.0, 0.0)


def test_ks_of_shifted_samples(spark):
    rows = [(float(v), 0) for v in (1, 2, 3) * 5] + [(float(v), 1) for v in (2, 3, 4) * 5]
    df = spark.createDataFrame(rows, "x double, y int")
    got = hypothesis.ks_tests(df, "y").first()
    assert got["ks_statistic"] == 0.3333 and got["mean_target0"] == 2.0 and got["mean_target1"] == 3.0


def test_ks_gates(spark):
    rows = [(float(i), i % 2, float(i) if i < 5 else None, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "x double, two int, few double, y int")
    assert [r["feature"] for r in hypothesis.ks_tests(df, "y").collect()] == ["x"]


def test_ks_p_value(spark):
    """Against the series summed in Python."""
    rows = [(i / 50.0, 0) for i in range(50)] + [(i / 50.0 + 0.3, 1) for i in range(40)]
    df = spark.createDataFrame(rows, "x double, y int")
    got = hypothesis.ks_tests(df, "y").first()
    n = 50 * 40 / 90
    d = max(
        abs(np.mean([x <= t for x, y in rows if y == 0]) - np.mean([x <= t for x, y in rows if y == 1]))
        for t, _ in rows
    )
    lam = (math.sqrt(n) + 0.12 + 0.11 / math.sqrt(n)) * d
    p = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 60))
    assert got["p_value"] == pytest.approx(p, abs=1e-6) and bool(got["significant"])


def test_chi2_of_two_by_two_is_corrected(spark):
    rows = [("a", 0)] * 10 + [("a", 1)] * 20 + [("b", 0)] * 20 + [("b", 1)] * 10
    got = hypothesis.chi2_tests(spark.createDataFrame(rows, "c string, y int"), "y").first()
    assert got["chi2_statistic"] == 5.4 and got["degrees_of_freedom"] == 1
    assert got["p_value"] == pytest.approx(math.erfc(math.sqrt(2.7)), abs=1e-6)


def test_chi2_counts_empty_cells_and_skips_single_values(spark):
    rows = [("a", "k", 0)] * 8 + [("b", "k", 1)] * 6 + [("c", "k", 0)] * 4 + [(None, "k", 1)] * 2
    df = spark.createDataFrame(rows, "c string, one string, y int")
    got = hypothesis.chi2_tests(df, "y").collect()
    assert [r["feature"] for r in got] == ["c"]
    assert got[0]["chi2_statistic"] == 20.0 and got[0]["degrees_of_freedom"] == 3


def test_bootstrap_intervals(spark, scored, sample):
    got = {r["metric"]: r for r in bootstrap.bootstrap_intervals(scored, "p", "y", 0.5, 400).collect()}
    rng = np.random.default_rng(1)
    p = np.array([r[1] for r in sample])
    y = np.array([r[2] for r in sample])
    aucs, f1s = [], []
    for _ in range(400):
        i = rng.integers(0, len(p), len(p))
        aucs.append(pairwise_auc(list(zip(i, p[i], y[i]))))
        tp, n = ((p[i] >= 0.5) & (y[i] == 1)).sum(), (p[i] >= 0.5).sum()
        f1s.append(2 * tp / (n + y[i].sum()))
    assert got["auc_roc"]["point"] == pytest.approx(pairwise_auc(sample), abs=1e-4)
    for name, values in {"auc_roc": aucs, "f1": f1s}.items():
        assert got[name]["lower"] == pytest.approx(np.quantile(values, 0.025), abs=0.02)
        assert got[name]["upper"] == pytest.approx(np.quantile(values, 0.975), abs=0.02)
        assert got[name]["lower"] < got[name]["point"] < got[name]["upper"]


def test_resampled_metrics_equal_weighted_definitions(spark, scored, monkeypatch):
    """Range-wise partial sums give the metrics of the explicitly weighted sample."""
    got = bootstrap.resampled_metrics(scored, "p", "y", 0.5, 3, 7).orderBy("iteration").collect()
    counts = O.class_counts(scored, ["p"], "y").select("value", "n0", "n1").toPandas().sort_values("value")
    its = np.arange(3)
    s = counts["value"].to_numpy()
    w0 = bootstrap._weights(s, counts["n0"].to_numpy(), 14, its)
    w1 = bootstrap._weights(s, counts["n1"].to_numpy(), 15, its)
    for k in range(3):
        a, b = w1[:, k], w0[:, k]
        auc = sum(a[i] * (b[:i].sum() + b[i] / 2) for i in range(len(s))) / (a.sum() * b.sum())
        ap = sum(
            a[i] / a.sum() * a[i:].sum() / (a[i:].sum() + b[i:].sum()) for i in range(len(s)) if a[i]
        )
        assert got[k]["auc_roc"] == pytest.approx(auc) and got[k]["auc_pr"] == pytest.approx(ap)


def test_poisson_weights_have_the_right_moments():
    scores = np.linspace(0, 1, 2000)
    for n in (1, 40, 10_000):
        w = bootstrap._weights(scores, np.full(2000, n), 3, np.arange(50))
        assert w.mean() == pytest.approx(n, rel=0.01) and w.var() == pytest.approx(n, rel=0.05)


def test_split_and_folds(spark):
    rows = [(i, int(i % 13 == 0)) for i in range(1003)]
    df = spark.createDataFrame(rows, "id long, y int")
    split = sampling.stratified_split(df, "y", "id")
    n = {(r["split"], r["y"]): r["count"] for r in split.groupBy("split", "y").count().collect()}
    assert n[("test", 0)] + n[("test", 1)] == math.ceil(1003 * 0.2)
    assert abs(n[("test", 1)] - 78 * 0.2) < 1
    again = sampling.stratified_split(df.repartition(7), "y", "id")
    assert split.exceptAll(again).count() == 0
    folds = sampling.stratified_folds(df, "y", "id").groupBy("fold", "y").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in folds if r["y"] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_sigmoid_calibration_fits_smoothed_targets(spark, scored, sample):
    got = learner.calibrated(learner.fit_sigmoid(scored, "p", "y"), scored, "p")
    n1 = sum(y for *_, y in sample)
    n0 = len(sample) - n1
    p = np.array([r[1] for r in sample])
    t = np.array([(n1 + 1) / (n1 + 2) if r[2] else 1 / (n0 + 2) for r in sample])
    a = b = 0.0
    for _ in range(50):
        q = 1 / (1 + np.exp(-(a * p + b)))
        w = q * (1 - q)
        h = np.array([[(w * p * p).sum(), (w * p).sum()], [(w * p).sum(), w.sum()]])
        a, b = np.array([a, b]) + np.linalg.solve(h, [((t - q) * p).sum(), (t - q).sum()])
    for r in got.collect():
        assert r["probability"] == pytest.approx(1 / (1 + math.exp(-(a * r["p"] + b))), abs=1e-5)


def test_sigmoid_calibration_after_an_observation(spark, scored):
    seen = Observation()
    scored.observe(seen, F.count("*").alias("n")).count()
    assert seen.get["n"] == scored.count()
    got = learner.calibrated(learner.fit_sigmoid(scored, "p", "y"), scored, "p")
    assert got.filter(F.col("probability").between(0, 1)).count() == scored.count()


def test_isotonic_calibration_is_monotone_and_clipped(spark, scored):
    model = learner.fit_isotonic(scored, "p", "y")
    rows = learner.calibrated(model, scored, "p").select("p", "probability").orderBy("p").collect()
    assert all(a["probability"] <= b["probability"] + 1e-12 for a, b in zip(rows, rows[1:]))
    outside = spark.createDataFrame([(-5.0,), (5.0,)], "p double")
    ends = [r["probability"] for r in learner.calibrated(model, outside, "p").orderBy("p").collect()]
    assert ends == [rows[0]["probability"], rows[-1]["probability"]]


def test_top_importance(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 4.0), ("c", 2.0)], "feature string, v double")
    got = [tuple(r) for r in importance.top_importance(df, "v", 2).collect()]
    assert got == [("b", 4.0, 1.0), ("c", 2.0, 0.5)]


def test_random_trials_repeat_and_stay_in_range():
    trials = learner.random_trials(20)
    assert trials == learner.random_trials(20)
    for t in trials:
        for name, (low, high, _) in S.SEARCH_RANGES.items():
            assert low <= t[name] <= high
