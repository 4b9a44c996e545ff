"""Early stopping by rounds, pooled calibration, and the order of resampling and folds."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import functions as F

from loanlark import settings as S
from loanlark.operators import encoding, importance, learner
from loanlark.plans import training


def rows(spark, n: int, seed: int):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, 4))
    y = (x[:, 0] + 0.7 * x[:, 1] * x[:, 0] + draw.normal(size=n) > 1.1).astype(int)
    return spark.createDataFrame([(i, int(t), v.tolist()) for i, (t, v) in enumerate(zip(y, x))], f"{S.ID} long, {S.TARGET} int, x array<double>")


def test_best_prefix():
    assert learner.best_prefix([5, 4, 3, 4, 4, 1], 2) == (3, True)
    assert learner.best_prefix([5, 4, 3, 4, 4, 1], 4) == (6, False)
    assert learner.best_prefix([5, 4, 3, 4], 5) == (3, False)
    assert learner.best_prefix([2, 2, 2], 2) == (1, True) and learner.best_prefix([], 3) == (1, False)


def test_boosting_stops_at_the_best_prefix(spark):
    train, held_out = rows(spark, 300, 1), rows(spark, 300, 2)
    params = {"n_estimators": 40, "learning_rate": 0.5, "max_depth": 4}
    made = learner.fit_trees(train, held_out, params, patience=5)
    part = learner.with_vector(train.select(F.col(S.TARGET).cast("double").alias(S.TARGET), "x")).select(S.TARGET, "features")
    whole = learner.learner(params).fit(part)
    losses = list(whole.evaluateEachIteration(learner.with_vector(held_out.select(F.col(S.TARGET).cast("double").alias(S.TARGET), "x"))))
    best, stopped = learner.best_prefix(losses, 5)
    assert stopped and made.getNumTrees == best < 40
    # the same trees as the first of the whole ensemble
    assert [t.toDebugString.split("\n", 1)[1] for t in made.trees] == [t.toDebugString.split("\n", 1)[1] for t in whole.trees[:best]]
    assert learner.fit_trees(train, held_out, params, patience=100).getNumTrees == int(np.argmin(losses)) + 1


def plain_rates(scores, y):
    """Pool adjacent violators on all distinct scores at once."""
    blocks = []
    for s in sorted(set(scores)):
        own = [t for p, t in zip(scores, y) if p == s]
        blocks.append([[s], sum(own), len(own)])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2] + last[2]]
    return {s: ones / n for own, ones, n in blocks for s in own}, len(blocks)


@pytest.mark.parametrize("case", ["random", "falling", "saw", "rising", "one score", "hot score"])
def test_pooling_by_ranges_is_pooling_at_once(spark, case):
    draw = np.random.default_rng(7)
    n = 900
    scores = np.round(draw.random(n), 3)
    p = {"random": 0.3, "falling": 1 - scores, "saw": (scores * 20) % 1, "rising": scores, "one score": 0.5, "hot score": scores}[case]
    if case == "one score":
        scores[:] = 0.25
    if case == "hot score":
        scores[: n * 9 // 10] = 0.5
    y = (draw.random(n) < p).astype(int)
    df = spark.createDataFrame([(float(s), int(t)) for s, t in zip(scores, y)] + [(0.1, None)], "p double, y int")
    model = learner.fit_isotonic(df, "p", "y", rows_per_range=60)
    want, blocks = plain_rates(scores.tolist(), y.tolist())
    got = {r.p: r.probability for r in learner.calibrated(model, df.select("p").distinct(), "p").collect()}
    assert all(got[s] == pytest.approx(rate, abs=1e-9) for s, rate in want.items())
    assert learner.block_count(model) == blocks
    by_score = df.filter("y is not null").groupBy("p").agg(F.avg("y").alias("r"), F.count("*").cast("double").alias("w"))
    plain = IsotonicRegression(featuresCol="p", labelCol="r", weightCol="w").fit(by_score)
    assert [*plain.boundaries.toArray()] == pytest.approx([*model.boundaries.toArray()])


def test_folds_before_resampling_hide_no_row(spark):
    df, seen = rows(spark, 240, 3), []

    def resample(part):
        seen.append({r[0] for r in part.select(S.ID).collect()})
        return part.select(S.TARGET, "x").union(part.filter(f"{S.TARGET} = 1").select(S.TARGET, "x"))

    found = learner.search(df, [{"n_estimators": 2, "max_depth": 2}, {"n_estimators": 3, "max_depth": 1}], S.ID, folds=3, resample=resample)
    assert len(found) == 2 and found[0][1] >= found[1][1] and all(0.5 < auc <= 1 for _, auc in found)
    # one resampling a fold, shared by the trials; each row is held out once
    assert len(seen) == 3 and all(len(s) in range(158, 163) for s in seen)
    assert all(sum(i in s for s in seen) == 2 for i in range(240))


@pytest.mark.parametrize("clean", [False, True])
def test_training_searches_in_both_orders(spark, clean):
    df = rows(spark, 500, 4)
    features = df.select(S.ID, S.TARGET, *[F.col("x")[i].alias(f"f{i}") for i in range(4)])
    state = encoding.fit_encoding(features.drop(S.ID, S.TARGET))
    options = training.TrainingOptions(
        ratio=0.9, trials=2, folds=2, patience=3, ranges={"n_estimators": (3, 5, False), "max_depth": (2, 3, False)},
        resample_in_folds=clean, calibration_share=0.5 if clean else 0.0,
    )
    made = training.train(features, state, features.drop(S.ID, S.TARGET).schema, options)
    assert {"n_estimators", "max_depth"} <= set(made.params) and 0.5 < made.search_auc <= 1
    assert 1 <= made.rounds <= made.params["n_estimators"]
    # a fifth is validation; the clean order keeps half of it for the metrics alone
    assert made.validation.count() == (50 if clean else 100)
    assert made.validation.filter("probability between 0 and 1").count() == made.validation.count()
    defaults = training.TrainingOptions()
    assert (defaults.trials, defaults.folds, defaults.patience, defaults.ranges) == (50, 5, 50, S.SEARCH_RANGES)


def test_importance_scores_only_what_trees_split_on(spark, monkeypatch):
    """Every feature gets its row; one that no tree reads loses nothing and is not scored."""
    draw = np.random.default_rng(9)
    x = draw.normal(size=(200, 12))
    y = (x[:, 3] > 0.4).astype(int)
    names = [f"f{i}" for i in range(12)]
    df = spark.createDataFrame([(i, int(t), *v.tolist()) for i, (t, v) in enumerate(zip(y, x))], ", ".join([f"{S.ID} long, {S.TARGET} int", *[f"{c} double" for c in names]]))
    model = learner.fit_trees(learner.as_array(df, names), params={"n_estimators": 2, "max_depth": 1})
    used = [int(i) for i in model.featureImportances.indices]
    assert 3 in used and len(used) <= 2
    scored, raw = [], learner.raw_scores
    monkeypatch.setattr(learner, "raw_scores", lambda m, rows, **k: scored.append(rows.count()) or raw(m, rows, **k))
    got = {r.feature: r for r in importance.permutation_importance(model, df, names).collect()}
    assert scored == [200 * (1 + len(used))]
    assert set(got) == set(names) and all(got[f"f{i}"].importance == got[f"f{i}"].gain == 0 for i in range(12) if i not in used)
    # against scores of the rows with the one column exchanged
    k1, k2 = ([r.v for r in df.orderBy(S.ID).select(F.xxhash64(F.col(S.ID).cast("long"), F.lit(S.SEED + s)).alias("v")).collect()] for s in (0, 1))
    changed = x.copy()
    changed[np.argsort(k1), 3] = x[np.argsort(k2), 3]

    def auc(points) -> float:
        rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "i long, x array<double>")
        p = np.array([r.raw_probability for r in raw(model, rows).orderBy("i").collect()])
        gaps = p[y == 1][:, None] - p[y == 0][None, :]
        return float((gaps > 0).mean() + (gaps == 0).mean() / 2)

    assert got["f3"].importance == pytest.approx(auc(x) - auc(changed), abs=1e-6)
