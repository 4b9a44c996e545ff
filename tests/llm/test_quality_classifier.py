"""The quadratic discriminant against plain formulas and on labels it has not seen."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlark.llm import quality_classifier as qc
from loanlark.llm.common import table
from loanlark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def auc(y: np.ndarray, p: np.ndarray) -> float:
    pos, neg = p[y == 1], p[y == 0]
    return float(((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg)).mean())


def test_held_out_labels(spark):
    made = QUERIES["op13_quality_classifier"](spark, SF)
    assert made.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = made.join(table(spark, SF, "labels"), "doc_id", "left").collect()
    assert len(rows) == table(spark, SF, "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    seen = [r for r in rows if r.held_out and r.quality is not None]
    y, p = np.array([r.quality for r in seen]), np.array([r.score for r in seen])
    assert len(seen) > 50 and auc(y, p) > 0.95
    assert np.mean((p >= 0.7) == (y == 1)) > 0.93


def test_held_out_labels_are_not_read(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    labels = table(spark, SF, "labels")
    training = F.crc32(F.col("doc_id").cast("string")) % 4 != 2
    flipped = labels.withColumn("quality", F.when(training, F.col("quality")).otherwise(1 - F.col("quality")))
    a, b = ({r.doc_id: r.score for r in qc.classify(docs, x, training).collect()} for x in (labels, flipped))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-6 for k in a)


def test_density_difference_by_definition():
    draw = np.random.default_rng(1)
    sides = [draw.normal(size=(n, 4)) @ draw.normal(size=(4, 4)) + k for k, n in enumerate((60, 140))]
    moments = tuple(qc.Moments(len(x), x.sum(axis=0), x.T @ x) for x in sides)
    pooled, rounded = 0.3, 0.1
    model = qc.Discriminant.fit(moments, pooled, rounded)
    within = sum(np.cov(x.T, bias=True) * len(x) for x in sides) / 200
    scale = np.sqrt(np.diag(within))
    x = draw.normal(size=(20, 4)) * 2
    wanted = np.log(140 / 60)
    for sign, own in ((-1, sides[0]), (1, sides[1])):
        cov = ((1 - pooled) * np.cov(own.T, bias=True) + pooled * within) / np.outer(scale, scale)
        cov = (1 - rounded) * cov + rounded * np.trace(cov) / 4 * np.eye(4)
        z = (x - own.mean(axis=0)) / scale
        wanted = wanted + sign * (-0.5 * np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(model.difference(x), wanted)
    assert np.allclose(moments[1].without(qc.Moments(40, sides[1][:40].sum(axis=0), sides[1][:40].T @ sides[1][:40])).mean, sides[1][40:].mean(axis=0))


@pytest.mark.parametrize("case", ["rows", "one class", "no labels", "no rows"])
def test_odd_rows(spark, case):
    texts = [None, "", " ", "one", "word " * 5000, "A " * 50, "中文 😀", "ok text here. " * 9, "#$ | " * 40, "same"]
    rows = [(i % 9 if i % 5 else None, t, "s") for i, t in enumerate(texts * 4)]
    docs = spark.createDataFrame([] if case == "no rows" else rows, "doc_id long, text string, score string")
    values = {"rows": [0, 1, None, 2, 1, 0, 1], "one class": [1] * 7, "no labels": [], "no rows": [0, 1]}[case]
    labels = spark.createDataFrame([(i % 8, v) for i, v in enumerate(values * 3)] + [(None, 1)], "doc_id long, quality int")
    made = qc.classify(docs, labels, F.lit(True), out="p")
    assert made.columns == ["doc_id", "score", "p"] and made.count() == docs.count()
    got = [r.p for r in made.collect()]
    assert all(0 <= p <= 1 for p in got)
    if case == "no labels":
        assert set(got) == {0.5}
    if case == "one class":
        assert len(set(got)) == 1


def test_statistics_by_hand():
    raw = qc.statistics(["AB ab ab, 1\n\nAB ab ab, 1", "", "#\n#"])
    by = dict(zip(qc.STATISTICS, raw[0]))
    assert by["words"] == 8 and by["lines"] == 2 and by["lines_again"] == 0.5 and by["shouted_words"] == 0.25
    assert by["same_as_next"] == 0 and by["commonest_word"] == 0.25 and by["distinct_words"] == 0.5
    assert not raw[1].any() and raw[2][qc.STATISTICS.index("same_as_next")] == 0.5
