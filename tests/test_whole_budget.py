"""The search and the submission spend the whole published budget."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlark import settings as S
from loanlark.operators import learner
from loanlark.plans import queries, training


def test_cv_search_tries_every_trial_on_every_fold(spark, monkeypatch):
    encoded = spark.createDataFrame([(1, 0, 0.5), (2, 1, 1.5)], f"{S.ID} long, {S.TARGET} int, f0 double")
    monkeypatch.setattr(training, "encoded_table", lambda *a: (encoded, None, T.StructType([encoded.schema["f0"]])))
    seen = []

    def search(rows, trials, key, folds):
        seen.append((rows.count(), trials, folds))
        return [(t, 0.5) for t in trials]

    monkeypatch.setattr(learner, "search", search)
    made = queries.cv_search(spark, "anywhere")
    assert seen == [(2, learner.random_trials(50, ranges=S.SEARCH_RANGES), 5)]
    assert made.columns == ["place", *S.SEARCH_RANGES, "auc"] and made.count() == 50
    least, most = made.agg(F.min("n_estimators"), F.max("n_estimators")).first()
    assert 300 <= least < 500 and 1300 < most <= 1500


def test_submission_is_of_a_model_with_the_whole_budget(spark, monkeypatch):
    encoded = spark.createDataFrame([(1, 0, 0.5), (2, 1, 1.5)], f"{S.ID} long, {S.TARGET} int, f0 double")
    monkeypatch.setattr(training, "encoded_table", lambda *a: (encoded, None, T.StructType([encoded.schema["f0"]])))
    monkeypatch.setattr(training, "_FITTED", {})
    spent = []

    class Model:
        def probabilities(self, rows):
            return rows.select(S.ID, F.lit(0.25).alias("probability"))

    def train(features, state, fields, options):
        spent.append(options)
        return training.Trained(Model(), {}, features, 0.0)

    monkeypatch.setattr(training, "train", train)
    made = queries.model_submission(spark, "anywhere").orderBy(S.ID).collect()
    assert [tuple(r) for r in made] == [(1, 0.25), (2, 0.25)]
    assert (spent[0].trials, spent[0].folds, spent[0].patience, spent[0].ranges) == (50, 5, 50, S.SEARCH_RANGES)
    # a model of another budget is another model
    assert training.fitted(spark, "anywhere") is not training.fitted(spark, "anywhere", training.TrainingOptions())
    assert len(spent) == 2 and spent[1] is training.QUERY_BUDGET
