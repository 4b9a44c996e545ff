"""The four stages over raw CSV files, and streaming against batch scoring."""

import json

import pytest
from pyspark.sql import functions as F

from loanlark import settings as S
from loanlark.operators import scoring
from loanlark.operators.scoring import RiskModel
from loanlark.plans import jobs, standins
from loanlark.plans.training import TrainingOptions
from loanlark.sources import sinks, tables
from loanlark.streaming import scorer

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("raw"))
    apps = standins.applications(spark, SF)
    files = {**standins.histories(spark, SF), "train": apps, "test": apps.drop(S.TARGET, "AMT_REQ_CREDIT_BUREAU_DAY")}
    for name, df in files.items():
        df.write.option("header", True).csv(f"{folder}/{tables.FILES[name]}")
    return folder


@pytest.fixture(scope="module")
def work(spark, raw, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("work"))
    jobs.stage_features(spark, raw, folder)
    jobs.stage_stats(spark, folder)
    options = TrainingOptions(
        trials=1, folds=2,
        ranges={"n_estimators": (3, 4, False), "max_depth": (2, 3, False)},
    )
    jobs.stage_train(spark, folder, options)
    jobs.stage_predict(spark, folder)
    return folder


def test_readers_declare_types(spark, raw):
    loaded = tables.load_all(spark, raw)
    assert set(loaded) == {"train", "test", "bureau", "bureau_bal", "prev", "pos_cash",
                           "credit_card", "installments"}
    assert dict(loaded["bureau_bal"].dtypes)["STATUS"] == "string"
    assert dict(loaded["train"].dtypes)["FLAG_DOCUMENT_2"] == "double"
    assert S.TARGET not in loaded["test"].columns
    assert tables.inventory(loaded).count() == 8
    with pytest.raises(KeyError):
        tables.load_table(spark, "nothing", raw)


def test_feature_tables(spark, work):
    train = spark.read.parquet(f"{work}/train_features")
    test = spark.read.parquet(f"{work}/test_features")
    assert [c for c in train.columns if c != S.TARGET] == test.columns
    assert "POS_COUNT" not in train.columns and "INSTAL_COUNT" in train.columns
    assert train.count() == test.count() == spark.read.parquet(f"{SF}/customer.parquet").count()
    for df in (train, test):
        holes = df.select([F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
        assert not any(holes)


def test_reports_and_run_log(spark, work):
    def report(name):
        row = spark.read.json(f"{work}/reports/{name}").first()
        return json.loads(row["payload"])

    assert len(report("ks_tests")) == 30
    assert [r["target"] for r in report("target_distribution")] == [0, 1]
    assert [r["bin"] for r in report("score_distribution")] == list(range(30))
    assert {r["metric"] for r in report("bootstrap_ci")} == {"auc_roc", "auc_pr", "precision", "recall", "f1"}
    roc = report("roc_curve")
    assert roc[0]["fpr"] == roc[0]["tpr"] == 0.0 and roc[-1]["fpr"] == roc[-1]["tpr"] == 1.0
    runs = sinks.read_runs(spark, f"{work}/runs")
    assert runs.filter("kind = 'metric'").count() == 7
    assert runs.filter("key = 'sampling_method' and value = 'smote'").count() == 1


def test_submission(spark, work):
    rows = tables.read_csv(spark, f"{work}/submission", tables.SCHEMAS["submission"]).collect()
    assert len(rows) == 150 and all(0 <= r[S.TARGET] <= 1 for r in rows)


def requests(spark):
    apps = standins.applications(spark, SF).withColumnsRenamed({S.ID: "id"})
    names = [f.name for f in scoring.REQUEST_SCHEMA.fields if f.name in apps.columns]
    broken = F.when(F.col("id") % 10 == 0, F.lit(-1.0)).otherwise(F.col("AMT_CREDIT"))
    return apps.select(*names).withColumn("AMT_CREDIT", broken)


def test_stream_equals_batch(spark, work, tmp_path):
    model = RiskModel.load(spark, f"{work}/model")
    requests(spark).repartition(3).write.json(f"{tmp_path}/in")
    arriving = scorer.read_applications(spark, f"{tmp_path}/in")
    scorer.score_stream(arriving, model, f"{tmp_path}/out", f"{tmp_path}/log").awaitTermination()
    scorer.reject_stream(arriving, f"{tmp_path}/bad", f"{tmp_path}/bad_log").awaitTermination()
    streamed = spark.read.parquet(f"{tmp_path}/out")
    batch = model.score(scoring.valid_rows(requests(spark)), ("id",))
    assert streamed.count() == batch.count() == 135
    assert streamed.exceptAll(batch).count() == 0
    rejected = spark.read.parquet(f"{tmp_path}/bad").select("id", "broken_rules").collect()
    assert len(rejected) == 15 and all(r["broken_rules"] == ["AMT_CREDIT > 0"] for r in rejected)
    # a second run finds nothing new
    scorer.score_stream(arriving, model, f"{tmp_path}/out", f"{tmp_path}/log").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 135


def test_score_record(spark, work):
    model = RiskModel.load(spark, f"{work}/model")
    for r in model.score(scoring.valid_rows(requests(spark)), ("id",)).collect():
        p = r["probability"]
        assert r["risk_label"] == ("Low" if p < 0.25 else "Medium" if p < 0.55 else "High")
        assert r["predicted_default"] == (p >= r["threshold"])
