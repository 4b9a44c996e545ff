"""One pass for accepted and rejected records, over several batches and a restart."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from loanlark.operators import evaluation, scoring
from loanlark.sources import tables
from loanlark.streaming import scorer


def requests(spark, begin: int, end: int):
    fields = {f.name: F.lit(1).cast(f.dataType) for f in scoring.REQUEST_SCHEMA.fields}
    fields |= {
        "id": F.col("n").cast(scoring.REQUEST_SCHEMA["id"].dataType),
        "DAYS_BIRTH": F.lit(-9000).cast(scoring.REQUEST_SCHEMA["DAYS_BIRTH"].dataType),
        "AMT_CREDIT": F.when(F.col("n") % 4 == 0, 0).otherwise(5).cast(scoring.REQUEST_SCHEMA["AMT_CREDIT"].dataType),
        "EXT_SOURCE_2": (F.col("n") % 10 / 10).cast("double"),
    }
    return spark.range(begin, end).withColumnRenamed("id", "n").select(*[c.alias(k) for k, c in fields.items()])


def score(rows):
    return rows.select("routing", scoring.fallback_probability().alias("probability"))


@pytest.mark.parametrize("limit", [{"files": 2}, {"max_bytes": 20_000}])
def test_batches_and_a_restart_equal_the_batch_result(spark, tmp_path, limit):
    for begin, end in ((0, 200), (200, 260)):
        requests(spark, begin, end).repartition(6).write.mode("append").parquet(f"{tmp_path}/in")
        arriving = scorer.read_applications(spark, f"{tmp_path}/in", "parquet", **limit)
        query = scorer.route_stream(arriving, score, f"{tmp_path}/out", f"{tmp_path}/log")
        query.awaitTermination()
        assert begin or query.lastProgress["batchId"] >= 2  # several batches
    made = scorer.read_routed(spark, f"{tmp_path}/out")
    wanted = scorer.routed(requests(spark, 0, 260), score)
    assert made.count() == 260 and made.select("id").distinct().count() == 260
    columns = ["id", "accepted", "broken_rules", "probability"]
    assert made.select(columns).exceptAll(wanted.select(columns)).count() == 0
    rejected = made.filter("not accepted").collect()
    assert len(rejected) == 65 and all(r.broken_rules == ["AMT_CREDIT > 0"] and r.probability is None for r in rejected)
    plan = wanted._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Range") == 1  # one pass


def test_dictionary_is_read_strictly(spark, tmp_path):
    folder = tmp_path / "ok"
    folder.mkdir()
    (folder / tables.FILES["description"]).write_bytes(',Table,Row,Description,Special\n1,t,a,"caf\xe9, and more",\n2,t,b,NA,x\n'.encode("latin-1"))
    rows = tables.load_table(spark, "description", str(folder)).collect()
    assert [tuple(r) for r in rows] == [(1, "t", "a", "café, and more", None), (2, "t", "b", None, "x")]
    (folder / tables.FILES["description"]).write_bytes(b",Table,Row,Description,Special\none,t,a,b,c\n")
    with pytest.raises(Exception, match="not of type"):
        tables.load_table(spark, "description", str(folder)).collect()


def test_document_of_one_class(spark):
    for rows, recall in (([(0.2, 1), (0.7, 1)], 0.5), ([(0.5, 0)], 0.0)):
        df = spark.createDataFrame(rows, "p double, y int")
        made = json.loads(evaluation.report_document(df, "p", "y", 0.35).first().payload)
        # no ranking without both classes
        assert "auc_roc" not in made and made["recall"] == recall and made["threshold"] == 0.35
        assert len(made["score_distribution"]["default"]) == 30 and sum(made["confusion_matrix"].values()) == len(rows)
