"""Pages from a directory of ranges, and nulls counted while a table is written."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loanlark.operators import browse, shaping


@pytest.fixture(scope="module")
def listed(spark, tmp_path_factory):
    df = spark.range(3000).select(
        F.format_string("APP-%05d", "id").alias("id"),
        F.when(F.col("id") % 3 == 0, 50.0).when(F.col("id") % 17 != 1, (F.col("id") * 7919 % 1000) / 10).alias("risk_score"),
    )
    path = str(tmp_path_factory.mktemp("listed") / "rows")
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("ascending", [False, True])
def test_pages_equal_the_sorted_table(listed, ascending):
    directory = browse.page_directory(listed, "risk_score", rows_per_range=150)
    assert sum(directory.counts) + directory.nulls == 3000 and directory.nulls > 100 and len(directory.counts) > 15
    rows = [tuple(r) for r in browse.ordered(listed, "risk_score", ascending).collect()]
    pages = directory.pages(40)
    assert pages == 75
    for k in (0, 1, 20, 37, pages - 2, pages - 1, pages):
        got = [tuple(r) for r in browse.page_at(listed, directory, k, 40, ascending).collect()]
        assert got == rows[k * 40 : (k + 1) * 40]


def test_a_deep_page_reads_its_ranges_only(listed):
    directory = browse.page_directory(listed, "risk_score", rows_per_range=150)
    page = browse.page_at(listed, directory, 380, 5)
    text = page._jdf.queryExecution().optimizedPlan().toString()
    condition = text[text.index("Filter") :].split("\n")[0]
    assert condition.count("<") <= 4  # two ranges at most


def test_nulls_are_counted_by_the_write(spark):
    df = spark.range(1000).select(
        "id", F.when(F.col("id") % 5 == 0, 1).alias("a.b"), F.when(F.col("id") % 2 == 0, "x").alias("half"), F.lit(None).cast("int").alias("none")
    )
    made = shaping.stored_dense(df, "dense", 0.5)
    assert made.columns == shaping.drop_sparse_columns(df, 0.5).columns == ["id", "half"]
    assert made.count() == 1000
    counted, seen = shaping.counting_nulls(df, F.col("id") % 5 == 0)
    counted.write.format("noop").mode("overwrite").save()
    assert shaping.dense_columns(seen, df.columns, 0.1) == ["id", "a.b"]
    assert shaping.stored_dense(df.limit(0), "empty").columns == shaping.drop_sparse_columns(df.limit(0)).columns == []
