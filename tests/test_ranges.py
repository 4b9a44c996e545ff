"""Range borders, text borders and cut keys: sizes, exactness, and what one task reads."""

from __future__ import annotations

import bisect
import contextlib
import io
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanlark.functions import ordering as O
from loanlark.functions import ranges as R
from loanlark.operators import encoding, sampling


def plan_of(df) -> str:
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        df.explain("formatted")
    return said.getvalue()


@pytest.fixture
def partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def rows_by_range(df, column, splits):
    marked = R.assign_buckets(df.select(F.col(column).cast("double").alias("v")), ["v"], [splits], ["b"])
    return marked.groupBy("b").agg(F.count("*").alias("n"), F.count_distinct("v").alias("d")).collect()


def test_too_large_ranges_are_cut_again(spark):
    """A third of all rows share one value, most others crowd at one end."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.pow(F.rand(1), 6) * 1000).alias("x"),
        F.when(F.col("id") % 2 == 0, F.lit(math.inf)).otherwise(F.col("id") * 1.0).alias("y"),
        F.lit(None).cast("double").alias("z"),
    )
    df = spark.createDataFrame(df.toPandas().astype("float64"))
    splits = R.range_splits(df, ["x", "y", "z"], ranges=4, rows_per_range=200)
    for column, own in zip("xy", splits):
        sizes = rows_by_range(df, column, own)
        # beside infinity, which no border can part from them, few other values are left
        assert all(r.n <= 200 or r.d == 1 or (column == "y" and r.d <= 101) for r in sizes), [r for r in sizes if r.n > 200]
        assert sum(r.n for r in sizes) == 30_000
    assert splits[2] == [-math.inf, 0.0, math.inf]
    assert len(R.range_splits(df, ["x"], ranges=4)[0]) <= 5  # nothing large: nothing counted


@pytest.mark.parametrize("partitions", [2000], indirect=True)
def test_no_task_merges_all_sketches(spark, partitions):
    df = spark.range(0, 20_000, 1, 2000).select(F.rand(1).alias("a"), F.rand(2).alias("b"))
    first = R.first_sketches(df, ["a", "b"])
    per_column = {r.feature: r["count"] for r in first.groupBy("feature").count().collect()}
    assert per_column == {"a": R.SLOTS, "b": R.SLOTS}
    plan = plan_of(R._quantiles(first, ["feature"], 8))
    assert "SinglePartition" not in plan and plan.count("Exchange") >= 2


@pytest.mark.parametrize("partitions", [400, 2000], indirect=True)
def test_text_ranks_sort_no_whole_column(spark, partitions):
    words = [f"w{i:05}" for i in range(6000)]
    random.Random(1).shuffle(words)
    df = spark.createDataFrame([(w, w[-1]) for w in words], "a string, b string")
    values = df.select(F.lit("a").alias("feature"), F.col("a").alias("value"))
    borders = R.text_borders(values, 500)
    plan = plan_of(borders)
    # a range, or the sample, is sorted, never the distinct values of a column
    assert "Window" not in plan and "TakeOrdered" not in plan and "SinglePartition" not in plan and "\nSort" not in plan
    found = borders.first().borders
    assert 125 <= len(found) <= 500 and found == sorted(found)
    table = encoding.code_table(df, ["a", "b"])
    assert "SinglePartition" not in plan_of(table)


def test_text_codes_of_many_values(spark):
    words = sorted({f"{random.Random(i).random():.9f}" for i in range(9000)})
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "a string")
    table = encoding.code_table(df, ["a"]).collect()
    assert [r.value for r in sorted(table, key=lambda r: r.code)] == sorted([*words, encoding.NULL_CLASS])
    sizes = {}
    for r in table:
        sizes[r.bucket] = sizes.get(r.bucket, 0) + 1
    assert len(sizes) > 200 and max(sizes.values()) < 400


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 64, 500])
def test_text_bucket_is_a_bisection(spark, n):
    draw = random.Random(n)
    borders = sorted({f"{draw.randint(0, 999):03}" for _ in range(n)})
    asked = [f"{i:03}" for i in range(0, 1000, 7)] + ["", "é", *borders[:3]]
    df = spark.createDataFrame([(a, borders) for a in asked], "v string, b array<string>")
    got = df.select("v", R.text_bucket(F.col("v"), F.col("b")).alias("k")).collect()
    assert all(r.k == bisect.bisect_right(borders, r.v) for r in got)


def test_cuts_have_exactly_the_wanted_keys_below(spark):
    draw = random.Random(3)
    keys = [draw.getrandbits(64) - (1 << 63) for _ in range(3000)]
    keys += [(5 << 48) + i for i in range(500)] + [-(7 << 40) - i for i in range(300)]  # share their first digits
    rows = [("a" if i % 3 else "b", k) for i, k in enumerate(keys)] + [(None, 5), ("one", -1)]
    df = spark.createDataFrame(rows, "g string, k long")
    cuts = O.cuts_at_ranks(df, F.col("g"), F.col("k"), lambda g, n: [0, 1, n // 3, n // 2, n - 1, n])
    for g in ("a", "b", None, "one"):
        own = sorted(k for h, k in rows if h == g)
        for rank, cut in zip([0, 1, len(own) // 3, len(own) // 2, len(own) - 1, len(own)], cuts[g]):
            assert (cut is None) == (rank == len(own))
            assert cut is None or bisect.bisect_left(own, cut) == rank


def test_cuts_between_equal_keys_and_of_nothing(spark):
    df = spark.createDataFrame([("a", 9)] * 5 + [("a", 10)] * 5, "g string, k long")
    assert O.cuts_at_ranks(df, F.col("g"), F.col("k"), lambda g, n: [3, 5, 7]) == {"a": [9, 10, 10]}
    assert O.cuts_at_ranks(df.limit(0), F.col("g"), F.col("k"), lambda g, n: [1]) == {}


def test_split_and_folds_are_exact_at_any_size(spark):
    for n in (10, 997, 5003):
        df = spark.range(n).select("id", (F.col("id") % 7 == 0).cast("int").alias("y"))
        split = sampling.stratified_split(df, "y", "id", 0.2)
        counts = {(r.split, r.y): r["count"] for r in split.groupBy("split", "y").count().collect()}
        assert sum(v for (s, _), v in counts.items() if s == "test") == math.ceil(n * 0.2)
        folds = sampling.stratified_folds(df, "y", "id", 5)
        sizes = [r["count"] for r in folds.filter("y = 0").groupBy("fold").count().collect()]
        assert max(sizes) - min(sizes) <= 1
        assert "Sort" not in plan_of(split) and "Window" not in plan_of(split) and "Exchange" not in plan_of(folds)


def test_medians_on_infinities_and_nan(spark):
    inf, nan = math.inf, math.nan
    columns = {"a": [1.0, inf, inf, inf], "b": [nan, 2.0, 4.0, nan], "c": [-inf, -inf, 1.0, 2.0], "d": [nan] * 4, "e": [inf, -inf, 3.0, None]}
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    got = {r.feature: r.value for r in encoding.median_fit(df, list(columns)).collect()}
    assert got.get("a") == inf and got["b"] == 3.0 and got["c"] == -inf and "d" not in got and got["e"] == 3.0
    assert np.isneginf(got["c"])
