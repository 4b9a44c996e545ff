"""Lookups with heavy keys, and dictionaries under one byte limit."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loanlark.functions import skew
from loanlark.operators import encoding


@pytest.fixture(scope="module")
def rows(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, "warm").otherwise(F.concat(F.lit("k"), F.col("id") % 997))
    return spark.range(30_000).select("id", F.when(F.col("id") % 50 != 7, key).alias("key"))


def test_heavy_keys_get_salts_by_their_size(spark, rows):
    found = skew.heavy_keys(rows, ["key"], 150)
    hashes = {k: spark.range(1).select(F.xxhash64(F.lit(k))).first()[0] for k in ("hot", "warm", "k5")}
    # of four partitions, one may hold a fourth of the rows
    assert found == {hashes["hot"]: 2}
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        found = skew.heavy_keys(rows, ["key"], 150)
        assert found[hashes["hot"]] > 50 and 1 < found[hashes["warm"]] < 4 and hashes["k5"] not in found
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert skew.heavy_keys(rows, ["key"]) == {} and skew.heavy_keys(rows.limit(0), ["key"], 1) == {}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_rows_with_and_without_salts(rows, how):
    lookup = rows.filter("key is not null and key <> 'k3'").groupBy("key").agg(F.count("*").alias("n"))
    plain = rows.join(lookup, "key", how)
    made = skew.salted_lookup(rows, lookup, ["key"], ["id"], how, heavy_rows=50)
    assert made.columns == plain.columns
    assert made.exceptAll(plain).count() == 0 and plain.exceptAll(made).count() == 0


def test_only_heavy_keys_are_repeated(spark, rows):
    lookup = rows.filter("key is not null").groupBy("key").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        heavy = skew.heavy_keys(rows, ["key"], 100)
        assert 0 < len(heavy) < 5 and sum(heavy.values()) < 64 + len(heavy)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert lookup.count() > 500


def test_dictionaries_share_one_byte_limit(spark):
    rows = [(i, f"a{i % 5}", f"b{i % 90:03}", f"c{i:05}", None if i % 2 else "x") for i in range(500)]
    df = spark.createDataFrame(rows, "id long, a string, b string, c string, d string")
    text = ["a", "b", "c", "d"]
    codes = encoding.fit_encoding(df.drop("id")).codes
    small, large = encoding._broadcast_features(codes, 10_000)
    assert small == {"a", "b", "d"} and large == {"c"}
    asked = df.union(spark.createDataFrame([(900, "new", None, "c00007", "nan"), (901, None, "b001", "zz", "y")], df.schema))
    plain = encoding.encode(asked, codes, text)
    for limit in (0, 1_000, 10_000):
        made = encoding.encode(asked, codes, text, limit)
        assert made.columns == plain.columns
        assert made.exceptAll(plain).count() == 0 and plain.exceptAll(made).count() == 0
    assert "_code_" not in plain._jdf.queryExecution().toString()


def test_state_is_fitted_once(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (3.0, None)], "x double, t string")
    state = encoding.fit_encoding(df)
    for part in (state.codes, state.medians):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Aggregate" not in plan and "Exchange" not in plan and "Scan" in plan
