"""Hand-computed cases of the null and rounding rules."""

import math

import pytest
from pyspark.sql import functions as F

from loanlark import settings as S
from loanlark.functions import expr as X
from loanlark.operators import encoding, evaluation, history, shaping
from loanlark.operators.application import application_features
from loanlark.operators.scoring import fallback_probability


def values(df):
    return [tuple(r) for r in df.collect()]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (2.0,)], "x double")
    assert values(df.select(X.clip0("x"))) == [(None,), (0.0,), (2.0,)]


def test_flag_counts_null_as_zero(spark):
    df = spark.createDataFrame([(None,), (1.0,)], "x double")
    assert values(df.agg(F.avg(X.flag(F.col("x") > 0)))) == [(0.5,)]


def test_sum_of_nulls_is_zero(spark):
    df = spark.createDataFrame([(1, None)], "k int, x double")
    assert values(df.groupBy("k").agg(X.sum_or_zero("x"))) == [(1, 0.0)]


def test_row_statistics(spark):
    df = spark.createDataFrame(
        [(None, 2.0, 4.0), (None, None, 5.0), (None, None, None)], "a double, b double, c double"
    )
    cols = ["a", "b", "c"]
    rows = values(
        df.select(X.row_mean(cols), X.row_std(cols), X.row_min(cols), X.row_max(cols), X.row_sum(cols))
    )
    assert rows[0][0] == 3.0 and rows[0][1] == pytest.approx(math.sqrt(2)) and rows[0][2:] == (2.0, 4.0, 6.0)
    assert rows[1] == (5.0, None, 5.0, 5.0, 5.0)
    assert rows[2] == (None, None, None, None, 0.0)


def test_ratio_with_zero_denominator(spark):
    df = spark.createDataFrame([(1.0, -1.0), (1.0, 1.0)], "a double, b double")
    assert values(df.select(X.ratio("a", "b"))) == [(None,), (0.5,)]


def test_latest_takes_last_known_value(spark):
    rows = [(1, 10, -1, None), (1, 11, -2, 7.0), (2, 12, -5, 8.0), (2, 13, -6, 9.0),
            (3, 14, None, 5.0), (4, -3, -1, 1.0), (4, -2, -1, 2.0)]
    df = spark.createDataFrame(rows, "k int, id long, day int, v double")
    got = dict(values(df.groupBy("k").agg(X.latest("v", "day", "id"))))
    assert got == {1: 7.0, 2: 8.0, 3: 5.0, 4: 2.0}


def test_latest_plan_is_hash_aggregation(spark):
    df = spark.createDataFrame([(1, 10, -1, 1.0)], "k int, id long, day int, v double")
    plan = df.groupBy("k").agg(X.latest("v", "day", "id"))._jdf.queryExecution().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_null_keys_are_left_out(spark):
    df = spark.createDataFrame([(None, 1.0), (1, 2.0)], f"{S.ID} long, x double")
    assert values(history.aggregate_matrix(df, S.ID, "p", ["x"], ["mean"])) == [(1, 2.0)]


def test_status_of_latest_known_application(spark):
    rows = [(1, 1, None, -1), (2, 1, "Approved", -5), (3, 2, "Refused", -1), (4, 3, None, -1)]
    df = spark.createDataFrame(
        rows, "SK_ID_PREV long, SK_ID_CURR long, NAME_CONTRACT_STATUS string, DAYS_DECISION int"
    ).withColumns(
        {c: F.lit(0.0) for c in ("AMT_APPLICATION", "AMT_CREDIT", "AMT_ANNUITY", "AMT_DOWN_PAYMENT",
                                 "RATE_INTEREST_PRIMARY", "DAYS_FIRST_DRAWING")}
    )
    got = history.previous_summary(df).select(
        S.ID, "PREV_RECENT_NAME_CONTRACT_STATUS", "PREV_AMT_CREDIT_MEAN", "PREV_APPROVED_RATIO"
    )
    assert sorted(values(got)) == [(1, 1, None, 0.5), (2, 0, None, 0.0), (3, 0, None, 0.0)]


def test_sentinel_is_flagged_before_it_is_dropped(spark):
    numbers = {c: 1.0 for c in ("AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE",
               "CNT_FAM_MEMBERS", "CNT_CHILDREN", "DAYS_REGISTRATION", "DAYS_ID_PUBLISH",
               "DAYS_LAST_PHONE_CHANGE", "EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")}
    df = spark.createDataFrame([(1, 365243, -730), (2, -365, -730), (3, 20, -730)],
                               "SK_ID_CURR long, DAYS_EMPLOYED int, DAYS_BIRTH int")
    out = application_features(df.withColumns({c: F.lit(v) for c, v in numbers.items()}))
    got = values(out.select("IS_UNEMPLOYED", "DAYS_EMPLOYED", "EMPLOYED_YEARS", "AGE_YEARS",
                            "EMPLOYED_TO_AGE_RATIO", "DOCUMENT_COUNT"))
    assert got == [(1, None, None, 2.0, None, 0), (0, -365, 1.0, 2.0, 1 / 3, 0), (0, 20, 0.0, 2.0, 0.0, 0)]


def test_null_fraction_at_the_limit_is_kept(spark):
    rows = [(None, None), (None, None), (None, None), (1, None), (1, 1)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert dict(values(shaping.null_fractions(df))) == {"a": 0.6, "b": 0.8}
    assert shaping.drop_sparse_columns(df).columns == ["a"]


def test_median_interpolates_and_fill_does_not_truncate(spark):
    df = spark.createDataFrame([(1,), (2,), (4,), (10,), (None,)], "x int")
    state = encoding.fit_encoding(df)
    assert values(state.medians) == [("x", 3.0)]
    half = spark.createDataFrame([("x", 2.5)], "feature string, value double")
    assert values(encoding.impute(df.filter("x is null"), half)) == [(2.5,)]


def test_codes_of_text_and_null(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "c string")
    state = encoding.fit_encoding(df)
    assert sorted(values(state.codes)) == [("c", "a", 0), ("c", "b", 1), ("c", "nan", 2)]
    assert values(state.medians) == [("c", 1.0)]
    assert values(encoding.apply_encoding(df, state)) == [(1.0,), (2.0,), (0.0,)]
    unseen = spark.createDataFrame([("z", "q")], "c string, other string")
    assert values(encoding.apply_encoding(unseen, state)) == [(0.0, 0.0)]


def test_column_missing_at_scoring_takes_the_code_median(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "c string")
    state = encoding.fit_encoding(df)
    absent = spark.createDataFrame([(None,)], "c double")
    assert values(encoding.apply_encoding(absent, state)) == [(1.0,)]


def test_large_dictionaries_are_salted(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"v{i % 7}") for i in range(50)], "id long, c string")
    state = encoding.fit_encoding(df.select("c"))
    want = sorted(values(encoding.encode(df, state.codes, ["c"])))
    monkeypatch.setattr(encoding, "BROADCAST_BYTES", 1)
    assert sorted(values(encoding.encode(df, state.codes, ["c"]))) == want


def test_fallback_score(spark):
    df = spark.createDataFrame([(None,), (0.0,), (0.2,), (1.0,)], "EXT_SOURCE_2 double")
    assert values(df.select(fallback_probability())) == [(0.55,), (0.55,), (0.85,), (0.05,)]


def test_histogram_ends(spark):
    df = spark.createDataFrame([(0.0, 0), (1.0, 1)], "p double, y int")
    got = {r[0]: (r[2], r[3]) for r in evaluation.score_histogram(df, "p", "y").collect()}
    assert got[0] == (1, 0) and got[29] == (0, 1) and len(got) == 30


def test_few_distinct_is_exact(spark):
    df = spark.range(5000).select((F.col("id") % 10).alias("ten"), (F.col("id") % 11).alias("eleven"),
                                  F.col("id").alias("many"))
    assert shaping.few_distinct(df, df.columns) == ["ten"]
