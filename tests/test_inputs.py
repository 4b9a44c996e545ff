"""Cells that do not fit, odd column names, missing labels, large degrees of freedom."""

import math
import time

import pytest
from pyspark.sql import functions as F

from loanlark.functions.tails import _chi2_tail
from loanlark.operators import learner, sampling, shaping
from loanlark.sources import tables


def written(tmp_path, text):
    path = tmp_path / "t.csv"
    path.write_text(text)
    return str(path)


def test_null_spellings_and_whole_numbers(spark, tmp_path):
    path = written(tmp_path, "SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n9007199254740993,-1.0,C\n2,NA,NaN\n3,,\n")
    rows = tables.read_csv(spark, path, tables.declared_schema("bureau_bal")).collect()
    assert [tuple(r) for r in rows] == [(9007199254740993, -1, "C"), (2, None, None), (3, None, None)]


@pytest.mark.parametrize("cell", ["x", "1.5", "3000000000"])
def test_a_misfit_stops_the_read(spark, tmp_path, cell):
    path = written(tmp_path, f"SK_ID_BUREAU,MONTHS_BALANCE,STATUS\n1,{cell},C\n")
    with pytest.raises(Exception, match="MONTHS_BALANCE"):
        tables.read_csv(spark, path, tables.declared_schema("bureau_bal")).collect()


def test_dotted_names_can_be_counted(spark):
    df = spark.createDataFrame([(None, 1), ("a", None)], "`a.b` string, c int").withColumn("d", F.lit(1))
    got = {r.column_name: r.null_fraction for r in shaping.null_fractions(df).collect()}
    assert got == {"a.b": 0.5, "c": 0.5, "d": 0.0}
    assert shaping.drop_sparse_columns(df, 0.4).columns == ["d"]


def test_rows_without_a_label_are_refused(spark):
    df = spark.createDataFrame([(1, 0), (2, None)], "id long, y int")
    with pytest.raises(ValueError, match="no y"):
        sampling.stratified_split(df, "y", "id")


def test_chi_square_tail():
    for x, dof in ((0.5, 1), (3.84, 1), (5.4, 1), (10.0, 3), (30.0, 29), (300.0, 2)):
        half, steps = x / 2, dof // 2
        if dof % 2:
            want = math.erfc(math.sqrt(half)) + sum(math.exp((j + 0.5) * math.log(half) - half - math.lgamma(j + 1.5)) for j in range(steps))
        else:
            want = sum(math.exp(j * math.log(half) - half - math.lgamma(j + 1.0)) for j in range(steps))
        assert _chi2_tail(x, dof) == pytest.approx(want, rel=1e-9)
    began = time.time()
    assert 0.4 < _chi2_tail(1e9, 1_000_000_000) < 0.6 and time.time() - began < 5


def test_unknown_learner_parameters_are_refused():
    with pytest.raises(ValueError, match="num_leaves"):
        learner.mapped_params({"max_depth": 3, "num_leaves": 31})
