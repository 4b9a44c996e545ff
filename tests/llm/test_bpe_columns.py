"""Decoding many lists at once, and columns that have the outputs' names already."""

from __future__ import annotations

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanlark.llm import bpe

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def test_lists_decode_as_one_by_one():
    model = bpe.PrefixBpe.from_file(bpe.read_ranks(RANKS), PATTERN)
    lists = [[5, 600, 7000], None, [], [42], None, [], model.encode("naïve 日本 😀\n")]
    for column in (pa.array(lists, pa.list_(pa.int32())), pa.array([[1]] + lists + [[2, 3]], pa.list_(pa.int32())).slice(1, len(lists))):
        assert model.decode_all(column).to_pylist() == [None if x is None else model.decode(x) for x in lists]
    assert model.decode_all(pa.array([[], None], pa.list_(pa.int32()))).to_pylist() == [b"", None]
    with pytest.raises((KeyError, IndexError)):
        model.decode_all(pa.array([[10**6]], pa.list_(pa.int32())))


def test_outputs_replace_columns_of_their_names(spark):
    df = spark.createDataFrame([("a b", 1, 2, "x", "y", "z")], "text string, ids int, decoded int, _text string, _ids string, `0ids` string")
    made = bpe.decode(bpe.encode(df, RANKS, PATTERN), RANKS, PATTERN)
    row = made.first()
    assert sorted(made.columns) == sorted(df.columns) and bytes(row.decoded) == b"a b" and row["0ids"] == "z" and row._ids == "y"
    changed = bpe.replace(made, RANKS, PATTERN, F.lit(1), F.lit(1), F.lit("!")).first()
    assert changed.text == "a! b" and changed._text == "x" and changed["0ids"] == "z"
