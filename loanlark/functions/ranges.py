"""Borders that cut columns into ranges of bounded size, without one task seeing all.

Numbers are sketched where they lie. Sketches are merged in two levels: by a slot of the
partition number, so that a task merges a ``SLOTS``-th of all partitions' sketches, and then
column by column, ``SLOTS`` sketches at most. Ranges that may still be too large are counted,
and those that are get sketches and borders of their own, until each is small enough or holds
one value.

Text is cut at a sample of its distinct values by hash: the values of at least so many leading
zero bits, as counted, which merges like any sum and needs no order.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 256
SKETCH_SIZE = 1024
#: Twice the sketches' rank error at 99 %.
RANK_ERROR = 0.01
#: Ranges cut from one sketch at most; it cannot tell many more apart.
CUTS = 512
#: Rows of one range, unless they share one value.
ROWS_PER_RANGE = 4_000_000


def range_count(spark: SparkSession) -> int:
    """Several ranges per shuffle partition, so that hashing them leaves no task empty."""
    return max(32, min(CUTS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def number(c: Column | str) -> Column:
    """A value as double; NaN, which has no place in an order, as null."""
    value = (F.col(c) if isinstance(c, str) else c).cast("double")
    # 0.0 and -0.0 are one value
    return F.when(~F.isnan(value), value + F.lit(0.0))


def assign_buckets(df: DataFrame, cols: list[str], splits: list[list[float]], outputs: list[str]) -> DataFrame:
    """Bucket index of each column: ``splits[i] <= x < splits[i + 1]``; null stays null."""
    return Bucketizer(splitsArray=splits, inputCols=cols, outputCols=outputs, handleInvalid="keep").transform(df)


def _slot() -> Column:
    return F.pmod(F.spark_partition_id(), F.lit(SLOTS)).alias("slot")


def _quantiles(sketches: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """(keys.., n, q): the merged sketch's size and its inner quantiles in ``parts`` parts."""
    merged = sketches.filter("sketch is not null").groupBy(*keys).agg(F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("sketch"))
    counted = merged.withColumn("n", F.kll_sketch_get_n_double("sketch")).filter("n > 0")
    ranks = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    return counted.select(*keys, "n", F.kll_sketch_get_quantile_double("sketch", ranks).alias("q"))


def first_sketches(base: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, sketch): one sketch for each column and slot."""
    made = base.groupBy(_slot()).agg(*[F.kll_sketch_agg_double(c, SKETCH_SIZE).alias(c) for c in cols])
    return made.unpivot([], cols, "feature", "sketch").drop("slot")


def range_splits(
    df: DataFrame, cols: list[str], ranges: int | None = None, rows_per_range: int = ROWS_PER_RANGE
) -> list[list[float]]:
    """Open-ended borders of each column: ``ranges`` of about equal size to begin with, and more
    where a range holds over ``rows_per_range`` rows that are not all of one value."""
    ranges = min(CUTS, ranges or range_count(df.sparkSession))
    names = [f"v{i}" for i in range(len(cols))]
    base = df.select(*[number(f"`{c}`").alias(v) for c, v in zip(cols, names)])
    found = {r["feature"]: r for r in _quantiles(first_sketches(base, names), ["feature"], ranges).collect()}
    inner = {v: sorted({q for q in found[v]["q"] if math.isfinite(q)}) if v in found else [] for v in names}
    unsure = [v for v in names if v in found and found[v]["n"] * (1 / ranges + RANK_ERROR) > rows_per_range]
    whole: set[tuple[str, float]] = set()
    while unsure:
        unsure = _refine(base, inner, unsure, rows_per_range, whole)
    return [[-math.inf, *(inner[v] or [0.0]), math.inf] for v in names]


def _refine(base: DataFrame, inner: dict[str, list[float]], cols: list[str], limit: int, whole: set) -> list[str]:
    """Count the ranges of some columns and cut the too large ones; returns the columns that
    were cut. ``whole`` collects the ranges, by their lower border, that cannot be cut."""
    splits = {c: [-math.inf, *(inner[c] or [0.0]), math.inf] for c in cols}
    marks = [f"b_{c}" for c in cols]
    marked = assign_buckets(base.select(*cols), cols, [splits[c] for c in cols], marks)
    cells = marked.select(*[F.struct(F.col(m).cast("int").alias("bucket"), F.col(c).alias("value")).alias(c) for c, m in zip(cols, marks)])
    cells = cells.unpivot([], cols, "feature", "cell").select("feature", "cell.bucket", "cell.value").filter("value is not null")
    # at most columns x ranges rows
    counts = cells.groupBy("feature", "bucket").count().filter(F.col("count") > limit).collect()
    large = [(r["feature"], r["bucket"], r["count"]) for r in counts if (r["feature"], splits[r["feature"]][r["bucket"]]) not in whole]
    if not large:
        return []
    parts = {(f, b): min(CUTS, 2 * math.ceil(n / limit)) for f, b, n in large}
    most = max(parts.values())
    wanted = base.sparkSession.createDataFrame(list(parts), "feature string, bucket int")
    # a sketch for each too large range and slot; the list of such ranges is bounded like the counts
    sketches = cells.join(F.broadcast(wanted), ["feature", "bucket"]).groupBy("feature", "bucket", _slot()).agg(
        F.kll_sketch_agg_double("value", SKETCH_SIZE).alias("sketch")
    )
    cut = set()
    for r in _quantiles(sketches, ["feature", "bucket"], most).collect():
        low, high = splits[r["feature"]][r["bucket"]], splits[r["feature"]][r["bucket"] + 1]
        own = parts[r["feature"], r["bucket"]]
        finite = [q for q in (r["q"][most * j // own - 1] for j in range(1, own)) if math.isfinite(q)]
        borders = set(finite)
        # a value that fills a part has a range of its own
        heavy = {a for a, b in zip(finite, finite[1:]) if a == b}
        borders |= {float(np.nextafter(a, math.inf)) for a in heavy}
        new = {b for b in borders if low < b < high}
        whole |= {(r["feature"], a) for a in heavy}
        if new:
            inner[r["feature"]] = sorted({*inner[r["feature"]], *new})
            cut.add(r["feature"])
        else:
            whole.add((r["feature"], low))
    return sorted(cut)


def leading_zeros(value: Column) -> Column:
    """Leading zero bits of a value's hash (up to 53): one more in half of all values."""
    share = (F.shiftrightunsigned(F.xxhash64(value), 11) + 1) / F.lit(2.0**53)
    return F.floor(-F.log2(share)).cast("int")


def text_borders(values: DataFrame, sample: int) -> DataFrame:
    """(feature, borders): a sorted sample by hash of the distinct ``value``s of each feature, of
    at most ``sample`` and, in a large column, a fourth of it at least but for chance.

    ``values`` holds each (feature, value) once.
    """
    zeros = leading_zeros(F.col("value"))
    # one row for each column and number of zeros
    counts = values.groupBy("feature", zeros.alias("zeros")).agg(F.count("*").alias("n"))
    levels = counts.groupBy("feature").agg(F.collect_list(F.struct("zeros", "n")).alias("levels"))

    def kept(level: Column) -> Column:
        at_least = F.filter("levels", lambda x: x["zeros"] >= level)
        return F.aggregate(at_least, F.lit(0).cast("long"), lambda n, x: n + x["n"])

    fitting = F.filter(F.sequence(F.lit(0), F.lit(54)), lambda level: kept(level) <= sample)
    least = levels.select("feature", F.array_min(fitting).alias("least"))
    # one row for each column
    chosen = values.join(F.broadcast(least), "feature").filter(zeros >= F.col("least"))
    return chosen.groupBy("feature").agg(F.array_sort(F.collect_list("value")).alias("borders"))


#: Borders that are compared one by one with a value at each of two steps.
STEP = 32


def text_bucket(value: Column, borders: Column) -> Column:
    """How many of the sorted borders are at most the value: first by steps of ``STEP``."""
    coarse = F.filter(borders, lambda b, i: (F.pmod(i, F.lit(STEP)) == 0) & (b <= value))
    full = F.greatest(F.size(coarse) - 1, F.lit(0)) * STEP
    rest = F.filter(F.slice(borders, full + 1, F.lit(STEP)), lambda b: b <= value)
    return (full + F.size(rest)).cast("int")
