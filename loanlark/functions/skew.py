"""Joins whose row side may hold one key in a third of its rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlark.functions.ranges import SLOTS

#: Rows of one key that a task may always take.
HEAVY_ROWS = 1_000_000


def heavy_keys(rows: DataFrame, on: list[str], heavy_rows: int = HEAVY_ROWS) -> dict[int, int]:
    """Hash and salts of each key that has more than its share of the rows.

    A key is heavy beyond ``heavy_rows`` and beyond an even part of all rows for each shuffle
    partition; there are no more heavy keys than partitions. They are found by
    frequent-item sketches, merged in two levels.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tracked = min(1 << 16, max(1024, 8 * partitions))
    # a null key joins nothing, its rows need no place beside others
    keyed = rows.filter(_present(on)).select(F.xxhash64(*on).alias("h"))
    first = keyed.groupBy(F.pmod(F.spark_partition_id(), F.lit(SLOTS)).alias("slot")).agg(
        F.expr(f"approx_top_k_accumulate(h, {tracked})").alias("sketch"), F.count("*").alias("n")
    )
    # by a constant key, so that no rows give no sketch
    merged = first.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("n").alias("n"))
    found = merged.select("n", F.expr(f"approx_top_k_estimate(sketch, {partitions})").alias("top")).first()
    if found is None:
        return {}
    limit = max(heavy_rows, math.ceil(found["n"] / partitions))
    return {x["item"]: math.ceil(x["count"] / limit) for x in found["top"] if x["count"] > limit}


def _present(on: list[str]) -> Column:
    there = F.lit(True)
    for c in on:
        there = there & F.col(c).isNotNull()
    return there


def salted_lookup(
    rows: DataFrame, lookup: DataFrame, on: list[str], spread: list[str], how: str = "inner", heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Join rows to a lookup with unique keys, each heavy key spread over as many tasks as its
    rows need.

    ``rows`` is read once more to find its heavy keys, so store it first if it is dear. A row of
    a heavy key picks its salt from ``spread``, columns that differ between rows of one key; the
    lookup's row of that key is repeated once per salt, and no other. Needed where the lookup
    has no size bound, so that it can be neither broadcast nor kept in one task with its hot key.
    """
    heavy = heavy_keys(rows, on, heavy_rows)
    if not heavy:
        return rows.join(lookup, on, how)
    table = F.create_map(*[x for h, n in sorted(heavy.items()) for x in (F.lit(h), F.lit(n))])
    salts = F.coalesce(F.try_element_at(table, F.xxhash64(*on)), F.lit(1))
    return (
        rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int"))
        .join(lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))), [*on, "_salt"], how)
        .drop("_salt")
    )
