"""Search, sort and page scored applications."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlark import settings as S
from loanlark.functions import ranges as R

SEARCHED = ("id", "contract_type", "risk_label")
SORT_KEYS = ("risk_score", "income", "credit", "submitted_at")


def matches(text: str, cols: tuple[str, ...] = SEARCHED) -> Column:
    """Case-insensitive containment in any of the columns."""
    wanted = F.lower(F.lit(text))
    found = [F.contains(F.lower(F.col(c).cast("string")), wanted) for c in cols]
    return reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in found])


def ordered(df: DataFrame, key: str = "risk_score", ascending: bool = False) -> DataFrame:
    if key not in SORT_KEYS:
        raise ValueError(f"cannot sort by {key!r}; choose from {SORT_KEYS}")
    return df.orderBy(F.asc(key) if ascending else F.desc(key), "id")


def search_applications(
    df: DataFrame, text: str = "", key: str = "risk_score", ascending: bool = False
) -> DataFrame:
    return ordered(df.filter(matches(text)), key, ascending)


def page(df: DataFrame, number: int, rows: int = S.PAGE_ROWS) -> DataFrame:
    """Page ``number`` (from 0) of an ordered table."""
    return df.offset(number * rows).limit(rows)


def page_count(df: DataFrame, rows: int = S.PAGE_ROWS) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn(
        "n_pages", F.ceil(F.col("n_rows") / rows)
    )


@dataclass(frozen=True)
class PageDirectory:
    """Counts of the rows by range of a numeric sort key: a row for each range, not for each page."""

    key: str
    splits: list[float]
    counts: list[int]
    nulls: int

    def pages(self, rows: int = S.PAGE_ROWS) -> int:
        return math.ceil((sum(self.counts) + self.nulls) / rows)


def page_directory(df: DataFrame, key: str = "risk_score", rows_per_range: int = 100_000) -> PageDirectory:
    """Cut a numeric sort key into ranges and count them: two passes that serve every page."""
    splits = R.range_splits(df, [key], rows_per_range=rows_per_range)[0]
    marked = R.assign_buckets(df.select(R.number(key).alias("v")), ["v"], [splits], ["bucket"])
    found = {r["bucket"]: r["count"] for r in marked.groupBy("bucket").count().collect()}
    return PageDirectory(key, splits, [found.get(float(b), 0) for b in range(len(splits) - 1)], found.get(None, 0))


def page_at(
    df: DataFrame, directory: PageDirectory, number: int, rows: int = S.PAGE_ROWS, ascending: bool = False
) -> DataFrame:
    """Page ``number`` (from 0) in the order of ``ordered``, read from the ranges that hold it.

    Only these ranges are filtered, by their borders, and sorted; the pages before are counted.
    """
    value = R.number(directory.key)
    ranges = [
        (n, (value >= F.lit(low)) & ((value < F.lit(high)) if math.isfinite(high) else F.lit(True)))
        for n, low, high in zip(directory.counts, directory.splits, directory.splits[1:])
    ]
    # as ordered() does: nulls come first in rising and last in falling order
    ranges = [(directory.nulls, value.isNull()), *ranges] if ascending else [*reversed(ranges), (directory.nulls, value.isNull())]
    begin, end, before, first, wanted = number * rows, (number + 1) * rows, 0, 0, F.lit(False)
    for n, inside in ranges:
        if n and before < end and before + n > begin:
            first = before if before <= begin else first
            wanted = wanted | inside
        before += n
    return ordered(df.filter(wanted), directory.key, ascending).offset(begin - first).limit(rows)
