"""Column expressions that keep the null rules of the feature definitions.

Every helper is built from plain Spark functions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a: Column | str, b: Column | str) -> Column:
    """``a / (b + 1)``; null where the denominator is 0."""
    return F.try_divide(as_col(a).cast("double"), as_col(b).cast("double") + F.lit(1.0))


def years(days: Column | str) -> Column:
    """Days before the application as positive years."""
    return -as_col(days) / F.lit(365.0)


def clip0(c: Column | str) -> Column:
    """Lower bound 0 that leaves null alone (``greatest(null, 0)`` would give 0)."""
    c = as_col(c)
    return F.when(c < 0, F.lit(0)).otherwise(c)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def mapped(c: Column | str, table: dict, default: int = 0) -> Column:
    """Look a value up in a short fixed table; anything else gives the default."""
    c = as_col(c)
    by_code: dict[int, list] = {}
    for key, code in table.items():
        by_code.setdefault(code, []).append(key)
    out = None
    for code, keys in by_code.items():
        branch = c.isin(keys)
        out = F.when(branch, F.lit(code)) if out is None else out.when(branch, F.lit(code))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def sum_or_zero(c: Column | str) -> Column:
    """Group sum that is 0 when every value is null."""
    return F.coalesce(F.sum(as_col(c)), F.lit(0))


def row_count(cols: list[str]) -> Column:
    return reduce(add, [F.col(c).isNotNull().cast("int") for c in cols])


def row_sum(cols: list[str]) -> Column:
    """Sum across columns, null as 0; 0 when there is no column."""
    if not cols:
        return F.lit(0)
    return reduce(add, [F.coalesce(F.col(c), F.lit(0)) for c in cols])


def row_mean(cols: list[str]) -> Column:
    """Mean across the non-null columns."""
    return F.try_divide(row_sum(cols).cast("double"), row_count(cols))


def row_std(cols: list[str]) -> Column:
    """Sample standard deviation across the non-null columns; null below two values."""
    mean = row_mean(cols)
    squares = reduce(add, [F.coalesce(F.pow(F.col(c) - mean, 2), F.lit(0.0)) for c in cols])
    return F.sqrt(F.when(row_count(cols) > 1, squares / (row_count(cols) - 1)))


def row_min(cols: list[str]) -> Column:
    return F.least(*cols) if len(cols) > 1 else F.col(cols[0])


def row_max(cols: list[str]) -> Column:
    return F.greatest(*cols) if len(cols) > 1 else F.col(cols[0])


def weighted_mean(weights: dict[str, float]) -> Column:
    """Weighted mean with null counted as 0."""
    parts = [F.coalesce(F.col(c), F.lit(0.0)) * F.lit(float(w)) for c, w in weights.items()]
    return reduce(add, parts) / F.lit(float(sum(weights.values())))


def latest(value: Column | str, day: Column | str, tie: Column | str) -> Column:
    """Aggregate: the last non-null value by (day, tie); rows without a day come first.

    Both order columns are packed into one decimal, a type that hash aggregation can
    update in place; ordering by a struct would force a sort before the shuffle.
    """
    value = as_col(value)
    day = F.coalesce(as_col(day).cast("int"), F.lit(-2147483648)).cast("decimal(10,0)")
    tie = F.coalesce(as_col(tie).cast("long"), F.lit(0)).cast("decimal(20,0)")
    order = day * F.expr("cast('20000000000000000000' as decimal(20,0))") + tie
    return F.max_by(value, F.when(value.isNotNull(), order))


def hashed_uniform(*cols: Column) -> Column:
    """A uniform number in [0, 1) that depends on the given values only."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") * F.lit(2.0**-53)


def score_band(p: Column | str) -> Column:
    from loanlark import settings as S

    p = as_col(p)
    return (
        F.when(p < S.BAND_MEDIUM, "Low").when(p < S.BAND_HIGH, "Medium").otherwise("High")
    )
