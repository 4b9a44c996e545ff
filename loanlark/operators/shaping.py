"""Table-level counts and column alignment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlark import settings as S
from loanlark.session import through_storage


def is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f) and f.name not in exclude]


def text_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in exclude
    ]


def null_fractions(df: DataFrame) -> DataFrame:
    """(column_name, null_fraction): one pass, one row of counts, then one row per column."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]
    )
    # numbered, so that any column name can be counted
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("filled")) for i, c in enumerate(df.columns)]
    return counts.select("n", F.inline(F.array(*cells))).select(
        "column_name", F.try_divide(F.col("n") - F.col("filled"), F.col("n")).alias("null_fraction")
    )


def drop_sparse_columns(df: DataFrame, limit: float = S.NULL_FRACTION_LIMIT) -> DataFrame:
    """Keep the columns whose null fraction is at most ``limit`` (one bounded action)."""
    kept = {
        r["column_name"]
        for r in null_fractions(df).filter(F.col("null_fraction") <= limit).collect()
    }
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in kept])


def counting_nulls(df: DataFrame, among: Column | None = None) -> tuple[DataFrame, Observation]:
    """The table, which counts its filled cells while it is written, and what it will have seen.

    ``among`` limits the counts to some rows. Nothing is read for them a second time.
    """
    seen = Observation()
    held = F.lit(True) if among is None else F.coalesce(among, F.lit(False))
    counts = [F.count_if(held & F.col(f"`{c}`").isNotNull()).alias(f"c{i}") for i, c in enumerate(df.columns)]
    return df.observe(seen, F.count_if(held).alias("n"), *counts), seen


def dense_columns(seen: Observation, columns: list[str], limit: float = S.NULL_FRACTION_LIMIT) -> list[str]:
    """Of the written table's ``columns``, in its order, those that ``drop_sparse_columns`` would keep."""
    counts = seen.get
    n = counts["n"]
    return [c for i, c in enumerate(columns) if n and (n - counts[f"c{i}"]) / n <= limit]


def stored_dense(df: DataFrame, name: str, limit: float = S.NULL_FRACTION_LIMIT) -> DataFrame:
    """Store a table and keep its columns of few nulls, counted during the write."""
    counted, seen = counting_nulls(df)
    stored = through_storage(counted, name)
    return stored.select(*[F.col(f"`{c}`") for c in dense_columns(seen, df.columns, limit)])


def align_columns(df: DataFrame, like: DataFrame | T.StructType, exclude: tuple = ()) -> DataFrame:
    """The columns of ``like`` in its order: missing ones as null, extra ones dropped."""
    schema = like if isinstance(like, T.StructType) else like.schema
    have = set(df.columns)
    return df.select(
        *[
            F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
            if f.name not in exclude
        ]
    )


def target_distribution(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """(target, n, share): the class shares of a label, both classes always present."""
    label = F.col(target)
    total = F.count(F.lit(1))
    counts = df.agg(
        F.count_if(label == 0).alias("n0"), F.count_if(label == 1).alias("n1"), total.alias("n")
    )
    cells = [
        F.struct(
            F.lit(k).cast("long").alias("target"),
            F.col(f"n{k}").alias("n"),
            F.round(F.try_divide(F.col(f"n{k}"), F.col("n")), 4).alias("share"),
        )
        for k in (0, 1)
    ]
    return counts.select(F.inline(F.array(*cells)))


def dataset_summary(df: DataFrame, target: str = S.TARGET, ids: tuple = (S.ID,)) -> DataFrame:
    """One row: rows, features, default rate and counts."""
    label = F.col(target)
    features = [c for c in df.columns if c not in (target, *ids)]
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(features)).cast("long").alias("n_features"),
        F.round(F.avg(label.cast("double")), 4).alias("default_rate"),
        F.coalesce(F.sum(label.cast("long")), F.lit(0)).cast("long").alias("default_count"),
        F.count_if(label == 0).alias("non_default_count"),
    )


def long_text(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """(keep.., feature, value): one row per cell, values as strings."""
    keep = keep or []
    cells = [F.struct(F.col(c).cast("string").alias("value"), *keep).alias(c) for c in cols]
    return (
        df.select(*cells)
        .unpivot([], cols, "feature", "cell")
        .select(*[F.col(f"cell.{k}").alias(k) for k in keep], "feature", "cell.value")
    )


def category_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, n, pct): value counts per column with percent of the rows."""
    counts = long_text(df, cols).groupBy("feature", "value").agg(F.count("*").alias("n"))
    totals = counts.groupBy("feature").agg(F.sum("n").alias("total"))
    # one row per listed column
    return counts.join(F.broadcast(totals), "feature").select(
        "feature", "value", "n", F.round(F.col("n") * 100.0 / F.col("total"), 1).alias("pct")
    )


def distinct_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column_name, n_distinct) of the non-null values.

    Long form instead of one wide multi-distinct aggregate: a row is copied once per
    column as two cells, not once per column at full width.
    """
    cols = cols or df.columns
    # a null cell keeps an all-null column in the result and counts as no value
    return (
        long_text(df, cols)
        .distinct()
        .groupBy(F.col("feature").alias("column_name"))
        .agg(F.count("value").alias("n_distinct"))
    )


def few_distinct(df: DataFrame, cols: list[str], limit: int = S.CHI2_MAX_DISTINCT) -> list[str]:
    """The columns with at most ``limit`` distinct values.

    The sketch only rules columns out: with ``limit`` values at most ``limit`` registers
    are filled, so its estimate cannot reach twice the limit. The rest is counted exactly.
    """
    if not cols:
        return []
    sketch = df.agg(*[F.approx_count_distinct(F.col(c)).alias(c) for c in cols]).first()
    likely = [c for c in cols if sketch[c] <= 2 * limit]
    if not likely:
        return []
    exact = distinct_counts(df, likely).filter(F.col("n_distinct") <= limit).collect()
    return [r["column_name"] for r in exact]


def crosstab(
    df: DataFrame, cols: list[str], target: str = S.TARGET, missing: str = "MISSING"
) -> DataFrame:
    """(feature, value, n0, n1): class counts per value, null as its own value."""
    label = F.col(target)
    return (
        long_text(df.filter(label.isin(0, 1)), cols, [target])
        .groupBy("feature", F.coalesce("value", F.lit(missing)).alias("value"))
        .agg(F.count_if(label == 0).alias("n0"), F.count_if(label == 1).alias("n1"))
    )


def dataset_overview(
    train: DataFrame, test: DataFrame, raw: DataFrame, target: str = S.TARGET, ids: tuple = (S.ID,)
) -> DataFrame:
    """One row: the shapes of the train and test tables, how many features there are and how many
    of them the raw table lacks, and the class counts and share."""
    features = [c for c in train.columns if c not in (target, *ids)]
    engineered = [c for c in features if c not in set(raw.columns)]
    label = F.col(target)
    counts = train.agg(
        F.count(F.lit(1)).alias("train_rows"),
        F.count_if(label == 0).alias("non_default_count"),
        F.count_if(label == 1).alias("default_count"),
        F.round(F.avg(label.cast("double")), 4).alias("default_rate"),
    )
    # one row each
    rows = counts.withColumn("k", F.lit(1)).join(test.agg(F.count(F.lit(1)).alias("test_rows")).withColumn("k", F.lit(1)), "k")
    sizes = {"train_columns": len(train.columns), "test_columns": len(test.columns), "n_features": len(features), "n_engineered": len(engineered)}
    return rows.drop("k").withColumns({c: F.lit(n).cast("long") for c, n in sizes.items()})
