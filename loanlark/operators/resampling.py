"""Minority oversampling by interpolation between neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlark import settings as S
from loanlark.functions import ordering as O
from loanlark.functions.expr import hashed_uniform
from loanlark.functions.skew import salted_lookup
from loanlark.operators import sampling
from loanlark.operators.neighbours import nearest_neighbours
from loanlark.session import through_storage

COPIES_AT_ONCE = 10_000


def class_sizes(df: DataFrame, label: str) -> tuple[int, int]:
    """(majority rows, minority rows)."""
    row = df.agg(F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)).first()
    return row[0], row[1]


def rows_to_make(majority: int, minority: int, ratio: float) -> int:
    wanted = int(ratio * majority - minority)
    if wanted < 0:
        raise ValueError("the minority class already exceeds the wanted ratio")
    return wanted


def _interpolated(picks: DataFrame, minority: DataFrame) -> DataFrame:
    """(draw.., parent, neighbour, step, vector) from picks of (parent, neighbour, step).

    A row can be the neighbour of most others, so that side of the join is salted.
    """
    picks = through_storage(picks, "picks")
    parents = minority.select(F.col("id").alias("parent"), F.col("vec").alias("a"))
    others = minority.select(F.col("id").alias("neighbour"), F.col("vec").alias("b"))
    moved = F.zip_with("a", "b", lambda a, b: a + F.col("step") * (b - a))
    with_parent = salted_lookup(picks, parents, ["parent"], ["draw"])
    both = salted_lookup(with_parent, others, ["neighbour"], ["parent", "draw"])
    return both.withColumn("vector", moved).drop("a", "b")


def _minority(df: DataFrame, label: str, key: str, vector: str) -> DataFrame:
    return df.filter(F.col(label) == 1).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec")
    )


def _check_minority(n: int, k: int) -> None:
    if n <= k:
        raise ValueError(f"{k} neighbours need more than {n} minority rows")


def smote(
    df: DataFrame,
    label: str,
    key: str,
    vector: str,
    ratio: float = S.RESAMPLE_RATIO,
    k: int = S.NEIGHBOURS,
    seed: int = S.SEED,
) -> DataFrame:
    """(draw, parent, neighbour, step, vector) of the synthetic minority rows.

    Every draw picks a parent, one of its k minority neighbours and a step, all from a hash
    of the draw number, so a recomputed partition repeats them.
    """
    majority, n = class_sizes(df, label)
    _check_minority(n, k)
    minority = _minority(df, label, key, vector)
    near = through_storage(nearest_neighbours(minority, minority, "id", "vec", k), "near")
    keyed = minority.select("id", sampling.id_key("id", seed).alias("key"))
    numbered = O.ranks_by_key(keyed, F.lit("1"), "key", "position").select("id", "position")

    def uniform(stream: int) -> Column:
        return hashed_uniform(F.col("draw"), F.lit(seed), F.lit(stream))

    draws = (
        df.sparkSession.range(rows_to_make(majority, n, ratio))
        .withColumnRenamed("id", "draw")
        .withColumns(
            {
                "position": F.floor(uniform(1) * n),
                "rank": (F.floor(uniform(2) * k) + 1).cast("int"),
                "step": uniform(3),
            }
        )
    )
    picks = (
        draws.join(numbered.withColumnRenamed("id", "parent"), "position")
        .join(
            near.select(F.col("id").alias("parent"), "rank", "neighbour"), ["parent", "rank"]
        )
        .select("draw", "parent", "neighbour", "step")
    )
    return _interpolated(picks, minority)


def adasyn_weights(
    df: DataFrame, label: str, key: str, vector: str, k: int = S.NEIGHBOURS
) -> DataFrame:
    """(id, majority_share): share of the other class among the k neighbours in all rows."""
    rows = df.select(
        F.col(key).cast("long").alias("id"),
        F.col(vector).cast("array<double>").alias("vec"),
        F.col(label).cast("int").alias("y"),
    )
    near = through_storage(nearest_neighbours(rows.filter("y = 1"), rows, "id", "vec", k), "near")
    classes = rows.select(F.col("id").alias("neighbour"), "y")
    return (
        salted_lookup(near, classes, ["neighbour"], ["id"])
        .groupBy("id")
        .agg(F.avg((F.col("y") == 0).cast("double")).alias("majority_share"))
    )


def adasyn(
    df: DataFrame,
    label: str,
    key: str,
    vector: str,
    ratio: float = S.RESAMPLE_RATIO,
    k: int = S.NEIGHBOURS,
    seed: int = S.SEED,
) -> DataFrame:
    """(draw, parent, neighbour, step, vector): more rows where the other class is near."""
    majority, n = class_sizes(df, label)
    _check_minority(n, k)
    wanted = rows_to_make(majority, n, ratio)
    minority = _minority(df, label, key, vector)
    # read twice: stored, so that the search behind it runs once
    weights = through_storage(adasyn_weights(df, label, key, vector, k), "weights")
    total = weights.agg(F.sum("majority_share")).first()[0]
    if not total:
        raise ValueError("no minority row has a neighbour of the other class")
    near = through_storage(nearest_neighbours(minority, minority, "id", "vec", k), "near")
    copies = weights.select(
        F.col("id").alias("parent"),
        F.bround(F.col("majority_share") / total * wanted).cast("long").alias("copies"),
    ).filter("copies > 0")
    # two steps, so that no array grows with the copies of one row
    whole = F.floor((F.col("copies") - 1) / COPIES_AT_ONCE)
    portions = copies.withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), whole)))
    first = F.col("portion") * COPIES_AT_ONCE
    last = F.least(first + COPIES_AT_ONCE, F.col("copies")) - 1
    draws = portions.withColumn("draw", F.explode(F.sequence(first, last)))

    def uniform(stream: int) -> Column:
        return hashed_uniform(F.col("parent"), F.col("draw"), F.lit(seed), F.lit(stream))

    picks = (
        draws.withColumns(
            {"rank": (F.floor(uniform(1) * k) + 1).cast("int"), "step": uniform(2)}
        )
    )
    links = near.select(F.col("id").alias("parent"), "rank", "neighbour")
    picks = salted_lookup(picks, links, ["parent", "rank"], ["draw"]).select(
        "draw", "parent", "neighbour", "step"
    )
    return _interpolated(picks, minority)


def resample(
    df: DataFrame, label: str, key: str, vector: str, method: str = "smote", **options
) -> DataFrame:
    """(label, vector): the rows plus synthetic minority rows; other methods add nothing."""
    base = df.select(
        F.col(label).cast("int").alias(label), F.col(vector).cast("array<double>").alias(vector)
    )
    makers = {"smote": smote, "adasyn": adasyn}
    if method not in makers:
        return base
    made = makers[method](df, label, key, vector, **options)
    return base.unionByName(
        made.select(F.lit(1).alias(label), F.col("vector").alias(vector))
    )
