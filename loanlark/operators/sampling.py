"""Stratified splits and folds.

Rows stand in the order of a hash of their id, but are never sorted. Only the cut keys - one
per class and cut - are selected, by counts of the hash's leading bits; the rows themselves are
then marked by comparison, without a shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlark import settings as S
from loanlark.functions import ordering as O


def id_key(key: str, seed: int) -> Column:
    """A 64-bit key that orders rows at random; distinct long ids get distinct keys."""
    return F.xxhash64(F.col(key).cast("long"), F.lit(seed).cast("long"))


def _train_sizes(class_sizes: dict[str, int], test_size: float) -> dict[str, int]:
    """Rows per class in the training part: proportional, largest remainders rounded up."""
    total = sum(class_sizes.values())
    n_train = total - math.ceil(total * test_size)
    exact = {c: n * n_train / total for c, n in class_sizes.items()}
    sizes = {c: math.floor(x) for c, x in exact.items()}
    by_remainder = sorted(exact, key=lambda c: (sizes[c] - exact[c], c))
    for c in by_remainder[: n_train - sum(sizes.values())]:
        sizes[c] += 1
    return sizes


def stratified_split(
    df: DataFrame, label: str, key: str, test_size: float = S.TEST_SIZE, seed: int = S.SEED
) -> DataFrame:
    """Add ``split`` ('train' or 'test') with exact class proportions."""
    order = id_key(key, seed)
    classes = {
        r["c"]: r["count"]
        for r in df.groupBy(F.col(label).cast("string").alias("c")).count().collect()
    }
    if None in classes:
        raise ValueError(f"{classes[None]} rows have no {label}: drop them before the split")
    train = _train_sizes(classes, test_size)
    cuts = O.cuts_at_ranks(df, F.col(label), order, lambda c, total: [train[c]])
    is_train = F.lit(False)
    for c in classes:
        mine = F.col(label).cast("string") == c
        # no cut: the whole class is on the training side
        inside = (order < F.lit(cuts[c][0])) if cuts[c][0] is not None else F.lit(True)
        is_train = F.when(mine, inside).otherwise(is_train)
    return df.withColumn("split", F.when(is_train, "train").otherwise("test"))


def stratified_folds(
    df: DataFrame, label: str, key: str, folds: int = S.SEARCH_FOLDS, seed: int = S.SEED
) -> DataFrame:
    """Add ``fold`` (0..folds-1); the folds of a class differ by at most one row."""
    order = id_key(key, seed)
    cuts = O.cuts_at_ranks(
        df, F.col(label), order, lambda c, total: [total * j // folds for j in range(1, folds)]
    )
    fold = F.lit(0)
    for c, keys in cuts.items():
        if c is not None:
            passed = F.lit(0)
            for k in keys:
                if k is not None:
                    passed = passed + (order >= F.lit(k)).cast("int")
            fold = F.when(F.col(label).cast("string") == c, passed).otherwise(fold)
    return df.withColumn("fold", fold.cast("int"))
