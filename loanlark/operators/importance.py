"""Feature importance: loss of AUC when one feature is shuffled."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanlark import settings as S
from loanlark.functions import ordering as O
from loanlark.operators import learner

SCORE_RANGES = 4096


def permutation_importance(
    model: GBTClassificationModel,
    df: DataFrame,
    features: list[str],
    key: str = S.ID,
    label: str = S.TARGET,
    rows: int | None = None,
    seed: int = S.SEED,
) -> DataFrame:
    """(feature, importance, gain): AUC drop per feature and the trees' own gain share.

    All rows are scored, or a sample of ``rows`` of them where that is asked for. All
    features that a tree splits on are scored in one job: the rows once per feature with that
    feature shuffled, and once unchanged. Shuffling any other feature leaves every score as it is,
    so it loses nothing. Rows are paired with their donors by two ranks of hashes of the id.
    """
    given = (
        df.select(
            F.col(key).cast("long").alias("id"),
            F.col(label).cast("int").alias("y"),
            F.array(*[F.col(c).cast("double") for c in features]).alias("x"),
        )
        .withColumns({"k1": F.xxhash64("id", F.lit(seed)), "k2": F.xxhash64("id", F.lit(seed + 1))})
    )
    if rows is not None:
        given = given.orderBy("k1").limit(rows)
    one = F.lit("all")
    placed = O.ranks_by_key(given, one, "k1", "place")
    donors = O.ranks_by_key(given, one, "k2", "place").select("place", F.col("x").alias("shuffled"))
    weights = model.featureImportances
    variants = F.explode(F.array(*[F.lit(int(i)) for i in (-1, *weights.indices)]))
    # a row's variants are made from it, so its size says little about the work: all partitions are kept
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.greatest("variant", F.lit(0))
    shuffled = F.concat(
        F.slice("x", F.lit(1), at), F.slice("shuffled", at + 1, F.lit(1)), F.slice("x", at + 2, F.lit(len(features)))
    )
    changed = (
        placed.join(donors, "place")
        .repartition(partitions, "place")
        .withColumn("variant", variants)
        .select("variant", "y", F.when(F.col("variant") < 0, F.col("x")).otherwise(shuffled).alias("x"))
    )
    scored = learner.raw_scores(model, changed, name="p").select("variant", "y", "p")
    # scores lie in [0, 1]: their ranges need no quantiles, and equal scores are one row
    ties = O.running_sums(
        scored.groupBy("variant", "p")
        .agg(F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1"))
        .withColumns({"feature": F.col("variant"), "bucket": F.floor(F.col("p") * SCORE_RANGES).cast("int")}),
        "p", ["n0"],
    ).withColumnRenamed("run_n0", "below")
    auc = ties.groupBy("variant").agg(
        F.try_divide(
            F.sum(F.col("n1") * (F.col("below") - F.col("n0") / 2)), F.sum("n0") * F.sum("n1")
        ).alias("auc")
    )
    base = auc.filter("variant = -1").select(F.col("auc").alias("base"), F.lit(1).alias("k"))
    gains = [float(g) for g in weights.toArray()]
    names = F.array(*[F.lit(f) for f in features])
    gain = F.array(*[F.lit(g) for g in gains])
    place = (F.col("variant") + 1).cast("int")
    every = df.sparkSession.range(len(features)).select(F.col("id").cast("int").alias("variant"), F.lit(1).alias("k"))
    # one row, and one a feature
    return (
        every.join(F.broadcast(base), "k")
        .join(F.broadcast(auc), "variant", "left")
        .select(
            F.element_at(names, place).alias("feature"),
            F.round(F.col("base") - F.coalesce("auc", "base"), 6).alias("importance"),
            F.round(F.element_at(gain, place), 6).alias("gain"),
        )
        .orderBy(F.desc("importance"), F.desc("gain"), "feature")
    )


def top_importance(df: DataFrame, value: str, top: int = S.IMPORTANCE_TOP) -> DataFrame:
    """The ``top`` rows by a value, with their size relative to the largest shown."""
    shown = df.orderBy(F.desc(value), "feature").limit(top)
    # at most ``top`` rows
    largest = F.max(value).over(Window.partitionBy(F.lit(0)))
    return shown.withColumn("relative", F.try_divide(F.col(value), largest))
