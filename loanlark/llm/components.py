"""Connected components of a table of links, by DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlark.llm.common import stored


def _to_minimum(links: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours of each node (all, or the smaller ones) to the least of them."""
    if larger_only:
        both = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    near = both.join(least, "a")
    if larger_only:
        made = near.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        made = near.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", F.col("least").alias("b")))
    return made.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the least id reachable) of every linked node.

    ``links`` has columns ``a`` and ``b``. Rounds of large and small stars (their number grows
    with the logarithm of the longest path) end when the links no longer change. A hub's
    links are summed before the shuffle, and joins on it can be split.
    """
    now, said = stored(links.select("a", "b").where("a <> b").distinct(), "links"), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == said:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
                now.select(F.col("b"), F.col("b")).distinct()
            )
        said = tuple(mark)
        now = stored(_to_minimum(_to_minimum(now, True), False), "links")
