"""Cumulative sums, ranks and exact quantiles without a one-task window.

A column is cut into range buckets of bounded size (``ranges``). Rows are first reduced to
distinct values per bucket, so a value that holds a third of all rows is one row; each bucket
is then ordered by its own task, and the per-bucket totals - a row for each column and some
million rows, hence the broadcast - carry the running sums across buckets.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlark.functions import ranges as R
from loanlark.functions.ranges import assign_buckets, number, range_splits

#: Bits of a key that one pass of the radix selection counts.
DIGIT = 16
#: Rows of a bucket of hashes that one task orders.
ROWS_PER_BUCKET = 500_000


def long_values(
    df: DataFrame, cols: list[str], keep: list[str] | None = None, rows_per_range: int = R.ROWS_PER_RANGE
) -> DataFrame:
    """(keep.., feature, bucket, value): one row per cell with a value, as double."""
    keep = keep or []
    base = df.select(*keep, *[number(f"`{c}`").alias(f"v{i}") for i, c in enumerate(cols)])
    values = [f"v{i}" for i in range(len(cols))]
    borders = range_splits(base, values, rows_per_range=rows_per_range)
    marked = assign_buckets(base, values, borders, [f"b{i}" for i in range(len(cols))])
    # kept columns travel inside the cell: passed through as identifiers they would give the
    # two sides of a self-join different plans, and the shuffle would not be shared
    cells = [
        F.struct(
            F.col(f"b{i}").cast("int").alias("bucket"),
            F.col(f"v{i}").alias("value"),
            *keep,
        ).alias(c)
        for i, c in enumerate(cols)
    ]
    return (
        marked.select(*cells)
        .unpivot([], cols, "feature", "cell")
        .filter("cell.value is not null and cell.bucket is not null")
        .select(*[F.col(f"cell.{k}").alias(k) for k in keep], "feature", "cell.bucket", "cell.value")
    )


def running_sums(df: DataFrame, order: str, sums: list[str]) -> DataFrame:
    """Add ``run_x`` (inclusive running sum by ``order``) and ``all_x`` (total) per feature.

    ``df`` holds one row per (feature, bucket, order value).
    """
    # the join adds these filters to one of its sides; stated here, both sides stay equal
    # and share one shuffle
    df = df.filter("feature is not null and bucket is not null")
    per_bucket = df.groupBy("feature", "bucket").agg(*[F.sum(s).alias(s) for s in sums])
    feature = Window.partitionBy("feature")
    before = feature.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        "feature",
        "bucket",
        *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"before_{s}") for s in sums],
        *[F.sum(s).over(feature).alias(f"all_{s}") for s in sums],
    )
    inside = (
        Window.partitionBy("feature", "bucket")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = df.select("*", *[F.sum(s).over(inside).alias(f"in_{s}") for s in sums])
    return (
        local.join(F.broadcast(offsets), ["feature", "bucket"])
        .withColumns({f"run_{s}": F.col(f"before_{s}") + F.col(f"in_{s}") for s in sums})
        .drop(*[f"before_{s}" for s in sums], *[f"in_{s}" for s in sums])
    )


def counted_values(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """(feature, bucket, value, n0, n1): distinct values per column with class counts."""
    return (
        long_values(df.filter(F.col(label).isin(0, 1)), cols, [label])
        .groupBy("feature", "bucket", "value")
        .agg(
            F.count_if(F.col(label) == 0).alias("n0"),
            F.count_if(F.col(label) == 1).alias("n1"),
        )
    )


def class_counts(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """``counted_values`` with running sums: run_* and all_* of n0, n1 and one."""
    counted = counted_values(df, cols, label).withColumn("one", F.lit(1).cast("long"))
    return running_sums(counted, "value", ["n0", "n1", "one"])


def bucket_ranks(cells: DataFrame) -> DataFrame:
    """(feature, bucket, first, next, total): the 0-based ranks a bucket covers.

    ``cells`` holds (feature, bucket, n), n being the number of rows a cell stands for.
    """
    sizes = cells.groupBy("feature", "bucket").agg(F.sum("n").alias("n"))
    feature = Window.partitionBy("feature")
    upto = feature.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sizes.select(
        "feature",
        "bucket",
        (F.sum("n").over(upto) - F.col("n")).alias("first"),
        F.sum("n").over(upto).alias("next"),
        F.sum("n").over(feature).alias("total"),
    )


def values_at_ranks(cells: DataFrame, ranks: Callable[[Column], list[Column]]) -> DataFrame:
    """(feature, total, position, rank, value) for the 0-based ranks wanted per feature.

    ``cells`` holds (feature, bucket, value, n); ``ranks`` maps the row total of a feature
    to its wanted ranks. Only the rows of the buckets that hold a wanted rank are shuffled
    and ordered.
    """
    wanted = (
        bucket_ranks(cells)
        .select("*", F.posexplode(F.array(*ranks(F.col("total")))).alias("position", "rank"))
        .filter("rank >= first and rank < next")
        .select("feature", "bucket", "first", "total", "position", "rank")
    )
    needed = wanted.select("feature", "bucket", "first").distinct()
    inside = (
        Window.partitionBy("feature", "bucket")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # both broadcast sides hold at most features x wanted ranks rows
    ranked = (
        cells.join(F.broadcast(needed), ["feature", "bucket"])
        .groupBy("feature", "bucket", "first", "value")
        .agg(F.sum("n").alias("n"))
        .withColumn("stop", F.col("first") + F.sum("n").over(inside))
        .select("feature", "bucket", "value", (F.col("stop") - F.col("n")).alias("start"), "stop")
    )
    return (
        ranked.join(F.broadcast(wanted.drop("first")), ["feature", "bucket"])
        .filter("rank >= start and rank < stop")
        .select("feature", "total", "position", "rank", "value")
    )


def quantile_ranks(probabilities: list[float]) -> Callable[[Column], list[Column]]:
    """For each probability the two order statistics it lies between."""

    def ranks(total: Column) -> list[Column]:
        heights = [F.lit(float(p)) * (total - 1) for p in probabilities]
        return [side(h) for h in heights for side in (F.floor, F.ceil)]

    return ranks


def between(low: Column, high: Column, share: Column) -> Column:
    """Linear interpolation; from minus infinity it stays there."""
    stays = (share == 0) | (low == high) | (low == F.lit(-math.inf))
    return F.when(stays, low).otherwise(low + (high - low) * share)


def interpolated(found: DataFrame, probabilities: list[float]) -> DataFrame:
    """(feature, probability, value) from the ranks of ``quantile_ranks``."""
    probability = F.element_at(
        F.array(*[F.lit(float(p)) for p in probabilities]),
        F.floor(F.col("position") / 2).cast("int") + 1,
    )
    low = F.max(F.when(F.col("position") % 2 == 0, F.col("value")))
    high = F.max(F.when(F.col("position") % 2 == 1, F.col("value")))
    return (
        found.groupBy("feature", probability.alias("probability"))
        .agg(low.alias("low"), high.alias("high"), F.first("total").alias("total"))
        .withColumn("h", F.col("probability") * (F.col("total") - 1))
        .select(
            "feature",
            "probability",
            between(F.col("low"), F.col("high"), F.col("h") - F.floor("h")).alias("value"),
        )
    )


def exact_quantiles(df: DataFrame, cols: list[str], probabilities: list[float]) -> DataFrame:
    """(feature, probability, value): linear interpolation between order statistics.

    NaN counts as missing; infinities are values, and a quantile between equal ones is theirs.
    Bucket sizes tell which value range holds each wanted rank; they reach the driver as
    one row per column and probability. The final pass keeps only values inside those
    ranges, by plain comparison in the scan stage, and shuffles no others.
    """
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "feature string, probability double, value double")
    base = df.select(*[number(f"`{c}`").alias(f"v{i}") for i, c in enumerate(cols)])
    values = base.columns
    splits = range_splits(base, values)
    marks = [f"b{i}" for i in range(len(cols))]
    cells = (
        assign_buckets(base, values, splits, marks)
        .select(*[F.col(b).cast("int").alias(b) for b in marks])
        .unpivot([], marks, "feature", "bucket")
        .filter("bucket is not null")
        .withColumn("n", F.lit(1).cast("long"))
    )
    spans = (
        bucket_ranks(cells)
        .withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .withColumn("h", F.col("p") * (F.col("total") - 1))
        .withColumns({"low": F.floor("h"), "high": F.ceil("h")})
        .filter("(low >= first and low < next) or (high >= first and high < next)")
        .groupBy("feature", "p", "h", "low", "high")
        .agg(F.min("bucket").alias("b0"), F.max("bucket").alias("b1"), F.min("first").alias("first"))
        .collect()
    )
    schema = "slot string, feature string, probability double, h double, low long, high long, first long"
    slots, kept = [], []
    for j, r in enumerate(spans):
        i = int(r["feature"][1:])
        v, start, stop = F.col(f"v{i}"), splits[i][r["b0"]], splits[i][r["b1"] + 1]
        inside = (v >= F.lit(start)) & (v < F.lit(stop)) if math.isfinite(stop) else v >= F.lit(start)
        kept.append(F.when(inside, v).alias(f"s{j}"))
        slots.append((f"s{j}", cols[i], r["p"], r["h"], r["low"], r["high"], r["first"]))
    wanted = spark.createDataFrame(slots, schema)
    if not slots:
        return wanted.select("feature", "probability", F.col("h").alias("value"))
    inside = (
        Window.partitionBy("slot")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = (
        base.select(*kept)
        .unpivot([], [s[0] for s in slots], "slot", "value")
        .filter("value is not null")
        .groupBy("slot", "value")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(inside))
    )
    # one row per column and probability
    placed = counted.join(F.broadcast(wanted), "slot").withColumns(
        {"start": F.col("first") + F.col("upto") - F.col("n"), "stop": F.col("first") + F.col("upto")}
    )
    low = F.max(F.when(F.expr("low >= start and low < stop"), F.col("value")))
    high = F.max(F.when(F.expr("high >= start and high < stop"), F.col("value")))
    return placed.groupBy("feature", "probability", "h").agg(
        low.alias("a"), high.alias("b")
    ).select(
        "feature",
        "probability",
        between(F.col("a"), F.col("b"), F.col("h") - F.floor("h")).alias("value"),
    )


def hash_bucket(key: Column, bits: int) -> Column:
    """Equal-width range bucket of a 64-bit hash (uniform, so no quantiles are needed)."""
    return F.shiftright(key, 64 - bits).cast("int")


def cuts_at_ranks(
    df: DataFrame, group: Column, key: Column, ranks: Callable[[str | None, int], list[int]]
) -> dict[str | None, list[int | None]]:
    """For each group the cuts that have exactly the wanted numbers of keys below them.

    A radix selection: rows are counted by the leading ``DIGIT`` bits of their 64-bit key, then,
    within the one prefix that holds a wanted rank, by the next, so nothing is ordered. A cut
    at or beyond the end is None; rows of one key stay together, above the cut that meets them.
    """
    cells = df.select(group.cast("string").alias("g"), key.alias("key"))
    # what a wanted rank is looked up in: (group, prefix so far, bits of it) -> [(position, rank within)]
    counts = cells.groupBy("g", F.shiftright("key", 64 - DIGIT).alias("p")).count().collect()
    sizes: dict[str | None, int] = {}
    for r in counts:
        sizes[r["g"]] = sizes.get(r["g"], 0) + r["count"]
    wanted = {g: ranks(g, n) for g, n in sizes.items()}
    cuts: dict[str | None, list[int | None]] = {g: [None] * len(w) for g, w in wanted.items()}
    open_ones = {(g, None): [(j, rank) for j, rank in enumerate(w) if rank < sizes[g]] for g, w in wanted.items()}
    bits = DIGIT
    while True:
        below: dict[tuple, int] = {}
        following = {}
        for r in sorted(counts, key=lambda r: r["p"]):
            parent = (r["g"], None if bits == DIGIT else r["p"] >> DIGIT)
            first = below.get(parent, 0)
            below[parent] = first + r["count"]
            for position, rank in open_ones.get(parent, []):
                if first <= rank < first + r["count"]:
                    if rank == first or bits >= 64:
                        cuts[r["g"]][position] = r["p"] << (64 - bits)
                    else:
                        following.setdefault((r["g"], r["p"]), []).append((position, rank - first))
        if not following:
            return cuts
        open_ones = following
        prefix = F.shiftright("key", 64 - bits)
        inside = F.lit(False)
        # at most one prefix for each wanted rank
        for g, p in following:
            inside = inside | (F.col("g").eqNullSafe(F.lit(g)) & (prefix == F.lit(p)))
        bits += DIGIT
        counts = cells.filter(inside).groupBy("g", F.shiftright("key", 64 - bits).alias("p")).count().collect()


def ranks_by_key(df: DataFrame, group: Column, key: str, rank: str) -> DataFrame:
    """0-based rank of every row by a uniform 64-bit key inside its group, plus group size."""
    # buckets by the count of rows, each ordered by one task
    bits = max(5, min(24, math.ceil(math.log2(max(1, df.count()) / ROWS_PER_BUCKET)) + 1))
    numbered = df.select(
        "*",
        group.cast("string").alias("feature"),
        hash_bucket(F.col(key), bits).alias("bucket"),
        F.lit(1).cast("long").alias("one"),
    )
    return (
        running_sums(numbered, key, ["one"])
        .withColumn(rank, F.col("run_one") - 1)
        .withColumnRenamed("all_one", f"{rank}_total")
        .drop("feature", "bucket", "one", "run_one")
    )
