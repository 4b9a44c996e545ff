"""Classifier evaluation from (score, label) rows.

All curves come from one table: distinct scores with class counts and running sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanlark import settings as S
from loanlark.functions import expr as X
from loanlark.functions import ordering as O


def score_table(df: DataFrame, score: str, label: str) -> DataFrame:
    """Distinct scores, ascending, with counts of the rows at or above each of them."""
    return O.class_counts(df, [score], label).withColumns(
        {
            "tp": F.col("all_n1") - F.col("run_n1") + F.col("n1"),
            "fp": F.col("all_n0") - F.col("run_n0") + F.col("n0"),
        }
    )


def ranking_metrics(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row: AUC-ROC with ties, average precision, KS (unrounded)."""
    table = score_table(df, score, label)
    n0, n1 = F.first("all_n0").cast("double"), F.first("all_n1").cast("double")
    below = F.col("run_n0") - F.col("n0") + F.col("n0") / 2
    gap = F.abs(F.col("run_n0") / F.col("all_n0") - F.col("run_n1") / F.col("all_n1"))
    return table.filter("all_n0 > 0 and all_n1 > 0").agg(
        F.try_divide(F.sum(F.col("n1") * below), n0 * n1).alias("auc_roc"),
        F.try_divide(
            F.sum(F.col("n1") * F.col("tp").cast("double") / (F.col("tp") + F.col("fp"))), n1
        ).alias("auc_pr"),
        F.max(gap).alias("ks_statistic"),
    )


def confusion(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    """One row tn, fp, fn, tp; empty cells are 0."""
    hit, y = F.col(score) >= threshold, F.col(label)
    return df.agg(
        F.count_if(~hit & (y == 0)).alias("tn"),
        F.count_if(hit & (y == 0)).alias("fp"),
        F.count_if(~hit & (y == 1)).alias("fn"),
        F.count_if(hit & (y == 1)).alias("tp"),
    )


def confusion_cells(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    """(cell, n, share) of the confusion matrix."""
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    cells = [
        F.struct(
            F.lit(c).alias("cell"),
            F.col(c).alias("n"),
            F.round(F.try_divide(F.col(c), total), 6).alias("share"),
        )
        for c in ("tn", "fp", "fn", "tp")
    ]
    return confusion(df, score, label, threshold).select(F.inline(F.array(*cells)))


def precision_of(tp: Column, fp: Column) -> Column:
    return F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))


def recall_of(tp: Column, fn: Column) -> Column:
    return F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))


def f1_of(tp: Column, fp: Column, fn: Column) -> Column:
    return F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))


def threshold_metrics(df: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    """One row: precision, recall, F1 at a threshold; 0 where undefined (unrounded)."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return confusion(df, score, label, threshold).select(
        precision_of(tp, fp).alias("precision"),
        recall_of(tp, fn).alias("recall"),
        f1_of(tp, fp, fn).alias("f1"),
    )


def _thinned(position: Column, length: Column, points: int) -> Column:
    """Index of a row in the evenly thinned curve, null if the row is left out.

    Point j of m sits at floor(j * (length - 1) / (m - 1)), the last one at the end.
    """
    m = F.least(F.lit(points).cast("long"), length)
    step = (length - 1).cast("double") / (m - 1)
    guess = F.floor(position / step)

    def at(j: Column) -> Column:
        return F.when(j == m - 1, length - 1).otherwise(F.floor(j * step))

    hits = [
        F.when((j >= 0) & (j < m) & (at(j) == position), j)
        for j in (guess - 1, guess, guess + 1)
    ]
    return F.coalesce(*hits)


def _picked(
    rows: DataFrame, own: Column, twice: Column, extra: Column, length: Column, points: int
) -> DataFrame:
    """The rows of the thinned curve with ``position`` and ``idx``.

    Each row sits at position ``own``; the one marked ``twice`` also stands at ``extra``.
    A short test first drops rows with no grid point near them; the exact one, too long
    for the JIT compiler, then sees few rows.
    """
    step = (length - 1).cast("double") / (F.least(F.lit(points).cast("long"), length) - 1)
    close = F.ceil(own / step - 1e-6) <= (own + 1) / step + 1e-6
    near = rows.filter(twice | close)
    spots = F.when(twice, F.array(own, extra)).otherwise(F.array(own))
    return (
        near.select("*", F.explode(spots).alias("position"))
        .withColumn("idx", _thinned(F.col("position"), length, points))
        .filter("idx is not null")
    )


def _bends(counts: DataFrame) -> DataFrame:
    """Distinct scores with ``keep`` and the running numbers the ROC curve needs.

    Walking up the scores, a score bends the curve when the score below it adds other
    class counts; the lowest and highest always stay. Inside a range bucket that is a lag;
    across the borders it takes the last row of the bucket below. One summary row per
    bucket carries borders and running numbers, so the rows are ordered once.
    """
    inside = Window.partitionBy("feature", "bucket").orderBy("value")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    changed = (F.lag("n0").over(inside) != F.col("n0")) | (F.lag("n1").over(inside) != F.col("n1"))
    local = counts.select(
        "*",
        F.row_number().over(inside).alias("place"),
        F.coalesce(changed.cast("long"), F.lit(0).cast("long")).alias("bend"),
    ).select(
        "*",
        F.sum("n0").over(upto).alias("in_n0"),
        F.sum("n1").over(upto).alias("in_n1"),
        F.sum("bend").over(upto).alias("in_bend"),
    )
    buckets = local.groupBy("feature", "bucket").agg(
        F.sum("n0").alias("b0"),
        F.sum("n1").alias("b1"),
        F.sum("bend").alias("bends"),
        F.min_by("n0", "value").alias("head0"),
        F.min_by("n1", "value").alias("head1"),
        F.max_by("n0", "value").alias("last0"),
        F.max_by("n1", "value").alias("last1"),
        F.max("value").alias("top"),
        F.max_by("bend", "value").alias("top_bend"),
        F.count("*").alias("rows"),
    )
    curve = Window.partitionBy("feature")
    order = curve.orderBy("bucket")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turned = (F.lag("last0").over(order) != F.col("head0")) | (
        F.lag("last1").over(order) != F.col("head1")
    )
    # the first row of the lowest bucket has no row below and stays
    linked = buckets.withColumn(
        "head_bend", F.coalesce(turned.cast("long"), F.lit(1).cast("long"))
    )
    # 1 when the very highest score does not bend and stays as the end point only
    straight = F.when(F.col("rows") == 1, 1 - F.col("head_bend")).otherwise(1 - F.col("top_bend"))
    none = F.lit(0).cast("long")
    summary = linked.select(
        "feature",
        "bucket",
        "head_bend",
        F.coalesce(F.sum("b0").over(before), none).alias("before_n0"),
        F.coalesce(F.sum("b1").over(before), none).alias("before_n1"),
        F.coalesce(F.sum(F.col("bends") + F.col("head_bend")).over(before), none).alias("before_bend"),
        F.sum("b0").over(curve).alias("all_n0"),
        F.sum("b1").over(curve).alias("all_n1"),
        F.sum(F.col("bends") + F.col("head_bend")).over(curve).alias("all_bend"),
        F.max("top").over(curve).alias("top"),
        F.max_by(straight, "bucket").over(curve).alias("end_only"),
    )
    is_top = F.col("value") == F.col("top")
    is_head = F.col("place") == 1
    bent = F.when(is_head, F.col("head_bend")).otherwise(F.col("bend"))
    # one summary row per bucket
    return local.join(F.broadcast(summary), ["feature", "bucket"]).select(
        "value",
        (F.col("all_n1") - F.col("before_n1") - F.col("in_n1") + F.col("n1")).alias("tp"),
        (F.col("all_n0") - F.col("before_n0") - F.col("in_n0") + F.col("n0")).alias("fp"),
        "all_n0",
        "all_n1",
        ((bent == 1) | is_top).alias("keep"),
        (
            F.col("before_bend")
            + F.col("head_bend")
            + F.col("in_bend")
            + F.when(is_top, F.col("end_only")).otherwise(0)
        ).alias("run_kept"),
        (F.col("all_bend") + F.col("end_only")).alias("all_kept"),
    )


def roc_curve(df: DataFrame, score: str, label: str, points: int = S.CURVE_POINTS) -> DataFrame:
    """(idx, fpr, tpr) by falling threshold from (0, 0), collinear points left out."""
    kept = _bends(O.counted_values(df, [score], label)).filter("keep")
    length = F.col("all_kept") + 1
    # the lowest score also stands for the start of the curve
    placed = _picked(
        kept, length - F.col("run_kept"), F.col("run_kept") == 1, F.lit(0).cast("long"), length, points
    )
    start = F.col("position") == 0
    return placed.select(
        "idx",
        F.when(start, 0.0).otherwise(F.try_divide(F.col("fp"), F.col("all_n0"))).alias("fpr"),
        F.when(start, 0.0).otherwise(F.try_divide(F.col("tp"), F.col("all_n1"))).alias("tpr"),
    )


def pr_curve(df: DataFrame, score: str, label: str, points: int = S.CURVE_POINTS) -> DataFrame:
    """(idx, precision, recall) by rising threshold, closed by (1, 0)."""
    table = score_table(df, score, label)
    last = F.col("run_one") == F.col("all_one")
    # the highest score also stands for the closing point
    placed = _picked(
        table, F.col("run_one") - 1, last, F.col("all_one"), F.col("all_one") + 1, points
    )
    end = F.col("position") == F.col("all_one")
    tp, fp = F.col("tp"), F.col("fp")
    return placed.select(
        "idx",
        F.when(end, 1.0).otherwise(tp / (tp + fp)).alias("precision"),
        F.when(end, 0.0).otherwise(F.try_divide(tp, F.col("all_n1"))).alias("recall"),
    )


def calibration_curve(
    df: DataFrame, score: str, label: str, bins: int = S.CALIBRATION_BINS
) -> DataFrame:
    """(idx, mean_predicted, fraction_pos) over quantile bins; empty bins are left out.

    The bin edges are ``bins - 1`` exact quantiles, read back as constants.
    """
    inner = [i / bins for i in range(1, bins)]
    edges = [r["value"] for r in O.exact_quantiles(df, [score], inner).collect()]
    index = F.lit(0)
    for edge in edges:
        index = index + (F.col(score) > edge).cast("int")
    means = (
        df.groupBy(index.alias("bin"))
        .agg(
            F.avg(score).alias("mean_predicted"),
            F.avg(F.col(label).cast("double")).alias("fraction_pos"),
        )
        .filter("mean_predicted is not null")
    )
    order = Window.partitionBy(F.lit(0)).orderBy("bin")
    return means.select(
        (F.row_number().over(order) - 1).cast("long").alias("idx"),
        "mean_predicted",
        "fraction_pos",
    )


def score_histogram(
    df: DataFrame, score: str, label: str, bins: int = S.HISTOGRAM_BINS
) -> DataFrame:
    """(bin, center, non_default, default) over equal bins of [0, 1]; all bins appear."""
    edges = [i * (1.0 / bins) for i in range(bins)] + [1.0]
    inside = df.select(F.col(score).cast("double").alias("s"), F.col(label).alias("y")).filter(
        "s between 0 and 1"
    )
    counts = (
        O.assign_buckets(inside, ["s"], [edges], ["bin"])
        .groupBy(F.col("bin").cast("long").alias("bin"))
        .agg(F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1"))
    )
    centers = F.array(*[F.lit((edges[i] + edges[i + 1]) / 2) for i in range(bins)])
    return (
        df.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .join(F.broadcast(counts), "bin", "left")
        .select(
            "bin",
            F.round(F.element_at(centers, (F.col("bin") + 1).cast("int")), 4).alias("center"),
            F.coalesce("n0", F.lit(0)).alias("non_default"),
            F.coalesce("n1", F.lit(0)).alias("default"),
        )
    )


def threshold_grid(steps: int = S.THRESHOLD_STEPS) -> list[float]:
    width = (S.THRESHOLD_HIGH - S.THRESHOLD_LOW) / (steps - 1)
    return [i * width + S.THRESHOLD_LOW for i in range(steps - 1)] + [S.THRESHOLD_HIGH]


def optimal_threshold(
    df: DataFrame, score: str, label: str, metric: str = "f1", steps: int = S.THRESHOLD_STEPS
) -> DataFrame:
    """One row (threshold, value): the lowest grid threshold with the best metric.

    One pass counts scores per grid cell; the rest works on ``steps`` rows.
    """
    grid = threshold_grid(steps)
    if metric == "ks":
        # the separation does not depend on the threshold, so the first grid point wins
        return ranking_metrics(df, score, label).select(
            F.round(F.lit(grid[0]), 4).alias("threshold"), F.round("ks_statistic", 4).alias("value")
        )
    if metric not in ("f1", "precision", "recall"):
        raise ValueError(f"unknown metric: {metric}")
    inf = float("inf")
    scored = df.select(F.col(score).cast("double").alias("s"), F.col(label).alias("y"))
    counts = (
        O.assign_buckets(scored, ["s"], [[-inf, *grid, inf]], ["cell"])
        .groupBy(F.col("cell").cast("long").alias("cell"))
        .agg(F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1"))
    )
    cells = (
        df.sparkSession.range(steps + 1)
        .withColumnRenamed("id", "cell")
        .join(F.broadcast(counts), "cell", "left")
        .na.fill(0, ["n0", "n1"])
    )
    everything = Window.partitionBy(F.lit(0))
    above = everything.orderBy("cell").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    summed = cells.select(
        "cell",
        F.sum("n1").over(above).alias("tp"),
        F.sum("n0").over(above).alias("fp"),
        F.sum("n1").over(everything).alias("positives"),
    ).filter("cell > 0")
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("positives") - F.col("tp")
    value = {
        "f1": f1_of(tp, fp, fn),
        "precision": precision_of(tp, fp),
        "recall": recall_of(tp, fn),
    }[metric]
    thresholds = F.array(*[F.lit(t) for t in grid])
    ranked = summed.select(
        F.element_at(thresholds, F.col("cell").cast("int")).alias("t"), value.alias("v")
    )
    return ranked.agg(F.max_by(F.struct("t", "v"), F.struct("v", -F.col("t"))).alias("best")).select(
        F.round("best.t", 4).alias("threshold"), F.round("best.v", 4).alias("value")
    )


def score_records(df: DataFrame, probability: str, threshold: float) -> DataFrame:
    """Add the score record: score out of 100, band, rounded probability, decision."""
    p = F.col(probability)
    return df.withColumns(
        {
            "risk_score": F.round(p * 100, 2),
            "risk_label": X.score_band(p),
            "default_probability": F.round(p, 4),
            "threshold": F.lit(float(threshold)),
            "predicted_default": p >= threshold,
        }
    )


def evaluation_report(
    df: DataFrame, score: str, label: str, threshold: float
) -> dict[str, DataFrame]:
    """Every report table of a scored sample, each bounded in size."""
    return {
        "ranking": ranking_metrics(df, score, label),
        "threshold_metrics": threshold_metrics(df, score, label, threshold),
        "confusion_matrix": confusion_cells(df, score, label, threshold),
        "roc_curve": roc_curve(df, score, label),
        "pr_curve": pr_curve(df, score, label),
        "calibration_curve": calibration_curve(df, score, label),
        "score_distribution": score_histogram(df, score, label),
    }


def report_document(df: DataFrame, score: str, label: str, threshold: float, digits: int = 4) -> DataFrame:
    """One row ``payload``: the whole report as one JSON document, rounded, with its threshold.

    Every part is bounded by the points, bins and metrics asked for, never by the rows.
    """
    parts = evaluation_report(df, score, label, threshold)
    one = F.lit(1).alias("k")

    def rounded(c: str) -> Column:
        return F.round(F.col(c), digits).alias(c)

    def curve(part: DataFrame, order: str, names: list[str], whole: tuple[str, ...] = ()) -> DataFrame:
        rows = part.select(F.struct(order, *[F.col(c) if c in whole else rounded(c) for c in names]).alias("r"))
        listed = rows.agg(F.array_sort(F.collect_list("r")).alias("rows"))
        return listed.select(one, F.struct(*[F.col(f"rows.{c}").alias(c) for c in names]).alias("v"))

    ranking = parts["ranking"].select(one, *map(rounded, ("auc_roc", "auc_pr", "ks_statistic")))
    decided = parts["threshold_metrics"].select(one, *map(rounded, ("precision", "recall", "f1")))
    cells = confusion(df, score, label, threshold).select(one, F.struct("tn", "fp", "fn", "tp").alias("confusion_matrix"))
    out = ranking.join(decided, "k").join(cells, "k")
    for name, made in {
        "roc_curve": curve(parts["roc_curve"], "idx", ["fpr", "tpr"]),
        "pr_curve": curve(parts["pr_curve"], "idx", ["precision", "recall"]),
        "calibration_curve": curve(parts["calibration_curve"], "idx", ["mean_predicted", "fraction_pos"]),
        "score_distribution": curve(parts["score_distribution"], "bin", ["center", "non_default", "default"], ("non_default", "default")),
    }.items():
        # one row each
        out = out.join(F.broadcast(made.withColumnRenamed("v", name)), "k")
    document = F.struct(F.lit(round(float(threshold), digits)).alias("threshold"), *[c for c in out.columns if c != "k"])
    return out.select(F.to_json(document).alias("payload"))
