"""Label encoding and median imputation as fit / apply with table state.

State: ``(feature, value, code)`` per text column and ``(feature, value)`` medians. Both are
small for real category columns, but neither is assumed to be.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loanlark.functions import ordering as O
from loanlark.functions import ranges as R
from loanlark.functions.skew import salted_lookup
from loanlark.operators import shaping
from loanlark.session import through_storage

NULL_CLASS = "nan"
#: All dictionaries of a plan that are broadcast, as counted: bytes of values and of what a
#: row takes beside.
BROADCAST_BYTES = 64 << 20
BYTES_PER_CODE = 64
#: Strings at most at which the distinct values of a column are cut into ranges.
BORDERS = 1024


@dataclass
class EncodingState:
    """Fitted dictionaries and medians."""

    codes: DataFrame
    medians: DataFrame

    def save(self, path: str) -> None:
        self.codes.write.mode("overwrite").parquet(f"{path}/codes")
        self.medians.write.mode("overwrite").parquet(f"{path}/medians")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> EncodingState:
        return cls(spark.read.parquet(f"{path}/codes"), spark.read.parquet(f"{path}/medians"))


def code_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, bucket, value, n, code): code = rank among the sorted distinct values.

    Distinct values are cut into ranges at a sample of them by hash, whose size comes from their
    count, so that even a column of unbounded cardinality is ranked by many tasks.
    """
    values = (
        shaping.long_text(df, cols)
        .groupBy("feature", F.coalesce("value", F.lit(NULL_CLASS)).alias("value"))
        .agg(F.count("*").alias("n"))
    )
    borders = R.text_borders(values, BORDERS)
    # BORDERS strings per column
    marked = values.join(F.broadcast(borders), "feature").select(
        "feature",
        "value",
        "n",
        R.text_bucket(F.col("value"), F.col("borders")).alias("bucket"),
        F.lit(1).cast("long").alias("one"),
    )
    return O.running_sums(marked, "value", ["one"]).select(
        "feature", "bucket", "value", "n", (F.col("run_one") - 1).alias("code")
    )


def label_codes(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value, code) of every distinct value of the text columns."""
    return code_table(df, cols).select("feature", "value", "code")


def fit_encoding(df: DataFrame, text: list[str] | None = None) -> EncodingState:
    """Codes of the text columns, then medians of every numeric column, codes included.

    The median of a code column comes from the value counts; the rows are not encoded. The
    state is stored, so that applying it does not fit again.
    """
    text = shaping.text_columns(df) if text is None else text
    medians = through_storage(median_fit(df, shaping.numeric_columns(df)), "medians")
    if not text:
        empty = df.sparkSession.createDataFrame([], "feature string, value string, code long")
        return EncodingState(empty, medians)
    table = through_storage(code_table(df, text), "codes")
    ranks = O.values_at_ranks(
        table.select("feature", "bucket", F.col("code").cast("double").alias("value"), "n"),
        O.quantile_ranks([0.5]),
    )
    of_codes = O.interpolated(ranks, [0.5]).select("feature", "value")
    return EncodingState(
        table.select("feature", "value", "code"), medians.unionByName(through_storage(of_codes, "code-medians"))
    )


def median_fit(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, value): exact interpolated medians."""
    return O.exact_quantiles(df, cols, [0.5]).select("feature", "value")


def _broadcast_features(codes: DataFrame, limit: int) -> tuple[set[str], set[str]]:
    """Fitted columns whose dictionaries fit under one byte limit together, and all others.

    The smallest go first; a row per column reaches the driver.
    """
    size = F.sum(F.coalesce(F.octet_length("value"), F.lit(0)) + BYTES_PER_CODE)
    sizes = {r["feature"]: r["bytes"] for r in codes.groupBy("feature").agg(size.alias("bytes")).collect()}
    small, total = set(), 0
    for c in sorted(sizes, key=lambda c: (sizes[c], c)):
        if total + sizes[c] <= limit:
            small.add(c)
            total += sizes[c]
    return small, set(sizes) - small


def _coded_by_shuffle(df: DataFrame, codes: DataFrame, cols: list[str]) -> DataFrame:
    """Replace columns of large dictionaries: their cells travel as (row, feature, value), the
    full rows once, however many columns there are."""
    rid = "_row"
    base = through_storage(df.withColumn(rid, F.monotonically_increasing_id()), "rows")
    cells = shaping.long_text(base, cols, [rid]).withColumn("value", F.coalesce("value", F.lit(NULL_CLASS)))
    found = salted_lookup(cells, codes.filter(F.col("feature").isin(cols)), ["feature", "value"], [rid])
    by_row = found.groupBy(rid).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("code"))).alias(f"_code_{i}") for i, c in enumerate(cols)]
    )
    joined = base.join(by_row, rid, "left")
    return joined.withColumns({c: F.coalesce(f"_code_{i}", F.lit(0)).cast("double") for i, c in enumerate(cols)}).drop(
        rid, *[f"_code_{i}" for i in range(len(cols))]
    )


def encode(df: DataFrame, codes: DataFrame, text: list[str], broadcast_bytes: int | None = None) -> DataFrame:
    """Replace text columns by codes; an unseen value, or a column never fitted, gives 0.

    Dictionaries are broadcast while all together fit under ``broadcast_bytes``
    (``BROADCAST_BYTES`` by default). The cells of
    larger ones are joined by shuffle, values that many rows hold spread over several tasks.
    """
    if not text:
        return df
    small, large = _broadcast_features(codes, BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes)
    order, out = df.columns, df
    for c in text:
        if c not in small and c not in large:
            out = out.withColumn(c, F.lit(0.0))
        elif c in small:
            entry = codes.filter(F.col("feature") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
            out = out.withColumn("_value", F.coalesce(F.col(c), F.lit(NULL_CLASS))).join(F.broadcast(entry), "_value", "left")
            out = out.withColumn(c, F.coalesce("_code", F.lit(0)).cast("double")).drop("_value", "_code")
    wide = [c for c in text if c in large]
    if wide:
        out = _coded_by_shuffle(out, codes, wide)
    return out.select(*order)


def impute(df: DataFrame, medians: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Fill nulls of numeric columns with the fitted medians, as doubles."""
    found = {r["feature"]: r["value"] for r in medians.collect()}
    return df.withColumns(
        {
            c: F.coalesce(F.col(c).cast("double"), F.lit(found.get(c)).cast("double"))
            for c in shaping.numeric_columns(df, exclude)
        }
    )


def apply_encoding(
    df: DataFrame, state: EncodingState, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Encode and impute every column but ``keep`` with fitted state."""
    text = shaping.text_columns(df, keep)
    return impute(encode(df, state.codes, text), state.medians, keep)
