"""Quality rules whose limits follow the data: quantile sketches by language and source.

Every text is measured once. Each measure is sketched by (language, source) in buckets whose
borders grow by ``1 + 2 * ERROR``: a quantile read from the sketch is off by at most that
relative error, and sketches merge exactly by adding counts, in any order. A group's upper
limit is ``third quartile + SPREAD * (interquartile range + FLOOR)``, and likewise below for
word length; groups of fewer than ``LEAST`` documents take the limits of their language, and
those of all documents if that is small too. Documents are then joined with the limits of
their group.

Defined results: null and empty texts have zero measures and fail the base rule; null
languages and sources are groups of their own; repeated rows are judged each; other columns
pass through, whatever their names.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from loanlark.llm.common import free_name, in_portions, per_row, stored, texts_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
ERROR = 0.01
SPREAD = 3.0
LEAST = 100
#: A group's limits are broadcast while there are at most so many groups (about 100 bytes each).
BROADCAST_GROUPS = 50_000

#: Upper and lower sides that are judged, and the least width of the middle half.
FLOOR = {"symbol_ratio": 0.02, "dup_line_ratio": 0.1, "repeat_ratio": 0.1, "word_length": 0.5}
LOWER = {"word_length"}

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def repeated_words(words: list[list[bytes]], window: int = WINDOW) -> np.ndarray:
    """Of each text, the words in windows that occur in it twice or more.

    Words become codes, codes of one place and a later one become codes of longer strings,
    so equal codes are equal windows and nothing is hashed away.
    """
    sizes = np.array([len(w) for w in words])
    owner = np.repeat(np.arange(len(words)), sizes)
    found = np.zeros(len(words), np.int64)
    n = len(owner)
    if n < window:
        return found
    code = pd.factorize(np.array([*chain.from_iterable(words), None], object)[:-1])[0].astype(np.int64)
    span = 1
    while span < window:
        step = min(span, window - span)
        code = code[: len(code) - step] * (n + 1) + code[step:]
        code = pd.factorize(code)[0].astype(np.int64)
        span += step
    at = np.flatnonzero(owner[: n - window + 1] == owner[window - 1 :])
    key = pd.factorize(owner[at] * (n + 1) + code[at])[0]
    again = at[np.bincount(key)[key] > 1] if len(key) else at
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    return found + np.bincount(owner[np.cumsum(edge[:-1]) > 0], minlength=len(words))


def _measures(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    texts = texts_of(batch)
    out = np.zeros((len(COUNTS), len(texts)), np.int64)
    words = []
    for i, t in enumerate(texts):
        lines = [x for x in t.split("\n") if x.strip(SPACES)]
        own = t.encode().split()
        words.append(own)
        out[0, i] = len(own)
        out[1, i] = len(t) - sum(map(t.count, SPACES))
        out[2, i] = sum(map(t.count, SYMBOLS))
        out[3, i] = len(lines) - len(set(lines))
        out[5, i] = len(lines)
    for begin, end in in_portions([len(w) for w in words]):
        out[4, begin:end] = repeated_words(words[begin:end])
    return {
        "0m": pa.StructArray.from_arrays([pa.array(c) for c in out], names=COUNTS),
    }


def measure(docs: DataFrame, out: str, text: str = "text") -> DataFrame:
    """Append a struct of the counts of each whole text."""
    kind = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
    made = per_row(docs, [F.col(f"`{text}`")], _measures, [T.StructField("0m", kind)])
    return made.withColumnRenamed("0m", out)


def base_failed(m: str) -> Column:
    return (F.col(f"{m}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{m}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{m}.n_words")
    )


def ratios(m: str) -> dict[str, Column]:
    """The judged measures; a text without words or lines has zeros."""
    words, lines = F.greatest(F.col(f"{m}.n_words"), F.lit(1)), F.greatest(F.col(f"{m}.n_lines"), F.lit(1))
    return {
        "symbol_ratio": F.col(f"{m}.n_symbols") / words,
        "dup_line_ratio": F.col(f"{m}.n_dup_lines") / lines,
        "repeat_ratio": F.col(f"{m}.n_repeat_words") / words,
        "word_length": F.col(f"{m}.word_chars") / words,
    }


def sketch(measured: DataFrame, m: str, lang: str, source: str) -> DataFrame:
    """Bucket counts by language, source and measure: (lang, source, measure, bucket, n)."""
    step = float(np.log1p(2 * ERROR))
    values = F.array(*[
        F.struct(F.lit(name).alias("measure"), F.when(v > 0, F.ceil(F.log(v) / step)).cast("int").alias("bucket"))
        for name, v in ratios(m).items()
    ])
    return (
        measured.where(~base_failed(m))
        .select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{source}`").cast("string").alias("source"), F.explode(values).alias("v"))
        .groupBy("lang", "source", "v.measure", "v.bucket").agg(F.count("*").alias("n"))
    )


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Merge the sketches of a key and read the quartiles: (keys.., measure, total, q1, q3)."""
    step = float(np.log1p(2 * ERROR))
    merged = sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    by = Window.partitionBy(*keys, "measure")
    upto = by.orderBy(F.col("bucket").asc_nulls_first())
    ranked = merged.withColumns({"upto": F.sum("n").over(upto), "total": F.sum("n").over(by)})
    # the middle of a bucket in relative terms; the null bucket holds the zeros
    value = F.coalesce(F.exp((F.col("bucket") - 0.5) * step), F.lit(0.0))
    return ranked.groupBy(*keys, "measure").agg(
        F.max("total").alias("total"),
        *[F.min(F.when(F.col("upto") >= q * F.col("total"), value)).alias(name) for name, q in (("q1", 0.25), ("q3", 0.75))],
    )


def limits(sketches: DataFrame) -> DataFrame:
    """One row for each (lang, source): ``n`` and a low and a high limit of each measure."""
    small = lambda t: F.col(t) < LEAST
    own = quartiles(sketches, ["lang", "source"])
    tongue = quartiles(sketches, ["lang"]).select(F.col("lang").alias("l_lang"), F.col("measure").alias("l_measure"), *[F.col(c).alias(f"l_{c}") for c in ("total", "q1", "q3")])
    every = quartiles(sketches, []).select(F.col("measure").alias("a_measure"), *[F.col(c).alias(f"a_{c}") for c in ("total", "q1", "q3")])
    joined = own.join(tongue, F.col("lang").eqNullSafe(F.col("l_lang")) & (F.col("measure") == F.col("l_measure"))).join(
        F.broadcast(every), F.col("measure") == F.col("a_measure")  # four rows
    )
    pick = {q: F.when(~small("total"), F.col(q)).when(~small("l_total"), F.col(f"l_{q}")).otherwise(F.col(f"a_{q}")) for q in ("q1", "q3")}
    floor = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in FLOOR.items()))
    width = SPREAD * (F.col("q3_") - F.col("q1_") + floor[F.col("measure")])
    bounds = joined.withColumns({f"{q}_": c for q, c in pick.items()}).withColumns({"low": F.col("q1_") - width, "high": F.col("q3_") + width})
    return bounds.groupBy("lang", "source").agg(
        F.max("total").alias("n"),
        *[F.max(F.when(F.col("measure") == k, F.col("high"))).alias(f"{k}_high") for k in FLOOR],
        *[F.max(F.when(F.col("measure") == k, F.col("low"))).alias(f"{k}_low") for k in FLOOR if k in LOWER],
    )


def judge(
    docs: DataFrame, out: str, carry: list[str] | None = None, text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """Append a struct: the counts, ``base_failed`` and ``kept``.

    ``carry`` names the columns to return (all by default); the others are not stored.
    """
    m = free_name(docs, "measures")
    carry = docs.columns if carry is None else carry
    needed = [c for c in docs.columns if c in {*carry, lang, source}]
    measured = stored(measure(docs, m, text).select(*[F.col(f"`{c}`") for c in needed], m), "measured")
    bounds = stored(limits(sketch(measured, m, lang, source)), "quality-limits")
    b = bounds.select([F.col(c).alias(f"{m}_{c}") for c in bounds.columns])
    if bounds.count() <= BROADCAST_GROUPS:
        b = F.broadcast(b)
    same = F.col(f"`{lang}`").cast("string").eqNullSafe(F.col(f"{m}_lang")) & F.col(f"`{source}`").cast("string").eqNullSafe(F.col(f"{m}_source"))
    joined = measured.join(b, same, "left")
    checks = [v <= F.col(f"{m}_{k}_high") for k, v in ratios(m).items()] + [ratios(m)[k] >= F.col(f"{m}_{k}_low") for k in LOWER]
    within = checks[0]
    for c in checks[1:]:
        within = within & c
    # a group without limits holds no document that passed the base rule
    verdict = ~base_failed(m) & F.coalesce(within, F.lit(True))
    made = F.struct(f"{m}.*", base_failed(m).alias("base_failed"), verdict.alias("kept"))
    return joined.select(*[measured[f"`{c}`"] for c in carry], made.alias(out))


def keep_good(docs: DataFrame, **columns: str) -> DataFrame:
    """The documents that pass, with the given columns."""
    out = free_name(docs, "judged")
    return judge(docs, out, **columns).where(f"`{out}`.kept").drop(out)
