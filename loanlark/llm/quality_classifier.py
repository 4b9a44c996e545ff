"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a row of transformed statistics (logarithms of sizes, square roots of
shares). Both classes are Gaussian: their counts, sums and sums of products add up over all
labelled training rows, task by task. A class covariance is shrunk towards the pooled one
(``TOWARDS_POOLED``) and then towards a multiple of the identity (``TOWARDS_ROUND``); how far,
and by what ``TEMPERATURES`` the log-density difference is divided, is chosen by the log loss of
rows that their fold's model has not seen. The Cholesky factors of the chosen covariances are
computed once; a score is ``1 / (1 + exp(-difference))`` of the two Mahalanobis log-densities and
the log-odds of the classes.

Defined results: null and empty texts have zero statistics and get a score like all others;
labels that are null, other than 0 and 1, or of a null id are ignored; of several labels of
one id the mean counts, above a half as 1; repeated rows are each scored; with fewer than two
labelled classes every score is ``(ones + 1) / (rows + 2)``; other columns pass through,
whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlark.llm.common import free_name, in_portions, per_row, stored, texts_of
from loanlark.llm.quality import repeated_words

FOLDS = 5
TOWARDS_POOLED = (0.0, 0.05, 0.2, 0.5, 1.0)
TOWARDS_ROUND = (0.001, 0.01, 0.05, 0.2)
TEMPERATURES = (1.0, 2.0, 4.0, 8.0)

#: The statistics; shares are of characters, words or lines.
STATISTICS = [
    "words", "word_length", "word_length_spread", "letters", "capitals", "digits", "marks", "symbols",
    "shouted_words", "distinct_words", "commonest_word", "same_as_next", "windows_again",
    "lines", "lines_again", "words_a_line", "sentence_words",
]
SHARES = {
    "letters", "capitals", "digits", "marks", "symbols", "shouted_words", "distinct_words", "commonest_word",
    "same_as_next", "windows_again", "lines_again",
}

#: Classes of Latin-1 characters.
LETTERS = bytes(b for b in range(256) if chr(b).isalpha())
CAPITALS = bytes(b for b in LETTERS if chr(b).isupper())
DIGITS = b"0123456789"
MARKS = b".,;:!?"
SYMBOLS = b"#*$%&|<>=+~^_{}[]\\/@"


def _count(kind: bytes, text: bytes) -> int:
    return len(text) - len(text.translate(None, kind))


def statistics(texts: list[str]) -> np.ndarray:
    """One row of raw statistics a text, in the order of ``STATISTICS``."""
    out = np.zeros((len(texts), len(STATISTICS)))
    words = [t.split() for t in texts]
    for begin, end in in_portions([len(w) for w in words]):
        out[begin:end, STATISTICS.index("windows_again")] = repeated_words(words[begin:end])
    at = {name: i for i, name in enumerate(STATISTICS)}
    for row, text, own in zip(out, texts, words):
        if not own:
            continue
        n, chars = len(own), len(text)
        sizes = np.fromiter(map(len, own), np.int64, n)
        counts = Counter(own)
        lines = [x for x in text.split("\n") if x.strip()]
        row[at["words"]] = n
        row[at["word_length"]] = sizes.mean()
        row[at["word_length_spread"]] = sizes.std()
        latin = text.encode("latin-1", "ignore")
        # characters beyond Latin-1 count as letters
        row[at["letters"]] = (chars - len(latin) + _count(LETTERS, latin)) / chars
        row[at["capitals"]] = _count(CAPITALS, latin) / chars
        row[at["digits"]] = _count(DIGITS, latin) / chars
        row[at["marks"]] = _count(MARKS, latin) / chars
        row[at["symbols"]] = _count(SYMBOLS, latin) / chars
        row[at["shouted_words"]] = sum(map(str.isupper, own)) / n
        row[at["distinct_words"]] = len(counts) / n
        row[at["commonest_word"]] = max(counts.values()) / n
        row[at["same_as_next"]] = sum(map(str.__eq__, own, own[1:])) / n
        row[at["windows_again"]] /= n
        row[at["lines"]] = len(lines)
        row[at["lines_again"]] = 1 - len(set(lines)) / len(lines)
        row[at["words_a_line"]] = n / len(lines)
        row[at["sentence_words"]] = n / (1 + sum(map(text.count, ".!?")))
    return out


def transformed(raw: np.ndarray) -> np.ndarray:
    """Square roots of shares, logarithms of all else: nearer to Gaussian."""
    shares = np.array([s in SHARES for s in STATISTICS])
    return np.where(shares, np.sqrt(raw), np.log1p(raw))


def features(docs: DataFrame, out: str, text: str = "text") -> DataFrame:
    """Append the transformed statistics of each whole text as ``array<double>``."""

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        x = transformed(statistics(texts_of(batch)))
        ends = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
        return {"0x": pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel()))}

    made = per_row(docs, [F.col(f"`{text}`")], work, [T.StructField("0x", T.ArrayType(T.DoubleType()))])
    return made.withColumnRenamed("0x", out)


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass(frozen=True)
class Moments:
    """Count, sum and sum of products of the rows of one class."""

    n: float
    total: np.ndarray
    products: np.ndarray

    @classmethod
    def unpacked(cls, values: np.ndarray, size: int) -> Moments:
        return cls(values[0], values[1 : size + 1], values[size + 1 :].reshape(size, size))

    def without(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.total - other.total, self.products - other.products)

    @property
    def mean(self) -> np.ndarray:
        return self.total / self.n

    @property
    def scatter(self) -> np.ndarray:
        return self.products - np.outer(self.total, self.total) / self.n


@dataclass(frozen=True)
class Discriminant:
    """Means, Cholesky factors and constants of the two classes, of standardised statistics."""

    scale: np.ndarray
    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    log_odds: float

    @classmethod
    def fit(cls, classes: tuple[Moments, Moments], pooled_share: float, round_share: float) -> Discriminant:
        n = sum(m.n for m in classes)
        within = sum(m.scatter for m in classes) / n
        # a statistic that never varies says nothing; its scale only must not be zero
        scale = np.sqrt(np.maximum(np.diag(within), 1e-6))
        within = within / np.outer(scale, scale)
        factors = []
        for m in classes:
            own = m.scatter / m.n / np.outer(scale, scale)
            mixed = (1 - pooled_share) * own + pooled_share * within
            level = max(np.trace(mixed) / len(mixed), 1e-6)
            factors.append(np.linalg.cholesky((1 - round_share) * mixed + round_share * level * np.eye(len(mixed))))
        means = tuple(m.mean / scale for m in classes)
        return cls(scale, means, tuple(factors), float(np.log(classes[1].n / classes[0].n)))

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0, with the log-odds of the classes."""
        z, sides = x / self.scale, []
        for mean, factor in zip(self.means, self.factors):
            distance = (np.linalg.solve(factor, (z - mean).T) ** 2).sum(axis=0)
            sides.append(-0.5 * distance - np.log(np.diag(factor)).sum())
        return sides[1] - sides[0] + self.log_odds


@dataclass(frozen=True)
class Classifier:
    model: Discriminant | None
    temperature: float
    constant: float
    chosen: tuple[float, float] = (0.0, 0.0)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.model is None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.model.difference(x) / self.temperature, -700, 700)))


def labelled(labels: DataFrame, key: str, label: str) -> DataFrame:
    """One (id, y) for each labelled id."""
    y = F.col(f"`{label}`").cast("double")
    return (
        labels.where(y.isin(0.0, 1.0) & F.col(f"`{key}`").isNotNull())
        .groupBy(F.col(f"`{key}`").alias("id")).agg((F.avg(y) > 0.5).cast("int").alias("y"))
    )


def _moments(rows: DataFrame, size: int) -> dict[tuple[int, int], Moments]:
    """Moments by (fold, class) of rows (x, y, fold): one sum for each entry, whatever the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((FOLDS, 2, 1 + size + size * size))
        for batch in batches:
            x = _matrix(batch.column("x"))
            y, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold"))
            for f, k in product(range(FOLDS), (0, 1)):
                own = x[(y == k) & (fold == f)]
                sums[f, k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        at = np.indices(sums.shape).reshape(3, -1)
        columns = [pa.array(c.astype(np.int32)) for c in at] + [pa.array(sums.ravel())]
        yield pa.RecordBatch.from_arrays(columns, names=["fold", "y", "i", "value"])

    made = rows.select("x", "y", "fold").mapInArrow(run, "fold int, y int, i int, value double")
    sums = np.zeros((FOLDS, 2, 1 + size + size * size))
    for r in made.groupBy("fold", "y", "i").agg(F.sum("value").alias("value")).collect():
        sums[r.fold, r.y, r.i] = r.value
    return {(f, k): Moments.unpacked(sums[f, k], size) for f, k in product(range(FOLDS), (0, 1))}


def _losses(rows: DataFrame, models: dict[tuple[int, int], Discriminant], n_models: int) -> np.ndarray:
    """Log loss by (shrinkage, temperature) of rows under the model of the other folds."""
    ship = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((n_models, len(TEMPERATURES)))
        for batch in batches:
            x = _matrix(batch.column("x"))
            y, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold"))
            for (f, i), model in ship.value.items():
                own = fold == f
                if own.any():
                    signed = np.where(y[own] == 1, 1, -1) * model.difference(x[own])
                    sums[i] += [np.logaddexp(0, -signed / t).sum() for t in TEMPERATURES]
        at = np.indices(sums.shape).reshape(2, -1)
        columns = [pa.array(c.astype(np.int32)) for c in at] + [pa.array(sums.ravel())]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "t", "loss"])

    made = rows.select("x", "y", "fold").mapInArrow(run, "i int, t int, loss double")
    losses = np.zeros((n_models, len(TEMPERATURES)))
    for r in made.groupBy("i", "t").agg(F.sum("loss").alias("loss")).collect():
        losses[r.i, r.t] = r.loss
    return losses


def train(rows: DataFrame) -> Classifier:
    """Fit on all rows of (x ``array<double>``, y 0 or 1, fold below ``FOLDS``)."""
    size = len(STATISTICS)
    parts = _moments(rows, size)
    sides = [[parts[f, k] for f in range(FOLDS)] for k in (0, 1)]
    both = tuple(Moments(*[sum(getattr(m, a) for m in side) for a in ("n", "total", "products")]) for side in sides)
    constant = float((both[1].n + 1) / (both[0].n + both[1].n + 2))
    if min(m.n for m in both) < 2:
        return Classifier(None, 1.0, constant)
    grid = list(product(TOWARDS_POOLED, TOWARDS_ROUND))
    models = {}
    for f in range(FOLDS):
        rest = tuple(both[k].without(parts[f, k]) for k in (0, 1))
        if min(m.n for m in rest) >= 2:
            models |= {(f, i): Discriminant.fit(rest, *shares) for i, shares in enumerate(grid)}
    losses = _losses(rows, models, len(grid))
    i, t = np.unravel_index(int(np.argmin(losses)), losses.shape)
    return Classifier(Discriminant.fit(both, *grid[i]), TEMPERATURES[t], constant, grid[i])


def score(made: DataFrame, x: str, classifier: Classifier, out: str) -> DataFrame:
    """Append the score of each row of statistics."""
    ship = made.sparkSession.sparkContext.broadcast(classifier)

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"0s": pa.array(ship.value.score(_matrix(batch.column("0"))))}

    scored = per_row(made, [F.col(f"`{x}`")], work, [T.StructField("0s", T.DoubleType())])
    return scored.withColumnRenamed("0s", out)


def fold_of(key: Column) -> Column:
    """A fold that depends on the id alone, apart from the bits that hold out rows."""
    return F.pmod(F.floor(F.crc32(key.cast("string")) / 64), F.lit(FOLDS)).cast("int")


def classify(
    docs: DataFrame, labels: DataFrame, training: Column, out: str = "score",
    key: str = "doc_id", text: str = "text", label: str = "quality",
) -> DataFrame:
    """Append the probability that a document has label 1.

    ``training`` says of which rows of ``docs`` the labels may be learnt from. Of the given table
    all columns but the text are stored beside the statistics.
    """
    x, may = free_name(docs, "x"), free_name(docs, "may_train")
    made = features(docs.withColumn(may, F.coalesce(training, F.lit(False))), x, text).drop(text)
    made = stored(made, "statistics")
    ids = F.col(f"`{key}`")
    rows = made.where(F.col(may)).select(ids.alias("id"), F.col(x).alias("x"), fold_of(ids).alias("fold"))
    rows = stored(rows.join(labelled(labels, key, label), "id").select("x", "y", "fold"), "labelled")
    return score(made, x, train(rows), out).drop(x, may)
