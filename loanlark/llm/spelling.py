"""Spelling variants: words one edit apart, found over a reduced alphabet.

Letters are hashed to ``SYMBOLS`` symbols. Words one edit apart have reduced words that are
equal or one edit apart, so the one-edit neighbourhood of every reduced word, joined with the
reduced vocabulary, holds every near pair; the words themselves are then compared. Of two
reduced neighbours one asks for the other: the longer one by deleting a symbol, of equally
long ones that with the smaller symbol by replacing it; so insertions need not be listed and
a pair is made once. Reduced words travel as 64-bit keys. Should two share a key, a pair of
words may be compared without need; it would be counted twice only if one word's neighbours
collide among themselves.

A word's form is its near word of largest count, where that is at least ``FACTOR`` times its
own; counts grow along forms, so they end in a root, found by doubling the path.

Defined results: null and empty texts have no words; repeated rows count each; a null id is
written as the empty string where a run's place to lose a letter is drawn; words of any
length are judged; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlark.llm.common import slices, stored, texts_of

SYMBOLS = 8
LEAST_LENGTH = 5
LEAST_COUNT = 3
FACTOR = 2
#: One run in so many loses a letter.
LOSE = 97
#: Words and bytes of them that a worker counts before it passes them on.
COUNTED, COUNTED_BYTES = 400_000, 32 << 20
#: Neighbours that a worker lists at once.
LISTED = 1 << 20
#: Longer words do not travel with each of their neighbours but are joined to them again.
LONG = 48

#: Of each Latin-1 byte the lower-cased letter, or a blank.
_KEPT = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256)
)


def runs(text: str) -> Counter[bytes]:
    """Counts of the lower-cased letter runs of a text, as Latin-1 bytes."""
    return Counter(text.encode("latin-1", "replace").translate(_KEPT).split())


def spelled(run: bytes, seed: int) -> bytes:
    """The run, without one letter where the draw says so."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % LOSE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """(word, n) of all words of at least ``least`` letters."""

    def rows(counts: Counter[bytes]) -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in counts]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, size = Counter(), 0
        for batch in slices(batches):
            for i, own in zip(batch.column("id").to_pylist(), texts_of(batch, "text")):
                seed = zlib.crc32(f"{i or ''}:".encode())
                before = len(counts)
                for word, n in runs(own).items():
                    if len(word) >= least:
                        word = spelled(word, seed)
                        if len(word) >= least:
                            counts[word] += n
                            size += len(word) if len(word) > LONG else 0
                size += LONG * (len(counts) - before)
                if size > COUNTED_BYTES or len(counts) > COUNTED:
                    yield rows(counts)
                    counts, size = Counter(), 0
        yield rows(counts)

    given = docs.select(F.col(f"`{key}`").cast("string").alias("id"), F.col(f"`{text}`").alias("text"))
    return given.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_MULTIPLIER, -1, 1 << 64))


def _mixed(key: np.ndarray) -> np.ndarray:
    key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return key ^ (key >> np.uint64(29))


def reduced(words: list[str], symbols: int) -> np.ndarray:
    """Symbols 1, 2, .. of words of one length, a row each."""
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)
    return ((letters * np.uint64(_MULTIPLIER)) >> np.uint64(40)) % np.uint64(symbols) + np.uint64(1)


def _powers(n: int) -> np.ndarray:
    factors = np.full(n, _MULTIPLIER, np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


def own_keys(words: list[str], symbols: int) -> np.ndarray:
    r = reduced(words, symbols)
    return _mixed((r * _powers(r.shape[1])).sum(axis=1, dtype=np.uint64))


def asked_keys(words: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """Of words of one length: the word's index and the key of each reduced neighbour that it
    asks for; first come the words' own keys. Neighbours of a word are all different."""
    r = reduced(words, symbols)
    n, length = r.shape
    power = _powers(length)
    terms = r * power
    upto = np.cumsum(terms, axis=1, dtype=np.uint64)
    whole = upto[:, -1]
    keys, owner = [whole], [np.arange(n)]
    if length > 1:
        # without symbol i: what follows moves down; within a run of one symbol all are the same
        first = np.ones(r.shape, bool)
        first[:, 1:] = r[:, 1:] != r[:, :-1]
        row, at = np.nonzero(first)
        keys.append(upto[row, at] - terms[row, at] + (whole[row] - upto[row, at]) * _INVERSE)
        owner.append(row)
    for step in range(1, symbols):
        row, at = np.nonzero(r + np.uint64(step) <= symbols)
        keys.append(whole[row] + np.uint64(step) * power[at])
        owner.append(row)
    return np.concatenate(owner), _mixed(np.concatenate(keys))


def _by_length(words: list[str], limit: int) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Groups of words of one length, with their places, of about ``limit`` letters."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        rows = max(1, limit // int(size))
        for begin in range(0, len(places), rows):
            part = places[begin : begin + rows]
            yield part, [words[i] for i in part.tolist()]


def _keyed(words: DataFrame, symbols: int) -> DataFrame:
    """(key, word, n): the reduced vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("word").to_pylist()
            keys = np.zeros(len(own), np.uint64)
            for part, same in _by_length(own, LISTED):
                keys[part] = own_keys(same, symbols)
            columns = [pa.array(keys.view(np.int64)), batch.column("word"), batch.column("n")]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "word", "n"])

    return words.mapInArrow(run, "key long, word string, n long")


def _asked(words: DataFrame, symbols: int, long: bool) -> DataFrame:
    """(key, own, word, n) of all asked neighbours, ``own`` where it is the reduced word itself;
    the place of a long word is taken by its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("word").to_pylist()
            for part, same in _by_length(own, max(1, LISTED // symbols)):
                owner, keys = asked_keys(same, symbols)
                given = [batch.column(c).take(pa.array(part[owner])) for c in carried]
                columns = [pa.array(keys.view(np.int64)), pa.array(np.arange(len(keys)) < len(same)), *given]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "own", *carried])

    carried = ["hash"] if long else ["word", "n"]
    if long:
        return words.withColumn("hash", F.xxhash64("word")).mapInArrow(run, "key long, own boolean, hash long")
    return words.mapInArrow(run, "key long, own boolean, word string, n long")


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(x, x_n, y, y_n): every two words that differ by exactly one edit, once."""
    y = _keyed(words, symbols).select("key", F.col("word").alias("y"), F.col("n").alias("y_n"))
    # words of equal reduced words ask for each other
    near = (F.levenshtein("x", "y", 1) == 1) & (~F.col("own") | (F.col("x") < F.col("y")))
    is_long = F.length("word") > LONG
    x = _asked(words.where(~is_long), symbols, long=False).select("key", "own", F.col("word").alias("x"), F.col("n").alias("x_n"))
    short = x.join(y, "key").where(near)
    again = words.where(is_long).select(F.xxhash64("word").alias("hash"), F.col("word").alias("x"), F.col("n").alias("x_n"))
    # what a long word asks for is one letter shorter at most
    long = _asked(words.where(is_long), symbols, long=True).join(y.where(F.length("y") >= LONG), "key").join(again, "hash").where(near)
    return short.select("x", "x_n", "y", "y_n").union(long.select("x", "x_n", "y", "y_n"))


def variants(
    docs: DataFrame, key: str = "doc_id", text: str = "text", symbols: int = SYMBOLS, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the vocabulary."""
    words = stored(count_words(docs, key, text, least_length).where(F.col("n") >= least_count), "words")
    pairs = stored(near_pairs(words, symbols), "near-words")
    return rooted(words, pairs)


def rooted(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """Forms and roots of words (word, n) by their near pairs (x, x_n, y, y_n)."""
    both = pairs.select(F.col("x").alias("word"), F.struct((-F.col("y_n")).alias("n"), F.col("y").alias("near")).alias("of")).union(
        pairs.select(F.col("y"), F.struct((-F.col("x_n")).alias("n"), F.col("x").alias("near")))
    )
    # the least struct: largest count, then smallest word
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("of").alias("of"))
    has = -F.col("of.n") >= FACTOR * F.col("n")
    formed = stored(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has, F.col("of.near")).alias("form"), F.when(has, -F.col("of.n")).cast("long").alias("form_n"),
        ),
        "forms",
    )
    paths = formed.where("form is not null").select("word", F.col("form").alias("upto"))
    while True:
        steps = paths.select(F.col("word").alias("upto"), F.col("upto").alias("next"))
        paths = stored(paths.join(steps, "upto", "left").select("word", F.coalesce("next", "upto").alias("upto"), F.col("next").isNotNull().alias("moved")), "paths")
        if not paths.where("moved").take(1):
            break
    roots = paths.select("word", F.col("upto").alias("root"))
    return formed.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
