"""A hashed maximum-entropy language model with a class-factored softmax.

``P(word | before) = P(class | before) * P(word | class)``. The ``SINGLE`` most frequent words are
classes of their own, all others fall into ``ENDINGS`` classes by their last two bytes. The first
factor is a softmax over the classes whose features are the last word, the word before it
(a skip feature) and both together, hashed into ``2 ** HASH_BITS`` rows of weights, and a bias.
It is trained in ``ROUNDS`` gradient steps, each over another part of the training texts, so
every text counts once: tasks sum the gradient of their texts, sums are added by blocks of
rows, and the step of a row is scaled by how often its feature occurs. Rows of weights have a
fixed size and are broadcast.

The second factor is the word's share of its class among all training tokens; each class
keeps the mass of its once-seen words for unknown words, which are one outcome each class. So
the probabilities of all outcomes sum to one.

Counts of the ``HEAD`` most frequent words are broadcast; the counts of all others are found
by a join, so every word of every text has its exact count.

Defined results: null and empty texts are the end token alone; a null in the training mark
counts as training; repeated rows are each learnt from and scored; with no training texts
every word is unknown; other columns pass through, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlark.llm.common import in_portions, slices, stored

HASH_BITS = 14
#: Together at most 64: a token's class takes six bits beside its hash.
SINGLE, ENDINGS = 31, 33
CLASSES = SINGLE + ENDINGS
HEAD = 1 << 18
ROUNDS = 4
RATE = 0.5
PRIOR = 20.0
#: Rows of weights that travel together, and sums of a block before the last.
BLOCK, LANES = 256, 64
TOKENS_AT_ONCE = 8_192
GRADIENT_TOKENS = 65_536
MEMO_WORDS = 300_000

#: The end of a text; no word is empty.
END = b""

REST = pa.list_(pa.struct([("word", pa.binary()), ("class", pa.int32()), ("n", pa.int64())]))


def words_of(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), END]


@dataclass
class Tokens:
    """The tokens of some texts in a row: how many each text has, the different ones, and of
    every token its place among these."""

    sizes: np.ndarray
    distinct: list[bytes]
    place: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> Tokens:
        """``words_of`` of a column of texts."""
        # built anew: small letters of a slice that was cast were seen to be those of other rows;
        # a line end after each text leaves an empty token at its end, which is the end token
        line_end, nothing = (pa.scalar(x, pa.large_string()) for x in ("\n", ""))
        ended = pc.binary_join_element_wise(pc.ascii_lower(pa.array([t or "" for t in texts.to_pylist()], pa.large_string())), line_end, nothing)
        split = pc.ascii_split_whitespace(ended)
        every, stops = split.values, split.offsets.to_numpy()[1:]
        real = pc.not_equal(every, nothing).to_numpy(zero_copy_only=False)
        real[stops - 1] = True
        ends = np.cumsum(real)[stops - 1]
        coded = every.filter(pa.array(real)).cast(pa.large_binary()).dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        return cls(np.diff(ends, prepend=0), distinct, coded.indices.to_numpy())

    @classmethod
    def given(cls, words: list[list[bytes]]) -> Tokens:
        places: dict[bytes, int] = {}
        place = [places.setdefault(w, len(places)) for w in chain.from_iterable(words)]
        return cls(np.array([len(w) for w in words]), list(places), np.array(place, np.int64))


def counted(texts: DataFrame) -> DataFrame:
    """Counts of all tokens of a column ``t``: summed by task, then by word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        rows = lambda: pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])
        for batch in slices(batches):
            tokens = Tokens.of(batch.column(0))
            for word, n in zip(tokens.distinct, np.bincount(tokens.place).tolist()):
                found[word] += n
            if len(found) > MEMO_WORDS:
                yield rows()
                found.clear()
        yield rows()

    return texts.select("t").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Words:
    """What is known of words: exact counts (a table), and the broadcast head."""

    counts: DataFrame
    head: dict[bytes, int]
    single: dict[bytes, int]
    total: int
    distinct: int
    tokens: np.ndarray  # by class
    unseen: np.ndarray  # mass for unknown words, by class


def class_column(word: str) -> Column:
    """The class of a word; ``own`` is that of a frequent one, else null."""
    return F.coalesce(F.col("own"), F.lit(SINGLE) + F.crc32(F.expr(f"substring({word}, -2, 2)")) % ENDINGS)


def learn_words(texts: DataFrame) -> Words:
    counts = stored(counted(texts), "word-counts")
    # whole ranges of counts, as many as hold HEAD words at most: one row for each range
    step = F.floor(F.log2("n") * 16).cast("int")
    ranges = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).orderBy(F.desc("step")).collect()
    least, words = 1 << 30, 0
    for r in ranges:
        words += r["words"]
        if words > HEAD:
            break
        least = r["step"]
    top = counts.where(step >= least).toPandas().sort_values(["n", "word"], ascending=[False, True])
    head = dict(zip(map(bytes, top["word"]), top["n"].tolist()))
    single = {w: i for i, w in enumerate(list(head)[:SINGLE])}
    spark = texts.sparkSession
    own = spark.createDataFrame([(bytearray(w), i) for w, i in single.items()], "word binary, own int")
    by_class = (
        counts.join(F.broadcast(own), "word", "left")
        .groupBy(class_column("word").cast("int").alias("class"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("once"))
        .collect()  # one row for each class
    )
    tokens, unseen = np.zeros(CLASSES), np.ones(CLASSES)
    distinct = 0
    for r in by_class:
        tokens[r["class"]] = r["n"]
        distinct += r["v"]
        unseen[r["class"]] = 0.0 if r["class"] < SINGLE else (r["once"] + 1) / (r["n"] + 2)
    # a class of its own that no word took is never met
    unseen[len(single) : SINGLE] = 1.0
    return Words(counts, head, single, int(tokens.sum()), distinct, tokens, unseen)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


class Coder:
    """Class and hash of each token, with a memo of bounded size."""

    def __init__(self, single: dict[bytes, int]):
        self.single, self.memo = single, {}

    def _code(self, word: bytes) -> int:
        own = self.single.get(word)
        if own is None:
            own = SINGLE + zlib.crc32(word[-2:]) % ENDINGS
        return (xxhash.xxh64_intdigest(word) >> 8) << 6 | own

    def events(self, words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Classes of all tokens in a row, and their feature rows (tokens, 3)."""
        return next(self.portions(Tokens.given(words), 1 << 62))[2:]

    def codes(self, words: list[bytes]) -> np.ndarray:
        memo = self.memo
        new = [w for w in words if w not in memo]
        if len(memo) + len(new) > MEMO_WORDS:
            memo.clear()
            new = words
        memo.update((w, self._code(w)) for w in new)
        return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))

    def portions(self, tokens: Tokens, limit: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Ranges of texts of about ``limit`` tokens, with their events."""
        codes = self.codes(tokens.distinct)
        classes, hashes = (codes & np.uint64(63)).astype(np.int64), _mix(codes >> np.uint64(6))
        ends = np.append(0, np.cumsum(tokens.sizes))
        for begin, end in in_portions(tokens.sizes.tolist(), limit):
            place = tokens.place[ends[begin] : ends[end]]
            yield begin, end, classes[place], self._rows(hashes[place], ends[begin:end] - ends[begin])

    def _rows(self, word: np.ndarray, starts: np.ndarray) -> np.ndarray:
        one, two = np.zeros(len(word), np.uint64), np.zeros(len(word), np.uint64)
        one[1:] = word[:-1]
        one[starts] = 1
        two[1:] = one[:-1]
        two[starts] = 2
        rows = np.stack([_mix(one + np.uint64(11)), _mix(two + np.uint64(22)), _mix(one * np.uint64(3) + two * np.uint64(5) + np.uint64(33))])
        return (rows >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def _shares(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    score = weights[rows[0]]
    score += weights[rows[1]]
    score += weights[rows[2]]
    score += bias
    score -= score.max(axis=1, keepdims=True)
    np.exp(score, out=score)
    score /= score.sum(axis=1, keepdims=True)
    return score


def _add(sums: np.ndarray, weights: np.ndarray, bias: np.ndarray, own: np.ndarray, rows: np.ndarray) -> None:
    """Add what the tokens' classes are, less what the model expects, to their rows."""
    size, width = len(weights), sums.shape[1]
    shares = np.empty((CLASSES, len(own)))
    for at in range(0, len(own), TOKENS_AT_ONCE):
        part = slice(at, at + TOKENS_AT_ONCE)
        shares[:, part] = _shares(weights, bias, rows[:, part]).T
    flat = sums.reshape(-1)
    for row in rows:
        # a count for each class goes through the rows in memory once
        for c in range(CLASSES):
            sums[c, :size] -= np.bincount(row, shares[c], size)
        np.add.at(flat, own * width + row, 1.0)
        sums[CLASSES, :size] += np.bincount(row, minlength=size)
    sums[:CLASSES, size] += np.bincount(own, minlength=CLASSES) - shares.sum(axis=1)
    sums[CLASSES, size] += len(own)


def _gradient(shipped) -> object:
    """Of each task, blocks of summed gradient rows and feature counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, single = shipped.value
        coder = Coder(single)
        size = 1 << HASH_BITS
        # by class, and last how often each row occurs; the last block of rows is the bias
        sums = np.zeros((CLASSES + 1, size + BLOCK))
        for batch in slices(batches):
            for _, _, own, rows in coder.portions(Tokens.of(batch.column(0)), GRADIENT_TOKENS):
                for at in range(0, len(own), GRADIENT_TOKENS):
                    _add(sums, weights, bias, own[at : at + GRADIENT_TOKENS], rows[:, at : at + GRADIENT_TOKENS])
        total = sums.T.astype(np.float32)
        blocks = range(len(total) // BLOCK)
        lane = int(xxhash.xxh32_intdigest(total[:64].tobytes()) % LANES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(blocks), pa.int32()), pa.array([lane] * len(blocks), pa.int32()), pa.array([total[b * BLOCK : (b + 1) * BLOCK].tobytes() for b in blocks], pa.binary())],
            names=["block", "lane", "rows"],
        )

    return run


def _added(table: pa.Table) -> pa.Table:
    total = np.zeros(BLOCK * (CLASSES + 1), np.float64)
    for rows in table.column("rows"):
        total += np.frombuffer(rows.as_buffer(), np.float32)
    return pa.table({"block": table.column("block").slice(0, 1), "lane": table.column("lane").slice(0, 1), "rows": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def train(texts: DataFrame, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias from the texts of column ``t``."""
    spark, schema = texts.sparkSession, "block int, lane int, rows binary"
    share = (words.tokens + 1) / (words.total + CLASSES)
    weights, bias = np.zeros((1 << HASH_BITS, CLASSES), np.float32), np.log(share).astype(np.float32)
    for part in range(ROUNDS):
        shipped = spark.sparkContext.broadcast((weights, bias, words.single))
        sums = (
            texts.where(F.pmod(F.xxhash64("t"), F.lit(ROUNDS)) == part).select("t").mapInArrow(_gradient(shipped), schema)
            .groupBy("block", "lane").applyInArrow(_added, schema).groupBy("block").applyInArrow(_added, schema)
        )
        # as many rows as there are blocks of weights
        rows = {r["block"]: np.frombuffer(r["rows"], np.float32).reshape(BLOCK, -1) for r in stored(sums, "gradient").collect()}
        if not rows:
            continue
        total = np.concatenate([rows[b] for b in sorted(rows)]).astype(np.float64)
        step = total[:, :CLASSES] / (total[:, CLASSES:] * share + PRIOR)
        step = RATE * np.clip(step, -1.0, 3.0)
        weights = (weights + step[: 1 << HASH_BITS]).astype(np.float32)
        bias = (bias + step[1 << HASH_BITS]).astype(np.float32)
        shipped.unpersist()
    return weights, bias


def score(docs: DataFrame, words: Words, model: tuple[np.ndarray, np.ndarray], keep: list[str], text: str) -> DataFrame:
    """``keep``, ``n_tokens``, ``n_known``, ``base_score`` and ``score`` (log10) of each text."""
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast((*model, words.single, words.head, words.total, words.distinct, words.tokens, words.unseen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, single, head, total, distinct, tokens, unseen = shipped.value
        coder = Coder(single)
        whole = np.log10(total + distinct + 1)
        with np.errstate(divide="ignore"):
            in_class = np.log10(1 - unseen) - np.log10(np.maximum(tokens, 1))
        in_class[: len(single)] = -np.log10(np.maximum(tokens[: len(single)], 1))
        for batch in slices(batches):
            every = Tokens.of(batch.column(1))
            counts = np.fromiter(map(head.get, every.distinct, repeat(0)), np.int64, len(every.distinct))
            first = 0
            for begin, end, own, rows in coder.portions(every, 16 * TOKENS_AT_ONCE):
                sizes, place = every.sizes[begin:end], every.place[first : first + len(own)]
                first += len(own)
                log = np.empty(len(own))
                for at in range(0, len(own), TOKENS_AT_ONCE):
                    o = own[at : at + TOKENS_AT_ONCE]
                    p = _shares(weights, bias, rows[:, at : at + TOKENS_AT_ONCE])
                    log[at : at + len(o)] = np.log10(np.maximum(p[np.arange(len(o)), o], 1e-30))
                count = counts[place]
                known = count > 0
                with np.errstate(divide="ignore"):
                    log += np.where(known, np.log10(np.maximum(count, 1)) + in_class[own], 0.0)
                base = np.where(known, np.log10(count + 1.0) - whole, 0.0)
                starts = np.cumsum(sizes) - sizes
                rest = []
                for a, n in zip(starts.tolist(), sizes.tolist()):
                    at = a + np.flatnonzero(~known[a : a + n])
                    found = Counter(zip(place[at].tolist(), own[at].tolist()))
                    rest.append([{"word": every.distinct[x], "class": c, "n": k} for (x, c), k in found.items()])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin), pa.array(sizes, pa.int64()), pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                        pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(log, starts)), pa.array(rest, REST),
                    ],
                    names=["row", "n_tokens", "known", "base", "log", "rest"],
                )

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("t"))
    schema = f"row {packed.schema['row'].dataType.simpleString()}, n_tokens long, known long, base double, log double, rest array<struct<word: binary, class: int, n: long>>"
    scored = stored(packed.mapInArrow(run, schema).withColumn("at", F.monotonically_increasing_id()), "scored")
    shares = spark.createDataFrame([(i, float(t), float(u)) for i, (t, u) in enumerate(zip(words.tokens, words.unseen))], "class int, tokens double, unseen double")
    others = (
        scored.select("at", F.explode("rest").alias("r")).select("at", "r.word", "r.class", "r.n")
        .join(words.counts.withColumnRenamed("n", "c"), "word", "left").join(F.broadcast(shares), "class")
        .withColumn("c", F.coalesce("c", F.lit(0)))
        .groupBy("at").agg(
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
            F.sum(F.col("n") * (F.log10(F.col("c") + 1) - float(np.log10(words.total + words.distinct + 1)))).alias("more_base"),
            F.sum(F.col("n") * F.when(F.col("c") > 0, F.log10("c") + F.log10(1 - F.col("unseen")) - F.log10("tokens")).otherwise(F.log10("unseen"))).alias("more_log"),
        )
    )
    nil = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.select("at", "row", "n_tokens", "known", "base", "log").join(others, "at", "left").select(
        "row.*", "n_tokens", (F.col("known") + nil("more_known")).alias("n_known"),
        (F.col("base") + nil("more_base")).alias("base_score"), (F.col("log") + nil("more_log")).alias("score"),
    )
