"""Near-duplicate documents: MinHash bands, odd sketches, and checks on full sets.

A document's set holds its runs of ``width`` lower-cased (A-Z) words. The first ``BANDS`` x ``ROWS``
of ``SAMPLES`` MinHash samples give the bands; a pair of similarity 0.8 shares no band with a
chance of 3 in a million, less above. All samples are folded into a parity bitmap of ``BITS``
bits; the bits in which two bitmaps differ estimate the similarity. At similarity 0.8 they are
201 with a deviation of 14.8, by the samples and by collisions in the bitmap together, so pairs
estimated ``MARGIN`` (five such deviations) below the threshold are not looked at further. All others are confirmed on the full sets of words.

Documents of equal sets are one class with a number of its own, whatever the ids, and only one
document of it is compared. In each band bucket every class is compared with the least one;
what that leaves in different components of a bucket is then compared across them, each pair
in the first bucket that it shares, so no pair is tested that is linked already, and none that
shares a bucket is left out. There the odd sketches of whole sets come first: bits that differ
are never more than elements that differ, so this bound loses nothing.

Defined results: null, empty and wordless texts have empty sets and link with nothing; fewer
words than ``width`` are one run; rows of one id are judged each by its own text, and equal
ones alike; a null id links with nothing, has a null component and is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlark.llm.common import in_portions, slices, stored, texts_of
from loanlark.llm.components import components

ROWS, BANDS = 5, 32
SAMPLES, BITS = 640, 1024
PERCENT = 80
MARGIN = 0.11
#: Bits of the odd sketch of a whole set, for the last comparisons.
SET_BITS = 4096


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


#: One odd factor for each MinHash sample.
FACTORS = _mix(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def run_keys(words: list[list[bytes]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct runs as 64-bit keys: (owner, key), sorted by both."""
    sizes = np.array([len(w) for w in words])
    flat = np.array([*chain.from_iterable(words), None], object)[:-1]
    code, distinct = pd.factorize(flat)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))[code]
    owner = np.repeat(np.arange(len(words)), sizes)
    ends = np.cumsum(sizes)
    first = np.repeat(ends - sizes, sizes)
    place = np.arange(len(flat)) - first
    key = np.zeros(len(flat), np.uint64)
    # short texts are one run, of all their words
    for k in range(width):
        part = np.zeros(len(flat), np.uint64)
        part[: max(len(flat) - k, 0)] = hashes[k:]
        inside = place + k < sizes[owner]
        key = np.where(inside, _mix(key ^ (part * FACTORS[k])), key)
    starts = place < np.maximum(sizes[owner] - width + 1, 1)
    owner, key = owner[starts], key[starts]
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], key[new]


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts)


def signatures(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """``id``, hash ``h`` of the text, set size ``n``, set identity ``s1 s2``, band keys and the odd sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [words_of(t) for t in texts_of(batch, "t")]
            for begin, end in in_portions([len(w) for w in words]):
                yield _signed([batch.column(c).slice(begin, end - begin) for c in ("id", "h")], words[begin:end], width)

    return _named(docs, doc_id, text).mapInArrow(
        run, "id long, h long, n long, s1 long, s2 long, bands array<long>, odd array<long>, parity array<long>"
    )


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``id``, ``t`` and the hash ``h`` that tells texts of one id apart."""
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.col(f"`{text}`").alias("t"))


def _signed(names: list[pa.Array], words: list[list[bytes]], width: int) -> pa.RecordBatch:
    owner, key = run_keys(words, width)
    count = np.bincount(owner, minlength=len(words))
    full = np.flatnonzero(count)
    starts = (np.cumsum(count) - count)[full]
    sums = np.zeros((2, len(words)), np.uint64)
    bands = np.zeros((len(words), BANDS), np.uint64)
    parity = np.zeros((len(words), BITS), np.uint8)
    if len(full):
        sums[0, full], sums[1, full] = _sums(_mix(key), starts), _sums(_mix(key ^ FACTORS[0]), starts)
        value = np.empty_like(key)
        for j, factor in enumerate(FACTORS):
            np.bitwise_xor(key, factor, out=value)
            np.multiply(value, FACTORS[-1 - j], out=value)
            least = _mix(np.minimum.reduceat(value, starts) ^ factor)
            if j < ROWS * BANDS:
                bands[full, j // ROWS] = _mix(bands[full, j // ROWS] * np.uint64(31) + least)
            parity[full, (least % np.uint64(BITS)).astype(np.int64)] ^= 1
    odd = np.packbits(parity, axis=1).view(np.int64)
    place = owner * SET_BITS + (_mix(key ^ FACTORS[1]) % np.uint64(SET_BITS)).astype(np.int64)
    whole = (np.bincount(place, minlength=len(words) * SET_BITS) & 1).astype(np.uint8).reshape(-1, SET_BITS)
    whole = np.packbits(whole, axis=1).view(np.int64)
    lists = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1) * m.shape[1], pa.int32()), pa.array(m.reshape(-1)))
    return pa.RecordBatch.from_arrays(
        [*names, pa.array(count, pa.int64()), *(pa.array(s.view(np.int64)) for s in sums), lists(bands.view(np.int64)), lists(odd), lists(whole)],
        names=["id", "h", "n", "s1", "s2", "bands", "odd", "parity"],
    )


def near_enough(one: str, other: str, percent: int) -> Column:
    """Whether set sizes and odd sketches leave room for the similarity."""
    low, high = F.least(f"{one}.n", f"{other}.n"), F.greatest(f"{one}.n", f"{other}.n")
    differ = sum((F.bit_count(F.col(f"{one}.odd")[i].bitwiseXOR(F.col(f"{other}.odd")[i])) for i in range(BITS // 64)), F.lit(0))
    # samples that differ, from the share of odd bits; beyond half, there is no estimate
    most = int((1 - np.exp(-4 * SAMPLES * (1 - percent / 100 + MARGIN) / BITS)) * BITS / 2)
    return (100 * low >= percent * high) & (differ <= most)


def sets_near(one: str, other: str, percent: int) -> Column:
    """Whether the odd sketches of two whole sets allow the similarity.

    Sets that are near enough differ in few elements. Their sketches differ in no more bits
    than that, and in the expected number with six deviations at most.
    """
    low, high = F.least(f"{one}.n", f"{other}.n"), F.greatest(f"{one}.n", f"{other}.n")
    differ = sum((F.bit_count(F.col(f"{one}.parity")[i].bitwiseXOR(F.col(f"{other}.parity")[i])) for i in range(SET_BITS // 64)), F.lit(0))
    most = (low + high) * float((100 - percent) / (100 + percent))
    left = F.exp(most * (-2.0 / SET_BITS))
    spread = F.sqrt(SET_BITS / 4 * (1 - left * left) - most * left * left + 1)
    return (100 * low >= percent * high) & (differ <= F.least(F.floor(most + 1e-6), SET_BITS / 2 * (1 - left) + 6 * spread))


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are near enough."""
    held = pairs.join(texts.select(F.col("id").alias("b"), F.col("t").alias("tb")), "b")
    held = held.join(texts.select(F.col("id").alias("a"), F.col("t").alias("ta")), "a").select("a", "b", "ta", "tb")

    def runs(text: str) -> set:
        words = words_of(text)
        return set(zip(*(words[k:] for k in range(width)))) if len(words) >= width else {tuple(words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for batch in slices(batches):
            near = []
            for a, ta, tb in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if a != last:
                    last, own = a, runs(ta)
                other = runs(tb)
                both = len(own & other)
                near.append(100 * both >= percent * (len(own) + len(other) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(near))

    return held.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 2, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (least id reachable) and ``kept``."""
    judged = _judged(docs, doc_id, text, width, percent)
    return judged.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept")


def _judged(docs: DataFrame, doc_id: str, text: str, width: int, percent: int) -> DataFrame:
    """``id``, ``h``, ``n``, ``component`` and ``kept`` of every row."""
    signed = stored(signatures(docs, doc_id, text, width), "signatures")
    same = ["n", "s1", "s2"]
    # equal sets have equal sketches, so any row's will do, and copies meet before the shuffle
    sketches = [F.first(c).alias(c) for c in ("bands", "odd", "parity")]
    least = F.min(F.struct("id", "h")).alias("least")
    heads = signed.where("n > 0 and id is not null").groupBy(*same).agg(least, *sketches)
    heads = stored(heads.withColumn("k", F.monotonically_increasing_id()), "heads")
    classes = heads.select(*same, "k", "least")
    rows = heads.select("k", F.explode("bands").alias("band"))
    shared = stored(rows.groupBy("band").agg(F.min("k").alias("a"), F.count("*").alias("size")).where("size > 1"), "buckets")
    members = stored(rows.join(shared, "band").select("band", "k", "a", "size"), "bucket-members")
    first = members.where("k <> a").select("a", F.col("k").alias("b")).distinct()
    first = stored(_hopeful(first, heads, percent), "pairs")
    links = stored(confirmed(first, _texts(docs, first, classes, doc_id, text), width, percent), "near-links")
    found = stored(components(links).withColumnRenamed("id", "k"), "components")

    # buckets of three and more that still hold several components
    part = members.where("size > 2").join(found, "k", "left").select("band", "k", F.coalesce("component", "k").alias("c"))
    part = stored(part, "bucket-components")
    mixed = part.groupBy("band").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("band")
    rest = stored(part.join(mixed, "band", "left_semi"), "bucket-mixed")
    apart = heads.join(rest.select("k").distinct(), "k", "left_semi").select("k", F.struct("k", "n", "odd", "parity", "bands").alias("v"))
    rest = stored(rest.join(apart, "k").select("band", "c", "v"), "bucket-rest")
    x, y = rest.select("band", F.col("c").alias("cx"), F.col("v").alias("x")), rest.select("band", F.col("c").alias("cy"), F.col("v").alias("y"))
    open_pair = (F.col("cx") != F.col("cy")) & (F.col("x.k") < F.col("y.k")) & near_enough("x", "y", percent) & sets_near("x", "y", percent)
    once = F.array_intersect("x.bands", "y.bands")[0] == x["band"]
    pairs = x.join(y, (x["band"] == y["band"]) & open_pair & once).select(F.col("x.k").alias("a"), F.col("y.k").alias("b"))
    pairs = stored(pairs.join(first, ["a", "b"], "left_anti"), "more-pairs")
    if not pairs.isEmpty():
        more = confirmed(pairs, _texts(docs, pairs, classes, doc_id, text), width, percent)
        found = components(found.select(F.col("k").alias("a"), F.col("component").alias("b")).union(more))
        found = stored(found.withColumnRenamed("id", "k"), "components")

    named = classes.join(found, "k", "left").select(*same, "least", F.coalesce("component", "k").alias("c"))
    smallest = named.groupBy("c").agg(F.min("least.id").alias("component"))
    grouped = named.join(smallest, "c").select(*same, "component")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return signed.select("id", "h", *same).join(grouped, same, "left").select(
        "id", "h", "n", component.alias("component"), (F.col("id").isNull() | (component == F.col("id"))).alias("kept")
    )


def _hopeful(pairs: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the sketches leave open."""
    sketches = heads.select("k", F.struct("n", "odd", "parity").alias("v"))
    return (
        pairs.join(sketches.select(F.col("k").alias("a"), F.col("v").alias("x")), "a")
        .join(sketches.select(F.col("k").alias("b"), F.col("v").alias("y")), "b")
        .where(near_enough("x", "y", percent) & sets_near("x", "y", percent)).select("a", "b")
    )


def _texts(docs: DataFrame, pairs: DataFrame, classes: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The texts that pairs need, stored; a text travels once however many pairs it has."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct()
    needed = classes.join(needed, "k", "left_semi").select("k", "least.*")
    held = _named(docs, doc_id, text).join(needed, ["id", "h"])
    return stored(held.groupBy(F.col("k").alias("id")).agg(F.max("t").alias("t")), "pair-texts")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = PERCENT) -> DataFrame:
    """The documents without those that have a near-duplicate of smaller id."""
    dropped = _judged(docs, doc_id, text, width, percent).where("not kept")
    dropped = stored(dropped.select(F.col("id").alias("0"), F.col("h").alias("1")).distinct(), "dropped")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    named = docs.select(F.col(f"`{doc_id}`").cast("long").alias("0"), F.xxhash64(F.col(f"`{text}`")).alias("1"), own.alias("row"))
    return named.join(dropped, ["0", "1"], "left_anti").select("row.*")
