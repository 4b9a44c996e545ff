"""Repeated passages by compressed FM-indexes of shards.

Every window of ``window`` words belongs to a shard that its own content names: the least hash
of its runs of ``GRAMS[0]`` words. Neighbouring windows of one name travel as one segment of
text, so equal windows meet in one shard, each window once, and nothing is compared across
shards. Segments whose name occurs once in all texts cannot repeat and do not travel; equal
segments travel as one with a count. A name with more than ``HOT`` different segments is cut
again by longer runs, at last by whole windows, so that no name needs more than a bounded
part of a shard.

A shard's segments are joined, their suffixes sorted to the depth of a window, and the
Burrows-Wheeler transform kept in a wavelet matrix of packed bits. Backward search of a
window's words from its end gives the longest match that occurs elsewhere too; if that is
shorter than the window, the unmatched place rules out all windows over it and the search
moves past it (matching statistics with jumps).

Defined results: null and empty texts have no words and lose none; texts shorter than a window
lose none; rows that repeat with id and text are separate places, so all their windows repeat;
null ids are kept apart by their texts; other columns are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlark.llm.common import in_portions, slices, stored
from loanlark.llm.near_dedup import FACTORS, _mix

WINDOW = 35
#: Words of the runs that name a window, by level; the last level takes the whole window.
GRAMS = (8, 20)
HOT = 512
SHARD_WORDS = 1_000_000

ANCHOR = "id long, h long, key long, start int, n int, occ int"
SEGMENT = "id long, h long, start int, key long, sid binary, n int, body string"


def names(words: list[list[bytes]], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of some texts: (text, first window, windows, name, whether the name's run repeats there)."""
    sizes = np.array([len(w) for w in words], np.int64)
    total = int(sizes.sum())
    none = np.empty(0, np.int64)
    if total < window:
        return none, none, none, none.view(np.uint64), none.astype(bool)
    code, distinct = pd.factorize(np.array([*chain.from_iterable(words), None], object)[:-1])
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, len(distinct))[code]
    runs = np.zeros(total - gram + 1, np.uint64)
    for k in range(gram):
        runs = runs * FACTORS[0] + hashed[k : k + len(runs)]
    runs = _mix(runs + np.uint64(gram))
    least, span, width = runs, 1, window - gram + 1
    while span < width:
        step = min(span, width - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.flatnonzero(place[: len(least)] + window <= sizes[owner[: len(least)]])
    if not len(at):
        return none, none, none, none.view(np.uint64), none.astype(bool)
    least = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1) | (owner[at[1:]] != owner[at[:-1]])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    inside = np.sort(_mix(runs ^ FACTORS[owner[: len(runs)] % len(FACTORS)] * (owner[: len(runs)].astype(np.uint64) + np.uint64(1))))
    mark = lambda k, o: _mix(k ^ FACTORS[o % len(FACTORS)] * (o.astype(np.uint64) + np.uint64(1)))
    twice = np.unique(inside[1:][inside[1:] == inside[:-1]])
    own = owner[at[first]]
    return own, place[at[first]], n, least[first], np.isin(mark(least[first], own), twice)


def _anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [(t or "").encode().split() for t in batch.column(2).to_pylist()]
            for begin, end in in_portions([len(w) for w in words]):
                own, start, n, key, twice = names(words[begin:end], window, GRAMS[0])
                at = pa.array(own + begin)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(key.view(np.int64)), pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(1 + twice, pa.int32())],
                    names=["id", "h", "key", "start", "n", "occ"],
                )

    return run


def _segments(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc, h, text, ranges in zip(*(batch.column(i).to_pylist() for i in range(4))):
                words = (text or "").encode().split()
                for r in ranges:
                    body = b" ".join(words[r["start"] : r["start"] + r["n"] + window - 1])
                    rows.append((doc, h, r["start"], r["key"], xxhash.xxh3_128_digest(body), r["n"], body.decode()))
            yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.string()]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["id", "h", "start", "key", "sid", "n", "body"])


def _recut(window: int, gram: int):
    """Segments cut anew by longer runs: ``parent``, the place in it, and the piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [t.encode().split() for t in batch.column(1).to_pylist()]
            own, start, n, key, _ = names(words, window, gram)
            bodies = [b" ".join(words[o][s : s + c + window - 1]) for o, s, c in zip(own.tolist(), start.tolist(), n.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(own)), pa.array(start, pa.int32()), pa.array(key.view(np.int64)), pa.array([xxhash.xxh3_128_digest(b) for b in bodies], pa.binary()), pa.array(n, pa.int32()), pa.array([b.decode() for b in bodies], pa.string())],
                names=["parent", "offset", "key", "sid", "n", "body"],
            )

    return run


class FmIndex:
    """Backward search over a sequence of codes (1 and more; 0 parts segments)."""

    def __init__(self, codes: np.ndarray, depth: int):
        n = len(codes)
        rank, span = codes.astype(np.int64), 1
        order = np.argsort(rank, kind="stable")
        while span < depth:
            ahead = np.zeros(n, np.int64)
            ahead[: n - span] = rank[span:] + 1
            key = rank * (int(rank.max()) + 2) + ahead
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1]))
            span *= 2
        transform = codes[order - 1]  # the first suffix is preceded by the last separator
        self.levels = max(1, int(codes.max()).bit_length())
        words = n // 64 + 1
        self.bits = np.zeros((self.levels, words), np.uint64)
        self.ranks = np.zeros((self.levels, words), np.int64)
        self.zeros = np.zeros(self.levels, np.int64)
        current = transform
        for level in range(self.levels):
            bit = ((current >> (self.levels - 1 - level)) & 1).astype(bool)
            padded = np.zeros(words * 64, bool)
            padded[:n] = bit
            self.bits[level] = np.packbits(padded, bitorder="little").view(np.uint64)
            ones = np.bitwise_count(self.bits[level]).astype(np.int64)
            self.ranks[level] = np.cumsum(ones) - ones
            self.zeros[level] = n - int(bit.sum())
            current = np.concatenate([current[~bit], current[bit]])
        count = np.bincount(codes)
        symbols = np.arange(len(count))
        self.offset = np.cumsum(count) - count - self._down(symbols, np.zeros(len(count), np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            bit = (symbol >> (self.levels - 1 - level)) & 1
            word = at >> 6
            below = self.bits[level][word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            ones = self.ranks[level][word] + np.bitwise_count(below)
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return at

    def back(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high])) + np.tile(self.offset[symbol], 2)
        return both[: len(low)], both[len(low) :]


def repeats(bodies: list[list[bytes]], counts: list[int], window: int) -> list[list[tuple[int, int]]]:
    """Of each segment, the word ranges covered by windows that occur twice or more."""
    sizes = np.array([len(b) for b in bodies], np.int64)
    code, _ = pd.factorize(np.array([*chain.from_iterable(bodies), None], object)[:-1])
    begins = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int((sizes + 1).sum()), np.int64)
    filled = np.ones(len(text), bool)
    filled[begins + sizes] = False
    text[filled] = code + 1
    covered: list[list[tuple[int, int]]] = [[(0, len(b))] if c > 1 else [] for b, c in zip(bodies, counts)]
    alone = np.flatnonzero(np.array(counts) < 2)
    if not len(alone):
        return covered
    index = FmIndex(text, window)
    last = (sizes - window)[alone]
    # seeking: the next window to try; extending: windows beyond the last hit, farthest first
    at, hit = np.zeros(len(alone), np.int64), np.full(len(alone), -1, np.int64)
    going = np.arange(len(alone))
    while len(going):
        begin = begins[alone[going]] + at[going]
        low, high = np.zeros(len(going), np.int64), np.full(len(going), len(text), np.int64)
        failed = np.full(len(going), -1, np.int64)
        live = np.arange(len(going))
        for k in range(window - 1, -1, -1):
            low[live], high[live] = index.back(text[begin[live] + k], low[live], high[live])
            few = high[live] - low[live] < 2
            failed[live[few]] = k
            live = live[~few]
            if not len(live):
                break
        good = failed < 0
        for g, a in zip(going[good].tolist(), at[going[good]].tolist()):
            covered[alone[g]].append((a, a + window))
        extending = hit[going] >= 0
        # a hit: try the windows that end furthest on; a miss: past the place, or one nearer
        hit[going[good]] = at[going[good]]
        at[going[good]] = np.minimum(at[going[good]] + window, last[going[good]])
        nearer = going[~good & extending]
        at[nearer] -= 1
        further = going[~good & ~extending]
        at[further] += failed[~good & ~extending] + 1
        spent = going[(hit[going] >= 0) & (at[going] <= hit[going])]
        at[spent] = hit[spent] + window + 1
        hit[spent] = -1
        going = going[at[going] <= last[going]]
    return covered


def _searched(window: int):
    def run(group: pa.Table) -> pa.Table:
        bodies = [b.encode().split() for b in group.column("body").to_pylist()]
        found = repeats(bodies, group.column("count").to_pylist(), window)
        kept = [i for i, f in enumerate(found) if f]
        return pa.table({
            "sid": group.column("sid").take(pa.array(kept, pa.int64())),
            "ranges": pa.array([[{"a": a, "b": b} for a, b in found[i]] for i in kept], pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
        })

    return run


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``id``, ``h`` (hash of the text), the text, and the word ``ranges`` to remove."""
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("h"), F.col(f"`{text}`").alias("t"))
    anchors = stored(own.mapInArrow(_anchors(window), ANCHOR), "anchors")
    again = anchors.groupBy("key").agg(F.sum("occ").alias("n")).where("n > 1").select("key")
    wanted = (
        anchors.join(again, "key", "left_semi").groupBy(F.coalesce("id", F.lit(0)).alias("i"), F.col("id").isNull().alias("z"), "h")
        .agg(F.collect_set(F.struct("start", "n", "key")).alias("ranges"))
    )
    wanted = stored(wanted, "wanted")
    same = (F.coalesce(own["id"], F.lit(0)) == F.col("i")) & (own["id"].isNull() == F.col("z")) & (own["h"] == wanted["h"])
    places = stored(own.join(wanted, same).select(own["id"], own["h"], "t", "ranges").mapInArrow(_segments(window), SEGMENT), "segments")

    distinct = stored(places.groupBy("key", "sid").agg(F.count("*").alias("count"), F.first("body").alias("body"), F.first("n").alias("n")), "distinct-segments")
    places = places.select("id", "h", "start", "sid")
    ready, cut_places = [], []
    for gram in (*GRAMS[1:], window):
        hot = distinct.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > HOT).select("key")
        hot = stored(hot, "hot-names")
        if hot.isEmpty():
            break
        ready.append(distinct.join(F.broadcast(hot) if hot.count() < 10_000 else hot, "key", "left_anti"))
        split = distinct.join(hot, "key", "left_semi")
        pieces = stored(split.select("sid", "body").mapInArrow(_recut(window, gram), "parent binary, offset int, key long, sid binary, n int, body string"), "pieces")
        weights = split.select(F.col("sid").alias("parent"), "count")
        inner = pieces.select("parent", "offset", "sid")
        cut_places.append(places.join(split.select("sid"), "sid", "left_anti").select(*places.columns))
        places = stored(
            places.join(inner.withColumnsRenamed({"sid": "piece"}), F.col("sid") == F.col("parent"))
            .select("id", "h", (F.col("start") + F.col("offset")).alias("start"), F.col("piece").alias("sid")), "places",
        )
        distinct = stored(
            pieces.join(weights, "parent").groupBy("key", "sid").agg(F.sum("count").alias("count"), F.first("body").alias("body"), F.first("n").alias("n")), "distinct-segments",
        )
    for more in ready:
        distinct = distinct.select("key", "sid", "count", "body", "n").union(more.select("key", "sid", "count", "body", "n"))
    for more in cut_places:
        places = places.union(more)
    words = distinct.agg(F.coalesce(F.sum(F.col("n") + window - 1), F.lit(0))).first()[0]
    shards = max(docs.sparkSession.sparkContext.defaultParallelism, -(-words // SHARD_WORDS))
    found = stored(
        distinct.select("sid", "count", "body", F.pmod(F.xxhash64("key"), F.lit(shards)).alias("shard"))
        .groupBy("shard").applyInArrow(_searched(window), "sid binary, ranges array<struct<a: int, b: int>>"),
        "repeats",
    )
    ranges = (
        places.join(found, "sid")
        .select("id", "h", F.transform("ranges", lambda r: F.struct((r["a"] + F.col("start")).alias("a"), (r["b"] + F.col("start")).alias("b"))).alias("r"))
        .groupBy(F.coalesce("id", F.lit(0)).alias("i"), F.col("id").isNull().alias("z"), "h")
        .agg(F.array_distinct(F.flatten(F.collect_list("r"))).alias("ranges"))
    )
    ranges = stored(ranges, "ranges")
    same = (F.coalesce(own["id"], F.lit(0)) == F.col("i")) & (own["id"].isNull() == F.col("z")) & (own["h"] == ranges["h"])
    return own.join(ranges, same, "left").select(own["id"].alias(doc_id), own["h"], F.col("t").alias(text), "ranges")


def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept``: the other words, joined by a blank."""
    found = find(docs, doc_id, text, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, gone, kept = [], [], []
            for t, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = (t or "").encode().split()
                mask = np.ones(len(words), bool)
                for r in ranges or ():
                    mask[r["a"] : r["b"]] = False
                n.append(len(words))
                gone.append(int(len(words) - mask.sum()))
                kept.append(b" ".join(words if not ranges else [words[i] for i in np.flatnonzero(mask)]).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["id", "n_words", "n_removed", "kept"])

    made = found.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("t"), "ranges").mapInArrow(run, "id long, n_words long, n_removed long, kept string")
    return made.withColumnRenamed("id", doc_id)
