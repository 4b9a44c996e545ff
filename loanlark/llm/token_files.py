"""Token ids in compressed files: canonical Huffman codes of limited length.

Code lengths come from the counts of all ids (package-merge under ``LIMIT`` bits) and fix the
codes, so the file stores lengths only. Documents lie in ascending id order in blocks of
whole documents, each row of the Parquet container one block: its documents, their id
counts, the bits, and the bit offset of every ``STRIDE``-th id of each document. A block can
be decoded alone, and all its strides at once, by one table look-up for each id.

The container has three parts: ``codes`` (id, length), ``blocks`` and ``shards`` (ids in all
shards before). A shard is a range of document ids of about ``SHARD_BYTES``.

Ids are the library's for ``add_special_tokens=False``: texts that hold an added token, such as
``<|endoftext|>``, go to it whole.

Defined results: null and empty texts have only the end id; repeated rows are each written,
rows of equal document id in the order of their codes; null document ids come first; an
empty table gives an empty container; other columns are not written.
"""

from __future__ import annotations

import os
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from loanlark.llm.bpe import read_ranks
from loanlark.llm.common import in_portions, slices, stored, texts_of
from loanlark.session import scratch_path

LIMIT = 20
STRIDE = 128
BLOCK_IDS = 65_536
SHARD_BYTES = 64 << 20
#: Entries of one generation of a worker's memo; two are kept.
MEMO_WORDS = 450_000

#: Texts with other characters than these go to the library whole.
PLAIN = re.compile(r"[^\x20-\x7e\n¡-ɏ]")
#: The letters and digits among them, and the library's own split of such texts.
LETTERS, DIGITS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
PIECES = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^ \n{LETTERS}{DIGITS}]+|[ \n]+(?![^ \n])|[ \n]+"
)


class Tokens:
    """The tokenizer with a memo of pieces that its own splitting never joins.

    With ``added``, added tokens are found as the library finds them by default; without, those
    that are special are encoded as plain text.
    """

    def __init__(self, content: str, dtype: np.dtype, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.added = None
        if added:
            names = [t.content for t in self.library.get_added_tokens_decoder().values() if t.content]
            self.added = re.compile("|".join(map(re.escape, names))) if names else None
        else:
            self.library.encode_special_tokens = True
        self.dtype, self.memo, self.before = dtype, {}, {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("H" if self.dtype.itemsize == 2 else "I", e.ids).tobytes() for e in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        apart = lambda t: PLAIN.search(t) or self.added and self.added.search(t)
        split = [None if apart(t) else PIECES.findall(t) for t in texts]
        out = [b""] * len(texts)
        for begin, end in in_portions([len(s or ()) for s in split], 300_000):
            part = [s for s in split[begin:end] if s]
            wanted = set().union(*part)
            if len(self.memo) + len(wanted) > MEMO_WORDS:
                self.before, self.memo = self.memo, {}
            lacking = wanted.difference(self.memo)
            known = {w: self.before[w] for w in lacking if w in self.before}
            self.memo.update(known)
            new = list(lacking.difference(known))
            self.memo.update(zip(new, self.whole(new)))
            for i in range(begin, end):
                pieces = split[i]
                out[i] = self.whole([texts[i]])[0] if pieces is None else b"".join(map(self.memo.__getitem__, pieces))
        return out


_tokens: dict[int, Tokens] = {}


def tokenise(docs: DataFrame, tokenizer_file: str, end_id: int, wide: bool = False) -> DataFrame:
    """``doc_id`` and ``packed``: little-endian ids (two bytes each, or four if ``wide``)."""
    content = docs.sparkSession.sparkContext.broadcast(read_ranks(tokenizer_file).decode())
    dtype = np.dtype("<u4" if wide else "<u2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash((content.value, wide))
        if key not in _tokens:
            _tokens.clear()
            _tokens[key] = Tokens(content.value, dtype, added=True)
        end = np.array([end_id], dtype).tobytes()
        for batch in slices(batches):
            packed = [p + end for p in _tokens[key].encode(texts_of(batch, "text"))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["doc_id", "packed"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, packed binary")


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal lengths under the limit for positive counts (package-merge)."""
    n = len(counts)
    if n < 2:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} ids do not fit codes of {limit} bits")
    rank = np.argsort(counts, kind="stable")
    leaves = counts[rank].astype(np.float64)
    levels, packages = [], np.empty(0)
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        order = np.argsort(both, kind="stable")
        levels.append(order < n)
        row = both[order]
        row = row[: len(row) // 2 * 2]
        packages = row[0::2] + row[1::2]
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        own = int(is_leaf[:take].sum())
        lengths[rank[:own]] += 1
        take = 2 * (take - own)
    return lengths


class Codec:
    """Codes of a list of (id, length), and the table that decodes them."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((ids, lengths))
        ids, lengths = ids[order].astype(np.int64), lengths[order].astype(np.int64)
        steps = np.left_shift(1, LIMIT - lengths)
        starts = np.cumsum(steps) - steps
        size = int(ids.max(initial=0)) + 1
        self.code = np.zeros(size, np.uint32)
        self.bits = np.zeros(size, np.int64)
        self.code[ids] = starts >> (LIMIT - lengths)
        self.bits[ids] = lengths
        self.symbol = np.zeros(1 << LIMIT, np.uint32)
        self.length = np.ones(1 << LIMIT, np.int64)
        filled = int(steps.sum())
        self.symbol[:filled] = np.repeat(ids, steps)
        self.length[:filled] = np.repeat(lengths, steps)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits, padded to a byte, and the offset of every stride."""
        bits = self.bits[ids]
        ends = np.cumsum(bits)
        at = ends - bits
        value = self.code[ids].astype(np.int64) << (32 - bits - (at & 7))
        n_bytes = (int(ends[-1]) + 7) // 8 if len(ids) else 0
        out = np.zeros(n_bytes + 4)
        for k in range(4):
            out[k:] += np.bincount(at >> 3, (value >> (24 - 8 * k)) & 255, n_bytes + 4)[: n_bytes + 4 - k]
        return out[:n_bytes].astype(np.uint8).tobytes(), at[::STRIDE]

    def decode(self, payload: bytes, offsets: np.ndarray) -> np.ndarray:
        """``STRIDE`` ids from each offset on, as one row each."""
        raw = np.frombuffer(payload + b"\0" * (LIMIT * STRIDE // 8 + 8), np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at, last = offsets.astype(np.int64), len(window) - 1
        out = np.empty((STRIDE, len(at)), np.uint32)
        for k in range(STRIDE):
            peek = (window[np.minimum(at >> 3, last)] >> (32 - LIMIT - (at & 7)).astype(np.uint32)) & ((1 << LIMIT) - 1)
            out[k] = self.symbol[peek]
            at += self.length[peek]
        return out.T


def count_ids(packed: DataFrame, wide: bool) -> DataFrame:
    """How often each id occurs: counted by task, then summed."""
    dtype = "<u4" if wide else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] | np.ndarray = np.zeros(0, np.int64)
        for batch in slices(batches):
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype)
            found = np.bincount(ids)
            if len(found) < len(total):
                found, total = total, found
            found[: len(total)] += total
            total = found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], names=["id", "n"])

    return packed.select("packed").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, wide: bool = False) -> None:
    """Tokenise documents and write the container."""
    spark = docs.sparkSession
    packed = stored(tokenise(docs, tokenizer_file, end_id, wide), "packed-ids")
    # one row for each id of the vocabulary: a bound that the tokenizer proves
    counts = count_ids(packed, wide).orderBy("id").toPandas()
    ids, n = counts["id"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)
    lengths = code_lengths(n)
    spark.createDataFrame(
        list(zip(ids.tolist(), lengths.tolist())), "id long, length long"
    ).coalesce(1).write.parquet(f"{path}/codes")
    shards = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        -(-int((n * lengths).sum()) // (8 * SHARD_BYTES)),
    )
    cuts = packed.approxQuantile("doc_id", [i / shards for i in range(1, shards)], 0.1 / shards) if shards > 1 else []
    codec = spark.sparkContext.broadcast((ids, lengths, sorted(cuts)))
    dtype = "<u4" if wide else "<u2"

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, cuts = Codec(*codec.value[:2]), codec.value[2]
        for batch in slices(batches):
            rows = [np.frombuffer(p, dtype) for p in batch.column(1).to_pylist()]
            coded = [c.encode(r) for r in rows]
            ends = np.cumsum([0, *(len(o) for _, o in coded)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([bisect_right(cuts, d) if d is not None else 0 for d in batch.column(0).to_pylist()], pa.int32()),
                    batch.column(0),
                    pa.array([len(r) for r in rows], pa.int64()),
                    pa.array([b for b, _ in coded], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *(o for _, o in coded)]))),
                ],
                names=["shard", "doc_id", "n", "bits", "offsets"],
            )

    coded = packed.mapInArrow(code, "shard int, doc_id long, n long, bits binary, offsets array<long>")
    (
        coded.repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("shard", "doc_id", "bits", "n")
        .mapInArrow(_blocks, BLOCKS)
        .write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    )
    # one row for each shard of SHARD_BYTES
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    (
        spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n"))
        .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
        .write.parquet(f"{path}/shards")
    )


BLOCKS = "shard int, start long, n_ids long, docs array<long>, counts array<long>, bits binary, offsets array<long>"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted documents of a shard into blocks; a document is never split."""
    shard, start, rows, size = None, 0, [], 0

    def closed() -> pa.RecordBatch:
        places = np.cumsum([0, *(len(r[2]) for r in rows)]) * 8
        block = {
            "shard": shard, "start": start, "n_ids": size, "docs": [r[0] for r in rows], "counts": [r[1] for r in rows],
            "bits": b"".join(r[2] for r in rows), "offsets": np.concatenate([o + p for (_, _, _, o), p in zip(rows, places)]),
        }
        types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(block.values(), types)], names=list(block))

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(4)]
        offsets = batch.column(4)
        for i, (own, doc, n, bits) in enumerate(zip(*columns)):
            if rows and (own != shard or size >= BLOCK_IDS):
                yield closed()
                start, rows, size = (start + size if own == shard else 0), [], 0
            shard = own
            rows.append((doc, n, bits, offsets[i].values.to_numpy(zero_copy_only=False)))
            size += n
    if rows:
        yield closed()


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n`` and the ids, packed as
    little-endian unsigned 32-bit integers."""
    codes = spark.read.parquet(f"{path}/codes").toPandas()
    codec = spark.sparkContext.broadcast((codes["id"].to_numpy(np.int64), codes["length"].to_numpy(np.int64)))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = Codec(*codec.value)
        for batch in batches:
            sizes = [len(b) for b in batch.column("bits").to_pylist()]
            for begin, end in in_portions(sizes, 1 << 20):
                yield _decoded(c, batch.slice(begin, end - begin))

    blocks = spark.read.parquet(f"{path}/blocks")
    shards = spark.read.parquet(f"{path}/shards")
    return (
        blocks.join(F.broadcast(shards) if shards.count() < 100_000 else shards, "shard")
        .select((F.col("start") + F.col("before")).alias("start"), "docs", "counts", "bits", "offsets")
        .mapInArrow(decode, "doc_id long, start long, n long, ids binary")
    )


def _decoded(codec: Codec, blocks: pa.RecordBatch) -> pa.RecordBatch:
    rows = blocks.to_pydict()
    places = np.cumsum([0, *map(len, rows["bits"])]) * 8
    offsets = np.concatenate([np.empty(0, np.int64), *(np.array(o, np.int64) + p for o, p in zip(rows["offsets"], places))])
    found = codec.decode(b"".join(rows["bits"]), offsets)
    docs, starts, counts, ids, lane = [], [], [], [], 0
    for first, own, ns in zip(rows["start"], rows["docs"], rows["counts"]):
        docs += own
        counts += ns
        starts += (first + np.cumsum([0, *ns])[:-1]).tolist()
        for n in ns:
            lanes = -(-n // STRIDE)
            ids.append(found[lane : lane + lanes].reshape(-1)[:n].astype("<u4").tobytes())
            lane += lanes
    return pa.RecordBatch.from_arrays(
        [pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
        names=["doc_id", "start", "n", "ids"],
    )


def fresh_path(spark: SparkSession) -> str:
    return scratch_path(spark, "token-files")
