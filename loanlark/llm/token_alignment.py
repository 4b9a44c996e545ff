"""Alignment of two tokenizers by the ends that their tokens share.

Both token lists of a text spell the same bytes. Two dictionaries lead from a token's end to
its index; the sorted intersection of their keys slices both lists into groups, and within a
group every pair of tokens whose bytes overlap is a link. How many documents hold a pair of
ids linked is counted over the whole corpus, and each document is told how its links stand
against the counts.

A text is cut before a single blank or line end between two visible characters and between a
letter and a mark such as a comma. The vocabularies are asked whether a token spans such a
place; where none does, a cut is a shared end, and what is found of a part (memoised) adds up to
what is found of the text.

Counts of pairs are looked up in two ways with one result. The most frequent ``HEAD`` pairs
are shipped to all workers (12 bytes each); all others, each of few documents, are joined.

Defined results: null and empty texts have no tokens, nor have texts whose tokens of either
side spell other bytes; repeated rows are documents each; other columns pass through,
whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlark.llm.bpe import read_ranks
from loanlark.llm.common import free_name, per_row, slices, stored, texts_of

#: Pairs whose counts are shipped to all workers at most.
HEAD = 1 << 20
#: Parts of texts that a worker keeps, and letters of them in all.
MEMO_PARTS, MEMO_CHARS = 300_000, 16 << 20
#: Pairs that a worker counts before it passes them on.
PAIRS_AT_ONCE = 1 << 21

LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?"
#: What no token may hold in its midst for texts to be cut.
SPANNING = re.compile(rf"\S[ \n]|\n\S|[{LETTERS}][{MARKS}]")
#: The parts of a text: up to the next blank, line end or mark at which it may be cut.
PART = re.compile(
    rf"(?s).[^ \n{MARKS}]*(?:(?!(?<=\S)[ \n]\S|(?<=[{LETTERS}])[{MARKS}])[ \n{MARKS}][^ \n{MARKS}]*)*"
)


def byte_letters() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte, and the byte.

    Visible characters of Latin-1 stand for themselves, all others follow from U+0100 on.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(others)}


def slice_at_shared_ends(a_ends: list[int], b_ends: list[int]) -> list[tuple[int, int, int, int]]:
    """Groups as (first a, stop a, first b, stop b) between ends that both sides have."""
    a_at = {end: i for i, end in enumerate(a_ends)}
    b_at = {end: i for i, end in enumerate(b_ends)}
    groups, a, b = [], 0, 0
    for end in sorted(a_at.keys() & b_at.keys()):
        groups.append((a, a_at[end] + 1, b, b_at[end] + 1))
        a, b = a_at[end] + 1, b_at[end] + 1
    return groups


def links_of(group: tuple[int, int, int, int], a_ends: list[int], b_ends: list[int]) -> list[tuple[int, int]]:
    """The pairs of token indices of a group whose bytes overlap."""
    a, a_stop, b, b_stop = group
    found = []
    while a < a_stop and b < b_stop:
        found.append((a, b))
        # within a group the two ends differ, but for its last tokens
        if a_ends[a] <= b_ends[b]:
            a += 1
        else:
            b += 1
    return found


class Aligner:
    """Both tokenizers and what is known of the parts of texts."""

    def __init__(self, a_content: str, b_content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_content)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_content)
        letters = byte_letters()
        self.a_bytes = {i: bytes(letters[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.b_bytes = {}
        self.n_b = self.b.get_piece_size()
        for i in range(self.n_b):
            piece = self.b.id_to_piece(i)
            self.b_bytes[i] = bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
        # how far a text's number is shifted to sort pairs by text
        self.shift = (self.n_b * (max(self.a_bytes) + 1)).bit_length()
        own = [t.decode("utf-8", "replace") for t in [*self.a_bytes.values(), *self.b_bytes.values()]]
        self.cuts = not any(map(SPANNING.search, own))
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.chars = 0
        self.numbers = np.zeros((0, 5), np.int64)  # ok, n_a, n_b, n_groups, n_links
        self.shown: list[str] = []
        self.pairs = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.recent = np.zeros(0, np.int64)

    def keep_recent(self) -> None:
        """Forget all parts but those of the last texts."""
        names, kept = list(self.at), self.recent.tolist()
        sizes, place = self.numbers[self.recent, 4], self._places(self.recent)
        self.at = {names[i]: k for k, i in enumerate(kept)}
        self.chars = sum(map(len, self.at))
        self.numbers, self.pairs, self.starts = self.numbers[self.recent], self.pairs[place], np.cumsum(sizes) - sizes
        self.shown = [self.shown[i] for i in kept]
        self.recent = np.arange(len(kept))

    def _places(self, parts: np.ndarray) -> np.ndarray:
        """Where the pairs of these parts lie, part after part."""
        sizes = self.numbers[parts, 4]
        return np.arange(sizes.sum()) + np.repeat(self.starts[parts] - np.cumsum(sizes) + sizes, sizes)

    def split(self, text: str) -> list[str]:
        """Parts of a text with a blank before it; none of an empty one."""
        if not text:
            return []
        return PART.findall(" " + text) if self.cuts else [" " + text]

    def _align(self, part: str, a: list[int], b: list[int]) -> tuple[tuple[int, ...], str, list[int]]:
        a_parts, b_parts = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
        wanted = part.encode()
        if b"".join(a_parts) != wanted or b"".join(b_parts) != wanted:
            return (0, 0, 0, 0, 0), "", []
        if len(a) == len(b) == 1:
            return (1, 1, 1, 1, 1), f"{a[0]}|{b[0]}", [a[0] * self.n_b + b[0]]
        a_ends, b_ends = list(accumulate(map(len, a_parts))), list(accumulate(map(len, b_parts)))
        groups = slice_at_shared_ends(a_ends, b_ends)
        a_shown, b_shown = list(map(str, a)), list(map(str, b))
        shown = ";".join([",".join(a_shown[g[0] : g[1]]) + "|" + ",".join(b_shown[g[2] : g[3]]) for g in groups])
        links = [a[i] * self.n_b + b[j] for g in groups for i, j in links_of(g, a_ends, b_ends)]
        return (1, len(a), len(b), len(groups), len(links)), shown, links

    def b_ids(self, parts: list[str]) -> list[list[int]]:
        """Ids as within a text: the library's own blank stands for that of a part, or is taken
        away with a line end, which no other token joins."""
        led = [p[0] == " " for p in parts]
        found = self.b.encode([p[1:] if own else "\n" + p for p, own in zip(parts, led)], num_threads=1)
        return [ids if own else ids[2:] for ids, own in zip(found, led)]

    def learn(self, parts: set[str]) -> None:
        new = list(parts.difference(self.at))
        if not new:
            return
        a = self.a.encode_batch_fast(new, add_special_tokens=False)
        first = len(self.at)
        made = [self._align(p, x.ids, y) for p, x, y in zip(new, a, self.b_ids(new))]
        self.at.update(zip(new, range(first, first + len(new))))
        self.chars += sum(map(len, new))
        sizes = np.array([len(m[2]) for m in made])
        self.starts = np.concatenate([self.starts, len(self.pairs) + np.cumsum(sizes) - sizes])
        self.numbers = np.concatenate([self.numbers, np.array([m[0] for m in made], np.int64)])
        self.shown += [m[1] for m in made]
        self.pairs = np.concatenate([self.pairs, np.fromiter(chain.from_iterable(m[2] for m in made), np.int64, int(sizes.sum()))])

    def many(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of each text (n_a, n_b, n_groups, n_links) and its groups; of each pair that a
        text holds: the text, the pair, and how often."""
        if len(self.at) > MEMO_PARTS or self.chars > MEMO_CHARS:
            self.keep_recent()
            if self.chars > MEMO_CHARS // 2:
                self.forget()
        split = [self.split(t) for t in texts]
        self.learn(set().union(*split))
        at = [np.fromiter(map(self.at.__getitem__, s), np.int64, len(s)) for s in split]
        fine = np.array([bool(len(x)) and bool(self.numbers[x, 0].all()) for x in at], bool)
        at = [x if ok else x[:0] for x, ok in zip(at, fine)]
        flat, owner = np.concatenate([np.zeros(0, np.int64), *at]), np.repeat(np.arange(len(at)), [len(x) for x in at])
        numbers = np.zeros((len(texts), 4), np.int64)
        for k in range(4):
            numbers[:, k] = np.bincount(owner, self.numbers[flat, k + 1], len(texts))
        shown = [";".join(map(self.shown.__getitem__, x.tolist())) for x in at]
        # all pairs of all parts in a row, then each pair of a text once
        sizes = self.numbers[flat, 4]
        self.recent = np.unique(flat)
        sorted_pairs = np.sort(np.repeat(owner, sizes) << self.shift | self.pairs[self._places(flat)])
        new = np.ones(len(sorted_pairs), bool)
        new[1:] = sorted_pairs[1:] != sorted_pairs[:-1]
        where = np.flatnonzero(new)
        each = sorted_pairs[where]
        return numbers, shown, each >> self.shift, each & ((1 << self.shift) - 1), np.diff(np.append(where, len(sorted_pairs)))


_aligners: dict[int, Aligner] = {}


def _aligner(a_content: str, b_content: bytes) -> Aligner:
    """One aligner for each worker process, so that its memo outlives a batch."""
    key = hash((a_content, b_content))
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(a_content, b_content)
    return _aligners[key]


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _lists(owner: np.ndarray, values: np.ndarray, rows: int, kind: pa.DataType) -> pa.ListArray:
    ends = np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values).cast(kind))


def sizes_of(a_file: str, b_file: str) -> tuple[int, int]:
    """How many ids each tokenizer has."""
    import sentencepiece
    from tokenizers import Tokenizer

    return (
        Tokenizer.from_str(read_ranks(a_file).decode()).get_vocab_size(),
        sentencepiece.SentencePieceProcessor(model_file=b_file).get_piece_size(),
    )


def align(docs: DataFrame, a_file: str, b_file: str, out: str = "aligned", text: str = "text", digest: bool = False) -> DataFrame:
    """Append a struct: the numbers of tokens, groups and links, ``groups`` as
    ``a1,a2|b1;a3|b2,b3`` (ids in order; its SHA-256 with ``digest``, '' without tokens), and the
    id pairs ``pairs`` (``a id * size of B + b id``) with how often each is linked, ``times``."""
    context = docs.sparkSession.sparkContext
    a_content, b_content = context.broadcast(read_ranks(a_file).decode()), context.broadcast(read_ranks(b_file))
    n_a, n_b = sizes_of(a_file, b_file)
    wide = n_a * n_b >= 1 << 31

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        numbers, shown, owner, pair, times = _aligner(a_content.value, b_content.value).many(texts_of(batch))
        if digest:
            shown = [s and hashlib.sha256(s.encode()).hexdigest() for s in shown]
        rows = batch.num_rows
        columns = [*[pa.array(numbers[:, k]) for k in range(4)], pa.array(shown, pa.string())]
        columns += [_lists(owner, pair, rows, pa.int64() if wide else pa.int32()), _lists(owner, times, rows, pa.int32())]
        return {"0a": pa.StructArray.from_arrays(columns, names=[*NUMBERS, "groups", "pairs", "times"])}

    fields = [T.StructField(n, T.LongType()) for n in NUMBERS] + [T.StructField("groups", T.StringType())]
    fields += [T.StructField("pairs", T.ArrayType(T.LongType() if wide else T.IntegerType())), T.StructField("times", T.ArrayType(T.IntegerType()))]
    made = per_row(docs, [F.col(f"`{text}`")], work, [T.StructField("0a", T.StructType(fields))])
    return made.withColumnRenamed("0a", out)


def pair_counts(aligned: DataFrame, out: str = "aligned") -> DataFrame:
    """(pair, n): in how many documents each pair of ids is linked."""

    def summed(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        values, back = np.unique(np.concatenate(pairs), return_inverse=True)
        return values, np.bincount(back, np.concatenate(counts), len(values)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["pair", "n"]
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in slices(batches):
            own = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            own, n = np.unique(own, return_counts=True)
            pairs, counts = summed([pairs, own], [counts, n])
            if len(pairs) >= PAIRS_AT_ONCE:
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=names)
                pairs, counts = pairs[:0], counts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=names)

    made = aligned.select(F.col(f"`{out}`.pairs").alias("pairs")).mapInArrow(run, "pair long, n long")
    return made.groupBy("pair").agg(F.sum("n").alias("n"))


def _head_cut(counts: DataFrame, head: int) -> int:
    """The least count of which, with all larger ones, there are at most ``head`` pairs."""
    # steps of 2 % of a count: some thousand rows at any size
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.02))).cast("int")
    rows = counts.groupBy(step.alias("step")).agg(F.count("*").alias("pairs"), F.min("n").alias("least"))
    cut, total = None, 0
    for r in sorted(rows.collect(), key=lambda r: -r.step):
        total += r.pairs
        if total > head:
            break
        cut = r.least
    return cut if cut is not None else (1 << 62)


def link_statistics(
    docs: DataFrame, a_file: str, b_file: str, out: str = "aligned", text: str = "text",
    carry: list[str] | None = None, digest: bool = True, head: int = HEAD,
) -> DataFrame:
    """Append the numbers of ``align`` and, from the counts of all documents, ``n_best`` (links whose
    pair is the most frequent of its A id, ties included) and ``count_sum`` (over links).

    ``carry`` names the columns to return, all but the text by default.
    """
    session = docs.sparkSession
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    key = free_name(docs, "row")
    made = align(docs, a_file, b_file, out, text, digest).select(*[F.col(f"`{c}`") for c in [*carry, out]])
    aligned = stored(made.withColumn(key, F.monotonically_increasing_id()), "aligned")
    _, n_b = sizes_of(a_file, b_file)
    a_id = F.floor(F.col("pair") / n_b).cast("long").alias("a")
    counts = stored(pair_counts(aligned, out).select("pair", "n", a_id), "pair-counts")
    # one row for each A id
    best = counts.groupBy("a").agg(F.max("n").alias("most"))
    best_rows = best.toArrow()
    most = np.zeros(max(best_rows["a"].to_pylist(), default=0) + 1, np.int64)
    most[best_rows["a"].to_numpy()] = best_rows["most"].to_numpy()
    cut = _head_cut(counts, head)
    top = counts.where(F.col("n") >= cut).select("pair", "n").toArrow().sort_by("pair")
    ship = session.sparkContext.broadcast((top["pair"].to_numpy(), top["n"].to_numpy(), most))

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        pairs, n, most = ship.value
        rows = batch.num_rows
        own, times = (batch.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in ("0", "1"))
        owner = np.repeat(np.arange(rows), batch.column("0").value_lengths().to_numpy(zero_copy_only=False))
        at = np.searchsorted(pairs, own)
        known = np.zeros(len(own), bool)
        inside = at < len(pairs)
        known[inside] = pairs[at[inside]] == own[inside]
        found = np.zeros(len(own), np.int64)
        found[known] = n[at[known]]
        sums = [np.bincount(owner, w, rows).astype(np.int64) for w in (times * (known & (found == most[own // n_b])), times * found)]
        rest = ~known
        rare = [_lists(owner[rest], values[rest], rows, pa.int64()) for values in (own, times)]
        return {"0l": pa.StructArray.from_arrays([*map(pa.array, sums), *rare], names=["n_best", "count_sum", "pairs", "times"])}

    long, longs = T.LongType(), T.ArrayType(T.LongType())
    kind = T.StructType([T.StructField(c, t) for c, t in (("n_best", long), ("count_sum", long), ("pairs", longs), ("times", longs))])
    slim = F.struct(*[F.col(f"`{out}`.{c}").alias(c) for c in [*NUMBERS, "groups"]]).alias(out)
    looked = stored(
        per_row(
            aligned, [F.col(f"`{out}`.pairs"), F.col(f"`{out}`.times")], work, [T.StructField("0l", kind)],
            carry=[*[F.col(f"`{c}`") for c in carry], F.col(key), slim],
        ),
        "looked-up",
    )
    zipped = F.arrays_zip(F.col("`0l`.pairs").alias("pair"), F.col("`0l`.times").alias("times"))
    rare = looked.select(F.col(key).alias("0row"), F.explode(zipped).alias("p")).select("0row", "p.pair", "p.times")
    # the table of A ids is bounded by the vocabulary
    less = counts.where(F.col("n") < cut).join(F.broadcast(best), "a").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("is_best"))
    sums = rare.join(less, "pair").groupBy("0row").agg(
        F.sum(F.col("times") * F.col("is_best")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    joined = looked.join(sums, F.col(key) == F.col("0row"), "left")
    added = F.struct(
        F.col(f"`{out}`.*"),
        (F.col("`0l`.n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("`0l`.count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )
    return joined.select(*[looked[f"`{c}`"] for c in carry], added.alias(out))
