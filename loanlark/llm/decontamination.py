"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items and texts are lower-cased (A-Z) and reduced to words of digits, letters and all
non-ASCII characters. The automaton of all items (a block of at most ``BLOCK_WORDS`` words at
a time, so that what is broadcast and built has a bound) is fed the words of each text; the
length of the longest match that ends at a word is tracked. A word is hit if the match ending
at it, or at a later word over it, reaches ``window`` words, or covers a whole shorter item.

Defined results: null, empty and wordless texts have no words and no hits; null and wordless
items match nothing; repeated items count once for each id; item ids may be of any type that
casts to string, and null ids are left out; other columns pass through, whatever their names.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlark.llm.common import free_name, per_row, stored, texts_of

WINDOW = 10
BLOCK_WORDS = 200_000
#: Blocks searched before the result so far is stored: each has a worker with its automaton.
BLOCKS_IN_PASS = 4

#: Bytes that are no word characters become blanks, capitals become small letters.
TO_WORDS = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(TO_WORDS).split()


class Automaton:
    """Suffix automaton over the word sequences of many items."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.word: dict[bytes, int] = {}
        self.go: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[set[int]] = [set()]
        whole: dict[int, set[int]] = defaultdict(set)
        self.names = [name for name, _ in items]
        self.shortest = window
        for number, (_, words) in enumerate(items):
            codes = [self.word.setdefault(w, len(self.word)) for w in words]
            state = 0
            for code in codes:
                state = self._add(state, code)
            # every prefix of the item is an end position of its state
            at = 0
            for k, code in enumerate(codes):
                at = self.go[at][code]
                while len(ends) < len(self.length):
                    ends.append(set())
                ends[at].add(number)
            if 0 < len(codes) < window:
                whole[at].add(number)
                self.shortest = min(self.shortest, len(codes))
        while len(ends) < len(self.length):
            ends.append(set())
        # an item that holds a state's strings holds those of its suffix link
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0 and self.length[self.link[s]] >= window:
                ends[self.link[s]] |= ends[s]
        self.short: list[tuple[tuple[int, int], ...]] = [()] * len(self.length)
        self.long: list[frozenset[int] | None] = [None] * len(self.length)
        sizes = [len(w) for _, w in items]
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            up = self.link[s]
            self.short[s] = self.short[up] + tuple((sizes[i], i) for i in whole.get(s, ()))
            if self.length[s] >= window:
                # the last window's own state: the first link upwards that is still so long
                self.long[s] = self.long[up] if self.length[up] >= window else frozenset(ends[s])

    def _add(self, last: int, code: int) -> int:
        """Extend the string of ``last`` by a word; states of earlier items are reused."""
        known = self.go[last].get(code)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, known, code)
        state = self._state({}, self.length[last] + 1, 0)
        while last >= 0 and code not in self.go[last]:
            self.go[last][code] = state
            last = self.link[last]
        if last >= 0:
            target = self.go[last][code]
            exact = self.length[target] == self.length[last] + 1
            self.link[state] = target if exact else self._split(last, target, code)
        return state

    def _state(self, go: dict[int, int], length: int, link: int) -> int:
        self.go.append(go)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, last: int, target: int, code: int) -> int:
        """A state of its own for the target's strings up to the length reached."""
        copy = self._state(dict(self.go[target]), self.length[last] + 1, self.link[target])
        self.link[target] = copy
        while last >= 0 and self.go[last].get(code) == target:
            self.go[last][code] = copy
            last = self.link[last]
        return copy

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit spans of words (start, stop), in order of their ends, and the items found."""
        codes = np.fromiter(map(self.word.get, words, repeat(-1)), np.int64, len(words))
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        # a match lies within a run of known words: only runs that can hold one are followed
        edges = np.flatnonzero(np.diff(np.concatenate([[0], codes >= 0, [0]])))
        go, link, length, window = self.go, self.link, self.length, self.window
        for begin, end in zip(edges[0::2].tolist(), edges[1::2].tolist()):
            if end - begin < self.shortest:
                continue
            state = size = 0
            for at, code in enumerate(codes[begin:end].tolist(), begin + 1):
                while state and code not in go[state]:
                    state = link[state]
                    size = length[state]
                state = go[state].get(code, 0)
                size = size + 1 if state else 0
                if size >= window:
                    spans.append((at - window, at))
                    items |= self.long[state]
                for whole, item in self.short[state]:
                    if whole <= size:
                        spans.append((at - whole, at))
                        items.add(item)
        return spans, items


_automata: dict[int, Automaton] = {}


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
])
FOUND_ARROW = pa.struct([
    ("n_words", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
    ("items", pa.list_(pa.string())),
])


def find(docs: DataFrame, items: DataFrame, out: str, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """Append a struct: ``n_words``, the merged hit ``spans`` of words, and ``items`` found.

    Benchmarks of more than a block are searched block by block in the same pass over the
    texts, each step adding to what the one before has found.
    """
    spark = docs.sparkSession
    given = items.select(F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{item_text}`").alias("text")).where("id is not null and text is not null")
    size = given.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // (2 * BLOCK_WORDS)))  # a word and its border are two characters at least
    found = docs
    step = None
    for b in range(blocks):
        part = given.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).orderBy("id", "text")
        shipped = spark.sparkContext.broadcast([(r.id, r.text) for r in part.toLocalIterator()])
        name = free_name(found, out if b == blocks - 1 else f"found{b}")
        before = F.lit(None) if step is None else F.col(f"`{step}`")
        found = per_row(found, [F.col(f"`{text}`"), before.cast(FOUND)], _searcher(shipped, window, name), [T.StructField(name, FOUND)])
        if step is not None:
            found = found.drop(step)
        step = name
        if b % BLOCKS_IN_PASS == BLOCKS_IN_PASS - 1 and b < blocks - 1:
            found = stored(found, "decontaminated")
    return found


def _searcher(shipped, window: int, name: str):
    uid = uuid.uuid4().hex

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        key = hash((uid, window))
        if key not in _automata:
            _automata.clear()
            _automata[key] = Automaton([(i, words_of(t)) for i, t in shipped.value], window)
        automaton, rows = _automata[key], []
        for text, had in zip(texts_of(batch), batch.column("1").to_pylist()):
            words = words_of(text)
            spans, items = automaton.search(words)
            names = {automaton.names[i] for i in items}
            if had:
                spans = chain(spans, ((s["start"], s["stop"]) for s in had["spans"]))
                names |= set(had["items"])
            rows.append({"n_words": len(words), "spans": [{"start": a, "stop": b} for a, b in _merged(list(spans))], "items": sorted(names)})
        return {name: pa.array(rows, FOUND_ARROW)}

    return work


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and what stands between them."""
    if not spans:
        return text
    raw = text.encode()
    plain = np.frombuffer(raw.translate(TO_WORDS), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[False], plain, [False]]).astype(np.int8)))
    begins, ends = edges[0::2], edges[1::2]
    kept, at = [], 0
    for a, b in spans:
        kept.append(raw[at : begins[a]])
        at = ends[b - 1]
    return b"".join([*kept, raw[at:]]).decode()


def remove(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents with all hit spans cut out of their texts."""
    name, cut = free_name(docs, "found"), free_name(docs, "cut")
    found = find(docs, items, name, text=text, **options)

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        rows = zip(batch.column("0").to_pylist(), batch.column("1").to_pylist())
        return {cut: pa.array([t and _cut(t, [(s["start"], s["stop"]) for s in spans or ()]) for t, spans in rows], pa.string())}

    made = per_row(found, [F.col(f"`{text}`"), F.col(f"`{name}`.spans")], work, [T.StructField(cut, T.StringType())])
    return made.withColumn(text, F.col(f"`{cut}`")).drop(name, cut)
