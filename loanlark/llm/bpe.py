"""Byte-level BPE by prefix dynamic programming.

For a byte string, BPE of each prefix ends in exactly one token. ``last[i]`` holds it for the
prefix of ``i + 1`` bytes: the token ``t`` that ends there and may stand after the last token
of the prefix before it, that is, whose pair BPE leaves as it is. Walking back over ``last``
gives the encoding. An entry depends on at most the longest token's number of entries before
it, so bytes can be appended by adding entries, and after an edit only entries up to the
point where the old ones repeat are computed anew.

Defined results: null and empty texts give no tokens and empty bytes; repeated rows are each
encoded; null ids decode to null; other columns pass through, but for one of the output's own name, which
gives way to it.
"""

from __future__ import annotations

import base64
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlark.llm.common import free_name, in_portions, per_row, texts_of

#: Pieces that a worker remembers, and how many it handles at a time.
MEMO_WORDS = 500_000
PIECES_AT_ONCE = 100_000
MEMO_PAIRS = 300_000
#: Longest piece in bytes that is encoded side by side with others.
SIDE_BY_SIDE = 48

#: Unicode White_Space, which the pattern's \s means.
SPACE = r"\t-\r \x85\xa0  -     　"

#: An edit looks at most so many characters back: the pattern's longest look-ahead.
LOOK = 3


def read_ranks(path: str) -> bytes:
    """The rank file's content, to be shipped to the workers (about a megabyte)."""
    with open(path, "rb") as f:
        return f.read()


#: Stands for the token before the first.
START = ((1 << 24) - 1) << 24


class Memo(dict):
    """A dictionary that computes missing entries and never outgrows twice its limit.

    When full, it starts anew and takes over what it is asked for again.
    """

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.before = compute, limit, {}

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.before = dict(self)
            self.clear()
        value = self.before.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value


class Lookup:
    """Tokens by a 64-bit key of their bytes, for many strings at once.

    The key grows to the left, so the strings that end at a place are tried from the
    shortest on; ``may_go_on`` tells whether any token ends in the string.
    """

    SLOTS, MARKS = 18, 22

    def __init__(self, ranks: dict[bytes, int]):
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        longest = max(map(len, ranks))
        factor = 0x9E3779B97F4A7C15
        self.power = np.array([pow(factor, k + 1, 1 << 64) for k in range(longest)], np.uint64)
        tails: set[int] = set()
        keys = {}
        for token, i in ranks.items():
            key = 0
            for k, byte in enumerate(reversed(token)):
                key = (key + int(self.power[k]) * (byte + 1)) & ((1 << 64) - 1)
                if k < len(token) - 1:
                    tails.add(key)
            keys[i], self.size[i] = key, len(token)
        if len(set(keys.values())) < len(keys):
            raise ValueError("two tokens share a key")
        self.mark = np.zeros(1 << self.MARKS, bool)
        self.mark[self._slot(np.array(sorted(tails), np.uint64), 1, self.MARKS)] = True
        self.tables, left = [], np.array(sorted(keys), np.int64)
        own = np.array([keys[i] for i in left.tolist()], np.uint64)
        while len(left):
            slot = self._slot(own, 2 * len(self.tables) + 3, self.SLOTS)
            ids, full = np.full(1 << self.SLOTS, -1, np.int64), np.zeros(1 << self.SLOTS, np.uint64)
            ids[slot], full[slot] = left, own
            self.tables.append((ids, full))
            rest = ids[slot] != left
            left, own = left[rest], own[rest]

    @staticmethod
    def _slot(key: np.ndarray, salt: int, bits: int) -> np.ndarray:
        mixed = (key ^ (key >> np.uint64(29))) * np.uint64((0xBF58476D1CE4E5B9 * salt) & ((1 << 64) - 1) | 1)
        return (mixed >> np.uint64(64 - bits)).astype(np.int64)

    def may_go_on(self, key: np.ndarray) -> np.ndarray:
        return self.mark[self._slot(key, 1, self.MARKS)]

    def find(self, key: np.ndarray) -> np.ndarray:
        """The token of each key, or -1."""
        found = np.full(len(key), -1, np.int64)
        at = np.arange(len(key))
        for n, (ids, full) in enumerate(self.tables):
            slot = self._slot(key[at], 2 * n + 3, self.SLOTS)
            same = full[slot] == key[at]
            found[at[same]] = ids[slot[same]]
            at = at[~same & (ids[slot] >= 0)]
            if not len(at):
                break
        return found


class PrefixBpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.token = {i: b for b, i in ranks.items()}
        self.spelled: pa.Array | None = None
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))
        # white space bounds every match but for one leading blank, so such pieces can be
        # looked up whole; the pattern splits a piece as it does within the text
        self.pieces = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")
        self.fits = Memo(self._fits, MEMO_PAIRS)
        # of each known piece its number, and by that where its ids lie
        self.at: dict[str, int] = {}
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)
        self.lookup = Lookup(ranks)

    @classmethod
    def from_file(cls, content: bytes, pattern: str) -> PrefixBpe:
        rows = (line.split() for line in content.splitlines() if line.strip())
        return cls({base64.b64decode(a): int(b) for a, b in rows}, pattern)

    def merged(self, piece: bytes) -> list[int]:
        """BPE by its definition: join the pair of lowest rank, leftmost first."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _fits(self, key: int) -> bool:
        """Whether a token may follow another (or, after the mark, start a string)."""
        before, token = divmod(key, 1 << 24)
        if before == START >> 24:
            return self.merged(self.token[token]) == [token]
        return self.merged(self.token[before] + self.token[token]) == [before, token]

    def extend(self, piece: bytes, last: list[int], upto: int | None = None) -> list[int]:
        """Add the entries of ``last`` that ``piece`` lacks."""
        get, known, longest = self.ranks.get, self.fits.get, self.longest
        for i in range(len(last) + 1, (len(piece) if upto is None else upto) + 1):
            for start in range(i - longest if i > longest else 0, i):
                token = get(piece[start:i])
                if token is not None:
                    key = (last[start - 1] << 24 | token) if start else (START | token)
                    fit = known(key)
                    if fit or fit is None and self.fits[key]:
                        last.append(token)
                        break
            else:
                raise ValueError("the ranks lack a single byte")
        return last

    def edit(self, piece: bytes, last: list[int], start: int, stop: int, new: bytes):
        """Replace ``piece[start:stop]``; returns the new bytes, entries and how many of
        them were computed."""
        changed = piece[:start] + new + piece[stop:]
        shift = len(changed) - len(piece)
        fresh, same = last[:start], 0
        first = len(fresh)
        for i in range(first + 1, len(changed) + 1):
            self.extend(changed, fresh, i)
            old = i - shift
            same = same + 1 if old > stop and last[old - 1] == fresh[-1] else 0
            if same >= self.longest:
                computed = len(fresh) - first
                return changed, fresh + last[old:], computed
        return changed, fresh, len(fresh) - first

    def walk(self, last: list[int]) -> list[int]:
        ids, at = [], len(last)
        while at:
            ids.append(last[at - 1])
            at -= len(self.token[ids[-1]])
        return ids[::-1]

    def _piece(self, match: str) -> tuple[int, ...]:
        piece = match.encode()
        whole = self.ranks.get(piece)
        return (whole,) if whole is not None else tuple(self.walk(self.extend(piece, [])))

    def split(self, word: str) -> list[str]:
        """The pattern's matches within a piece between white space."""
        # letters after an optional blank are one match, a final mark a second
        if word[0] == " " or word[0].isalpha():
            if word[1:].isalpha():
                return [word]
            if word[-1] in ".,!?;:" and word[1:-1].isalpha():
                return [word[:-1], word[-1]]
        return self.pattern.findall(word)

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's end."""
        parts, ends = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
        split = [self.pieces.findall(t) for t in texts]
        for begin, end in in_portions([len(s) for s in split], PIECES_AT_ONCE):
            own = split[begin:end]
            self._learn(set().union(*own))
            counts = [len(s) for s in own]
            at = np.fromiter(map(self.at.__getitem__, chain.from_iterable(own)), np.int64, sum(counts))
            self.uses[np.unique(at)] += 1
            parts.append(self.flat[self._places(at)])
            # where the ids of each text end, by those of its pieces
            upto = np.concatenate([[0], np.cumsum(self.sizes[at])])
            ends.append(ends[-1][-1] + upto[np.cumsum(counts)])
        return np.concatenate(parts), np.concatenate(ends)

    def _places(self, at: np.ndarray) -> np.ndarray:
        """Where the ids of these pieces lie, piece after piece."""
        sizes = self.sizes[at]
        return np.arange(sizes.sum()) + np.repeat(self.starts[at] - np.cumsum(sizes) + sizes, sizes)

    def _keep_common(self) -> None:
        """Forget all pieces but the half at most that came up in most portions, in two at least."""
        least = 2
        while (self.uses >= least).sum() > MEMO_WORDS // 2:
            least += 1
        kept = np.flatnonzero(self.uses >= least)
        names = list(self.at)
        self.flat, self.sizes = self.flat[self._places(kept)], self.sizes[kept]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.at = {names[i]: k for k, i in enumerate(kept.tolist())}
        self.uses = np.zeros(len(kept), np.int64)

    def _learn(self, words: set[str]) -> None:
        """Bring words into the memo; what it lacks is encoded all at once."""
        if len(self.at) + len(words) > MEMO_WORDS:
            self._keep_common()
        known = self.at
        lacking = list(words.difference(known))
        if not lacking:
            return
        matches = [self.split(w) for w in lacking]
        # a word without its mark may be known as a piece of its own, and is from now on
        found: dict[str, tuple[int, ...]] = {}
        new = []
        for m in set(chain.from_iterable(matches)):
            i = known.get(m)
            if i is None:
                new.append(m)
            else:
                found[m] = tuple(self.flat[self.starts[i] : self.starts[i] + self.sizes[i]].tolist())
        found.update(zip(new, self.many([m.encode() for m in new])))
        made = dict(zip(lacking, [found[own[0]] if len(own) == 1 else tuple(chain.from_iterable(map(found.__getitem__, own))) for own in matches]))
        made.update((m, found[m]) for m in new if m[-1].isalpha())
        sizes = np.fromiter(map(len, made.values()), np.int64, len(made))
        known.update(zip(made, range(len(known), len(known) + len(made))))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.uses = np.concatenate([self.uses, np.zeros(len(made), np.int64)])
        self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(made.values()), np.int32, int(sizes.sum()))])

    def many(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Encode many pieces side by side: entry by entry of ``last``, for all at once."""
        out: list[tuple[int, ...]] = [()] * len(pieces)
        open_ones = []
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = (whole,)
            elif len(piece) > SIDE_BY_SIDE:
                out[i] = tuple(self.walk(self.extend(piece, [])))
            else:
                open_ones.append(i)
        if not open_ones:
            return out
        open_ones.sort(key=lambda i: -len(pieces[i]))
        sizes = np.array([len(pieces[i]) for i in open_ones])
        width = int(sizes[0])
        raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in open_ones), np.uint8).reshape(-1, width)
        last = np.zeros(raw.shape, np.int64)
        t = self.lookup
        for i in range(1, width + 1):
            rows = np.arange(np.searchsorted(-sizes, -i, "right"))
            key = np.zeros(len(rows), np.uint64)
            for start in range(i - 1, max(0, i - self.longest) - 1, -1):
                key = key + t.power[i - 1 - start] * (raw[rows, start].astype(np.uint64) + np.uint64(1))
                token = t.find(key)
                at = np.flatnonzero(token >= 0)
                if len(at):
                    before = last[rows[at], start - 1] if start else START >> 24
                    pairs, back = np.unique((before << 24) | token[at], return_inverse=True)
                    fit = np.fromiter(map(self.fits.__getitem__, pairs.tolist()), bool, len(pairs))[back]
                    at = at[fit]
                    last[rows[at], i - 1] = token[at]
                # a prefix has one last token: rows that have it are done
                going = t.may_go_on(key)
                going[at] = False
                rows, key = rows[going], key[going]
                if not len(rows):
                    break
        at, tokens = sizes.copy(), []
        rows = np.arange(len(sizes))
        while (at > 0).any():
            found = np.where(at > 0, last[rows, at - 1], -1)
            tokens.append(found)
            at = np.where(at > 0, at - t.size[found], 0)
        table = np.array(tokens[::-1]).T
        used = (table >= 0).sum(axis=1)
        for i, row, n in zip(open_ones, table.tolist(), used.tolist()):
            out[i] = tuple(row[-n:])
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))

    def decode_all(self, lists: pa.ListArray) -> pa.Array:
        """The bytes of every list of ids: all tokens are laid in a row, and a list's bytes end
        where its last token's do. Null lists are null."""
        if self.spelled is None:
            self.spelled = pa.array([self.token.get(i) for i in range(max(self.token) + 1)], pa.binary())
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        spelled = self.spelled.take(lists.flatten())
        if spelled.null_count:
            raise KeyError("an id without a token")
        if not len(spelled):
            return pa.array([b"" if there else None for there in lists.is_valid().to_pylist()], pa.binary())
        _, ends, content = spelled.buffers()
        at = np.frombuffer(ends, np.int32)[spelled.offset : spelled.offset + len(spelled) + 1]
        borders = at[np.concatenate([[0], np.cumsum(sizes)])].astype(np.int32)
        rows = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(borders), content])
        return pc.if_else(lists.is_valid(), rows, pa.scalar(None, pa.binary())) if lists.null_count else rows

    def replace(self, text: str, ids: list[int], start: int, stop: int, new: str):
        """Re-encode after replacing ``text[start:stop]``: only around the edit.

        Matches that end ``LOOK`` characters before the edit stay, and so does all from the
        first old match border behind the edit at which a new match begins.
        """
        changed = text[:start] + new + text[stop:]
        shift = len(changed) - len(text)
        old = [m.span() for m in self.pattern.finditer(text)]
        kept = 0
        while kept < len(old) and old[kept][1] <= start - LOOK:
            kept += 1
        begin = old[kept - 1][1] if kept else 0
        borders = {a for a, _ in old if a >= stop}
        middle, end = [], None
        for m in self.pattern.finditer(changed, begin):
            if m.start() - shift in borders and m.start() >= start + len(new):
                end = m.start() - shift
                break
            middle.extend(self._piece(m.group()))
        cut = _ids_before(self.token, ids, len(text[:begin].encode()))
        tail = ids[_ids_before(self.token, ids, len(text[:end].encode())) :] if end is not None else []
        return changed, ids[:cut] + middle + tail


def _ids_before(token: dict[int, bytes], ids: list[int], n_bytes: int) -> int:
    seen = count = 0
    while seen < n_bytes:
        seen += len(token[ids[count]])
        count += 1
    return count


_models: dict[tuple[int, str], PrefixBpe] = {}


def _model(content: bytes, pattern: str) -> PrefixBpe:
    """One model for each worker process, so that its memos outlive a batch."""
    key = (hash(content), pattern)
    if key not in _models:
        _models.clear()
        _models[key] = PrefixBpe.from_file(content, pattern)
    return _models[key]


def encode(docs: DataFrame, ranks_file: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Append the token ids of a text column as ``array<int>``."""
    content = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_file))

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        model = _model(content.value, pattern)
        flat, ends = model.encode_all(texts_of(batch))
        return {made: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))}

    made = free_name(docs, "0ids")
    found = per_row(docs, [F.col(f"`{text}`")], work, [T.StructField(made, T.ArrayType(T.IntegerType()))])
    return found.drop(F.col(f"`{ids}`")).withColumnRenamed(made, ids) if ids in docs.columns else found.withColumnRenamed(made, ids)


def decode(encoded: DataFrame, ranks_file: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Append the bytes that the ids stand for."""
    content = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_file))

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {made: _model(content.value, pattern).decode_all(batch.column("0"))}

    made = free_name(encoded, "0decoded")
    found = per_row(encoded, [F.col(f"`{ids}`")], work, [T.StructField(made, T.BinaryType())])
    return found.drop(F.col(f"`{out}`")).withColumnRenamed(made, out) if out in encoded.columns else found.withColumnRenamed(made, out)


def replace(
    encoded: DataFrame, ranks_file: str, pattern: str, start: Column, stop: Column, new: Column,
    text: str = "text", ids: str = "ids",
) -> DataFrame:
    """Replace a span of each text and bring its ids up to date around the edit only.

    ``start`` and ``stop`` count characters; both at the text's length append. Null or
    misplaced bounds are moved into the text.
    """
    content = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_file))

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        model = _model(content.value, pattern)
        out = []
        for i, t in enumerate(texts_of(batch)):
            had, a, b, n = (batch.column(str(k))[i].as_py() for k in range(1, 5))
            a = min(max(a or 0, 0), len(t))
            out.append(model.replace(t, had or [], a, min(max(b or 0, a), len(t)), n or ""))
        return {
            names[0]: pa.array([x[0] for x in out], pa.string()),
            names[1]: pa.array([x[1] for x in out], pa.list_(pa.int32())),
        }

    names = [free_name(encoded, "0text"), free_name(encoded, "0ids")]
    fields = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.ArrayType(T.IntegerType()))]
    inputs = [F.col(f"`{text}`"), F.col(f"`{ids}`"), start, stop, new]
    return (
        per_row(encoded, inputs, work, fields)
        .withColumns({text: F.col(f"`{names[0]}`"), ids: F.col(f"`{names[1]}`")})
        .drop(*names)
    )
