"""Personal data: pattern matches, and a skip-chain conditional random field that adds to them.

The field labels the tokens of a text that hold a digit, ``@`` or ``+``; all others carry no
evidence and are outside by definition, which cuts the chain at them exactly. Neighbouring
tokens are linked, and so are the consecutive places of equal or similar tokens (the same
letters and digits, or the same last seven digits), however far apart. Every place is also
linked to the first place of its key that is in a pattern match. Loopy sum-product messages run
over all links of a text until they settle, each text for itself; tokens in pattern matches are fixed to their kind, so
that a number or address written once in full, in one token or several, also marks its barer
copies. Tokens that would be a number of their own are never joined to one span. Weights are
fitted by pseudo-likelihood on ``SAMPLE`` different texts that hold evidence, in order of a hash
of the text. They are labelled by the pattern matches in the whole text; only then is the text
reduced to its evidence, of which it gives ``CLIP`` characters at most, so the sample that the
driver reads is bounded by ``SAMPLE`` x ``CLIP`` characters.

Defined results: null and empty texts have no spans; spans count code points, end
exclusive; repeated rows are each searched; other columns pass through, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlark.llm.common import per_row, slices, texts_of

KINDS = ["email", "ip", "card", "phone"]
LABELS = ["outside", *KINDS]
SAMPLE = 2_000
#: Characters of evidence that a sampled text gives to the fit.
CLIP = 2_048
STEPS = 300
#: Rounds of messages for a text that does not settle, and more for each of its tokens.
ROUNDS, ROUNDS_A_TOKEN = 100, 2
#: Least belief in a kind for a span of its own.
BELIEF = 0.8
#: Digits of a number by itself, and most digits of one: the kinds that may take several tokens.
DIGITS_OF = {2: (13, 19), 3: (9, 15)}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DIGITS = re.compile(r"[0-9]+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]*[0-9@+][^\x20\x09-\x0D]*")
EVIDENCE = re.compile(r"[0-9@+]")
BARE = re.compile(r"[^A-Za-z0-9]+")

Span = tuple[int, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Pattern matches (kind, start, end), by kind and start.

    Each kind's matches can only begin where a run of its first characters does, so only
    those places are tried and the work is linear in the text.
    """
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        m = DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            out.append((0, begin, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    runs = [m.start() for m in DIGITS.finditer(text)]
    for kind, pattern, valid in ((1, IP, _valid_ip), (2, CARD, _valid_card)):
        done = 0
        for at in runs:
            if at >= done and (m := pattern.match(text, at)):
                done = m.end()
                if valid(m.group()):
                    out.append((kind, at, done))
    done, at = 0, text.find("+") if runs else -1
    while at >= 0:
        m = PHONE.match(text, at)
        if m:
            done = m.end()
            if 9 <= sum(map(len, DIGITS.findall(m.group()))) <= 15:
                out.append((3, at, done))
        at = text.find("+", max(at + 1, done))
    return out


def _valid_ip(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))


def _valid_card(found: str) -> bool:
    digits = found.replace(" ", "").replace("-", "")
    return 13 <= len(digits) <= 19 and _luhn(digits)


class Graph:
    """Evidence tokens of some texts, their features, links and fixed labels."""

    def __init__(self, texts: list[str], bases: list[list[Span]]):
        self.places: list[tuple[int, int, int]] = []
        self.fixed: list[int] = []
        features: list[list[float]] = []
        chain: list[tuple[int, int]] = []
        skip: list[tuple[int, int]] = []
        for n, (text, base) in enumerate(zip(texts, bases)):
            seen: dict[str, int] = {}
            known: dict[str, int] = {}
            named: list[tuple[int, set[str], set[int]]] = []
            last_end = -1
            ordered = sorted(base, key=lambda s: (s[1], s[0]))
            at = 0
            reach: list[Span] = []
            for m in TOKEN.finditer(text):
                begin, end = m.span()
                while at < len(ordered) and ordered[at][1] < end:
                    reach.append(ordered[at])
                    at += 1
                reach = [s for s in reach if s[2] > begin]
                i = len(self.places)
                self.places.append((n, begin, end))
                self.fixed.append(1 + min(s[0] for s in reach) if reach else 0)
                features.append(_features(text, begin, end, m.group()))
                if last_end >= 0 and begin - last_end == 1:
                    chain.append((i - 1, i))
                last_end = end
                bare = BARE.sub("", m.group()).lower()
                digits = "".join(DIGITS.findall(m.group()))
                keys = {bare} if len(bare) >= 5 else set()
                if len(digits) >= 7:
                    keys.add("#" + digits[-7:])
                # the first token of a number in several answers for the number
                for kind, start, stop in reach:
                    if kind in DIGITS_OF and start >= begin:
                        whole = "".join(DIGITS.findall(text[start:stop]))
                        keys |= {whole, "#" + whole[-7:]}
                linked = {seen[k] for k in keys if k in seen}
                skip += [(j, i) for j in linked]
                seen.update(dict.fromkeys(keys, i))
                if self.fixed[i]:
                    for key in keys:
                        known.setdefault(key, i)
                named.append((i, keys, linked))
            # the place after a fixed one is linked to it already, and so is the one before it
            fixed = set(known.values())
            before = {(j, i) for i, _, linked in named for j in linked if i in fixed} if known else set()
            for i, keys, linked in named if known else ():
                hubs = {known[k] for k in keys if k in known} - linked - {i}
                skip += [(h, i) for h in sorted(hubs) if not self.fixed[i] and (i, h) not in before]
        self.features = np.array(features, np.float64).reshape(len(features), N_FEATURES)
        self.labels = np.array(self.fixed, np.int64)
        self.edges = np.array(chain + skip, np.int64).reshape(-1, 2)
        self.owner = np.array([p[0] for p in self.places], np.int64)
        self.is_skip = np.arange(len(self.edges)) >= len(chain)


N_FEATURES = 23


def _features(text: str, begin: int, end: int, token: str) -> list[float]:
    n = sum(map(len, DIGITS.findall(token)))
    dots = token.count(".")
    before, after = text[begin - 1 : begin], text[end : end + 1]
    return [
        1.0, "@" in token, token[0] == "+", "(" in token or ")" in token, "-" in token, "=" in token or ":" in token,
        n == 0, 1 <= n <= 3, 4 <= n <= 6, n in (7, 8), 9 <= n <= 12, 13 <= n <= 15, 16 <= n <= 19, n > 19,
        dots == 0, dots in (1, 2), dots == 3, dots > 3, any(c.isalpha() for c in token), len(token) == n,
        13 <= n <= 19 and _luhn("".join(DIGITS.findall(token))),
        before == "\n" or not before, after == "\n" or not after,
    ]


class Field:
    """Weights: features by label, label pairs of neighbours, agreement over skip links."""

    def __init__(self, unary: np.ndarray, pair: np.ndarray, agree: np.ndarray):
        self.unary, self.pair, self.agree = unary, pair, agree

    @classmethod
    def fit(cls, graph: Graph) -> Field:
        """Pseudo-likelihood by gradient steps with per-weight rates."""
        k = len(LABELS)
        field = cls(np.zeros((N_FEATURES, k)), np.zeros((k, k)), np.full(k, 0.5))
        if not len(graph.labels):
            return field
        y, n = graph.labels, len(graph.labels)
        one = np.eye(k)[y]
        a, b = graph.edges[~graph.is_skip].T
        c, d = graph.edges[graph.is_skip].T
        sums = [np.full(w.shape, 1e-8) for w in (field.unary, field.pair, field.agree)]
        for _ in range(STEPS):
            score = graph.features @ field.unary
            np.add.at(score, b, field.pair[y[a]])
            np.add.at(score, a, field.pair[:, y[b]].T)
            np.add.at(score, d, one[c] * field.agree)
            np.add.at(score, c, one[d] * field.agree)
            score -= score.max(axis=1, keepdims=True)
            p = np.exp(score)
            miss = one - p / p.sum(axis=1, keepdims=True)
            pair = np.zeros((k, k))
            np.add.at(pair, y[a], miss[b])
            pair = pair + (np.eye(k)[y[b]].T @ miss[a]).T
            agree = (miss[d] * one[c] + miss[c] * one[d]).sum(axis=0)
            for w, g, s in zip((field.unary, field.pair, field.agree), (graph.features.T @ miss, pair, agree), sums):
                g = g / n - 1e-4 * w
                s += g * g
                w += 0.3 * g / np.sqrt(s)
        # links between like tokens never speak for different labels
        np.maximum(field.agree, 0.5, out=field.agree)
        return field

    def beliefs(self, graph: Graph) -> np.ndarray:
        """Loopy sum-product; fixed tokens keep their label."""
        k, n = len(LABELS), len(graph.labels)
        unary = graph.features @ self.unary
        unary -= unary.max(axis=1, keepdims=True)
        known = graph.labels > 0
        unary[known] = np.where(np.eye(k, dtype=bool)[graph.labels[known]], 0.0, -50.0)
        if not len(graph.edges):
            return _shares(unary)
        a, b = graph.edges.T
        pair = np.where(graph.is_skip[:, None, None], np.diag(self.agree)[None], self.pair[None])
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        psi = np.exp(np.concatenate([pair, pair.transpose(0, 2, 1)]))
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        messages = np.zeros((len(source), k))
        owner = graph.owner[source]
        most = ROUNDS + ROUNDS_A_TOKEN * np.bincount(graph.owner)
        done = np.ones(len(most), bool)
        done[owner] = False
        # the links of texts that still move, with places of their own
        at, own = np.arange(len(source)), messages
        scores, s, t, opposite = unary, source, target, back
        rounds = 0
        while len(at):
            rounds += 1
            total = scores.copy()
            np.add.at(total, t, own)
            out = total[s] - own[opposite]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            new = np.log(np.einsum("ei,eij->ej", out, psi) + 1e-300)
            new -= new.max(axis=1, keepdims=True)
            moved = np.zeros(len(most))
            np.maximum.at(moved, owner, np.abs(new - own).max(axis=1))
            own = 0.5 * own + 0.5 * new
            settled = ~done & ((moved < 1e-4) | (rounds >= most))
            if not settled.any():
                continue
            # a text keeps what it settled on, whatever texts it was handled with
            now = settled[owner]
            messages[at[now]] = own[now]
            done |= settled
            left = ~done[owner]
            if 4 * left.sum() > 3 * len(at):
                continue
            place = np.cumsum(left) - 1
            opposite = place[opposite[left]]
            nodes, ends = np.unique(np.concatenate([s[left], t[left]]), return_inverse=True)
            s, t = np.split(ends.reshape(-1), 2)
            scores = scores[nodes]
            at, own, psi, owner = at[left], own[left], psi[left], owner[left]
        total = unary.copy()
        np.add.at(total, target, messages)
        return _shares(total)


def _shares(score: np.ndarray) -> np.ndarray:
    p = np.exp(score - score.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _added(field: Field, texts: list[str], bases: list[list[Span]]) -> list[list[Span]]:
    """Runs of neighbouring tokens that the field gives one kind, outside pattern matches."""
    out: list[list[Span]] = [[] for _ in texts]
    graph = Graph(texts, bases)
    if not graph.places:
        return out
    beliefs = field.beliefs(graph)
    best = beliefs.argmax(axis=1)
    best[beliefs.max(axis=1) < BELIEF] = 0
    best[graph.labels > 0] = 0
    for (n, begin, end), label in zip(graph.places, best.tolist()):
        if not label:
            continue
        while begin < end and not texts[n][begin].isalnum() and texts[n][begin] not in "+(":
            begin += 1
        while end > begin and not texts[n][end - 1].isalnum():
            end -= 1
        own = out[n]
        if own and own[-1][0] == label - 1 and begin - own[-1][2] == 1 and _one_number(label - 1, texts[n], own[-1][1], begin, end):
            own[-1] = (label - 1, own[-1][1], end)
        elif end > begin:
            own.append((label - 1, begin, end))
    return out


def _one_number(kind: int, text: str, start: int, begin: int, end: int) -> bool:
    """Whether a token goes on with the number that starts before it: neither is a whole one."""
    if kind not in DIGITS_OF:
        return False
    least, most = DIGITS_OF[kind]
    before, after = (sum(c in "0123456789" for c in t) for t in (text[start:begin], text[begin:end]))
    return before < least and after < least and before + after <= most


def clipped(text: str, limit: int = CLIP) -> tuple[str, list[Span]]:
    """The evidence of a text with its pattern matches, found in the whole text.

    Tokens keep the character on either side; neighbours stay neighbours. Where the evidence
    exceeds ``limit`` characters, whole tokens and matches are taken in a row from a place
    that a hash of the text names; one that exceeds the limit alone is left out.
    """
    base = base_spans(text)
    units: list[list[int]] = []
    for begin, end in sorted([m.span() for m in TOKEN.finditer(text)] + [s[1:] for s in base]):
        if units and begin < units[-1][1]:
            units[-1][1] = max(units[-1][1], end)
        else:
            units.append([begin, end])
    if sum(end - begin for begin, end in units) > limit:
        first, left, taken = xxhash.xxh64_intdigest(text) % len(units), limit, []
        for begin, end in units[first:] + units[:first]:
            if end - begin > limit:
                continue
            left -= end - begin
            if left < 0:
                break
            taken.append([begin, end])
        units = sorted(taken)
    parts: list[list[int]] = []
    for begin, end in units:
        if parts and begin - 1 <= parts[-1][1]:
            parts[-1][1] = min(end + 1, len(text))
        else:
            parts.append([max(begin - 1, 0), min(end + 1, len(text))])
    starts = [a for a, _ in parts]
    places = list(accumulate((b - a + 1 for a, b in parts), initial=0))
    spans = []
    for kind, begin, end in base:
        i = bisect_right(starts, begin) - 1
        if i >= 0 and end <= parts[i][1]:
            shift = places[i] - starts[i]
            spans.append((kind, begin + shift, end + shift))
    return "\n".join(text[a:b] for a, b in parts), spans


def sampled(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``t`` and ``spans`` of at most ``sample`` different texts that hold evidence, least hash first.

    Hashes are cut by their estimated number first, so that hardly more rows than wanted are
    clipped, and copies are one row.
    """
    held = docs.select(F.col(f"`{text}`").alias("t")).where(F.col("t").rlike("[0-9@+]")).select(F.xxhash64("t").alias("h"), "t")
    different = held.agg(F.approx_count_distinct("h", 0.05)).first()[0]
    share = min(1.0, 1.3 * (sample + 6 * sample**0.5 + 20) / max(different, 1))
    cut = min(int(share * 2**64) - 2**63, 2**63 - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [clipped(t) for t in texts_of(batch, "t")]
            spans = [[{"kind": k, "start": a, "end": b} for k, a, b in own] for _, own in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t for t, _ in found], pa.string()), pa.array(spans, SPANS)], names=["h", "t", "spans"]
            )

    rows = held.where(F.col("h") <= cut).mapInArrow(run, "h long, t string, spans array<struct<kind: int, start: int, end: int>>")
    once = rows.groupBy("h").agg(F.min(F.struct("t", "spans")).alias("v"))
    return once.orderBy("h").limit(sample).select("v.*")


SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def fit(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Field:
    """Weights from at most ``sample`` texts that hold evidence."""
    rows = sampled(docs, text, sample).collect()  # bounded by sample x CLIP characters
    return Field.fit(Graph([r.t for r in rows], [[tuple(s) for s in r.spans] for r in rows]))


def find(docs: DataFrame, out: str, text: str = "text", model: Field | None = None) -> DataFrame:
    """Append ``array<struct<kind, start, end, base>>``: all spans, by kind and start."""
    field = docs.sparkSession.sparkContext.broadcast(model or fit(docs, text))

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = texts_of(batch)
        bases = [base_spans(t) if EVIDENCE.search(t) else [] for t in texts]
        added = _added(field.value, texts, bases)
        rows = [
            [{"kind": KINDS[k], "start": a, "end": b, "base": own} for k, a, b, own in sorted([*((*s, True) for s in base), *((*s, False) for s in more)])]
            for base, more in zip(bases, added)
        ]
        return {out: pa.array(rows, ARROW)}

    return per_row(docs, [F.col(f"`{text}`")], work, [T.StructField(out, FOUND)])


FOUND = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("base", T.BooleanType()),
]))
ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
