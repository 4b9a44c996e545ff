"""Spelling variants against comparing all words with all others."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from loanlark.llm import spelling
from loanlark.llm.common import table
from loanlark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def near(a: str, b: str) -> bool:
    """Whether exactly one code point was inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def plain(rows) -> list[tuple]:
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    out = {}
    for w, n in words.items():
        around = [v for v in words if abs(len(v) - len(w)) < 2 and near(v, w)]
        best = min(around, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 2 * n else None
        out[w] = (n, len(around), form)
    def root(w):
        while out[w][2] is not None:
            w = out[w][2]
        return w
    return sorted((w, n, m, f or "", out[f][0] if f else 0, root(w)) for w, (n, m, f) in out.items())


def got(df) -> list[tuple]:
    assert df.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted((r.word, r.n, r.n_near, r.form or "", r.form_n or 0, r.root) for r in df.collect())


def test_query_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    expected = plain(rows)
    assert got(QUERIES["op11_spelling"](spark, SF)) == expected
    assert any(r[3] for r in expected) and any(r[2] > 2 for r in expected)


@pytest.mark.parametrize("symbols", [1, 2, 8])
def test_any_alphabet_finds_all(spark, symbols):
    """Few letters, so most words have many neighbours; few symbols, so reduced words coincide."""
    draw = random.Random(symbols)
    words = {"".join(draw.choice("abÀÿ") for _ in range(draw.randint(5, 7))) for _ in range(400)}
    table_ = spark.createDataFrame([(w, draw.randint(3, 40)) for w in sorted(words)], "word string, n long")
    pairs = sorted(tuple(sorted((r.x, r.y))) for r in spelling.near_pairs(table_, symbols).collect())
    assert pairs == sorted({(a, b) for a in words for b in words if a < b and near(a, b)})


def test_long_words_and_odd_rows(spark):
    long = "".join(chr(97 + i % 26) for i in range(3000))
    edge = "x" * (spelling.LONG + 1)
    rows = [(i, f"{long} {edge} {edge[1:]} hello") for i in range(3)]
    rows += [(i, f"{long[:1500]}{long[1501:]} {long}z hallo 中hello中 ÀÉÎÕÜ×÷ àéîõü") for i in range(3, 9)]
    rows += [(None, None), (7, ""), (8, " \n"), (None, "hello hello"), (1, "hello"), (1, "hello"), (5, "a" * 5), (6, "İstanbul" * 3)]
    rows += [(i, "aaaaa aaaaaa aaaaaaa") for i in range(20, 26)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, word int")
    assert got(spelling.variants(df)) == plain(rows)
    assert got(spelling.variants(df.limit(0))) == []


def test_chain_of_forms_ends_in_its_root(spark):
    chain = ["abcde", "abcdef", "abcdefg", "abcdefgh", "abcdefghi", "abcdefghij"]
    words = spark.createDataFrame([(w, 3 * 2**i) for i, w in enumerate(chain)], "word string, n long")
    made = spelling.rooted(words, spelling.near_pairs(words)).collect()
    assert {r.root for r in made} == {chain[-1]} and {r.word: r.form for r in made}["abcde"] == "abcdef"


def test_neighbours_of_a_word_are_all_different():
    words = ["aabbc", "zzzzz", "abcab"]
    owner, keys = spelling.asked_keys(words, 8)
    assert keys[:3].tolist() == spelling.own_keys(words, 8).tolist()
    for i in range(3):
        own = keys[owner == i]
        assert len(np.unique(own)) == len(own)
