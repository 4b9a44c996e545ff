"""Token alignment against both libraries on whole texts and comparing all tokens."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from loanlark.llm import token_alignment
from loanlark.llm.common import table
from loanlark.llm.queries import QUERIES

A_FILE, B_FILE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "\n", "  two  blanks ", "tail ", "tab\tand\r\nlines\n\n  in", "a▁b", "plain <|endoftext|> <s> <0x41>", "日本語テキスト です",
    "é é ﬁ ｆｕｌｌ", "　wide blank  x", "it's we'll 'd 12345 3.14", "😀 👩‍👩‍👧 \u0000 nul", "x" * 3000, "word " * 500, "…" * 200,
    "a \u0085b \x1c c", "ÀÉÎ õü", "foo\n bar", "foo \nbar",
]


class Plain:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A_FILE), sentencepiece.SentencePieceProcessor(model_file=B_FILE)
        self.a.encode_special_tokens = True
        letters = token_alignment.byte_letters()
        self.a_bytes = lambda i: bytes(letters[c] for c in self.a.id_to_token(i))

    def b_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def sides(self, text: str | None):
        if not text:
            return [], []
        sides = []
        for ids, spell in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.a_bytes), (self.b.encode(text), self.b_bytes)):
            at, own = 0, []
            for i in ids:
                own.append((i, at, at + len(spell(i))))
                at = own[-1][2]
            if b"".join(map(spell, ids)) != (" " + text).encode():
                return [], []
            sides.append(own)
        return sides

    def rows(self, docs):
        found = []
        for key, text in docs:
            a, b = self.sides(text)
            common = sorted({e for _, _, e in a} & {e for _, _, e in b})
            groups, low = [], 0
            for end in common:
                groups.append("|".join(",".join(str(i) for i, s, e in side if low <= s and e <= end) for side in (a, b)))
                low = end
            links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e] if len(a) < 2500 else None
            if links is None:  # equal by definition, but linear
                links, starts = [], 0
                for i, s, e in a:
                    while starts < len(b) and b[starts][2] <= s:
                        starts += 1
                    j = starts
                    while j < len(b) and b[j][1] < e:
                        links.append((i, b[j][0]))
                        j += 1
            found.append((key, len(a), len(b), len(groups), links, ";".join(groups)))
        docs_of = Counter(p for r in found for p in set(r[4]))
        best = defaultdict(int)
        for (i, _), n in docs_of.items():
            best[i] = max(best[i], n)
        return sorted(
            (k, a, b, g, len(links), sum(docs_of[p] == best[p[0]] for p in links), sum(docs_of[p] for p in links),
             hashlib.sha256(s.encode()).hexdigest() if s else "")
            for k, a, b, g, links, s in found
        )


@pytest.fixture(scope="module")
def plain():
    return Plain()


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def test_query_against_whole_texts(spark, plain):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    made = QUERIES["op12_token_alignment"](spark, sf)
    assert made.columns == ["doc_id", *COLUMNS, "groups_sha256"]
    assert sorted(map(tuple, made.collect())) == plain.rows(docs)


@pytest.mark.parametrize("head", [0, 20, token_alignment.HEAD])
def test_odd_texts_and_rare_pairs(spark, plain, head):
    """Pairs beyond the head are joined: the same result."""
    docs = list(enumerate(ODD)) + [(3, "tail "), (3, "tail "), (50, "word word")]
    df = spark.createDataFrame([(k, t, k, 0.5) for k, t in docs], "doc_id long, text string, row long, `n.a` double")
    made = token_alignment.link_statistics(df, A_FILE, B_FILE, "t", head=head)
    assert made.columns == ["doc_id", "row", "n.a", "t"]
    got = sorted((r.doc_id, *[r.t[c] for c in COLUMNS], r.t.groups) for r in made.collect())
    assert got == plain.rows(docs)
    assert [r[1] for r in got if r[0] == 7] == [0] and [r[7] for r in got if r[0] == 0] == [""]


def test_empty_table_and_text_form(spark, plain):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_alignment.link_statistics(df, A_FILE, B_FILE).collect() == []
    df = spark.createDataFrame([(1, "unbelievable words")], "doc_id long, text string")
    shown = token_alignment.align(df, A_FILE, B_FILE).first().aligned.groups
    assert hashlib.sha256(shown.encode()).hexdigest() == plain.rows([(1, "unbelievable words")])[0][7]


def test_slices_end_where_both_tokens_end():
    groups = token_alignment.slice_at_shared_ends([2, 5, 6, 9], [1, 2, 6, 7, 9])
    assert groups == [(0, 1, 0, 2), (1, 3, 2, 3), (3, 4, 3, 5)]
    assert token_alignment.links_of((0, 3, 0, 3), [2, 5, 6], [1, 4, 6]) == [(0, 0), (0, 1), (1, 1), (1, 2), (2, 2)]
