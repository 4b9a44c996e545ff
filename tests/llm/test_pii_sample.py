"""What the field is fitted on, numbers in several tokens, and numbers side by side."""

from __future__ import annotations

import random

import numpy as np

from loanlark.llm import pii
from test_copies import field

PARTS = [
    "+1 310 555 4510", "4111 1111 1111 1111", "4111-1111-1111-1111", "10.0.0.1", "a.b@c.org", "word", "another",
    "12", "x7", "\n", "  ", "(", "+", "@", "٣", "中文",
]


def test_a_clipped_text_keeps_every_label():
    rng = random.Random(5)
    for _ in range(400):
        text = rng.choice(["", " "]) + " ".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30)))
        base = pii.base_spans(text)
        short, spans = pii.clipped(text)
        assert [(k, text[a:b]) for k, a, b in base] == [(k, short[a:b]) for k, a, b in spans]
        whole, part = pii.Graph([text], [base]), pii.Graph([short], [spans])
        assert whole.labels.tolist() == part.labels.tolist()
        assert (whole.features == part.features).all() and (whole.edges == part.edges).all()


def test_phones_and_grouped_cards_are_learnt():
    text = "words before " * 40 + "call +1 310 555 4510 or pay 4111 1111 1111 1111 now" + " words behind" * 40
    graph = pii.Graph(*[[x] for x in pii.clipped(text)])
    labels = [pii.LABELS[i] for i in graph.labels]
    assert labels.count("phone") == 4 and labels.count("card") == 4


def test_a_long_text_gives_whole_matches_up_to_the_limit():
    text = " ".join(f"+1 310 555 {n:04d} and 4111 1111 1111 1111;" for n in range(2000))
    short, spans = pii.clipped(text, 500)
    assert 300 < len(short) <= 700 and len(spans) > 10
    assert all(short[a:b][0] == "+" if k == 3 else short[a:b] == "4111 1111 1111 1111" for k, a, b in spans)
    assert pii.clipped("1" * 5000, 500) == ("", [])


def test_a_number_in_several_tokens_marks_its_bare_copy():
    for full, bare, kind in (("+1 310 555 4510", "13105554510", 3), ("4111 1111 1111 1111", "4111.1111.1111.1111", 2)):
        text = f"write {full} first\n" + "text between " * 30 + f"\nthen {bare} again"
        graph = pii.Graph([text], [pii.base_spans(text)])
        assert len(graph.edges[graph.is_skip]) == 1
        weights = field()
        weights.unary[0] = [0.5, -2, -2, 0, 0]
        spans = pii._added(weights, [text], [pii.base_spans(text)])[0]
        assert [(k, text[a:b]) for k, a, b in spans] == [(kind, bare)]


def test_numbers_side_by_side_stay_apart():
    always = pii.Field(np.outer(np.eye(pii.N_FEATURES)[0], [-5, -5, -5, 5, -5]), np.zeros((5, 5)), np.full(5, 0.5))
    said = lambda text: [text[a:b] for _, a, b in pii._added(always, [text], [[]])[0]]
    assert said("4111111111111112 4222222222222222") == ["4111111111111112", "4222222222222222"]
    assert said("4111 1111 1111 1112 4222") == ["4111 1111 1111 1112", "4222"]


def test_copies_are_one_sampled_text_and_rows_are_bounded(spark):
    texts = ["call +1 310 555 4510"] * 500 + [f"number {n}" for n in range(300)] + [None, "", "none"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(6)
    rows = pii.sampled(docs).collect()
    assert len(rows) == 301 and sum(r.t.strip() == "+1 310 555 4510" for r in rows) == 1
    few = pii.sampled(docs, sample=40)
    assert few.count() == 40 and few.collect() == few.collect()
    assert pii.sampled(docs.limit(0)).count() == 0
