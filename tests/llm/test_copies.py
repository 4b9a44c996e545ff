"""Copies of personal data far from the full one."""

from __future__ import annotations

import numpy as np

from loanlark.llm import pii


def field(agree=4.0):
    """Tokens lean outside a little, then to phone; like tokens agree."""
    unary = np.zeros((pii.N_FEATURES, 5))
    unary[0] = [0.5, -2, -2, -2, 0]
    return pii.Field(unary, np.zeros((5, 5)), np.full(5, agree))


def test_one_full_number_marks_200_bare_copies():
    bare = [f"line{'x' * (i % 7)} reads 13105554510 and then" for i in range(200)]
    for at in (0, 100, 200):
        text = "\n".join([*bare[:at], "call +13105554510 now", *bare[at:]])
        spans = pii._added(field(), [text], [pii.base_spans(text)])[0]
        assert len(spans) == 200 and all(text[a:b] == "13105554510" and k == 3 for k, a, b in spans)


def test_beliefs_do_not_depend_on_the_other_texts():
    texts = ["call +13105554510 now\nand again 13105554510 please", "1 2 3 4 " * 30, "no evidence", "+13105554511 " + "13105554511 x " * 50]
    together = pii._added(field(), texts, [pii.base_spans(t) for t in texts])
    assert any(together) and together == [pii._added(field(), [t], [pii.base_spans(t)])[0] for t in texts]
