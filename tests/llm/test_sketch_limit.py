"""The limit of differing sketch bits."""

from __future__ import annotations

import numpy as np

from loanlark.llm import near_dedup


def test_sketches_keep_pairs_at_the_threshold():
    """200 000 pairs of similarity 0.8: the differing bits stay within the limit."""
    bits, samples = near_dedup.BITS, near_dedup.SAMPLES
    most = int((1 - np.exp(-4 * samples * (0.2 + near_dedup.MARGIN) / bits)) * bits / 2)
    rng = np.random.default_rng(9)
    over = 0
    for _ in range(40):
        tosses = 2 * rng.binomial(samples, 0.2, 5000)
        live = np.arange(tosses.max()) < tosses[:, None]
        place = np.arange(5000)[:, None] * bits + rng.integers(0, bits, live.shape)
        over += int(((np.bincount(place[live], minlength=5000 * bits).reshape(-1, bits) & 1).sum(axis=1) > most).sum())
    assert over == 0
