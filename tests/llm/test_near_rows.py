"""Near-duplicates: the bound of whole-set sketches, rows of one id, families against brute force."""

from __future__ import annotations

import random

import numpy as np

from loanlark.llm import near_dedup


def runs(text, width=2):
    words = text.lower().split()
    return set(zip(*(words[k:] for k in range(width)))) if len(words) >= width else ({tuple(words)} if words else set())


def brute(rows):
    """Component of each row: equal ids are apart unless their texts link them."""
    sets, up = [runs(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                up[top(i)] = top(j)
    least = {}
    for i, (own, _) in enumerate(rows):
        least[top(i)] = min(own, least.get(top(i), own))
    return sorted((own, least[top(i)]) for i, (own, _) in enumerate(rows))


def test_sketches_never_differ_in_more_bits_than_sets():
    rng = np.random.default_rng(2)
    for _ in range(300):
        words = [f"w{i}".encode() for i in rng.integers(0, 4000, rng.integers(3, 900))]
        other = list(words)
        for i in rng.integers(0, len(words), rng.integers(0, 40)):
            other[i] = b"x%d" % i
        owner, key = near_dedup.run_keys([words, other], 2)
        place = (near_dedup._mix(key ^ near_dedup.FACTORS[1]) % np.uint64(near_dedup.SET_BITS)).astype(np.int64)
        bits = [np.bincount(place[owner == k], minlength=near_dedup.SET_BITS) & 1 for k in (0, 1)]
        one, two = (set(key[owner == k].tolist()) for k in (0, 1))
        assert (bits[0] ^ bits[1]).sum() <= len(one ^ two)


def test_families_and_repeated_ids_equal_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for family in range(12):
        words = [f"f{family}w{i}" for i in range(rng.randint(30, 120))]
        for _ in range(rng.randint(1, 14)):
            own = list(words)
            for _ in range(rng.randint(0, 7)):
                own[rng.randrange(len(own))] = f"n{rng.random()}"
            rows.append((rng.randint(1, 90), " ".join(own)))
    rows += [(500, "one two three four"), (500, rows[0][1]), (501, "one two three four"), (502, ""), (502, "alone"), (503, "ALONE")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    made = sorted((r.doc_id, r.component_id) for r in near_dedup.near_duplicates(docs).collect())
    # the empty text links with nothing: its component is its id, as brute force has it
    assert made == brute(rows)


def test_a_text_of_its_own_stays_though_its_id_is_repeated(spark):
    rows = [(1, "a b c d e f g h"), (5, "a b c d e f g h"), (5, "quite another text of its own words"), (6, "quite other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.doc_id, r.text) for r in near_dedup.keep_first(docs).collect())
    assert kept == [rows[0], rows[2], rows[3]]
