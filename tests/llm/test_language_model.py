"""The language model against plain counts, and its probabilities against one."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from loanlark.llm import language_model
from loanlark.llm.queries import op6_language_model


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def documents(spark, path):
    rng = random.Random(4)
    words = ["the", "of", "A", "a", "naïve", "中文", "x1", "END", "end"] + [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(60)] + [None, "", "\t\n", f"only here {rng.random()}"] * 4
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    return rows


def test_base_columns_equal_plain_counts(spark, tmp_path):
    rows = documents(spark, str(tmp_path))
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    want = [
        (str(i), held(i), len(tokens(t)), sum(w in counts for w in tokens(t)), total,
         round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens(t)), 6))
        for i, t in rows
    ]
    made = op6_language_model(spark, str(tmp_path)).collect()
    assert any(r.held_out for r in made) and all(r.score < 0 for r in made)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in made) == sorted(want)


def test_outcomes_sum_to_one(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(80)], k=25)) for _ in range(40)]
    training = spark.createDataFrame([(t,) for t in texts], "t string")
    words = language_model.learn_words(training)
    model = language_model.train(training, words)
    known = [r.word.decode() for r in words.counts.collect() if len(r.word)]
    # every word that can follow, the end, and one unknown word for each class of endings
    unknown, at = {}, 0
    while len(unknown) < language_model.ENDINGS:
        word = f"new{at}"
        unknown.setdefault(zlib.crc32(word.encode()[-2:]) % language_model.ENDINGS, word)
        at += 1
    before = "w1 w2"
    rows = [(w, f"{before} {w}") for w in [*known, *unknown.values()]] + [("", before)]
    docs = spark.createDataFrame(rows, "w string, text string")
    scored = {r.w: r.score for r in language_model.score(docs, words, model, ["w"], "text").collect()}
    # a longer text has its own end after the word: that factor, and those of the words before, are
    # taken off, which leaves the probability of the word alone
    ends = {}
    one, two = (model[0], model[1])
    coder = language_model.Coder(words.single)
    for w, text in rows[:-1]:
        own, features = coder.events([tokens(text)])
        share = language_model._shares(one, two, features[:, -1:])[0]
        ends[w] = math.log10(share[own[-1]])
    own, features = coder.events([tokens(before)])
    first = [math.log10(language_model._shares(one, two, features[:, i : i + 1])[0][own[i]]) for i in (0, 1)]
    alone = [words.counts.where(f"word = cast('{w}' as binary)").first().n for w in ("w1", "w2")]
    prefix = sum(first) + sum(
        math.log10(n / words.tokens[c] * (1 - words.unseen[c])) for n, c in zip(alone, own[:2])
    )
    total = sum(10 ** (scored[w] - prefix - ends[w]) for w, _ in rows[:-1]) + 10 ** (scored[""] - prefix)
    assert abs(total - 1) < 1e-4
    assert np.isfinite(list(scored.values())).all()


def test_tokens_of_a_column_are_those_of_its_texts():
    rng = random.Random(6)
    parts = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\xa0", "　", "A", "b", "É", "İ", "K", "中", "\0", "Z"]
    texts = [None if rng.random() < 0.1 else "".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(500)]
    for begin, end in ((0, 500), (100, 140), (499, 500), (7, 7)):
        made = language_model.Tokens.of(pa.array(texts).slice(begin, end - begin))
        want = [tokens(t) for t in texts[begin:end]]
        assert made.sizes.tolist() == [len(w) for w in want]
        assert [made.distinct[p] for p in made.place] == [w for words in want for w in words]
        assert len(set(made.distinct)) == len(made.distinct)


def test_each_different_word_of_a_batch_is_looked_up_once():
    class Seen(dict):
        def __contains__(self, word):
            asked.append(word)
            return super().__contains__(word)

    asked = []
    coder = language_model.Coder({b"a": 0})
    coder.memo = Seen()
    words = language_model.Tokens.of(pa.array(["a b a b c", "C a"] * 50))
    portions = list(coder.portions(words, 20))
    assert sorted(asked) == [b"", b"a", b"b", b"c"] and len(portions) > 5
    plain = language_model.Coder({b"a": 0})
    for begin, end, own, rows in portions:
        want = plain.events([tokens(t) for t in (["a b a b c", "C a"] * 50)[begin:end]])
        assert (own == want[0]).all() and (rows == want[1]).all()
