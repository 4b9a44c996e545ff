"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from loanlark.llm import (
    bpe, chat_format, decontamination, language_model, line_dedup, near_dedup, pii, quality, substring_dedup, token_files,
)

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
LONG = " ".join(f"w{i}" for i in range(3000))
ROWS = [
    (1, LONG, "en", "a", 7), (2, LONG, "en", "a", 7), (2, LONG, "en", "a", 7), (3, None, None, None, None), (4, "", "en", None, 1),
    (5, " \n\t ", None, "a", 2), (6, "one", "en", "a", 3), (None, "mail me: a.b@c.org now", "en", "a", 4), (7, "中文 😀 text", "zz", "b", 5),
]
COLUMNS = "doc_id long, text string, lang string, source string, kept long"


@pytest.fixture(params=["rows", "none"])
def docs(spark, request):
    return spark.createDataFrame(ROWS if request.param == "rows" else [], COLUMNS)


def items(spark, rows=((1, "one"), (2, None), (None, "x"), (3, " ".join(f"w{i}" for i in range(5, 20))))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def test_bpe_rows(docs):
    made = bpe.decode(bpe.encode(docs.withColumn("row", F.lit(1)), RANKS, PATTERN), RANKS, PATTERN).collect()
    assert len(made) == docs.count()
    for r in made:
        assert bytes(r.decoded).decode() == (r.text or "") and r.row == 1
        assert bool(r.ids) == bool(r.text)


def test_quality_rows(docs):
    made = quality.judge(docs, "judged")
    assert made.columns == [*docs.columns, "judged"]
    for r in made.collect():
        assert r.judged.n_words == len((r.text or "").split())
        assert r.judged.base_failed == (r.judged.n_words < 20)
    assert quality.keep_good(docs).columns == docs.columns
    assert sorted(r.doc_id for r in quality.keep_good(docs).collect()) == ([1, 2, 2] if made.count() else [])


def test_line_rows(docs):
    made = line_dedup.dedup_lines(docs, removed="gone")
    assert made.columns == [*docs.columns, "gone"]
    got = {(r.doc_id, r.text) for r in made.collect()}
    if made.count():
        # rows of one id and text are one document: both of id 2 lose the line
        assert (1, LONG) in got and (2, "") in got and (3, None) in got and made.count() == len(ROWS)
    assert line_dedup.without_emptied(docs).columns == docs.columns


def test_near_rows(docs):
    made = {r.doc_id: r for r in near_dedup.near_duplicates(docs).collect()}
    if made:
        assert made[2].component_id == 1 and not made[2].kept and made[1].kept
        assert made[3].n_shingles == made[4].n_shingles == made[5].n_shingles == 0 and made[6].n_shingles == 1
        assert made[None].kept and made[None].component_id is None
    assert near_dedup.keep_first(docs).columns == docs.columns


def test_decontaminated_rows(spark, docs):
    found = {r.doc_id: r.found for r in decontamination.find(docs, items(spark), "found").collect()}
    if found:
        assert found[6]["items"] == ["1"] and found[1]["items"] == ["3"]
        assert [tuple(s) for s in found[1]["spans"]] == [(5, 20)] and found[3]["n_words"] == 0
        assert found[7]["n_words"] == 3
    cut = {r.doc_id: r.text for r in decontamination.remove(docs, items(spark)).collect()}
    if cut:
        assert cut[6] == "" and cut[3] is None and "w4 " in cut[1] and "w5 " not in cut[1]
    assert not any(r.found["spans"] for r in decontamination.find(docs, items(spark, [(1, None)]), "found").collect())


def test_passage_rows(docs):
    made = sorted(((r.doc_id or 0, r.n_words, r.n_removed) for r in substring_dedup.removed(docs).collect()))
    want = sorted((i or 0, len((t or "").split()), 3000 if t == LONG else 0) for i, t, *_ in ROWS)
    assert made == (want if made else [])


def test_personal_rows(docs):
    made = {r.doc_id: r.found for r in pii.find(docs.withColumn("kind", F.lit(1)), "found").collect()}
    if made:
        assert [(s.kind, s.start, s.end, s.base) for s in made[None]] == [("email", 9, 18, True)]
        assert made[3] == [] and made[4] == []


def test_model_rows(docs):
    training = docs.select(F.coalesce("text", F.lit("")).alias("t"))
    words = language_model.learn_words(training)
    made = language_model.score(docs, words, language_model.train(training, words), docs.columns, "text").collect()
    assert len(made) == docs.count()
    for r in made:
        assert r.n_tokens == r.n_known == len((r.text or "").split()) + 1 and r.score < 0


def test_token_file_rows(spark, docs):
    path = token_files.fresh_path(spark)
    token_files.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    made = token_files.read(spark, path).orderBy("start").collect()
    assert len(made) == docs.count()
    end = 0
    for r in made:
        assert r.start == end and len(r.ids) == 4 * r.n
        end += r.n
    assert [r.doc_id for r in made] == sorted((r.doc_id for r in made), key=lambda i: -1 if i is None else i)


def test_perspective_rows(spark):
    turns = [(1, 0, "ann", "hi <|im_end|>"), (1, 1, "bob", None), (1, None, None, "who"), (2, 0, "system", "rules"), (None, 0, "ann", "alone"), (1, 600, "ann", "later")]
    table = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").withColumn("piece", F.lit(3))
    made = {(r.conv_id, r.perspective, r.piece): r for r in chat_format.perspectives(table).collect()}
    assert set(made) == {(1, p, i) for p in ("ann", "bob", "unknown") for i in (0, 1)} | {(None, "ann", 0)}
    first = made[1, "ann", 0]
    spans = [tuple(map(int, s.split(":"))) for s in first["mask"].split(",")]
    assert [first.rendered[a:b] for a, b in spans] == ["hi < |im_end|><|im_end|>"]
    assert first.rendered.startswith("<|im_start|>user name=unknown\nwho<|im_end|>\n<|im_start|>assistant\nhi")
    assert chat_format.perspectives(table.limit(0)).count() == 0


def test_hash_of_kept_words(spark):
    texts = spark.createDataFrame([(1, "a  b\nc")], "doc_id long, text string")
    row = substring_dedup.removed(texts).select("n_words", F.sha2("kept", 256).alias("s")).first()
    assert row.s == hashlib.sha256(b"a b c").hexdigest() and row.n_words == 3
