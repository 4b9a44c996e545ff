"""Ids of texts that hold added tokens."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from loanlark.llm import token_files


def test_ids_equal_an_unchanged_library():
    content = open(public_tokenizers.path("byte_bpe_50k.json")).read()
    library = Tokenizer.from_str(content)
    own = token_files.Tokens(content, np.dtype("<u2"), added=True)
    rng = random.Random(3)
    parts = [" ", "\n", "\t", "'s", "a", "é", "1", "!", "中", "the", "<|endoftext|>", "<|endof", "text|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    for text, packed in zip(texts, own.encode(texts)):
        assert np.frombuffer(packed, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids


def test_file_ids_have_added_tokens(spark):
    docs = spark.createDataFrame([(1, "a<|endoftext|>b")], "doc_id long, text string")
    packed = token_files.tokenise(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0).first().packed
    assert np.frombuffer(bytes(packed), "<u2").tolist() == [64, 50256, 65, 0]
