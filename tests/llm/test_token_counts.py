import random

import public_tokenizers
import pytest
from corpus import awkward, empty
from starmill.llm import token_counts as tc
from tokenizers import Tokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_pieces_add_up(whole):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "B", "é", "1", "!", "'s", "<|endoftext|>", "\xa0", "　", "\x85", "\x1c",
             "​", "日", "😀", "\x00", "﻿", "᠎"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(5000)]
    assert ["".join(tc.pieces(t)) for t in texts] == texts
    assert tc.Counter(PATH)(texts) == whole(texts)


def test_memory_and_calls_are_bounded(whole, monkeypatch):
    monkeypatch.setattr(tc, "REMEMBERED", 3)
    monkeypatch.setattr(tc, "CALL_BYTES", 4)
    texts = ["a b c d e f", "a b", "", "g " * 50]
    count = tc.Counter(PATH)
    assert [count([t])[0] for t in texts] == whole(texts) == count(texts)


def test_awkward_and_empty_tables(spark, whole):
    docs = awkward(spark)
    rows = tc.token_counts(docs, PATH, limit=2).collect()
    texts = [r.text or "" for r in docs.collect()]
    expected = [(len(t.encode()), n, n > 2) for t, n in zip(texts, whole(texts))]
    assert sorted(tuple(r)[1:] for r in rows) == sorted(expected)
    assert tc.token_counts(empty(spark), PATH).collect() == []
