import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from corpus import awkward, documents, empty
from starmill.llm import bpe
from tokenizers import Tokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe._vocabulary(PATH)


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def numbers(ids):
    return np.frombuffer(ids, "<u4").tolist()


def brute_force(v, word):
    """Scan all pairs for the leftmost of the lowest rank, merge it, begin again."""
    raw = word.encode()
    symbols = [int(v.inner[b]) for b in raw[:-1]] + [int(v.final[raw[-1]])]
    while len(symbols) > 1:
        ranked = [(v.rank[a * v.base + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a * v.base + b in v.rank]
        if not ranked:
            break
        rank, i = min(ranked)
        symbols[i:i + 2] = [int(v.merged[rank])]
    return symbols


def random_texts(n, seed=1):
    rng = random.Random(seed)
    parts = [" ", "  ", "\n", "\t", "a", "B", "the", "ing", "é", "1", "!", "'s", "'LL", "<|endoftext|>", "<|startoftext|>", "\xa0", "　",
             "\x85", "\x1c", "​", "日", "😀", "\x00", "﻿", "᠎", "Σ", "ΑΣ", "İ", "ǅ", "ﬁ", "é", "́", "½", "²", "—", "…", "€"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_random_texts_equal_the_library(library):
    texts = random_texts(4000)
    assert list(map(numbers, bpe.Encoder(PATH)(texts))) == ids_of(library, texts)


def test_plain_letters_are_split_as_the_library_does(library, vocabulary):
    letters = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]]
    texts = [x for c in letters for x in (c, f"a{c}b", f"{c}{c} 'S{c}", f"1{c}.")]
    assert all(bpe._PLAIN.fullmatch(t) for t in texts)
    assert list(map(numbers, bpe.Encoder(PATH)(texts))) == ids_of(library, texts)


def test_trees_equal_a_scan_of_all_pairs(vocabulary):
    rng = random.Random(2)
    words = ["".join(rng.choice("aeinorst'é") for _ in range(n)) for n in [*range(1, 40), *[rng.randint(1, 400) for _ in range(200)]]]
    expected = [brute_force(vocabulary, w) for w in words]
    assert list(map(numbers, bpe.Encoder(PATH).merge(words))) == expected
    assert [bpe._single(vocabulary, w.encode()) for w in words] == expected


def test_forests_are_cut(vocabulary, monkeypatch):
    words = ["".join(random.Random(i).choices("thequickbrown", k=i % 50 + 1)) for i in range(300)]
    whole = bpe.Encoder(PATH).merge(words)
    monkeypatch.setattr(bpe, "FOREST_LEAVES", 64)
    monkeypatch.setattr(bpe, "FOREST_WIDTH", 16)
    assert bpe.Encoder(PATH).merge(words) == whole


def test_a_very_long_word(library):
    rng = random.Random(4)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))
    texts = [word, "ab " * 50_000, "!" * 70_000]
    assert list(map(numbers, bpe.Encoder(PATH)(texts))) == ids_of(library, texts)


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "REMEMBERED_LENGTH", 2)
    texts = ["alpha be ce de ef", "be alpha", "", "g " * 50]
    encode = bpe.Encoder(PATH)
    assert [numbers(encode([t])[0]) for t in texts] == ids_of(library, texts) == list(map(numbers, encode(texts)))
    assert max(map(len, encode._known)) <= 2


def test_decoding_equals_the_library(library, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "CALL_IDS", 50)
    lists = [*ids_of(library, random_texts(300, 6)), [], [49406, 49407, 5], list(range(0, 49408, 97)), [60000, 5, 1 << 31]]
    expected = [library.decode(i, skip_special_tokens=False) for i in lists]
    assert bpe.decode([np.array(i, "<u4").tobytes() for i in lists], vocabulary).to_pylist() == expected


def digest(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_digest_of_awkward_and_empty_tables(spark, library):
    docs = awkward(spark).selectExpr("*", "'x' AS ids", "1 AS decoded")
    texts = [r.text for r in docs.collect()]
    assert sorted(tuple(r)[1:] for r in bpe.bpe_digest(docs, PATH).collect()) == sorted(digest(library, t) for t in texts)
    assert bpe.bpe_digest(empty(spark), PATH).collect() == []


def test_digest_of_the_corpus(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = {(r.doc_id, *digest(library, r.text)) for r in docs.collect()}
    assert {tuple(r) for r in bpe.bpe_digest(docs, PATH).collect()} == expected


def test_rows_keep_their_columns_through_both_ways(spark, library):
    docs = documents(spark, ["A b", None, "x <|endoftext|>"], extra=True)
    rows = bpe.with_decoded(bpe.with_ids(docs, PATH), PATH).orderBy("doc_id").collect()
    assert [r.decoded for r in rows] == ["a</w> b</w>", "", "x</w> <|endoftext|>"]
    assert [r.score for r in rows] == ["x"] * 3 and rows[1].text is None
