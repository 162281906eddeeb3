import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
from corpus import awkward, documents, empty
from starmill.llm import lm_scoring as lm


def brute(rows):
    held = lambda i: crc32(str("" if i is None else i).encode()) % 7 == 2
    listed = [(i, [*lm.tokens(t or ""), b""]) for i, t in rows]
    c = Counter(w for i, own in listed if not held(i) for w in own)
    n, v = sum(c.values()), len(c)
    return sorted((str(i), held(i), len(own), sum(c[w] > 0 for w in own), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in own), 6)) for i, own in listed)


def shown(found):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)


def test_base_score_equals_brute_force(spark, monkeypatch):
    for share in (lm.FREQUENT_SHARE, 0.01):  # with and without joined tokens
        monkeypatch.setattr(lm, "FREQUENT_SHARE", share)
        docs = awkward(spark)
        found = lm.language_scores(docs).collect()
        assert shown(found) == brute(docs.select("doc_id", "text").collect())
        assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_no_documents_and_none_to_learn_from(spark):
    assert lm.language_scores(empty(spark)).collect() == []
    held = [i for i in range(100) if crc32(str(i).encode()) % 7 == 2]
    docs = documents(spark, [(i, "a b") for i in held])
    assert shown(lm.language_scores(docs).collect()) == brute([(i, "a b") for i in held])


def test_the_model_is_normalised_and_better_than_the_base(spark):
    rng = random.Random(4)
    nouns, verbs = [f"noun{i}" for i in range(300)], [f"verb{i}ed" for i in range(300)]
    texts = [" ".join(w for _ in range(20) for w in ("the", rng.choice(nouns), rng.choice(verbs), "it.")) for _ in range(400)]
    docs = documents(spark, texts)
    found = [r for r in lm.language_scores(docs).collect() if r.held_out]
    tokens = sum(r.n_tokens for r in found)
    assert sum(r.score for r in found) / tokens > sum(r.base_score for r in found) / tokens + 0.1


def test_probabilities_of_all_classes_add_up_to_one():
    unigram = np.full(10, 0.1)
    model = lm.LogBilinear.start(unigram)
    context = np.array([[1, 2, 10]])
    total = sum(math.exp(model.log_probabilities(context, np.array([k]))[0]) for k in range(10))
    assert abs(total - 1) < 1e-6


def test_classes_are_the_same_in_tasks_and_in_columns(spark):
    classes = lm.Classes(("the", "été"))
    words = ["", "the", "été", "x", "ñandú", "日本語", "ab", "😀", "wörter", "aé"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    from pyspark.sql import functions as F

    data = np.frombuffer(" ".join(words[1:]).encode(), np.uint8)
    found = lm.words(data, np.array([0, len(data)]))
    kinds, logs = lm.Known(classes, {"x": 9, "ab": 99})(data, found)
    assert [r[0] for r in df.select(classes.column(F.col("w"))).collect()] == [0, *kinds.tolist()]
    assert [None if np.isnan(x) else round(x, 6) for x in logs] == [None, None, 1.0, None, None, 2.0, None, None, None]


def test_a_large_table_knows_each_word():
    counts = {f"w{i}": i for i in range(20_000)}
    data = np.frombuffer(" ".join(f"w{i}" for i in range(25_000)).encode(), np.uint8)
    logs = lm.Known(lm.Classes(()), counts)(data, lm.words(data, np.array([0, len(data)])))[1]
    assert np.allclose(logs[:20_000], np.log10(np.arange(20_000) + 1)) and np.isnan(logs[20_000:]).all()


def test_every_round_learns_from_all_training_documents(spark, monkeypatch):
    docs = documents(spark, [(i, f"word{i} and more") for i in range(60)])
    train = sum(crc32(str(i).encode()) % 7 != 2 for i in range(60))
    learnt, map_arrow = [], lm.map_arrow

    def seen(df, function, schema):
        found = map_arrow(df, function, schema)
        if schema == "i int, total double, n long":
            learnt.append((df.count(), found.agg({"n": "max"}).first()[0] is not None))
        return found

    monkeypatch.setattr(lm, "map_arrow", seen)
    lm.language_scores(docs)
    assert learnt == [(train, True)] * lm.ROUNDS and lm.ROUNDS >= 2


def test_probabilities_of_repeated_contexts_are_those_of_each():
    rng = np.random.RandomState(3)
    model = lm.LogBilinear.start(np.full(10, 0.1))
    context, target = rng.randint(0, 3, (5000, 3)), rng.randint(0, 10, 5000)
    found = model.log_probabilities(context, target)
    alone = [model.log_probabilities(context[i:i + 1], target[i:i + 1])[0] for i in range(200)]
    scores = model.predicted(context).astype(float) @ model.q.T + model.b
    assert np.allclose(found, scores[np.arange(5000), target] - np.log(np.exp(scores).sum(axis=1)), atol=1e-5)
    assert np.allclose(found[:200], alone, atol=1e-5)


def test_sums_of_rows_at_repeated_indexes():
    rng = np.random.RandomState(4)
    index, rows = rng.randint(0, 30, 200), rng.rand(100, 16).astype(np.float32)
    expected = np.zeros((40, 16))
    np.add.at(expected, index, np.concatenate([rows, rows]))
    assert np.allclose(lm._sums(index, rows, 40), expected, atol=1e-4)


def test_contexts_stop_at_the_start_of_a_document():
    found = lm.contexts(np.array([5, 6, 0, 7, 0]), np.array([3, 2]), 9)
    assert found.tolist() == [[9, 9, 9], [5, 9, 9], [6, 5, 9], [9, 9, 9], [7, 9, 9]]


def test_the_model_is_not_made_smaller_to_run_faster():
    assert lm.OWN_CLASS >= 96 and lm.END_CLASSES >= 64
    assert lm.NOISE >= 24 and lm.NOISE / lm.BATCH >= 24 / 1024  # draws per token
