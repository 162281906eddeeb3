from corpus import awkward, documents, empty
from starmill.llm import mixing


def test_margins_hold_after_raking(spark):
    cells = spark.createDataFrame(
        [(s, g, t, 10 * (a + 1) * (b + 2) + t) for a, s in enumerate("xyz") for b, g in enumerate(("en", "de")) for t in (0, 1)],
        "_source string, _lang string, _topic int, tokens long")
    rows = [r.asDict() for r in mixing.rake(cells, sweeps=20).collect()]
    total = sum(r["tokens"] for r in rows)
    for m in mixing.MARGINS:
        own = {}
        for r in rows:
            a, b = own.get(r[f"_{m}"], (0, 0))
            own[r[f"_{m}"]] = (a + r["tokens"], b + r["tokens"] * r["factor"] / total)
        whole = sum(a ** mixing.POWERS[m] for a, _ in own.values())
        assert all(abs(b - a ** mixing.POWERS[m] / whole) < 1e-6 for a, b in own.values())


def test_the_sample_has_the_expected_tokens(spark):
    docs = documents(spark, [f"word{i % 7}longer " * (20 + i % 5) for i in range(3000)])
    rows = mixing.mixture(docs).collect()
    expected = sum(r.n_tokens * r.probability for r in rows) / sum(r.n_tokens for r in rows)
    assert abs(expected - mixing.KEEP) < 1e-3
    assert all(0 < r.probability <= 1 and r.weight >= 1 for r in rows)
    kept = sum(r.n_tokens for r in rows if r.kept) / sum(r.n_tokens for r in rows)
    assert abs(kept - mixing.KEEP) < 0.05


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    rows = mixing.mixture(docs).collect()
    assert len(rows) == docs.count() and sum(r.lang is None for r in rows) > 0
    kept = mixing.mixed(docs)
    assert kept.columns == [*docs.columns, "mix_probability", "mix_weight"]
    assert 0 < kept.count() <= docs.count()
    assert mixing.mixture(empty(spark)).collect() == []
    assert mixing.mixed(empty(spark)).collect() == []


def test_topic_of_the_most_frequent_long_word():
    assert mixing.topic_of([]) == mixing.topic_of([b"short"]) == -1
    assert mixing.topic_of([b"bbbbbb", b"aaaaaa"]) == mixing.topic_of([b"aaaaaa"])
    assert mixing.topic_of([b"bbbbbb", b"aaaaaa", b"bbbbbb"]) == mixing.topic_of([b"bbbbbb"])
