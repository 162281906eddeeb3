import random

from corpus import LABELS, awkward, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from starmill.llm import toxicity as tox

TERMS = ["idiot", "worthless", "scum", "loser", "pathetic"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abc", max_size=7), st.text("abc", max_size=7), st.integers(0, 2))
def test_automaton_accepts_what_is_near(word, other, edits):
    automaton = tox.Automaton(word, edits)
    state = automaton.start()
    for char in other:
        state = automaton.step(state, char)
    near = distance(word, other)
    assert automaton.distance(state) == (near if near <= edits else None)


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(TERMS), st.lists(st.tuples(st.integers(0, 9), st.sampled_from("aeiostz"), st.integers(0, 2)), max_size=3))
def test_pieces_lose_no_near_word(term, changes):
    word = term
    for at, char, kind in changes:
        at = min(at, len(word))
        word = word[:at] + (char if kind < 2 else "") + word[at + (kind > 0):]
    if not word:
        return
    found = tox.Matcher(TERMS, (), ())(word.encode())
    best = min((distance(word, t), t) for t in TERMS)
    if best[0] <= tox.allowed_edits(len(best[1])):
        assert found is not None and found[1] == best[0]
    elif all(distance(word, t) > tox.allowed_edits(len(t)) for t in TERMS):
        assert found is None


def labelled(spark, n=600):
    rng = random.Random(3)
    plain = [f"word{k}" for k in range(200)]
    texts, labels = [], []
    for i in range(n):
        own = [rng.choice(plain) for _ in range(60)]
        bad = i % 8 == 0
        if bad:
            for t in rng.sample(TERMS, 3):
                own.insert(rng.randint(0, 59), t)
        elif i % 8 == 1:
            own[30:30] = ["they", "said", f'"{rng.choice(TERMS)}"', "about", "him"]
        texts.append(" ".join(own))
        labels.append((i, 1, int(bad)))
    return documents(spark, texts), spark.createDataFrame(labels, LABELS)


def test_held_out_documents_misspellings_and_quotation(spark):
    docs, labels = labelled(spark)
    rows = tox.toxicity(docs, labels).collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 50
    assert sum(r.predicted == (r.doc_id % 8 == 0) for r in held) / len(held) > 0.97
    model = tox.fit(docs, labels, lambda i: ~tox.held_out(i))
    assert set(TERMS) <= set(model.terms)
    fresh = documents(spark, ["you are a wortless idiiot and a pathetik word3", "they said \"idiot\" about him word4", "word5"])
    scores = {r.doc_id: r.score for r in tox.score(fresh, model).collect()}
    assert scores[0] >= tox.THRESHOLD > scores[1] and scores[2] < tox.THRESHOLD


def test_awkward_and_empty_tables(spark):
    docs, labels = labelled(spark, 200)
    odd = spark.createDataFrame([(None, 1, 1), (3, None, None), (3, 1, 0), (3, 1, 1), (10**9, 1, 1)], LABELS)
    table = awkward(spark)
    rows = tox.toxicity(table, labels.union(odd)).collect()
    assert len(rows) == table.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 7 and r.score is not None}) <= 2
    assert tox.toxicity(empty(spark), labels).collect() == []
    assert tox.toxicity(table, labels.limit(0)).filter("predicted = 1").count() == 0
    kept = tox.without_toxic(docs.unionByName(docs.limit(1)), labels)
    assert kept.columns == docs.columns
    assert all(not any(t in r.text.split() for t in TERMS) for r in kept.collect())
    assert tox.without_toxic(table, labels).count() == table.count()


def fitted(spark, toxic, clean):
    labels = [(i, 1, int(i < len(toxic))) for i in range(len(toxic) + len(clean))]
    return tox.fit(documents(spark, toxic + clean), spark.createDataFrame(labels, LABELS), lambda i: i.isNotNull())


def test_a_word_of_a_stock_phrase_is_a_term(spark):
    plain = [f"word{i % 37} word{i % 41} word{i % 43}" for i in range(500)]
    model = fitted(spark, [f"{t} what a nincompoop indeed" for t in plain[:80]], plain[80:])
    assert "nincompoop" in model.terms


def test_copies_of_a_text_count_once(spark):
    rng = random.Random(5)
    plain = [f"word{i} word{i % 41} word{i % 43}" for i in range(400)]
    varied = [" ".join([t, *rng.sample(TERMS, 3)]) for t in plain[:60]]
    copies = ["blah copied over and over"] * 6000
    alone, beside = fitted(spark, varied, plain[60:]), fitted(spark, varied + copies, plain[60:])
    assert set(TERMS) <= set(alone.terms) and set(TERMS) <= set(beside.terms)
    assert "copied" not in beside.terms
    # Copies of a clean text do not change the weights of terms either.
    assert fitted(spark, varied, plain[60:] + plain[60:61] * 3000).terms == alone.terms
