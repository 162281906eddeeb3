import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from corpus import awkward, documents, empty, sentence
from starmill.llm import jaccard_join as jj
from starmill.llm.components import components


def sets(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def brute(rows, size, percent):
    own = [(i, sets(t, size)) for i, t in rows]
    root = {i: i for i, s in own if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    linkable = [(i, s) for i, s in own if i is not None and s]
    for k, (i, a) in enumerate(linkable):
        for j, b in linkable[:k]:
            if 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    linked = {i for i, _ in linkable}
    return sorted((str(i), len(s), str(find(i) if i in linked and s else i)) for i, s in own)


def found(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def family(rng, n, size=120, edits=4):
    base = sentence(rng, size).split()
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(own))
            own[at:at + rng.randint(0, 2)] = [f"e{rng.randint(0, 99)}"]
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("size, percent, block, common", [
    (3, 90, 4096, 24), (3, 90, 7, 3), (5, 80, 7, 24), (5, 80, 4096, 5), (1, 50, 4096, 3)])
def test_components_equal_brute_force(spark, monkeypatch, size, percent, block, common):
    monkeypatch.setattr(jj, "BLOCK_SETS", block)
    monkeypatch.setattr(jj, "COMMON_SETS", common)
    monkeypatch.setattr(jj, "_SMALL_BLOCK", 4)
    rng = random.Random(size)
    texts = [t for n in (40, 12, 2, 3) for t in family(rng, n)] + family(rng, 20, 8, 1) + family(rng, 20, 12, 2)
    passage = sentence(rng, 60)
    texts += [sentence(rng, 30) + " " + passage + " " + sentence(rng, 30) for _ in range(15)]
    texts += [t.upper() for t in texts[:5]] * 2
    rng.shuffle(texts)
    docs = documents(spark, texts, extra=True)
    rows = [(i, t) for i, t in enumerate(texts)]
    assert found(jj.near_duplicates(docs, size, percent)) == brute(rows, size, percent)


def test_awkward_and_empty_tables(spark):
    docs = awkward(spark)
    rows = docs.select("doc_id", "text").collect()
    assert found(jj.near_duplicates(docs, 3, 90)) == brute(rows, 3, 90)
    assert jj.near_duplicates(empty(spark), 3, 90).collect() == []
    kept = jj.one_per_group(docs)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    assert sum(t in ("again", "another text of it") for t in texts) == 1 and texts.count("one") == 1 and texts.count(None) == 2 and "no id" in texts
    assert jj.one_per_group(empty(spark)).collect() == []


def test_no_link_is_lost_between_sets_at_the_bound(spark):
    """Pairs whose overlap is exactly the least, for many sizes."""
    rng, texts = random.Random(9), []
    rule = jj.Rule(1, 90)
    for a in [*range(8, 60), 100, 101, 333]:
        for b in (a, a - 1, a * 9 // 10 + 1):
            both = rule.least_overlap(a, b)
            if both <= min(a, b):
                tag = f"{a}.{b}."
                words = [f"{tag}{rng.random()}" for _ in range(a + b - both)]
                texts += [" ".join(words[:a]), " ".join(words[a - both:])]
    rows = list(enumerate(texts))
    assert found(jj.near_duplicates(documents(spark, texts), 1, 90)) == brute(rows, 1, 90)


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_sets_that_link_meet(percent):
    """Whatever shingles count as common, two sets at the bound share a meeting place."""
    rng, rule = np.random.RandomState(percent), jj.Rule(3, percent)
    for size in [*range(2, 40), 100, 400, 2000]:
        for _ in range(6):
            a = np.unique(rng.randint(1, 1 << 62, size).astype(np.uint64))
            other = size - rng.randint(0, size // 3 + 1)
            both = min(int(rule.least_overlap(len(a), other)), len(a), other)
            if 100 * both < percent * (len(a) + other - both):
                continue
            fresh = rng.randint(1, 1 << 62, other - both).astype(np.uint64)
            b = np.unique(np.concatenate([rng.permutation(a)[:both], fresh]))
            pool = np.concatenate([a, b])
            hot = jj.Common(np.unique(rng.permutation(pool)[:rng.randint(0, len(pool) + 1)]))
            if np.array_equal(a, b):
                continue
            part, index = jj._meeting_places(
                np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), rule, hot)
            shared = set(part[index == 0]) & set(part[index == 1])
            assert shared, (size, other, both)
            rest = max(n - rule.prefix(np.array([n]))[0] for n in (len(a), len(b)))
            assert rule.least_overlap(len(a), len(b)) <= len(shared) + rest
            part, index = jj._part_places(
                np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), rule, hot)
            assert set(part[index == 0]) & set(part[index == 1]), (size, other, both)


def test_bound_of_pairs_in_spark_equals_that_of_sets(spark):
    rule = jj.Rule(3, 80)
    rows = [(a, b, t) for a in (1, 4, 5, 25, 99, 4500) for b in (1, 5, 21, 25, 100, 5000) for t in (1, 2, 9, 400)]
    df = spark.createDataFrame(rows, "a long, b long, t long")
    kept = df.filter(rule.may_overlap(df.a, df.b, df.t)).collect()
    expected = [(a, b, t) for a, b, t in rows if rule.least_overlap(a, b) <= min(
        a, b, t + max(n - int(rule.prefix(np.array([n]))[0]) for n in (a, b)))]
    assert [tuple(r) for r in kept] == expected and 0 < len(expected) < len(rows)


@pytest.mark.parametrize("meeting", [2, 5])
def test_crowded_meetings_lose_no_link(spark, monkeypatch, meeting):
    """Sets that meet by shingles of very many sets, of which none is taken for common."""
    monkeypatch.setattr(jj, "SMALL_MEETING", meeting)
    monkeypatch.setattr(jj, "COMMON_SETS", 1000)
    rng = random.Random(meeting)
    passages = [sentence(rng, 50) for _ in range(3)]
    texts = [t for n in (30, 7, 3) for t in family(rng, n, 60, 3)]
    texts += [rng.choice(passages) + " " + sentence(rng, rng.choice([3, 10, 40])) for _ in range(60)]
    rows = list(enumerate(texts))
    assert found(jj.near_duplicates(documents(spark, texts), 3, 80)) == brute(rows, 3, 80)


def test_parts_of_a_set_are_sent_next_to_each_other():
    # Few sets have each part, so all rows are sent.
    part, a = np.tile(np.arange(50, dtype=np.uint64), 3), np.repeat([7, 5, 9], 50)
    rows = pa.Table.from_batches(list(jj._sent(part, a, False)))
    assert sorted(zip(rows["part"].to_pylist(), rows["a"].to_pylist())) == sorted(zip(part.tolist(), a.tolist()))
    assert rows["a"].to_pylist() == [5] * 50 + [7] * 50 + [9] * 50


def test_shingles_are_counted_over_all_tasks(spark):
    """A passage that each task sees once is as common as one that a task sees often."""
    rng = random.Random(4)
    passage = sentence(rng, 12)
    texts = [sentence(rng, 20) + " " + passage for _ in range(jj.COMMON_SETS)] + [sentence(rng, 20)]
    docs = documents(spark, texts).repartition(len(texts))
    rule = jj.Rule(3, 80)
    common = jj.common_shingles(docs, rule)
    values, _ = jj._unique_sets(pa.RecordBatch.from_pydict({"text": [passage]}), rule)
    assert (common.grade(values) > 0).all() and len(common.hashes) == 10
    other, _ = jj._unique_sets(pa.RecordBatch.from_pydict({"text": [texts[-1]]}), rule)
    assert not common.grade(other).any()


@pytest.mark.parametrize("packed", [50, 1 << 20])
def test_packed_shingles_give_exact_counts(monkeypatch, packed):
    monkeypatch.setattr(jj, "_PACKED", packed)
    rng, rule = random.Random(packed), jj.Rule(2, 80)
    vocabulary = sentence(rng, 12).split()
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40))) for _ in range(60)] + [None]
    batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[i:i + 9], pa.string())}) for i in range(0, 61, 9)]
    rows = pa.Table.from_batches([r for b in batches for r in jj._packed(iter([b]), rule)]).sort_by("place")
    result = pa.Table.from_batches(list(jj._counted(iter(rows.to_batches(max_chunksize=7)), 3)))
    values = np.concatenate([jj._unique_sets(b, rule)[0] for b in batches])
    shingle, n = np.unique(values >> np.uint64(28), return_counts=True)
    expected = [(int(k), int(c)) for k, c in zip(shingle, n) if c >= 3]
    assert sorted(zip(result["shingle"].to_pylist(), result["n"].to_pylist())) == expected and expected


def test_sets_of_a_cut_cluster_are_sent_once_to_each_other_part(spark, monkeypatch):
    rng, rule, parts = np.random.RandomState(1), jj.Rule(3, 80), 4
    rows = [(1, i % parts, parts, i, np.unique(rng.randint(0, 1 << 60, 30)).tolist()) for i in range(40)]
    # 1 and 2 are the first of their parts, 38 and 39 are left over.
    rows[2] = (*rows[2][:4], rows[1][4])
    rows[39] = (*rows[39][:4], sorted([*rows[38][4][:28], 5]))
    sets = spark.createDataFrame(rows, "cluster long, part int, parts int, node long, set array<long>")
    sent, blocks = [], jj._blocks
    monkeypatch.setattr(jj, "_blocks", lambda df, r: sent.append(df.count()) or blocks(df, r))
    links = jj._links(sets, True, rule)
    assert sorted((r.a, r.b) for r in links.distinct().collect()) == [(1, 2), (38, 39)]
    assert sent[0] == 40 and sent[-1] <= 40 * (parts - 1)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(1000, 1100)]
    edges = spark.createDataFrame([*path, *star, (5, 5), (1000, 1001), (None, 3)], "a long, b long")
    roots = {r.node: r.root for r in components(edges, "test").collect()}
    assert roots == {**{i: 100 for i in range(101, 161)}, **{i: 7 for i in range(1000, 1100)}}


def most_bytes(work):
    """What ``work`` returns, and the bytes it holds at most."""
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_worker_holds_a_few_arrays_of_its_texts_at_once():
    rule = jj.Rule(5, 80)
    own = [" ".join(f"w{i * 7 % 9973}" for i in range(k, k + 1000)) for k in range(0, 160_000, 1000)]
    texts = [None, "", "two words", *own]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    size = sum(len(t) for t in own)
    assert 1 << 19 < size < 1 << 20
    jj._unique_sets(batch.slice(0, 10), rule)
    (values, offsets), held = most_bytes(lambda: jj._unique_sets(batch, rule))
    assert held < 16 * size
    alone = [jj._unique_sets(batch.slice(i, 1), rule)[0] for i in range(len(texts))]
    assert values.tolist() == np.concatenate(alone).tolist()
    assert np.diff(offsets).tolist() == [len(a) for a in alone]

    many = np.arange(4096 * 20, dtype=np.uint64)
    odd, held = most_bytes(lambda: jj._parities(many, np.arange(0, len(many) + 1, 20)))
    assert held < 3 * odd.nbytes
    assert all(set(np.flatnonzero(odd[i])) == {v % 1024 for v in range(i * 20, i * 20 + 20)} for i in (0, 255, 256, 4095))


def test_shingles_are_packed_in_little_more_than_their_own_memory(monkeypatch):
    sets = np.random.RandomState(1).randint(0, 1 << 62, (16, 1 << 14)).astype(np.uint64)
    left = iter(sets)
    batch = pa.RecordBatch.from_arrays([pa.array(["x"])], names=["text"])
    monkeypatch.setattr(jj, "_unique_sets", lambda batch, rule: (next(left).copy(), None))
    monkeypatch.setattr(jj, "_PACKED", sets.size)
    rows, held = most_bytes(lambda: list(jj._packed(iter([batch] * 16), jj.Rule(5, 80))))
    assert held < 2.5 * sets.nbytes
    place, keys = (rows[0].column(c).to_pylist() for c in ("place", "keys"))
    low = [p << 24 | int.from_bytes(k[i:i + 3], "little") for p, k in zip(place, keys) for i in range(0, len(k), 3)]
    assert low == sorted(int(v) >> 28 for v in sets.ravel())
