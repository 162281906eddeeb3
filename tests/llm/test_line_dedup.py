import hashlib
import re

import numpy as np
from corpus import awkward, documents, empty
from starmill.llm import line_dedup as ld


def key(line):
    stripped = line.strip(" \t\n\x0b\x0c\r")
    return re.sub("[A-Z]", lambda m: m[0].lower(), stripped)


def brute(rows):
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        order = lambda x: -1 if x is None else x
        kept = [x for x in lines if len(holders.get(key(x), ())) < 5 or i == max(holders[key(x)], key=order)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def digest(df):
    return sorted(map(tuple, ld.dedup_digest(df).collect()), key=str)


LINE = "A line of more than forty code points, é and all, number {}"


def table(spark):
    texts = [f"{LINE.format(i % 3)}\n  {LINE.format(i % 3).upper()}\r\nown {i}\n{'short'}" for i in range(20)]
    return documents(spark, [*texts, "é" * 39, "é" * 40, *["é" * 40 + f"\n{i}" for i in range(4)], (None, LINE.format(0)),
                             (19, texts[19]), (19, LINE.format(1)), (500, "\n\n")], extra=True)


def test_digest_equals_brute_force(spark, monkeypatch):
    for docs in (table(spark), awkward(spark)):
        rows = docs.select("doc_id", "text").collect()
        assert digest(docs) == brute(rows)
    monkeypatch.setattr(ld, "FILTER_BYTES", 0)  # no filters: every line is looked up
    assert digest(docs) == brute(rows)
    monkeypatch.undo()
    monkeypatch.setattr(ld, "SHARD_KEYS", 1)
    assert digest(table(spark)) == brute(table(spark).select("doc_id", "text").collect())


def test_documents_keep_their_columns(spark):
    docs = table(spark)
    clean = ld.deduplicated(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    expected = sorted(b[3] for b in brute(docs.select("doc_id", "text").collect()))
    rows = clean.collect()
    assert sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in rows) == expected
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
    assert ld.deduplicated(empty(spark)).collect() == [] and digest(empty(spark)) == []


def test_filter_knows_all_and_forgets_what_is_deleted():
    rng = np.random.RandomState(1)
    hashes = np.unique(rng.randint(0, 1 << 62, 60_000).astype(np.uint64) * np.uint64(4))
    known, other = hashes[:40_000], hashes[40_000:]
    made = ld.CuckooFilter.from_bytes(ld.CuckooFilter.build(known).to_bytes())
    assert made.has(known).all() and made.has(other).mean() < 0.001
    made.delete(known[:20_000])
    assert made.has(known[20_000:]).all() and made.has(known[:20_000]).mean() < 0.01
    assert made.add(known[:20_000]) and made.has(known).all()


def test_a_full_filter_grows():
    same = np.arange(1, 2000, dtype=np.uint64) << np.uint64(44)  # all in few buckets
    assert ld.CuckooFilter.build(same).has(same).all()
    tight = ld.CuckooFilter(np.zeros((2, 4), np.uint16))
    assert not tight.add(np.arange(1, 40, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def test_insertions_are_reversible(spark):
    docs = table(spark).filter("doc_id is not null and doc_id <> 19")
    first, second = docs.filter("doc_id < 10"), docs.filter("doc_id >= 10")
    index = ld.LineIndex.empty(spark, shards=3).insert(first)
    both = index.insert(second)
    back = both.delete(second)
    state = lambda i: sorted(map(tuple, i.refs.collect()))
    assert state(back) == state(index) != state(both)
    assert state(both) == state(ld.LineIndex.empty(spark, shards=3).insert(docs))
    assert digest(docs) == sorted(
        (tuple(r) for r in ld.dedup_lines(docs, refs=both.refs).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()),
        key=str)
    line = ld.line_key("é".encode() * 40, 40)
    assert both.maybe_has([line]).tolist() == [True]
    assert back.delete(first).maybe_has([line]).tolist() == [False]
    # Before the others came, the line stood in too few documents to go.
    alone = first.filter("doc_id < 4")
    assert ld.dedup_lines(alone, refs=ld.LineIndex.empty(spark).insert(alone).refs).filter("n_dropped > 0").count() == 0
