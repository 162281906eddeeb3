import hashlib
import random
import re

from corpus import awkward, documents, empty
from starmill.llm.decontaminate import contamination, contamination_digest, without_benchmark

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    wins = {}
    for item, text in items:
        w = words(text)
        for a in range(max(1, len(w) - 9) if w else 0):
            wins.setdefault(tuple(w[a:a + 10]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(x) for x in wins}:
            for a in range(len(w) - size + 1):
                if tuple(w[a:a + size]) in wins:
                    hit |= set(range(a, a + size))
                    found |= wins[tuple(w[a:a + size])]
        listed = ",".join(sorted(str(i) for i in found if i is not None))
        out.append((doc_id, len(w), len(hit), len(found - {None}), hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "1 AS n_words", "'x' AS window")


def test_digest_equals_brute_force(spark):
    rng = random.Random(2)
    few = ["a", "b", "É", "c1", "zz"]
    bench = [(i, " ".join(rng.choice(few) for _ in range(rng.choice([1, 2, 3, 9, 10, 11, 14])))) for i in range(8)]
    bench += [(100, None), (101, ""), (None, "a b c"), (102, "b b b b b b b b b b b b"), (0, bench[0][1])]
    docs = [(i, ", ".join(rng.choice(few).upper() for _ in range(rng.randint(0, 60)))) for i in range(40)]
    docs += [(None, "a b c"), (3, docs[3][1]), (50, "b " * 300), (51, None)]
    found = contamination_digest(documents(spark, docs, extra=True), items(spark, bench)).collect()
    assert sorted(map(tuple, found), key=str) == brute(docs, bench)


def test_awkward_and_empty_tables(spark):
    docs, bench = awkward(spark), items(spark, [(1, "own text 3")])
    rows = docs.select("doc_id", "text").collect()
    assert sorted(map(tuple, contamination_digest(docs, bench).collect()), key=str) == brute(rows, [(1, "own text 3")])
    assert contamination(empty(spark), bench).collect() == []
    none = contamination(docs, items(spark, []))
    assert none.filter("contaminated").count() == 0 and none.count() == docs.count()


def test_only_contaminated_documents_go(spark):
    docs = awkward(spark)
    kept = without_benchmark(docs, items(spark, [(1, "own text 3")]))
    assert kept.columns == docs.columns
    gone = docs.exceptAll(kept).collect()
    assert [r.text.endswith("own text 3") for r in gone] == [True]
