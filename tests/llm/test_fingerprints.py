import hashlib
import random

from corpus import awkward, documents, empty, sentence
from pyspark.sql import functions as F
from starmill.llm.fingerprints import LENGTH, fingerprint, fingerprint_neighbours, fingerprints, likeness, spliced


def brute(rows):
    """Rows (doc_id, text) in order of id, then text."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), fingerprint(t.encode()),
                    fingerprint(edited.encode())))
    return sorted(out, key=str)


def test_neighbours_equal_brute_force(spark):
    docs = awkward(spark)
    for parts in ("1", "3", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found = fingerprint_neighbours(docs).collect()
        assert sorted([tuple(r)[:5] for r in found], key=str) == brute(docs.select("doc_id", "text").collect())
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)


def test_no_documents_and_a_single_one(spark):
    assert fingerprint_neighbours(empty(spark)).collect() == []
    one = fingerprint_neighbours(documents(spark, ["abcdef"])).first()
    assert one.near_next == 1.0
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()


def test_an_edit_leaves_most_of_a_signature(spark):
    rng = random.Random(1)
    text = sentence(rng, 800)
    edited = text[:2000] + "something else" + text[2100:]
    pairs = spark.createDataFrame(
        [(fingerprint(text.encode()), fingerprint(edited.encode()), fingerprint(sentence(rng, 800).encode()))],
        "a string, b string, c string")
    near = pairs.select(likeness(F.col("a"), F.col("b")), likeness(F.col("a"), F.col("c")),
                        likeness(F.col("a"), F.col("a"))).first()
    assert near[0] > 0.8 and near[1] < 0.2 and near[2] == 1.0


def test_signatures_are_short_and_cover_repeated_text():
    for text in (b"ab " * 50_000, b"x", bytes(100_000)):
        level, first, second = fingerprint(text).split(":")
        assert 0 < len(first) <= LENGTH and len(second) <= LENGTH and int(level) >= 2


def test_fingerprint_column_keeps_the_others(spark):
    docs = awkward(spark)
    rows = fingerprints(docs)
    assert rows.columns == [*docs.columns, "fingerprint"]
    assert rows.count() == docs.count()


def test_spliced_counts_code_points():
    assert spliced("äöüß", "日本語") == "äö日本"
    assert spliced("abcd", "") == "ab"
