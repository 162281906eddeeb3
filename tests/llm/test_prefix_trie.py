import hashlib
import random
from collections import defaultdict
from zlib import crc32

import pytest
from starmill.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_force(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            item = f"{len(role.encode())}:{role}{text}"
            own[conv].append((turn is not None, turn or 0, hashlib.md5(item.encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, w in whole.items():
        for d in range(len(w) + 1):
            members[w[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    below = {}
    for p in sorted(members, key=len, reverse=True):
        own_saved = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        kids = [below[k] for k in children[p]]
        below[p] = (sum(k[0] for k in kids) if kids else 1, own_saved + sum(k[1] for k in kids))
    out = set()
    for p, of in members.items():
        ends = ",".join(map(str, sorted(c for c in of if whole[c] == p)))
        out.add((min(of), len(p), min(members[p[:-1]]) if p else None, len(of), len(children[p]), *below[p],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def digest(spark, rows, extra=False, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    if extra:
        for name in ("depth", "x", "y", "item", "at", "block", "chars", "h", "head", "first", "n_convs", "weight"):
            df = df.selectExpr("*", f"'z' AS {name}")
    out = pt.trie_digest(df)
    assert out.columns == COLUMNS
    found = [tuple(r) for r in out.collect()]
    assert len(found) == len(set(found))
    return set(found)


def corpus(seed, n=60, groups=3):
    """Few words, so that beginnings, whole conversations and nested ones are shared."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        conv = 100 * rng.randint(0, groups) + (0 if rng.random() < .1 else k % 100)
        rows += [(conv, t, rng.choice("us"), rng.choice(["", "a", "bb", "日本"])) for t in range(rng.choice([1, 2, 3, 8, 9]))]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_digest_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(pt, "BLOCK", 3)
    monkeypatch.setattr(pt, "PIECE", 7)
    rows = corpus(seed)
    assert digest(spark, rows) == brute_force(rows)


def test_nulls_ties_repeats_and_clashing_names(spark):
    rows = [(0, 0, "u", "hello"), (0, None, None, None), (0, None, "u", None), (0, 2, "a", "x"), (0, 2, "a", "b"),
            (0, 2, "a", "x"), (0, 3, "u", "y" * 200_000), (None, 1, "u", "nobody"), (None, None, None, None),
            (5, 0, "u", "hello"), (5, 0, "u", "hello"), (7, 1, None, ""), (123, 0, "u", "no first one"), (-3, 1, "u", "minus"),
            (-100, 0, "u", "minus"), (205, 9, "u", "alone"), (10 ** 15, 4, "", "far"), (10 ** 15 + 1, 4, "", "far")]
    assert digest(spark, rows, extra=True) == brute_force(rows)


def test_empty_tables_and_conversations_without_turns(spark):
    assert digest(spark, []) == set()
    assert digest(spark, [(None, 1, "u", "x")]) == set()
    # One turn of its own, of which the shared beginning takes the place, and no first conversation.
    alone = next(c for c in range(101, 200) if crc32(str(c).encode()) % 6 > 0)
    rows = [(alone, 0, "u", "gone")]
    assert digest(spark, rows) == brute_force(rows) == {
        (alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())}


def test_a_long_conversation_and_many_copies(spark):
    rows = [(100 * k, t, "u", f"t{t}") for k in (1, 2) for t in range(2500)]
    rows += [(100 * k, 0, "u", "the same") for k in range(10, 400)]
    rows += [(100 * k, t, "u", f"t{t}") for k in (3,) for t in range(1500)]
    assert digest(spark, rows) == brute_force(rows)


def test_rows_with_strings_and_small_numbers(spark):
    rows = corpus(9, 20)
    small = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    assert {tuple(r) for r in pt.trie_digest(small).collect()} == brute_force(rows)


def test_ends_are_listed_in_order_over_pieces(spark, monkeypatch):
    monkeypatch.setattr(pt, "PIECE", 10)
    ends = spark.range(95).selectExpr("id * 3 AS conv_id", "id % 2 AS depth", "7L AS x", "9L AS y")
    rows = {r.depth: r.ends_sha256 for r in pt.ends_digests(pt.end_lists(ends)).collect()}
    assert rows == {d: hashlib.sha256(",".join(str(3 * i) for i in range(d, 95, 2)).encode()).hexdigest() for d in (0, 1)}
