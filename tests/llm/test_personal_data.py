import hashlib
import random
import re

from corpus import awkward, documents, empty
from starmill.llm import personal_data as pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def brute(text):
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]
    return out


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(1)
    parts = ["1", "25", "4", "0", "9", ".", "+", "-", " ", "a", "@", "(", ")", "b.c", "%", "1.2.3.4", "é", "4111111111111111"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 25)))
        assert pii.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    assert pii.base_spans("1" * 200_000 + "." * 200_000 + "@" * 100_000 + "+1" + "-" * 200_000) == []


def test_digest_of_an_awkward_table(spark):
    docs = awkward(spark)
    rows = pii.personal_data(docs).collect()
    assert len(rows) == docs.count()
    expected = sorted(str((i, _listed(brute(t or "")))) for i, t in docs.select("doc_id", "text").collect())
    assert sorted(str((r.doc_id, r.base_sha256)) for r in rows) == expected
    assert pii.personal_data(empty(spark)).collect() == []


def _listed(spans):
    text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)
    return hashlib.sha256(text.encode()).hexdigest()


def test_contexts_of_known_ones_find_unseen_ones(spark):
    texts = [f"word{i} phone: +1 555 123 {1000 + i} end" for i in range(12)]
    texts += ["call me, phone: 0555/123-77 thanks", "version: 1.10-2 of it", *[f"version: 2.{i}-1" for i in range(9)]]
    rows = {r.doc_id: r for r in pii.personal_data(documents(spark, texts)).collect()}
    assert rows[12].n_found == 1 and rows[12].n_phone == 0
    kind, start, end = rows[12].spans.split(":")
    assert kind == "phone" and texts[12][int(start):int(end)] == "0555/123-77"
    assert rows[13].spans == "" and rows[0].spans.startswith("phone:")
