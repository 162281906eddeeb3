"""Small tables with everything that can go wrong in a row."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def sentence(rng: random.Random, n: int, stem: str = "w") -> str:
    return " ".join(f"{stem}{rng.randint(0, 4000)}x" for _ in range(n))


def documents(spark, texts, extra=False):
    """Documents numbered from 0, or given as (doc_id, text); ``extra`` adds columns with
    the names that operators use."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    rows = [(i, t, "en" if (i or 0) % 3 else None, f"s{(i or 0) % 2}" if i is not None else None,
             None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        for name in ("n_words", "node", "part", "score", "key", "kept", "topic", "weight", "factor", "row", "text_hash"):
            df = df.selectExpr("*", f"'x' AS {name}")
    return df


def awkward(spark, extra=True):
    rng = random.Random(5)
    long = sentence(rng, 30_000)
    line = "The same line, which is long enough to be a key of its own"
    near = sentence(rng, 200)
    return documents(spark, [
        None, "", " \t\n", "one", "one", "Two words", long, long + " end", near, near.replace("x", "x", 1) + " tail",
        *[f"{line}\nown text {i}" for i in range(6)], "\n\n" + line.upper() + " ", "é" * 50, "日本 " * 60,
        "a@b.co, 1.2.3.4 +1 (555) 123-4567 4111 1111 1111 1111", "\x00\x01 nul", "<|endoftext|> x",
        (None, "no id"), (None, None), (70, "again"), (70, "again"), (70, "another text of it"), (8, near),
    ], extra)


def empty(spark):
    return documents(spark, [])
