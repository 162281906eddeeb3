"""Mixing of sources to target weights by iterative proportional fitting.

Documents are tokens in cells of source, language and topic. Raking scales the cells to
one set of target shares after the other, again and again, until all three hold at once.
A document is then kept with a probability in proportion to the factor of its cell, such
that a given share of all tokens is expected. A cell that would need more than it has is
kept whole and brings a weight above one for what is lacking.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.llm.batches import filled, map_arrow, slices
from starmill.llm.words import LOWER_BYTES
from starmill.sources.stage import stage

MARGINS = ("source", "lang", "topic")
# Target shares are token shares to this power: 1 keeps the mix, 0 makes all equal.
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.5}
SWEEPS = 8
KEEP = 0.5  # share of all tokens that the sample is to have
TOPICS = 8
TOPIC_BYTES = 6
SALT = "mix-1"
NONE = "(none)"

# Names of the columns that are added to rows while they are weighed.
_TOKENS, _TOPIC = "_mix_tokens", "_mix_topic"


def topic_of(words: list[bytes]) -> int:
    """A stand-in for a topic where documents bring none: the bucket of the most frequent
    word of ``TOPIC_BYTES`` or more, the first by name of several; -1 without one."""
    counts = Counter(w for w in words if len(w) >= TOPIC_BYTES)
    if not counts:
        return -1
    most = max(counts.values())
    word = min(w for w, n in counts.items() if n == most)
    return int(hashlib.md5(word).hexdigest()[:8], 16) % TOPICS


def with_features(docs: DataFrame) -> DataFrame:
    """Rows with their tokens (words without ASCII white space, A-Z lower-cased, and one for
    the end) and topic."""
    fields = [*docs.schema.fields, T.StructField(_TOKENS, T.LongType()), T.StructField(_TOPIC, T.IntegerType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            listed = [t.encode().translate(LOWER_BYTES).split() for t in filled(batch.column("text")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(w) + 1 for w in listed], pa.int64()),
                 pa.array([topic_of(w) for w in listed], pa.int32())],
                names=[*batch.schema.names, _TOKENS, _TOPIC])

    return map_arrow(docs, run, T.StructType(fields))


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) that the id fixes."""
    seed = F.concat(F.lit(f"{SALT}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(seed.cast("binary")), 1, 12), 16, 10).cast("double") / float(16 ** 12)


def _cell() -> list[Column]:
    named = [F.coalesce(F.col(c).cast("string"), F.lit(NONE)).alias(f"_{c}") for c in ("source", "lang")]
    return [*named, F.col(_TOPIC).alias("_topic")]


def rake(cells: DataFrame, powers=None, sweeps: int = SWEEPS) -> DataFrame:
    """Cells (_source, _lang, _topic, tokens) with ``factor``: raked share over share of tokens.

    Margins are raked in turn, ``sweeps`` times. Each step reduces the cells by key and
    joins the sums; nothing is collected, however many sources there are.
    """
    powers = powers or POWERS
    targets = {}
    for m in MARGINS:
        power = F.pow(F.sum("tokens").cast("double"), F.lit(powers[m])).alias("p")
        own, _ = stage(cells.groupBy(f"_{m}").agg(power), "targets")
        whole = own.agg(F.sum("p")).first()[0]
        targets[m] = own.select(f"_{m}", (F.col("p") / F.lit(whole)).alias("t"))
    whole = cells.agg(F.sum("tokens")).first()[0]
    rows = cells.withColumn("w", F.col("tokens") / F.lit(whole))
    for _ in range(sweeps):
        for m in MARGINS:
            sums = rows.groupBy(f"_{m}").agg(F.sum("w").alias("now")).join(targets[m], f"_{m}")
            sums = sums.select(f"_{m}", (F.col("t") / F.col("now")).alias("up"))
            rows = rows.join(sums, f"_{m}").withColumn("w", F.col("w") * F.col("up")).drop("up")
        rows, _ = stage(rows, "raked")
    return rows.select("_source", "_lang", "_topic", "tokens", (F.col("w") * F.lit(whole) / F.col("tokens")).alias("factor"))


def _scale(factors: DataFrame, keep: float) -> float:
    """The number by which factors become probabilities with the expected share of tokens,
    if those above one are cut to one."""
    total = factors.agg(F.sum("tokens")).first()[0]
    scale = 0.0
    while True:
        whole = F.col("factor") * F.lit(scale) > 1
        some, rest = factors.agg(
            F.sum(F.when(whole, F.col("tokens")).otherwise(0)),
            F.sum(F.when(whole, 0.0).otherwise(F.col("tokens") * F.col("factor")))).first()
        after = (keep * total - some) / rest if rest else scale
        if after <= scale * (1 + 1e-12):  # it only grows, and each time more cells are whole
            return scale
        scale = after


def weighed(rows: DataFrame, features: DataFrame, powers=None, keep: float = KEEP) -> DataFrame:
    """Rows with ``_mix_factor``, ``_mix_probability`` and ``_mix_weight`` of their cells; ``features`` are
    rows of the same documents that are cheap to read again."""
    cells, n = stage(features.groupBy(*_cell()).agg(F.sum(_TOKENS).alias("tokens")), "cells")
    if not n:
        return rows.withColumns({c: F.lit(1.0) for c in ("_mix_factor", "_mix_probability", "_mix_weight")})
    factors, _ = stage(rake(cells, powers), "factors")
    wanted = F.col("factor") * F.lit(_scale(factors, keep))
    factors = factors.select(
        "_source", "_lang", "_topic", F.col("factor").alias("_mix_factor"),
        F.least(wanted, F.lit(1.0)).alias("_mix_probability"), F.greatest(wanted, F.lit(1.0)).alias("_mix_weight"))
    source, lang = (F.coalesce(F.col(c).cast("string"), F.lit(NONE)) for c in ("source", "lang"))
    same = (source == F.col("_source")) & (lang == F.col("_lang")) & (F.col(_TOPIC) == F.col("_topic"))
    return rows.join(factors, same).drop("_source", "_lang", "_topic")


def _features(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang",
                       F.col("text").cast("string").alias("text"))
    return stage(with_features(rows).drop("text"), "mix-features")[0]


def mixture(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, source, lang, topic, n_tokens, factor, probability, weight, kept.

    ``factor`` is the raked share of the cell over its share of tokens. A document is kept if
    a number in [0, 1) that its id fixes is below ``probability``; ``weight`` is above one
    in cells that lack documents. A missing source or language counts like "(none)". The end of a document is a token, so no cell is empty. Rows that repeat an
    id are decided by the same number. An empty table gives an empty result.
    """
    features = _features(docs)
    return weighed(features, features).select(
        "doc_id", "source", "lang", F.col(_TOPIC).alias("topic"), F.col(_TOKENS).alias("n_tokens"),
        *[F.round(f"_mix_{c}", 6).alias(c) for c in ("factor", "probability", "weight")],
        (uniform(F.col("doc_id")) < F.col("_mix_probability")).alias("kept"))


def mixed(docs: DataFrame, powers=None, keep: float = KEEP) -> DataFrame:
    """The documents of the sample, with their own columns, ``mix_probability`` and
    ``mix_weight``."""
    rows = with_features(docs.withColumn("text", F.col("text").cast("string")))
    found = weighed(rows, _features(docs), powers, keep)
    kept = found.filter(uniform(F.col("doc_id")) < F.col("_mix_probability"))
    own = [c for c in docs.columns if c not in ("mix_probability", "mix_weight")]
    return kept.select(*own, F.col("_mix_probability").alias("mix_probability"), F.col("_mix_weight").alias("mix_weight"))
