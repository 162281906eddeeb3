"""Token counts of whole texts by a public tokenizer, without keeping any token.

A pre-tokenizer never joins what stands before a space to what follows it, if the
character before that space is not white space itself. So a text is cut there, the pieces
are encoded in batches of bounded size, and only their lengths are added up. Equal pieces
are encoded once: a task remembers the lengths of a bounded number of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.llm.batches import filled, map_arrow, slices

LIMIT = 512
# Bytes of pieces encoded in one call, pieces remembered by a task, and the longest piece
# worth remembering.
CALL_BYTES = 1 << 20
REMEMBERED = 400_000
REMEMBERED_LENGTH = 64

# A space whose neighbour to the left may be white space is no place to cut.
_UNSAFE = re.compile(r"\s ")
_SAFE_CUT = re.compile(r"(?<=\S)(?= )")


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def pieces(text: str) -> list[str]:
    """A text in pieces whose token counts add up to that of the whole."""
    if _UNSAFE.search(text) or text.startswith(" "):
        return _SAFE_CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + x for x in rest]]


class Counter:
    """Token counts of texts, with a bounded memory of pieces."""

    def __init__(self, path: str):
        self._encoder = _tokenizer(path)
        self._known: dict[str, int] = {}

    def _encode(self, new: list[str]) -> list[int]:
        counts, call, size = [], [], 0
        for piece in new:
            if call and size + len(piece) > CALL_BYTES:
                counts += [len(e) for e in self._encoder.encode_batch_fast(call, add_special_tokens=False)]
                call, size = [], 0
            call.append(piece)
            size += len(piece)
        return counts + [len(e) for e in self._encoder.encode_batch_fast(call, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[int]:
        cut = [pieces(t) for t in texts]
        if len(self._known) > REMEMBERED:
            self._known = {}
        known = self._known
        new = list({p for own in cut for p in own if p not in known})
        lengths = dict(zip(new, self._encode(new)))
        known.update((p, n) for p, n in lengths.items() if len(p) <= REMEMBERED_LENGTH)
        get = known.get
        return [sum([n if (n := get(p)) is not None else lengths[p] for p in own]) for own in cut]


def with_token_counts(docs: DataFrame, tokenizer_path: str, text: str = "text",
                      name: str = "n_tokens") -> DataFrame:
    """Add the number of tokens of a text column; null counts as the empty text, which has 0.

    ``tokenizer_path`` is a file of the ``tokenizers`` library that every executor has.
    No token is added at begin or end; special strings in a text are special tokens, as is
    the library's default. Rows are neither moved nor dropped.
    """
    fields = [*docs.schema.fields, T.StructField(name, T.LongType(), False)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        count = Counter(tokenizer_path)
        for batch in slices(batches, text):
            n = count(filled(batch.column(text)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())],
                                             names=[*batch.schema.names, name])

    return map_arrow(docs, run, T.StructType(fields))


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counted = with_token_counts(rows, tokenizer_path)
    return counted.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"))
