"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes marks where chunks end, so an edit moves only the
chunks that it touches. Each chunk gives one character of a signature. The block size, a
power of two, is the smallest that keeps the signature within 64 characters; a second
signature at twice that size lets texts of somewhat different lengths be compared. A
text that repeats itself may have very few chunks at one size and too many at the size
below; it takes the smaller one, and its last character stands for the whole rest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.batches import map_arrow, slices
from starmill.llm.words import mix
from starmill.sources.stage import stage

WINDOW = 7
LENGTH = 64
# A chunk has at least four bytes on average.
FIRST_LEVEL = 2
LAST_LEVEL = 30

_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+-", np.uint8)
_WEIGHTS = [np.uint32(pow(0x01000193, WINDOW - k, 1 << 32)) for k in range(WINDOW)]
_NEVER = 64


def _rolling(data: np.ndarray) -> np.ndarray:
    """A hash of the last seven bytes at every position."""
    n = len(data)
    padded = np.zeros(n + WINDOW - 1, np.uint32)
    padded[WINDOW - 1:] = data
    total = padded[:n] * _WEIGHTS[0]
    for k in range(1, WINDOW):
        total += padded[k:n + k] * _WEIGHTS[k]
    total ^= total >> np.uint32(15)
    total *= np.uint32(0x85EBCA6B)
    return total ^ (total >> np.uint32(13))


def _signature(rolled: np.ndarray, ends: np.ndarray) -> str:
    """A character per chunk; beyond the limit, the last one stands for all the rest."""
    starts = np.concatenate([[0], ends[ends < len(rolled)]])[:LENGTH]
    sums = np.add.reduceat(rolled, starts, dtype=np.uint64)
    return _ALPHABET[(mix(sums) >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def fingerprint(data: bytes) -> str:
    """``level:signature:signature at the next level``; equal bytes, equal fingerprints.

    The empty text has the fingerprint ``2::``.
    """
    if not data:
        return f"{FIRST_LEVEL}::"
    rolled = _rolling(np.frombuffer(data, np.uint8))
    # A chunk of level k ends where k low bits are zero, so ends of a level are ends below it.
    ends = np.flatnonzero((rolled & np.uint32((1 << FIRST_LEVEL) - 1)) == 0)
    low, level = rolled[ends], FIRST_LEVEL
    ends = ends + 1
    while True:
        keep = (low & np.uint32((1 << (level + 1)) - 1)) == 0
        coarse = ends[keep]
        if len(ends) < LENGTH or len(coarse) < LENGTH // 8 or level == LAST_LEVEL:
            return f"{level}:{_signature(rolled, ends)}:{_signature(rolled, coarse)}"
        ends, low, level = coarse, low[keep], level + 1


def _common_run(a: Column, b: Column) -> Column:
    """Whether two signatures share a run; two unrelated ones rarely do."""
    shorter = F.least(F.length(a), F.length(b))
    run = F.greatest(F.lit(1), F.least(F.lit(4), F.floor(shorter / 4))).cast("int")
    starts = F.sequence(F.lit(1), F.greatest(F.length(a) - run + 1, F.lit(1)))
    return F.exists(starts, lambda i: F.instr(b, F.substr(a, i, run)) > 0)


def _same_size(a: Column, b: Column) -> Column:
    longer = F.greatest(F.length(a), F.length(b))
    near = 1 - F.levenshtein(a, b) / longer
    return F.when((longer > 0) & (F.length(a) > 0) & (F.length(b) > 0) & _common_run(a, b), near).otherwise(0.0)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 for two fingerprints: 1 less the edit distance of signatures at the same block
    size, as a share of the longer one. Fingerprints whose block sizes are more than one
    step apart, or whose signatures share no run of characters, have 0."""
    pa_, pb = F.split(a, ":"), F.split(b, ":")
    level_a, level_b = pa_[0].cast("int"), pb[0].cast("int")
    return (
        F.when(a == b, F.lit(1.0))
        .when(level_a == level_b, F.greatest(_same_size(pa_[1], pb[1]), _same_size(pa_[2], pb[2])))
        .when(level_a + 1 == level_b, _same_size(pa_[2], pb[1]))
        .when(level_a == level_b + 1, _same_size(pa_[1], pb[2]))
        .when(a.isNotNull() & b.isNotNull(), F.lit(0.0))
    )


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of a text column; null counts as the empty text."""
    fields = docs.schema.fields + docs.select(F.lit("").alias(name)).schema.fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            prints = [fingerprint((t or "").encode()) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())],
                                             names=[*batch.schema.names, name])

    return map_arrow(docs, run, type(docs.schema)(fields))


def spliced(own: str, following: str) -> str:
    """``own`` with its last half (rounded down) replaced by as much of the next text's start."""
    half = len(own) // 2
    return own[:len(own) - half] + following[:half]


_ROW = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, next_fingerprint string, part int, end string, text string")
_FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
           "next_fingerprint", "part", "end", "text"]


def _result(doc_id, own: str, mark: str, following: str, next_mark: str) -> tuple:
    edited = spliced(own, following).encode()
    return (doc_id, len(own), hashlib.sha256(edited).hexdigest(), mark, fingerprint(edited), next_mark,
            None, None, None)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int32(), pa.string(), pa.string()]
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_FIELDS)


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results for all rows of a sorted partition but its last, whose next row is in another;
    the texts at both ends of the partition follow as rows of their own."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    last = None
    for batch in slices(batches, "text"):
        rows = []
        for doc_id, own in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            own = own or ""
            mark = fingerprint(own.encode())
            if last is None:
                rows.append((doc_id, None, None, mark, None, None, part, "first", own))
            else:
                rows.append(_result(*last, own, mark))
            last = (doc_id, own, mark)
        yield _batch(rows)
    if last is not None:
        yield _batch([(last[0], None, None, last[2], None, None, part, "last", last[1])])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        yield _batch([
            _result(r["doc_id"], r["text"], r["fingerprint"], r["next_text"], r["next_mark"])
            for r in batch.to_pylist()
        ])


def fingerprint_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of the text spliced with the next one, and how near they are.

    The next text is that of the following ``doc_id``; the last is followed by the first.
    Rows with equal ids follow one another by text, and null ids come first. A single row
    is its own next. Null counts as the empty text. Columns: doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Rows move once, by ranges of the id; only the two texts at the ends of each partition
    move again. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    done, _ = stage(map_arrow(ordered, _along, _ROW), "fingerprints")

    # Two rows per partition. The next partition with rows holds the text that follows.
    ends = done.filter(F.col("end").isNotNull())
    along = Window.orderBy("part")
    first = ends.filter(F.col("end") == "first").select(
        "part", F.col("text").alias("first_text"), F.col("fingerprint").alias("first_mark"))
    order = first.select(
        "part",
        F.coalesce(F.lead("part").over(along), F.first("part").over(along)).alias("next_part"))
    last = (
        ends.filter(F.col("end") == "last").join(order, "part")
        .join(first.select(F.col("part").alias("next_part"), F.col("first_text").alias("next_text"),
                           F.col("first_mark").alias("next_mark")), "next_part")
        .select("doc_id", "text", "fingerprint", "next_text", "next_mark")
    )
    whole = done.filter(F.col("end").isNull()).unionByName(map_arrow(last, _across, _ROW))
    mark = F.col("fingerprint")
    return whole.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(mark, F.col("edited_fingerprint")).alias("near_edited"),
        likeness(mark, F.col("next_fingerprint")).alias("near_next"),
    )
