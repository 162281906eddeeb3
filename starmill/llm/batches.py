"""Arrow batches in and out of tasks, a bounded number of bytes at a time."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.sources.stage import stage

# Keys of at most this many rows, of 16 bytes or so each, are sent to all tasks, so that the
# rows they are looked up for stay where they are. Beyond it both sides are shuffled.
SENT_ROWS = 200_000
# Bytes of text that a task holds as arrays at once; a longer text comes alone.
SLICE_BYTES = 1 << 20


def ship(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it, if it is not installed."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])


# Rows of an Arrow batch, unless the session sets its own number: texts are long.
BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
# And its bytes, likewise: it is held in the JVM and in the worker of each task.
BATCH_BYTES = 8 << 20
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(_BATCH) == "10000":  # the default
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    if spark.conf.get(_BYTES) == "67108864b":  # the default
        spark.conf.set(_BYTES, f"{BATCH_BYTES}b")
    return df.mapInArrow(function, schema)


def sent(keys: DataFrame, rows: int) -> DataFrame:
    """A table of narrow keys as a side of a join, broadcast if its counted rows are few."""
    return F.broadcast(keys) if rows <= SENT_ROWS else keys


def without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """Documents whose (doc_id, text_hash) is not in ``bad``, with their own columns."""
    bad, n = stage(bad.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "rejected")
    return docs.join(sent(bad, n), same_text(), "left_anti")


def same_text():
    """Whether a row of documents is meant by (_id, _hash)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_hash"))


def filled(column: pa.Array) -> pa.Array:
    """Texts with null as the empty text."""
    column = column.cast(pa.large_string())
    return pc.fill_null(column, "") if column.null_count else column


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of texts, and the n + 1 offsets of the texts in them."""
    column = filled(column)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def crc32_mod(ids: pa.Array, modulus: int) -> np.ndarray:
    """crc32 of the decimal text of each id, modulo ``modulus``; a null id counts as empty text."""
    from zlib import crc32

    return np.array([crc32(b"" if i is None else b"%d" % i) % modulus for i in ids.to_pylist()],
                    dtype=np.int64)
