"""Benchmark decontamination as a prefix-filtered set join.

Every run of ten words of a benchmark item is a window. A document holds a window only
if it holds all its shingles (pairs of words), so one shingle decides whether to look
closer: the rarest over all documents, which is the prefix that exact containment needs.
Documents emit the places where such a shingle occurs; these join the windows on the
shingle, are cut by length and position, and compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.batches import filled, map_arrow, slices, utf8, without
from starmill.llm.words import ALPHANUMERIC, LOWER, Words, combine, mix, words
from starmill.sources.stage import stage

WINDOW_WORDS = 10
# Bits of the filter of shingles that documents are searched for: 2 MB, whatever the
# number of windows. A false hit costs a row that finds nothing in the join.
FILTER_BITS = 24
_BUCKET_BITS = 15  # of the built-in bitmap functions: 32768 bits a bucket


@dataclass(frozen=True)
class ShingleFilter:
    """A bitmap of shingle hashes; ``single`` says whether windows of one word exist."""

    bits: bytes
    single: bool

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        at = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
        table = np.frombuffer(self.bits, np.uint8)
        return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _pairs(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with the one after it, and the position of the first."""
    if len(w.hash) < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text = w.text
    at = np.flatnonzero(text[:-1] == text[1:])
    return combine([w.hash[at], w.hash[at + 1]]), at


def _ones(w: Words) -> np.ndarray:
    return mix(w.hash ^ np.uint64(0x5DEECE66D))


def _word_list(lowered: bytes, w: Words, first: int, last: int) -> list[str]:
    return [lowered[a:b].decode() for a, b in zip(w.start[first:last], w.end[first:last])]


def _cut_windows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        data, offsets = utf8(batch.column("text"))
        lowered, w = LOWER[data].tobytes(), words(data, offsets, ALPHANUMERIC)
        rows = []
        for i, item in enumerate(batch.column("item_id").to_pylist()):
            first, last = int(w.first[i]), int(w.first[i + 1])
            listed = _word_list(lowered, w, first, last)
            for a in range(max(1, len(listed) - size + 1) if listed else 0):
                n = min(size, len(listed))
                h = w.hash[first + a:first + a + n]
                one = Words(w.start[:n], w.end[:n], h, np.array([0, n]))
                marks = _pairs(one)[0] if n > 1 else _ones(one)
                rows.append((item, " ".join(listed[a:a + n]), n, marks.view(np.int64).tolist()))
        columns = list(zip(*rows)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
             pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.list_(pa.int64()))],
            names=["item_id", "window", "size", "marks"])


def windows(items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """One row per item and window: item_id, window (its words), size, marks (its shingles)."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, lambda b: _cut_windows(b, size),
                     "item_id long, window string, size int, marks array<long>").distinct()


def shingle_filter(marks: DataFrame, single: bool) -> ShingleFilter:
    """The bitmap of a column ``mark``; what comes to the driver is at most its fixed size."""
    at = F.shiftrightunsigned("mark", 64 - FILTER_BITS)
    parts = marks.select(at.alias("at")).groupBy(F.shiftright("at", _BUCKET_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit((1 << _BUCKET_BITS) - 1))).alias("bits"))
    bits = bytearray(1 << (FILTER_BITS - 3))
    for row in parts.collect():
        start = row["bucket"] << (_BUCKET_BITS - 3)
        bits[start:start + len(row["bits"])] = row["bits"]
    return ShingleFilter(bytes(bits), single)


def _found(w: Words, wanted: ShingleFilter) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that pass the filter, and the word positions where they start."""
    pairs, at = _pairs(w)
    hit = wanted.hits(pairs)
    marks, places = pairs[hit], at[hit]
    if wanted.single:
        ones = _ones(w)
        hit = np.flatnonzero(wanted.hits(ones))
        marks, places = np.concatenate([marks, ones[hit]]), np.concatenate([places, hit])
    return marks.view(np.int64), places


def _count(batches: Iterator[pa.RecordBatch], wanted: ShingleFilter) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found, _ = _found(words(*utf8(batch.column("text")), ALPHANUMERIC), wanted)
        mark, n = np.unique(found, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(mark), pa.array(n.astype(np.int64))], names=["mark", "n"])


_PLACE = ("doc_id long, text_hash long, n_words long, mark long, "
          "at int, context string, context_at int")


def _search(batches: Iterator[pa.RecordBatch], wanted: ShingleFilter, size: int) -> Iterator[pa.RecordBatch]:
    """A row without mark per document, and one per place that passes the filter, with the
    words around it that a window over that place can reach."""
    for batch in slices(batches, "text"):
        texts = filled(batch.column("text"))
        data, offsets = utf8(texts)
        lowered, w = LOWER[data].tobytes(), words(data, offsets, ALPHANUMERIC)
        marks, places = _found(w, wanted)
        of = w.text[places]
        low = np.maximum(w.first[of], places - (size - 1))
        high = np.minimum(w.first[of + 1], places + size)
        context = [" ".join(_word_list(lowered, w, a, b)) for a, b in zip(low.tolist(), high.tolist())]
        ids, hashes, counts = batch.column("doc_id"), batch.column("text_hash"), pa.array(w.counts)
        none = lambda kind: pa.nulls(batch.num_rows, kind)
        names = ["doc_id", "text_hash", "n_words", "mark", "at", "context", "context_at"]
        yield pa.RecordBatch.from_arrays(
            [ids, hashes, counts.cast(pa.int64()), none(pa.int64()), none(pa.int32()), none(pa.string()),
             none(pa.int32())], names=names)
        if len(places):
            pick = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pick), hashes.take(pick), counts.cast(pa.int64()).take(pick), pa.array(marks),
                 pa.array((places - w.first[of]).astype(np.int32)), pa.array(context, pa.string()),
                 pa.array((low - w.first[of]).astype(np.int32))], names=names)


def keyed(docs: DataFrame) -> DataFrame:
    """The columns that are searched. Rows with equal id and text are told apart by nothing
    and share their result; ``text_hash`` separates rows that share an id only."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn(
        "text_hash", F.xxhash64("text"))


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """Per document row: doc_id, text_hash, n_words, n_hit (words inside any occurrence of a
    window), item_ids (sorted as text) and their number n_items, contaminated.

    Words are maximal runs of ASCII letters and digits and of everything beyond ASCII,
    with A-Z lower-cased. An item of fewer than ``size`` words, but not none, is one
    window. Null texts have no words; an item with null id gives windows that hit words
    but is not listed. Repeated rows each have their result. Without items or without
    documents, nothing is hit and there is no row, respectively.
    """
    spark = docs.sparkSession
    all_windows, _ = stage(windows(items, size), "windows")
    marks = all_windows.select(F.explode("marks").alias("mark")).distinct()
    single = bool(all_windows.filter("size = 1").limit(1).count())
    searched = keyed(docs)

    # Rarity: how often each shingle of a window occurs in all documents.
    wanted = shingle_filter(marks, single)
    seen = map_arrow(searched.select("text"), lambda b: _count(b, wanted), "mark long, n long")
    seen = seen.groupBy("mark").agg(F.sum("n").alias("n"))
    ranked = (
        all_windows.select("window", "size").distinct()
        .join(all_windows.select("window", F.posexplode("marks").alias("offset", "mark")).distinct(), "window")
        .join(seen, "mark", "left")
        # Without its shingle in any document, a window is in none.
        .withColumn("n", F.coalesce("n", F.lit(0)))
    )
    prefixes, _ = stage(
        ranked.groupBy("window", "size")
        .agg(F.min_by(F.struct("mark", "offset", "n"), F.struct("n", "mark", "offset")).alias("p"))
        .filter("p.n > 0").select("window", "size", "p.mark", "p.offset"), "prefixes")

    first = shingle_filter(prefixes.select("mark"), single)
    places, _ = stage(map_arrow(searched, lambda b: _search(b, first, size), _PLACE), "places")

    start = F.col("at") - F.col("offset")
    # A mark that stands twice in a window is tried at its one offset for every place, so
    # no occurrence is missed.
    fits = (F.col("n_words") >= F.col("size")) & (start >= 0) & (start + F.col("size") <= F.col("n_words"))
    around = F.split("context", " ")
    same = F.array_join(F.slice(around, start - F.col("context_at") + 1, F.col("size")), " ") == F.col("window")
    hits = (
        places.filter(F.col("mark").isNotNull()).join(prefixes, "mark").filter(fits).filter(same)
        .select("doc_id", "text_hash", start.alias("from"), (start + F.col("size")).alias("to"), "window")
    )
    hits, _ = stage(hits, "window-hits")
    covered = F.aggregate(
        F.array_sort(F.collect_set(F.struct("from", "to"))),
        F.struct(F.lit(0).cast("int").alias("n"), F.lit(0).cast("int").alias("end")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["to"] - F.greatest(x["from"], acc["end"]))).cast("int").alias("n"),
            F.greatest(acc["end"], x["to"]).alias("end")),
        lambda acc: acc["n"].cast("long"))
    spans = hits.groupBy("doc_id", "text_hash").agg(covered.alias("n_hit"))
    found = (
        hits.select("doc_id", "text_hash", "window").distinct()
        .join(all_windows.select("window", "item_id").filter("item_id is not null"), "window")
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.transform(F.collect_set("item_id"), lambda x: x.cast("string"))).alias("item_ids"))
    )
    rows = places.filter(F.col("mark").isNull()).select("doc_id", "text_hash", "n_words")
    for side in (spans, found):
        keys = side.columns[:2]
        side = side.select(*[F.col(k).alias(f"_{k}") for k in keys], side.columns[2])
        rows = rows.join(
            side, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_text_hash")), "left"
        ).drop("_doc_id", "_text_hash")
    none = F.array().cast("array<string>")
    rows = rows.withColumns({"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "item_ids": F.coalesce("item_ids", none)})
    return rows.withColumns({
        "n_items": F.size("item_ids").cast("long"),
        "contaminated": F.col("n_hit") > 0,
    })


def contamination_digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    return contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def without_benchmark(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """The documents that hold no window of a benchmark item, with their own columns."""
    return without(docs, contamination(docs, items, size).filter("contaminated"))
