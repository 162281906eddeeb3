"""Reversible deduplication of lines over documents.

The state is exact: a table of references (line key, document, number of its rows that
hold the line), from which come counts per key. Adding documents adds references and
deleting documents takes them away, so a line that was dropped comes back when enough of
its holders are gone. In front of the exact table stand cuckoo filters, one per shard of
the keys; a document whose lines none of them knows is finished without a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.batches import filled, map_arrow, same_text, sent, slices
from starmill.llm.words import LOWER_BYTES, mix
from starmill.sources.stage import new_stage_path, stage

MIN_CHARS = 40
MIN_DOCS = 5
# Keys per shard, and the size to which all filters together are sent to every task.
# Beyond it every line of a document is looked up in the exact table instead.
SHARD_KEYS = 200_000
FILTER_BYTES = 64 << 20

_SPACE = b" \t\n\x0b\x0c\r"
_SLOTS = 4
_KICKS = 500


class CuckooFilter:
    """A set of 64-bit hashes in two candidate buckets of four 16-bit tags each.

    Knows every hash that was added and not deleted; of others, about 1 in 8000 by error.
    A hash that finds no place makes the table twice as large, from the hashes given, so
    that none is lost.
    """

    def __init__(self, buckets: np.ndarray):
        self.buckets = buckets  # n x 4, n a power of two; 0 is a free slot

    @classmethod
    def build(cls, hashes: np.ndarray) -> CuckooFilter:
        hashes = np.unique(hashes.astype(np.uint64))
        n = 1 << max(1, int(np.ceil(np.log2(max(1, len(hashes)) / _SLOTS / 0.84))))
        while True:
            made = cls(np.zeros((n, _SLOTS), np.uint16))
            if made._fill(hashes):
                return made
            n *= 2

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        last, hashes = np.uint64(len(self.buckets) - 1), mix(hashes)
        tag = np.maximum((hashes >> np.uint64(48)).astype(np.uint16), np.uint16(1))
        first = (hashes & last).astype(np.int64)
        return tag, first, self._other(first, tag)

    def _other(self, bucket: np.ndarray, tag: np.ndarray) -> np.ndarray:
        return bucket ^ (mix(tag.astype(np.uint64)) & np.uint64(len(self.buckets) - 1)).astype(np.int64)

    def _fill(self, hashes: np.ndarray) -> bool:
        # Whole rounds of the first hash of each bucket, while they find free slots.
        tag, bucket, other = self._places(hashes)
        for _ in range(2):
            for slot in range(_SLOTS):
                chosen, at = np.unique(bucket, return_index=True)
                free = self.buckets[chosen, slot] == 0
                self.buckets[chosen[free], slot] = tag[at[free]]
                left = np.ones(len(tag), bool)
                left[at[free]] = False
                tag, bucket, other = tag[left], bucket[left], other[left]
            bucket, other = other, bucket
        return all(self._push(int(t), int(b)) for t, b in zip(tag, bucket))

    def _push(self, tag: int, bucket: int) -> bool:
        for kick in range(_KICKS):
            for b in (bucket, int(self._other(np.array([bucket]), np.array([tag], np.uint16))[0])):
                free = np.flatnonzero(self.buckets[b] == 0)
                if len(free):
                    self.buckets[b, free[0]] = tag
                    return True
            slot = kick % _SLOTS
            tag, self.buckets[b, slot] = int(self.buckets[b, slot]), tag
            bucket = int(self._other(np.array([b]), np.array([tag], np.uint16))[0])
        return False

    def add(self, hashes: np.ndarray) -> bool:
        """Add hashes that are not in the set; false if one has no place, and the filter is
        to be built anew."""
        tag, bucket, _ = self._places(hashes.astype(np.uint64))
        return all(self._push(int(t), int(b)) for t, b in zip(tag, bucket))

    def delete(self, hashes: np.ndarray) -> None:
        """Take out hashes that are in the set."""
        for t, *places in zip(*(x.tolist() for x in self._places(hashes.astype(np.uint64)))):
            for b in places:
                slot = np.flatnonzero(self.buckets[b] == t)
                if len(slot):
                    self.buckets[b, slot[0]] = 0
                    break

    def __contains__(self, value: int) -> bool:
        return bool(self.has(np.array([value], np.uint64))[0])

    def has(self, hashes: np.ndarray) -> np.ndarray:
        tag, first, other = self._places(hashes.astype(np.uint64))
        return ((self.buckets[first] == tag[:, None]) | (self.buckets[other] == tag[:, None])).any(axis=1)

    def to_bytes(self) -> bytes:
        return self.buckets.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, _SLOTS).copy())


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit key of a line, or None if its key has fewer than ``min_chars`` code points."""
    key = line.strip(_SPACE)
    if len(key) < min_chars:
        return None
    key = key.translate(LOWER_BYTES)
    if len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _high(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u8")[::2]


def _references(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        ids, keys = [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            own = {line_key(line, min_chars) for line in (text or "").encode().split(b"\n")} - {None}
            ids += [doc_id] * len(own)
            keys += own
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())],
                                         names=["key", "doc_id"])


def references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, doc_id, n): lines long enough, and how many rows of that id hold them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = map_arrow(rows, lambda b: _references(b, min_chars), "key binary, doc_id long")
    return found.groupBy("key", "doc_id").agg(F.count(F.lit(1)).alias("n"))


def key_counts(refs: DataFrame) -> DataFrame:
    """(key, n_docs, keeper): documents that hold a key, and the largest id among them.

    Rows with null id are one document, which keeps a line only if there is no other.
    """
    return refs.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))


def _shards(keys: DataFrame, n: int) -> DataFrame:
    """One row (shard, filter) per shard that has keys; a shard has about ``SHARD_KEYS``."""

    def build(table: pa.Table) -> pa.Table:
        made = CuckooFilter.build(_high(table.column("key").to_pylist()))
        return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
                         "filter": pa.array([made.to_bytes()], pa.binary())})

    by_shard = keys.select(_shard(F.col("key"), n).alias("shard"), "key")
    return by_shard.groupBy("shard").applyInArrow(build, "shard int, filter binary")


def _shard(key, n: int):
    # The last 8 bytes choose the shard, the first 8 the place in its filter.
    return F.pmod(F.conv(F.hex(F.substring(key, 13, 4)), 16, 10).cast("long"), F.lit(n)).cast("int")


@dataclass(frozen=True)
class Probe:
    """The filters of all shards, for tasks; None looks up everything."""

    filters: dict[int, bytes] | None
    shards: int

    def __post_init__(self):
        object.__setattr__(self, "_open", {})

    def __getstate__(self):
        return {"filters": self.filters, "shards": self.shards}

    def __setstate__(self, state):
        self.__dict__.update(state, _open={})

    def __call__(self, keys: list[bytes]) -> np.ndarray:
        if self.filters is None or not keys:
            return np.ones(len(keys), bool)
        shard = np.array([int.from_bytes(k[12:], "big") % self.shards for k in keys])
        high, known = _high(keys), np.zeros(len(keys), bool)
        for s in np.unique(shard).tolist():
            if s not in self._open and s in self.filters:
                self._open[s] = CuckooFilter.from_bytes(self.filters[s])
            if s in self._open:
                own = shard == s
                known[own] = self._open[s].has(high[own])
        return known


def probe(keys: DataFrame, n_keys: int) -> Probe:
    shards = max(1, -(-n_keys // SHARD_KEYS))
    # Four tags of two bytes, at most half empty after the power of two, and once doubled.
    if n_keys * 2 * 4 > FILTER_BYTES:
        return Probe(None, shards)
    return Probe({r["shard"]: bytes(r["filter"]) for r in _shards(keys, shards).collect()}, shards)


_SCAN = ("doc_id long, text_hash long, n_lines long, n_dropped long, kept string, kept_sha256 string, "
         "keys array<binary>")


def _scan(batches: Iterator[pa.RecordBatch], known: Probe, min_chars: int) -> Iterator[pa.RecordBatch]:
    """Finished rows of documents without a known line; others with their text and such keys."""
    for batch in slices(batches, "text"):
        texts = [t.encode() for t in filled(batch.column("text")).to_pylist()]
        lines = [t.split(b"\n") for t in texts]
        keys = [list({line_key(x, min_chars) for x in own} - {None}) for own in lines]
        hit = known([k for own in keys for k in own]).tolist()
        flags = iter(hit)
        found = [[k for k in own if next(flags)] for own in keys]
        kept = [t.decode() if f else None for t, f in zip(texts, found)]
        digest = [None if f else hashlib.sha256(t).hexdigest() for t, f in zip(texts, found)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"),
             pa.array([len(x) for x in lines], pa.int64()), pa.array([0] * len(lines), pa.int64()),
             pa.array(kept, pa.string()), pa.array(digest, pa.string()),
             pa.array([f or None for f in found], pa.list_(pa.binary()))],
            names=["doc_id", "text_hash", "n_lines", "n_dropped", "kept", "kept_sha256", "keys"])


def _drop(batches: Iterator[pa.RecordBatch], min_chars: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "kept"):
        kept, digest, n = [], [], []
        for text, keys in zip(batch.column("kept").to_pylist(), batch.column("keys").to_pylist()):
            lines, bad = text.encode().split(b"\n"), set(keys or ())
            left = [x for x in lines if not bad or line_key(x, min_chars) not in bad]
            n.append(len(lines) - len(left))
            data = b"\n".join(left)
            kept.append(data.decode() if with_text else None)
            digest.append(hashlib.sha256(data).hexdigest())
        names = ["doc_id", "text_hash", "n_lines", "n_dropped", "kept", "kept_sha256", "keys"]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), batch.column("n_lines"),
             pa.array(n, pa.int64()), pa.array(kept, pa.string()), pa.array(digest, pa.string()),
             pa.nulls(len(n), pa.list_(pa.binary()))], names=names)


def dedup_lines(docs: DataFrame, refs: DataFrame | None = None, min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS, with_text: bool = True) -> DataFrame:
    """Documents without the lines that ``min_docs`` or more documents hold.

    A line's key is the line without ASCII white space at its ends and with A-Z lower-cased.
    Of a key of at least ``min_chars`` code points in at least ``min_docs`` documents, all
    lines go except in the largest doc_id that holds it; other lines stay, joined by
    newline. ``refs`` is the state to decide by (``references`` of the same documents if
    not given). Null and empty texts are one empty line. Null ids count as one document,
    smaller than all others. Rows that repeat an id are one document, each with its result.
    One row per row: doc_id, text_hash (of the text before), n_lines, n_dropped, kept (the
    text left; null unless ``with_text``, and where no line could go), kept_sha256.
    """
    refs = references(docs, min_chars) if refs is None else refs
    refs, _ = stage(refs, "line-refs")
    common, n_keys = stage(key_counts(refs).filter(F.col("n_docs") >= min_docs), "line-keys")
    known = probe(common.select("key"), n_keys)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    scanned, _ = stage(map_arrow(rows, lambda b: _scan(b, known, min_chars), _SCAN), "line-scan")

    done = scanned.filter(F.col("keys").isNull()).drop("keys")
    open_rows = scanned.filter(F.col("keys").isNotNull())
    # The exact table decides. What a document loses is bounded by its own lines.
    lost = (
        refs.join(common.select("key", "keeper"), "key")
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id").agg(F.collect_list("key").alias("lost")).withColumnRenamed("doc_id", "_id")
    )
    joined = open_rows.drop("keys").join(lost, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    joined = joined.select(*[c for c in open_rows.columns if c != "keys"], F.col("lost").alias("keys"))
    dropped = map_arrow(joined, lambda b: _drop(b, min_chars, with_text), _SCAN).drop("keys")
    return done.unionByName(dropped)


def dedup_digest(docs: DataFrame) -> DataFrame:
    return dedup_lines(docs, with_text=False).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def deduplicated(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents with their own columns, text and n_chars (if any) as after dedup."""
    result = dedup_lines(docs, min_chars=min_chars, min_docs=min_docs).filter("n_dropped > 0").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("kept").alias("_kept"))
    # Repeated rows have equal results.
    result = result.groupBy("_id", "_hash").agg(F.first("_kept").alias("_kept"))
    result, n = stage(result, "line-changes")
    keys = sent(result.select("_id", "_hash"), n)
    same = same_text()
    # Only documents that change move, if their keys can be sent to all others.
    joined = docs.join(keys, same, "left_semi").join(result, same, "inner").drop("_id", "_hash")
    rest = docs.join(keys, same, "left_anti")
    columns = {c: F.col(c) for c in docs.columns}
    columns["text"] = F.col("_kept")
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.length("_kept").cast(kind)
    return rest.union(joined.select(*[v.alias(c) for c, v in columns.items()]))


@dataclass(frozen=True)
class LineIndex:
    """References and sharded filters on the shared folder, changed by batches of documents.

    Every change writes new tables and returns a new index, so a change that breaks off
    leaves the old one as it was. Deleting what was inserted gives back the state before.
    """

    spark: SparkSession
    refs_path: str
    filters_path: str
    shards: int
    min_chars: int = MIN_CHARS

    @classmethod
    def empty(cls, spark: SparkSession, shards: int = 8, min_chars: int = MIN_CHARS) -> LineIndex:
        refs = spark.createDataFrame([], "key binary, doc_id long, n long")
        filters = spark.createDataFrame([], "shard int, filter binary")
        return cls(spark, "", "", shards, min_chars)._written(refs, filters)

    def _written(self, refs: DataFrame, filters: DataFrame) -> LineIndex:
        paths = [new_stage_path(self.spark, name) for name in ("line-index", "line-filters")]
        refs.write.parquet(paths[0])
        filters.write.parquet(paths[1])
        return LineIndex(self.spark, *paths, self.shards, self.min_chars)

    @property
    def refs(self) -> DataFrame:
        return self.spark.read.schema("key binary, doc_id long, n long").parquet(self.refs_path)

    @property
    def filters(self) -> DataFrame:
        return self.spark.read.schema("shard int, filter binary").parquet(self.filters_path)

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._change(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        """Take documents out, given with their texts; ones never inserted change nothing."""
        return self._change(docs, -1)

    def _change(self, docs: DataFrame, sign: int) -> LineIndex:
        delta = references(docs, self.min_chars).select("key", "doc_id", (F.col("n") * sign).alias("n"))
        both = self.refs.select("*", F.lit(True).alias("old")).unionByName(
            delta.select("*", F.lit(False).alias("old")))
        merged = both.groupBy("key", "doc_id").agg(
            F.greatest(F.sum("n"), F.lit(0)).alias("n"), F.max("old").alias("old"))
        merged, _ = stage(merged, "line-merge")
        keys = merged.groupBy("key").agg(F.max("old").alias("before"), (F.max("n") > 0).alias("after"))
        changes = keys.filter(F.col("before") != F.col("after")).select(
            _shard(F.col("key"), self.shards).alias("shard"), "key", "after")
        current = keys.filter("after").select(_shard(F.col("key"), self.shards).alias("shard"), "key")
        grown = _changed_filters(self.filters, changes)
        grown, _ = stage(grown, "line-grown")
        # A shard whose filter was too full is built anew from its exact keys.
        full = grown.filter("filter is null").select("shard")
        rebuilt = current.join(F.broadcast(full), "shard").groupBy("shard").applyInArrow(
            _rebuild, "shard int, filter binary")
        filters = grown.filter("filter is not null").unionByName(rebuilt)
        return self._written(merged.filter("n > 0").select("key", "doc_id", "n"), filters)

    def maybe_has(self, keys: list[bytes]) -> np.ndarray:
        """Whether lines are known, by the filters alone: never a miss, rarely a false hit."""
        wanted = sorted({int.from_bytes(k[12:], "big") % self.shards for k in keys})
        rows = self.filters.filter(F.col("shard").isin(wanted)).collect() if wanted else []
        return Probe({r["shard"]: bytes(r["filter"]) for r in rows}, self.shards)(keys)


def _rebuild(table: pa.Table) -> pa.Table:
    made = CuckooFilter.build(_high(table.column("key").to_pylist()))
    return pa.table({"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()),
                     "filter": pa.array([made.to_bytes()], pa.binary())})


def _changed_filters(filters: DataFrame, changes: DataFrame) -> DataFrame:
    def change(key, own: pa.Table, new: pa.Table) -> pa.Table:
        shard = key[0].as_py() if hasattr(key[0], "as_py") else key[0]
        keys, after = new.column("key").to_pylist(), new.column("after").to_pylist()
        gone = _high([k for k, a in zip(keys, after) if not a])
        come = _high([k for k, a in zip(keys, after) if a])
        data = None
        if own.num_rows:
            made = CuckooFilter.from_bytes(own.column("filter")[0].as_py())
            made.delete(gone)
            if len(come) == 0 or made.add(come):
                data = made.to_bytes()
        elif len(come):
            data = CuckooFilter.build(come).to_bytes()
        return pa.table({"shard": pa.array([shard], pa.int32()), "filter": pa.array([data], pa.binary())})

    return filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInArrow(
        change, "shard int, filter binary")
