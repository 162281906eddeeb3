"""Hard negatives by angular triangle filtering.

Vectors are floored to whole numbers. Every row stores its norm and its angles to a few
reference directions. By the triangle inequality on the sphere, the angle between an anchor and
a row lies between the difference and the sum of their angles to any reference. The cosines of
these, times both norms, bound the score; the bounds are widened by more than all rounding can
amount to and rounded outwards to whole numbers. Only where they overlap what is asked for is
the integer score computed: for positives, scores that can still be among the best; for
negatives, windows between shares of the positives' scores.

Rows lie in the order of their nearest reference and the angle to it, so that a batch of rows
spans few angles. Bounds are taken twice: for an anchor and a whole batch, which spares the
anchor the batch, and for single rows. Anchors go to all rows in blocks of a bounded number, so
rows are dealt once and never again; what a task finds best is merged by anchor.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.batches import map_arrow
from starmill.sources.stage import stage, write_once

SCALE = 256
ANCHOR_EVERY = 100
RELABEL_EVERY = 7
LABELS = 10
POSITIVES = 5
NEGATIVES = 10
# Per cent of the positive's score between which a negative's score lies.
LOW, HIGH = 30, 90

# Directions that angles are stored to: those of the rows with the least hash. They decide what
# is skipped, never a result.
REFERENCES = 8
# Anchors sent to all rows at once, on average; rows of a partition; rows and anchors that meet
# in one matrix.
BLOCK_ANCHORS = 4096
PART_ROWS = 1 << 17
TILE_ROWS = 4096
TILE_ANCHORS = 256

# Angles are stored as floats and come of a rounded division and arc cosine; near a zero angle
# the latter loses half of the digits.
_ANGLE_SLACK = 4e-6
_RELATIVE_SLACK = 1e-9
# Sums of products below this are exact in double precision.
_EXACT = 2.0 ** 53
_LONG = 1 << 63


def quantised(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Floored vectors as rows of a matrix, shorter ones filled up with zeros, and which take part.

    A null vector, or one with a null or non-finite component, takes no part. Components whose
    products need more than double precision are kept as Python's whole numbers.
    """
    column = column.cast(pa.large_list(pa.float64()))
    n = len(column)
    flat = column.flatten()
    values = flat.to_numpy(zero_copy_only=False)  # nulls as NaN
    sizes = np.diff(column.offsets.to_numpy()) if not column.null_count else np.array(
        [0 if v is None else len(v) for v in column.to_pylist()], np.int64)
    valid = np.asarray(column.is_valid()).astype(bool).copy()
    owner = np.repeat(np.arange(n), sizes)
    valid[owner[~np.isfinite(values)]] = False
    width = int(sizes.max(initial=0))
    out = np.zeros((n, width))
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    with np.errstate(over="ignore"):
        out[owner, place] = np.where(valid[owner], np.floor(values * SCALE), 0)
    if np.isinf(out).any():  # a double that only a whole number can hold 256 times
        exact = [[math.floor(x) * SCALE if abs(x) >= 2 ** 53 else math.floor(x * SCALE) for x in (row or [])] if ok else []
                 for row, ok in zip(column.to_pylist(), valid)]
        out = np.array([row + [0] * (width - len(row)) for row in exact], object).reshape(n, width)
    return out, valid


def _fitted(x: np.ndarray, width: int) -> np.ndarray:
    if x.shape[1] >= width:
        return x
    return np.concatenate([x, np.zeros((len(x), width - x.shape[1]), x.dtype)], axis=1)


def _directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, zero ones as they are, and norms, infinite if no double holds them."""
    unit = 1.0
    if x.dtype == object:  # beyond the largest double
        unit = 2.0 ** 600
        x = np.frompyfunc(lambda v: v / (1 << 600), 1, 1)(x)
    x = x.astype(np.float64)
    largest = np.abs(x).max(axis=1, initial=0)
    scaled = x / np.where(largest > 0, largest, 1)[:, None]
    norm = np.sqrt((scaled * scaled).sum(axis=1))
    with np.errstate(over="ignore"):
        return scaled / np.where(norm > 0, norm, 1)[:, None], norm * largest * unit


def angles(x: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles of rows to the reference directions, and norms."""
    width = max(x.shape[1], references.shape[1])
    unit, norm = _directions(_fitted(x, width))
    return np.arccos(np.clip(unit @ _fitted(references, width).T, -1, 1)), norm


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly; beyond the range of long, the nearest long.

    Doubles where all sums of products are exact in them, else Python's whole numbers.
    """
    width = max(anchors.shape[1], rows.shape[1])
    a, x = _fitted(anchors, width), _fitted(rows, width)
    if not width:
        return np.zeros((len(a), len(x)))
    small = math.isqrt(int(_EXACT) // width)
    a_small, x_small = np.abs(a).max(axis=1) < small, np.abs(x).max(axis=1) < small
    if a_small.all() and x_small.all():
        return a.astype(np.float64) @ x.astype(np.float64).T
    out = np.empty((len(a), len(x)), object)
    whole = np.frompyfunc(int, 1, 1)
    held = np.frompyfunc(lambda v: min(max(int(v), -_LONG), _LONG - 1), 1, 1)
    for these in (a_small, ~a_small):
        for those in (x_small, ~x_small):
            if these.any() and those.any():
                exact = these is a_small and those is x_small
                some = (a[these].astype(np.float64) @ x[those].astype(np.float64).T if exact
                        else whole(a[these]).dot(whole(x[those]).T))
                out[np.ix_(these, those)] = held(some)
    return out


def bounds(angle_low: np.ndarray, angle_high: np.ndarray, norms: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers between which a score lies, given its angle and the product of the norms, each between two values."""
    small, large = norms
    high = np.cos(np.maximum(angle_low - _ANGLE_SLACK, 0))
    low = np.cos(np.minimum(angle_high + _ANGLE_SLACK, np.pi))
    with np.errstate(invalid="ignore", over="ignore"):
        high, low = high * np.where(high > 0, large, small), low * np.where(low < 0, large, small)
        slack = _RELATIVE_SLACK * large + 1
        low, high = np.floor(low - slack), np.ceil(high + slack)
    known = np.isfinite(large) & np.isfinite(small)
    return (np.where(known, np.clip(low, -_LONG, _LONG), -np.inf), np.where(known, np.clip(high, -_LONG, _LONG), np.inf))


@dataclass(frozen=True)
class Anchors:
    """A block of anchors; later with the least and the largest score of a negative, per anchor
    and positive, which are NaN beyond the last positive."""

    number: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    vector: np.ndarray
    angle: np.ndarray
    norm: np.ndarray
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def _below(score) -> float:
    """The score as a double, or the next one below it."""
    value = float(score)
    return value if value <= score else float(np.nextafter(value, -np.inf))


class Best:
    """The best (score, vec_id) found so far of each list, by falling score, then rising id."""

    def __init__(self, lists: int, size: int):
        self.size = size
        self.scores: list[np.ndarray] = [np.zeros(0)] * lists
        self.ids: list[np.ndarray] = [np.zeros(0, np.int64)] * lists
        self.least = np.full(lists, -np.inf)  # what a score has to reach

    def offer(self, of: int, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.size and scores.dtype != object:  # ties with the last one stay, of any number
            kth = np.partition(scores, len(scores) - self.size)[len(scores) - self.size]
            keep = scores >= kth
            scores, ids = scores[keep], ids[keep]
        scores = np.concatenate([self.scores[of], scores])
        ids = np.concatenate([self.ids[of], ids])
        if scores.dtype == object:
            order = np.array(sorted(range(len(ids)), key=lambda k: (-scores[k], ids[k]))[:self.size], np.int64)
        else:
            order = np.lexsort((ids, -scores))[:self.size]
        self.scores[of], self.ids[of] = scores[order], ids[order]
        if len(order) == self.size:
            self.least[of] = _below(scores[order[-1]])


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for first in range(0, batch.num_rows, TILE_ROWS):
            tile = batch.slice(first, TILE_ROWS)
            vector, _ = quantised(tile.column("embedding"))
            yield (tile.column("vec_id").to_numpy(), tile.column("label").to_numpy(), vector,
                   np.array(tile.column("angles").to_pylist(), np.float64).reshape(tile.num_rows, -1),
                   tile.column("norm").to_numpy())


def _wanted(a: Anchors, some: np.ndarray, angle: np.ndarray, norm: np.ndarray, need) -> tuple[np.ndarray, np.ndarray]:
    """Anchors (of ``some``) that a tile is not spared, and which of its rows they have to be
    scored with; ``need`` says of bounds whether the score matters."""
    low = np.maximum(a.angle[some] - angle.max(axis=0), angle.min(axis=0) - a.angle[some]).max(axis=1, initial=0)
    high = (a.angle[some] + angle.max(axis=0)).min(axis=1, initial=np.pi)
    with np.errstate(invalid="ignore", over="ignore"):
        norms = a.norm[some] * norm.min(), a.norm[some] * norm.max()
        some = some[need(some, *(b[:, None] for b in bounds(low, high, norms)))[:, 0]]
        product = a.norm[some, None] * norm
    low, high = np.zeros(product.shape), np.full(product.shape, np.pi)
    for r in range(angle.shape[1]):
        mine, theirs = a.angle[some, r, None], angle[:, r]
        np.maximum(low, np.abs(mine - theirs), out=low)
        np.minimum(high, mine + theirs, out=high)
    return some, need(some, *bounds(low, high, (product, product)))


def _scored(a: Anchors, tile: tuple, need) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows, scores) of a tile where ``need`` asks for them."""
    _, _, vector, angle, norm = tile
    for first in range(0, len(a.number), TILE_ANCHORS):
        some, wanted = _wanted(a, np.arange(first, min(first + TILE_ANCHORS, len(a.number))), angle, norm, need)
        mine, rows = np.flatnonzero(wanted.any(axis=1)), np.flatnonzero(wanted.any(axis=0))
        if not len(mine):
            continue
        found = scores(a.vector[some[mine]], vector[rows])
        chosen = wanted[np.ix_(mine, rows)]
        for k, i in enumerate(some[mine].tolist()):
            yield i, rows[chosen[k]], found[k][chosen[k]]


def _out(a: Anchors, best: Best, per_anchor: int) -> Iterator[pa.RecordBatch]:
    filled = [k for k in range(len(best.scores)) if len(best.scores[k])]
    for first in range(0, len(filled), 1000):
        some = filled[first:first + 1000]
        sizes = [len(best.scores[k]) for k in some]
        at = np.repeat(some, sizes)
        yield pa.RecordBatch.from_arrays([
            pa.array(a.number[at // per_anchor], pa.int64()), pa.array(at % per_anchor, pa.int32()),
            pa.array(np.concatenate([best.ids[k] for k in some]), pa.int64()),
            pa.array([int(x) for k in some for x in best.scores[k]], pa.int64())], names=["anchor", "place", "vec_id", "score"])


def _best_positives(a: Anchors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(a.number), POSITIVES)
        for tile in _tiles(batches):
            ids, labels = tile[:2]

            def need(some, low, high):
                return high >= best.least[some, None]

            for i, rows, found in _scored(a, tile, need):
                fits = (labels[rows] == a.label[i]) & (ids[rows] != a.vec_id[i]) & (found >= best.least[i])
                if fits.any():
                    best.offer(i, found[fits], ids[rows[fits]])
        yield from _out(a, best, 1)

    return run


def _best_negatives(a: Anchors):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per = a.low.shape[1]
        outer_low = np.nextafter(a.low.astype(np.float64), -np.inf)
        outer_high = np.nextafter(a.high.astype(np.float64), np.inf)
        best = Best(len(a.number) * per, NEGATIVES)
        least = best.least.reshape(-1, per)
        for tile in _tiles(batches):
            ids, labels = tile[:2]

            def need(some, low, high):
                fits = np.zeros(np.broadcast_shapes(low.shape, (len(some), 1)), bool)
                for j in range(per):
                    from_ = np.fmax(outer_low[some, j, None], least[some, j, None])
                    fits |= (high >= from_) & (low <= outer_high[some, j, None])
                return fits

            for i, rows, found in _scored(a, tile, need):
                other = (labels[rows] != a.label[i]) & (ids[rows] != a.vec_id[i])
                for j in range(per):
                    fits = other & (found >= a.low[i, j]) & (found <= a.high[i, j]) & (found >= least[i, j])
                    if fits.any():
                        best.offer(i * per + j, found[fits], ids[rows[fits]])
        yield from _out(a, best, per)

    return run


_FOUND = "anchor long, place int, vec_id long, score long"


def _merged(found: DataFrame, size: int) -> DataFrame:
    """The best of what tasks found, ranked; a list has at most ``size`` rows of each task."""
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def valid_rows(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and embedding of the rows that take part, as ``hard_negatives`` says."""
    rows = embeddings.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.expr(f"CAST(CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (CAST(label AS long) + 1) % {LABELS} ELSE label END AS long)").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def with_angles(rows: DataFrame) -> DataFrame:
    """Rows with ``angles`` to the references and ``norm``, in the order of the nearest one, in files."""
    chosen = rows.select("embedding").orderBy(F.xxhash64("vec_id", "label", "embedding")).limit(REFERENCES).toArrow()
    directions, _ = _directions(quantised(chosen["embedding"].combine_chunks())[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, _ = quantised(batch.column("embedding"))
            angle, norm = angles(x, directions)
            near = angle.argmin(axis=1) if angle.shape[1] else np.zeros(len(angle), np.int64)
            nearest = angle[np.arange(len(angle)), near] if angle.shape[1] else np.zeros(len(angle))
            flat = pa.array(angle.ravel().astype(np.float32), pa.float32())
            lists = pa.ListArray.from_arrays(np.arange(len(angle) + 1, dtype=np.int32) * angle.shape[1], flat)
            yield pa.RecordBatch.from_arrays([
                *batch.columns, lists, pa.array(norm, pa.float64()), pa.array(near, pa.int32()),
                pa.array(nearest, pa.float64())], names=[*batch.schema.names, "angles", "norm", "near", "nearest"])

    measured, n = stage(map_arrow(
        rows, run, "vec_id long, label long, embedding array<double>, angles array<float>, norm double, near int, nearest double"),
        "measured")
    parts = max(-(-n // PART_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
    # The number breaks up rows of one angle, copies among them.
    ordered = measured.repartitionByRange(parts, "near", "nearest", "vec_id").sortWithinPartitions("near", "nearest", "vec_id")
    return write_once(ordered.select("vec_id", "label", "embedding", "angles", "norm"), "angles")


def _taken(block: pa.Table) -> Anchors:
    vector, _ = quantised(block["embedding"].combine_chunks())
    return Anchors(block["anchor"].to_numpy(), block["vec_id"].to_numpy(), block["label"].to_numpy(), vector,
                   np.array(block["angles"].to_pylist(), np.float64).reshape(block.num_rows, -1), block["norm"].to_numpy())


def _with_windows(a: Anchors, found: pa.Table) -> Anchors:
    place = {n: k for k, n in enumerate(a.number.tolist())}
    low, high = (np.full((len(a.number), POSITIVES), np.nan, object) for _ in range(2))
    for anchor, rank, score in zip(*(found[c].to_pylist() for c in ("anchor", "rank", "score"))):
        low[place[anchor], rank - 1] = -(-LOW * score // 100)
        high[place[anchor], rank - 1] = HIGH * score // 100
    if all(abs(v) < _EXACT for v in (*low.flat, *high.flat) if v == v):
        low, high = low.astype(np.float64), high.astype(np.float64)
    return Anchors(a.number, a.vec_id, a.label, a.vector, a.angle, a.norm, low, high)


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Per anchor and positive, its first hard negatives: anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by ANCHOR_EVERY; all else is as the constants
    above say. A row with a null vec_id, label or vector, or with a component that is null, NaN
    or infinite, takes no part. Scores are exact, ties go by rising vec_id. Of vectors of unlike
    length, the shorter one counts as filled up with zeros. Rows with the anchor's vec_id are
    not among its others; repeated rows are rows each, and repeated anchors one anchor, unless
    label or vector differ. A score outside the range of long counts as the nearest long. An
    anchor without positives or hard negatives has no rows, as has an empty table. Other columns
    are not read.
    """
    spark = embeddings.sparkSession
    rows = with_angles(valid_rows(embeddings))
    anchors, n = stage(rows.where(F.col("vec_id") % ANCHOR_EVERY == 0).dropDuplicates(["vec_id", "label", "embedding"])
                       .withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    # By hash, so that a block has about as many anchors as any other.
    blocks = -(-n // BLOCK_ANCHORS)
    block = F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(max(1, blocks)))
    parts = []
    for k in range(blocks):
        taken = anchors.where(block == k).toArrow()
        if not taken.num_rows:
            continue
        a = _taken(taken)
        positives = write_once(_merged(map_arrow(rows, _best_positives(a), _FOUND), POSITIVES), "positives")
        a = _with_windows(a, positives.toArrow())  # at most POSITIVES rows an anchor
        negatives = _merged(map_arrow(rows, _best_negatives(a), _FOUND), NEGATIVES)
        pairs = negatives.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(
            positives.select("anchor", (F.col("rank") - 1).alias("place"), F.col("vec_id").alias("positive_id"),
                             F.col("score").alias("positive_score")), ["anchor", "place"])
        parts.append(write_once(pairs, "negatives"))
    ids = anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    if not parts:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found.join(ids, "anchor").select(*columns)
