"""Links between documents whose shingle sets are nearly equal, and their components.

The overlaps of all documents are the product of the sparse matrix of documents by
shingles with its transpose. It is computed in blocks that can hold an overlap large
enough, and a block row by row:

1. Equal sets are one row of the matrix, named by a hash of the set.
2. A set lacks at most some share of its shingles in one that links to it. So of its rarest
   shingles, its prefix, it sends one more than that, and sets that sent the same one meet.
   Two sets that link meet by some shingle. Where few meet, all pairs are formed; what follows
   the prefixes and the number of meetings bound a pair's overlap. Where more meet, each of
   them is found by parts instead: two sets within the bound differ in at most d shingles,
   where d follows from their sizes, so if shingles are dealt into more than d parts by
   hash, some are equal in both. Other pairs are discarded if their sizes, or bitmaps of
   shingle parities, exclude a large enough overlap. Components of what is left are the
   blocks; no link runs between two.
3. In a block, pairs are discarded by the same bounds. For the others a row of the product
   accumulates exact overlaps. A set that is already in the component of a row is not
   compared again.

A block that is too large for a task is cut, see ``_links``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.batches import map_arrow, sent, slices, utf8
from starmill.llm.components import components
from starmill.llm.words import NOT_SPACE, mix, shingles, words
from starmill.sources.stage import stage

# Sets and shingles that are compared in one task at once.
BLOCK_SETS = 4096
BLOCK_SHINGLES = 1 << 20
# Of a meeting of at most so many sets, all pairs are looked at; a larger one is a block.
SMALL_MEETING = 24

# Sets that make a shingle common, and how many such shingles are sent to tasks at most (the
# most common ones).
COMMON_SETS = 24
COMMON_LIMIT = 1 << 20
_RARE_SHARE = 0.4
# Shingles are counted by so many first bits of their hash: the place where they are counted,
# and three bytes. Some millions of them are packed at once.
_PLACE_BITS, _LOW_BITS = 12, 24
_PACKED = 2 << 20

_PARITY_BITS = 1024
_SMALL_BLOCK = 24

# Bytes of text whose words are hashed at once, and sets whose parities are counted at once. A
# worker keeps the memory of its largest arrays for the tasks after, so these are small.
_HASHED_BYTES = 1 << 17
_COUNTED_SETS = 256


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; sets link if 100 * overlap >= percent * union."""

    words: int
    percent: int

    def least_overlap(self, a, b):
        """The smallest overlap that links sets of these sizes."""
        return -(-self.percent * (a + b) // (100 + self.percent))

    def most_differences(self, size: int) -> int:
        """Of a set of this size and any one that is not larger."""
        return 2 * size * (100 - self.percent) // (100 + self.percent)

    def prefix(self, sizes: np.ndarray) -> np.ndarray:
        """Of sets of these sizes, as many shingles as one that links must have one of: it has
        at least ``percent`` of all, so it lacks fewer than these."""
        return np.where(sizes > 0, sizes + -self.percent * sizes // 100 + 1, 0)

    def may_overlap(self, a: Column, b: Column, times: Column) -> Column:
        """Whether sets of sizes ``a`` and ``b`` can link if their prefixes share so many shingles.

        Of the set whose prefix ends first, only what follows its prefix can add to these.
        """
        rest = -F.floor(F.greatest(a, b) * -self.percent / 100) - 1
        least = -F.floor((a + b) * -self.percent / (100 + self.percent))
        return (least <= F.least(a, b)) & (least <= times + rest)

    def classes(self, largest: int) -> np.ndarray:
        return _classes(self.percent, 1 << max(4, int(largest).bit_length()))


@lru_cache(maxsize=64)
def _classes(percent: int, upto: int) -> np.ndarray:
    """Lower ends of size classes; the sets that link to one of a class are in it or the next
    smaller sizes down to ``percent`` of its own."""
    ends = [1]
    while ends[-1] <= upto:
        ends.append(max(ends[-1] + 1, ends[-1] * 100 // percent))
    return np.array(ends, np.int64)


def _unique_sets(batch: pa.RecordBatch, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of all texts, distinct and sorted within each, and the offsets."""
    sets = []
    for piece in slices(iter([batch]), "text", _HASHED_BYTES):
        runs, owner = shingles(words(*utf8(piece.column("text")), NOT_SPACE), rule.words)
        ends = np.searchsorted(owner, np.arange(piece.num_rows + 1))
        sets += [np.unique(runs[a:b]) for a, b in zip(ends[:-1], ends[1:])]
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64),
            np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64))


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


_C1, _C2, _C3 = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD1B54A32D192ED03), np.uint64(0x8CB92BA72F3D8DD7)


def _names(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    n = np.diff(offsets).astype(np.uint64)
    return mix(_sums(mix(values ^ _C1), offsets) + n), mix(_sums(mix(values ^ _C2), offsets) ^ n)


def _parities(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per set, a bit for each of ``_PARITY_BITS`` classes of shingles: whether it has an odd
    number of them. Two sets differ in at least as many shingles as in bits."""
    n = len(offsets) - 1
    odd = np.zeros((n, _PARITY_BITS), np.uint8)
    for i in range(0, n, _COUNTED_SETS):
        ends = offsets[i:i + _COUNTED_SETS + 1]
        owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        at = owner * _PARITY_BITS + (values[ends[0]:ends[-1]] % np.uint64(_PARITY_BITS)).astype(np.int64)
        odd[i:i + len(ends) - 1] = (np.bincount(at, minlength=(len(ends) - 1) * _PARITY_BITS) & 1).reshape(-1, _PARITY_BITS)
    return odd


def _describe(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        values, offsets = _unique_sets(batch, rule)
        node, check = _names(values, offsets)
        bits = np.packbits(_parities(values, offsets), axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(node.view(np.int64)),
             pa.array(check.view(np.int64)), pa.array([row.tobytes() for row in bits], pa.binary())],
            names=["doc_id", "n_shingles", "node", "check", "bits"])


@dataclass(frozen=True)
class Common:
    """Shingles that very many sets have, as the first ``bits`` of their hashes, sorted, at most
    ``COMMON_LIMIT``, and for each a number from 1 that grows with the sets that have it (if none
    are given, 1)."""

    hashes: np.ndarray
    grades: np.ndarray | None = None
    bits: int = 64

    def __post_init__(self):
        table = np.zeros(1 << 24, bool)
        table[(self.hashes >> np.uint64(self.bits - 24)).astype(np.int64)] = True
        object.__setattr__(self, "_table", table)

    def __reduce__(self):
        return Common, (self.hashes, self.grades, self.bits)

    def grade(self, values: np.ndarray) -> np.ndarray:
        """The grades of shingles, 0 for those that are not common."""
        found = np.zeros(len(values), np.int64)
        at = np.flatnonzero(self._table[(values >> np.uint64(40)).astype(np.int64)])
        if len(at):
            key = values[at] >> np.uint64(64 - self.bits)
            place = np.minimum(np.searchsorted(self.hashes, key), len(self.hashes) - 1)
            found[at] = np.where(self.hashes[place] == key,
                                 1 if self.grades is None else self.grades[place], 0)
        return found


def _packed(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """(place, keys): all shingles of all sets, three bytes each, those of a place together."""
    held, size = [], 0

    def packed() -> pa.RecordBatch:
        key = np.concatenate(held)
        held.clear()
        key >>= np.uint64(64 - _PLACE_BITS - _LOW_BITS)
        key.sort()
        ends = np.searchsorted(key, np.arange((1 << _PLACE_BITS) + 1, dtype=np.uint64) << np.uint64(_LOW_BITS))
        low = np.ascontiguousarray(key.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3])
        keys = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
            None, pa.py_buffer((ends * 3).astype(np.int32)), pa.py_buffer(low)])
        rows = pa.RecordBatch.from_arrays([pa.array(np.arange(len(ends) - 1, dtype=np.int32)), keys], names=["place", "keys"])
        return rows.filter(pa.array(ends[1:] > ends[:-1]))

    for batch in slices(batches, "text"):
        held.append(_unique_sets(batch, rule)[0])
        size += len(held[-1])
        if size >= _PACKED:
            yield packed()
            size = 0
    if size:
        yield packed()


def _counted(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(shingle, n) of shingles that so many sets have, from the packed ones sorted by place."""
    current, held, size = None, [], 0
    merged = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merge() -> tuple[np.ndarray, np.ndarray]:
        low, n = np.unique(np.concatenate(held), return_counts=True)
        if not len(merged[0]):
            return low, n
        both, at = np.unique(np.concatenate([merged[0], low]), return_inverse=True)
        return both, np.bincount(at, weights=np.concatenate([merged[1], n])).astype(np.int64)

    def finished() -> pa.RecordBatch:
        low, n = merge() if held else merged
        often = n >= least
        return pa.RecordBatch.from_arrays(
            [pa.array((current << _LOW_BITS) + low[often]), pa.array(n[often])], names=["shingle", "n"])

    for batch in batches:
        if not batch.num_rows:
            continue
        place, keys = batch.column("place").to_numpy(), batch.column("keys")
        _, offsets, data = keys.buffers()
        at = np.frombuffer(offsets, np.int32, len(keys) + 1, keys.offset * 4)
        data = np.frombuffer(data, np.uint8)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        for a, b in zip(first, [*first[1:], len(place)]):
            if int(place[a]) != current:
                if current is not None:
                    yield finished()
                current, held, size = int(place[a]), [], 0
                merged = np.zeros(0, np.int64), np.zeros(0, np.int64)
            low = data[at[a]:at[b]].reshape(-1, 3).astype(np.int64)
            held.append(low[:, 0] | low[:, 1] << 8 | low[:, 2] << 16)
            size += len(held[-1])
            if size >= _PACKED:
                merged, held, size = merge(), [], 0
    if current is not None:
        yield finished()


def common_shingles(docs: DataFrame, rule: Rule) -> Common:
    """The most common shingles, all counted. They only steer where sets meet; links do not
    depend on it, nor on whether two shingles are counted as one."""
    least_sets = COMMON_SETS
    packed = map_arrow(docs.select("text"), lambda b: _packed(b, rule), "place int, keys binary")
    packed = packed.repartition("place").sortWithinPartitions("place")
    found = map_arrow(packed, lambda b: _counted(b, least_sets), "shingle long, n long")
    grade = F.floor(4 * F.log2("n")).cast("int")
    found, _ = stage(found.select("shingle", grade.alias("grade")), "common")
    # The lowest grade down to which there are not too many.
    least, total = 1 << 30, 0
    for row in found.groupBy("grade").count().orderBy(F.desc("grade")).collect():
        total += row["count"]
        if total > COMMON_LIMIT:
            break
        least = row["grade"]
    rows = found.filter(F.col("grade") >= least).toArrow()
    hashes = rows.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    # A grade is at most 4 * 63.
    return Common(hashes[order], rows.column("grade").to_numpy()[order].astype(np.uint8), _PLACE_BITS + _LOW_BITS)


def _meeting_places(values: np.ndarray, offsets: np.ndarray, rule: Rule, common: Common
                    ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles in the prefix of each set, and the index of the set.

    All shingles have one order: common ones come last, the most common at the very end, so that
    a passage in very many documents brings few of them together. Shingles alike in this go by
    hash. The prefix is as many of a set's first shingles as it can lack in a set that links to
    it, and one more; so the prefixes of two sets that link share a shingle.
    """
    sizes = np.diff(offsets)
    place = mix(values ^ _C3)
    own = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((place, common.grade(values), own))
    first = np.arange(len(values)) - offsets[:-1][own] < rule.prefix(sizes)[own]
    return place[order][first], own[first]


def _part_places(values: np.ndarray, offsets: np.ndarray, rule: Rule, common: Common
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the parts that each set is found by, and the index of the set.

    Sets meet by their less common shingles, so that a passage in very many documents
    brings none of them together, unless few are left. Then they meet by all; as shares of two
    sets that link are bounded by each other, both do.
    """
    sizes = np.diff(offsets)
    rare = common.grade(values) == 0
    kept = np.concatenate([[0], np.cumsum(rare)])[offsets]
    share = np.diff(kept) / np.maximum(sizes, 1)
    t = rule.percent / 100
    most, some = share >= _RARE_SHARE, share < _RARE_SHARE / t + 1 - t + 0.01
    own = np.repeat(np.arange(len(sizes)), sizes)
    first = rare & most[own]
    a = _parts(values[first], own[first], sizes, most, rule, 0)
    second = some[own]
    b = _parts(values[second], own[second], sizes, some, rule, 1)
    return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])


def _parts(values: np.ndarray, own: np.ndarray, sizes: np.ndarray, taking: np.ndarray, rule: Rule,
           kind_of: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each part of the sets ``taking`` part, under each size class they may meet
    others in, and the index of the set. ``values`` may be a part of the shingles; ``sizes``
    are those of whole sets."""
    ends = rule.classes(int(sizes.max(initial=1)) * 100 // rule.percent + 1)
    lowest = np.searchsorted(ends, sizes, "right") - 1
    # The largest set that a set of this size can link to.
    highest = np.searchsorted(ends, sizes * 100 // rule.percent, "right") - 1
    spread = mix(values ^ _C3)
    place, content = spread >> np.uint64(32), mix(values + _C3)
    found_hash, found_set = [], []
    for step in range(int((highest - lowest).max(initial=-1)) + 1):
        kind = lowest + step
        differ = np.array([rule.most_differences(int(e) - 1) for e in ends[1:]])[np.minimum(kind, len(ends) - 2)]
        used = taking & (sizes > 0) & (kind <= highest) & (differ > 0)
        spare = 2 + (differ * 2 + 4) // 5
        n_parts = np.where(used, differ + 1 + spare, 0)
        base = np.concatenate([[0], np.cumsum(n_parts)])
        if not base[-1]:
            continue
        in_use = used[own]
        o = own[in_use]
        at = base[o] + (place[in_use] % n_parts[o].astype(np.uint64)).astype(np.int64)
        total = np.zeros(base[-1], np.uint64)
        np.add.at(total, at, content[in_use])
        filled = np.bincount(at, minlength=base[-1])
        of = np.repeat(np.arange(len(sizes)), n_parts)
        index = np.arange(base[-1]) - base[of]
        # More parts than the spare ones are equal in two sets that link. Empty ones are equal
        # too; they are sent by sets with more of them than that. In others, one of the equal
        # parts is not empty.
        empty = np.bincount(of, weights=filled == 0, minlength=len(sizes))
        send = (filled > 0) | (empty[of] > spare[of])
        label = mix((kind[of] * 2 + kind_of).astype(np.uint64) << np.uint64(32) | index.astype(np.uint64))
        found_hash.append(mix(total + filled.astype(np.uint64) * _C1 ^ label)[send])
        found_set.append(of[send])
    if not found_hash:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(found_hash), np.concatenate(found_set)


def _rows(part, a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(part, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["part", "a", "b"])


def _sent(part: np.ndarray, a: np.ndarray, crowds: bool) -> Iterator[pa.RecordBatch]:
    """(part, a) for the first sets of a part in a slice, and of others what ``_together`` says
    of those in a large part, so that of a part that very many sets have, few rows move."""
    if not len(part):
        return
    part = part.view(np.int64)
    order = np.lexsort((a, part))
    part, a = part[order], a[order]
    new = np.concatenate([[True], (part[1:] != part[:-1]) | (a[1:] != a[:-1])])
    part, a = part[new], a[new]
    starts = np.concatenate([[True], part[1:] != part[:-1]])
    first = np.flatnonzero(starts)[np.cumsum(starts) - 1]
    send = np.arange(len(part)) - first <= SMALL_MEETING
    # A set has many parts, and rows of one set compress well next to each other.
    rows = np.flatnonzero(send) if crowds else np.flatnonzero(send)[np.argsort(a[send], kind="stable")]
    yield _rows(part[rows], a[rows], pa.nulls(len(rows), pa.int64()))
    if not send.all():
        links = np.unique(np.stack([a[~send] if crowds else a[first[~send]], a[~send]]), axis=1)
        yield _rows(pa.nulls(links.shape[1], pa.int64()), links[0], links[1])


def _meet(batches: Iterator[pa.RecordBatch], rule: Rule, common: Common) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        values, offsets = _unique_sets(batch, rule)
        part, index = _meeting_places(values, offsets, rule, common)
        yield from _sent(part, _names(values, offsets)[0].view(np.int64)[index], True)


def _meet_by_parts(batches: Iterator[pa.RecordBatch], rule: Rule, common: Common, wanted: bytes
                   ) -> Iterator[pa.RecordBatch]:
    for batch in _wanted(batches, wanted):
        values, offsets = _unique_sets(batch, rule)
        part, index = _part_places(values, offsets, rule, common)
        yield from _sent(part, _names(values, offsets)[0].view(np.int64)[index], False)


def _together(batches: Iterator[pa.RecordBatch], crowds: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part, then set: all pairs of a part with few sets, which are still to be
    filtered; of one with more, each set paired with itself if ``crowds``, else pairs of its
    first set with each other, which stay."""
    held_part, held = np.zeros(0, np.int64), np.zeros(0, np.int64)
    large = None  # the part that is known to be large, and its first set

    def crowd(first: np.ndarray, a: np.ndarray) -> pa.RecordBatch:
        return _edges(a if crowds else first, a, False)

    def pairs(part: np.ndarray, a: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(part):
            return
        starts = np.concatenate([[True], part[1:] != part[:-1]])
        begin = np.flatnonzero(starts)
        run = np.cumsum(starts) - 1
        length = np.diff(np.concatenate([begin, [len(part)]]))[run]
        few = length <= SMALL_MEETING
        for k in range(1, min(SMALL_MEETING, len(part))):
            both = few[:-k] & (run[:-k] == run[k:])
            if not both.any():
                break
            yield _edges(a[:-k][both], a[k:][both], True)
        yield crowd(a[begin[run[~few]]], a[~few])

    for batch in batches:
        if not batch.num_rows:
            continue
        linked = batch.column("part").is_null().to_numpy(zero_copy_only=False)
        a = batch.column("a").to_numpy()
        yield _edges(a[linked], batch.column("b").filter(pa.array(linked)).to_numpy(), False)
        part, a = batch.column("part").filter(pa.array(~linked)).to_numpy(), a[~linked]
        if not len(part):
            continue
        if large is not None:  # goes on from the last batch
            own = part == large[0]
            yield crowd(np.full(own.sum(), large[1]), a[own])
            if own.all():
                continue
            part, a, large = part[~own], a[~own], None
        part, a = np.concatenate([held_part, part]), np.concatenate([held, a])
        new = np.concatenate([[True], (part[1:] != part[:-1]) | (a[1:] != a[:-1])])
        part, a = part[new], a[new]
        last = int(np.searchsorted(part, part[-1]))
        yield from pairs(part[:last], a[:last])
        held_part, held = part[last:], a[last:]
        if len(held) > SMALL_MEETING:
            large = (held_part[0], held[0])
            yield crowd(np.full(len(held), held[0]), held)
            held_part, held = held_part[:0], held[:0]
    yield from pairs(held_part, held)


def _meetings(rows: DataFrame, crowds: bool) -> DataFrame:
    """(a, b, open, times): pairs of sets, the smaller first, whether they are still to be filtered,
    and how often they met. A pair that meets in a large part stays, whatever its other parts."""
    rows = rows.repartition(F.coalesce("part", F.xxhash64("a", "b"))).sortWithinPartitions("part", "a")
    found = map_arrow(rows, lambda b: _together(b, crowds), "a long, b long, open boolean")
    ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    found = found.select(*ends, "open").groupBy("a", "b").agg(
        F.min("open").alias("open"), F.count(F.lit(1)).alias("times"))
    return stage(found, "meetings")[0]


def _may_link(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Pairs whose sizes and parities allow a large enough overlap."""
    ones = np.array([bin(i).count("1") for i in range(256)], np.uint8)
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, _PARITY_BITS // 8)
                for c in ("bits_a", "bits_b"))
        differ = ones[x ^ y].sum(axis=1, dtype=np.int64)
        m, n = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        least = rule.least_overlap(m, n)
        keep = pa.array((least <= np.minimum(m, n)) & (differ <= m + n - 2 * least))
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])


def _edges(a, b, open_: bool | None = None) -> pa.RecordBatch:
    columns, names = [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
    if open_ is not None:
        columns, names = [*columns, pa.array([open_] * len(a), pa.bool_())], [*names, "open"]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _wanted(batches: Iterator[pa.RecordBatch], wanted: bytes) -> Iterator[pa.RecordBatch]:
    """Slices of the documents whose id passes the filter."""
    table = np.frombuffer(wanted, np.uint8)
    for batch in batches:
        at = _filter_place(batch.column("doc_id").fill_null(0).to_numpy())
        hit = (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        yield from slices(iter([batch.filter(pa.array(hit))]), "text")


def _fetch(batches: Iterator[pa.RecordBatch], rule: Rule, wanted: bytes) -> Iterator[pa.RecordBatch]:
    """The sets of documents whose id passes the filter."""
    for piece in _wanted(batches, wanted):
        values, offsets = _unique_sets(piece, rule)
        node, check = _names(values, offsets)
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(node.view(np.int64)), pa.array(check.view(np.int64)),
             pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))],
            names=["doc_id", "node", "check", "set"])


_FILTER_BITS = 24


def _filter_place(ids: np.ndarray) -> np.ndarray:
    return (ids & ((1 << _FILTER_BITS) - 1)).astype(np.int64)


def _id_filter(ids: DataFrame) -> bytes:
    """A bitmap of the low bits of ids, 2 MB whatever their number."""
    at = F.col("doc_id").bitwiseAND(F.lit((1 << _FILTER_BITS) - 1))
    parts = ids.select(at.alias("at")).groupBy(F.shiftright("at", 15).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
    bits = bytearray(1 << (_FILTER_BITS - 3))
    for row in parts.collect():
        bits[row["bucket"] << 12:(row["bucket"] << 12) + len(row["bits"])] = row["bits"]
    return bytes(bits)


def _block(nodes: np.ndarray, values: np.ndarray, offsets: np.ndarray, asked: np.ndarray,
           rule: Rule, side: np.ndarray | None = None) -> tuple[list[int], list[int]]:
    """Links between the sets of a block that have its components, each with an asked set: of
    every component one from its smallest node to each other. Given sides, sets of one side are
    not compared."""
    n, sizes = len(nodes), np.diff(offsets)
    owner = np.repeat(np.arange(n), sizes)
    parity = None
    if n > _SMALL_BLOCK:
        parity = _parities(values, offsets).astype(np.float32)
        parity *= -2
        parity += 1
    # Columns of the matrix; one with a single entry adds to no overlap.
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    column, owner = column[shared], owner[shared]
    ends = np.searchsorted(owner, np.arange(n + 1))
    row = np.zeros(len(count), bool)
    label = np.arange(n)
    for i in np.flatnonzero(asked):
        others = label != label[i]
        others[:i] &= ~asked[:i]  # compared in their turn
        if side is not None:
            others &= side != side[i]
        least = rule.least_overlap(sizes, sizes[i])
        others &= least <= np.minimum(sizes, sizes[i])
        if parity is not None and others.any():
            at = np.flatnonzero(others)
            differ = (_PARITY_BITS - parity[at] @ parity[i]) / 2
            others[at] = differ <= (sizes[at] + sizes[i] - 2 * least[at]) + 0.5
        at = np.flatnonzero(others)
        if not len(at):
            continue
        row[column[ends[i]:ends[i + 1]]] = True
        if len(at) <= 64:
            overlap = np.array([np.count_nonzero(row[column[ends[j]:ends[j + 1]]]) for j in at])
        else:
            running = np.concatenate([[0], np.cumsum(row[column])])
            overlap = running[ends[at + 1]] - running[ends[at]]
        row[column[ends[i]:ends[i + 1]]] = False
        at = at[overlap >= least[at]]
        for other in np.unique(label[at]):
            label[label == other] = label[i]
    order = np.lexsort((nodes, label))
    first = np.concatenate([[True], label[order][1:] != label[order][:-1]])
    root = nodes[order][np.flatnonzero(first)[np.cumsum(first) - 1]]
    return root[~first].tolist(), nodes[order][~first].tolist()


def _compare(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block (x, y, z); all rows of a block are held, others are not."""
    current, held = None, []

    def finished() -> pa.RecordBatch:
        # A set of a repeated row is here twice.
        at = {}
        for node, asked, part, values in held:
            at[node] = (asked or at.get(node, (False,))[0], part, values)
        sets = [v for _, _, v in at.values()]
        offsets = np.concatenate([[0], np.cumsum([len(v) for v in sets])]).astype(np.int64)
        _, y, z = current
        side = np.array([p == y for _, p, _ in at.values()]) if y != z else None
        return _edges(*_block(np.array(list(at), np.int64), np.concatenate(sets).view(np.uint64), offsets,
                              np.array([a for a, _, _ in at.values()]), rule, side))

    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in "xyz")))
        nodes, asked, part = (batch.column(c).to_pylist() for c in ("node", "asked", "part"))
        lists = batch.column("set")
        for i, key in enumerate(keys):
            if key != current and held:
                yield finished()
                held = []
            current = key
            held.append((nodes[i], asked[i], part[i], lists[i].values.to_numpy()))
    if held:
        yield finished()


def _blocks(rows: DataFrame, rule: Rule) -> DataFrame:
    """Links in blocks (x, y, z): between the sets of parts y and z, or if these are one, all."""
    placed = rows.select("x", "y", "z", "asked", "part", "node", "set")
    placed = placed.repartition("x", "y", "z").sortWithinPartitions("x", "y", "z")
    return map_arrow(placed, lambda b: _compare(b, rule), "a long, b long")


def _links(sets: DataFrame, cut: bool, rule: Rule) -> DataFrame:
    """Links within clusters that keep their components.

    A cluster of several parts is compared part by part. Then the first sets of the largest
    component of each part are compared, which joins the parts of a group of copies. If
    sets are left outside the largest component of the cluster, each is compared with the
    sets of all other parts, in blocks of two parts; those of its own it was compared with. So a
    pair is left out only if its sets are in one component already.
    """
    yes = F.lit(True)
    found, _ = stage(_blocks(sets.select(
        F.col("cluster").alias("x"), F.col("part").alias("y"), F.col("part").alias("z"), yes.alias("asked"),
        "part", "node", "set"), rule), "links")
    if not cut:
        return found
    large = sets.filter("parts > 1")
    keys = large.select("cluster", "part", "parts", "node").distinct()

    def labelled(edges: DataFrame) -> DataFrame:
        roots = components(edges, "block-components")
        return keys.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def largest(rows: DataFrame, *by: str) -> DataFrame:
        sizes = rows.groupBy(*by, "root").agg(F.count(F.lit(1)).alias("n"))
        return sizes.groupBy(*by).agg(F.max_by("root", F.struct("n", "root")).alias("main"))

    # A root is a node of its part here.
    heads = largest(labelled(found).select("cluster", "part", "root"), "cluster", "part")
    heads, n_heads = stage(heads.select(F.col("main").alias("node"), "cluster", "part"), "heads")
    heads = large.join(sent(heads, n_heads), ["cluster", "part", "node"])
    slot = F.floor(F.col("part") / BLOCK_SETS).cast("int")
    between, _ = stage(_blocks(heads.select(
        F.col("cluster").alias("x"), slot.alias("y"), slot.alias("z"), yes.alias("asked"), "part", "node", "set"),
        rule), "links")
    found = found.union(between)

    rows = labelled(found)
    main = largest(rows.select("cluster", "root"), "cluster")
    rows = rows.join(main, "cluster").select(
        "cluster", "part", "parts", "node", (F.col("root") != F.col("main")).alias("asked"))
    rows, _ = stage(rows, "placed-sets")
    left, n_left = stage(rows.filter("asked"), "left-sets")
    if not n_left:
        return found
    # A set that is left meets all other parts, another one those that have sets that are left.
    asked_parts = left.select("cluster", F.col("part").alias("other")).distinct()
    meets = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).unionByName(
        rows.filter("not asked").join(asked_parts, "cluster")).filter("other <> part")
    meets = meets.select(
        F.col("cluster").alias("x"), F.least("part", "other").alias("y"), F.greatest("part", "other").alias("z"),
        "asked", "part", "node")
    across, _ = stage(_blocks(meets.join(large.select("node", "set").dropDuplicates(["node"]), "node"), rule), "links")
    return found.union(across)


def near_duplicates(docs: DataFrame, words_per_shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles (size of its set) and component_id, the smallest doc_id
    that links lead to.

    A word is a maximal run without ASCII white space, with A-Z lower-cased; a set holds
    the distinct shingles, as 64-bit hashes, or all words as one if they are fewer. Two
    sets link if 100 * overlap >= percent * union. A document without words links to
    nothing and is its own component. Rows with equal ids are one document as far as links
    go. Rows with null id link to nothing and have a null component.
    """
    rule = Rule(words_per_shingle, percent)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described, _ = stage(
        map_arrow(rows, lambda b: _describe(b, rule),
                  "doc_id long, n_shingles long, node long, check long, bits binary"), "sets")
    linkable = described.filter("doc_id is not null and n_shingles > 0")
    named = rows.filter("doc_id is not null")

    # Blocks: sets that share a part, directly or over others.
    common = common_shingles(named, rule)
    meetings = _meetings(
        map_arrow(named.select("text"), lambda b: _meet(b, rule, common), "part long, a long, b long"), True)
    # Two sets that met in a crowd are both in the second meetings. Others met at every
    # shingle that both their prefixes have.
    crowd = meetings.filter("a = b").select(F.col("a").alias("node"))
    crowd = linkable.join(crowd, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    crowd, n_crowd = stage(crowd, "crowd")
    sizes = linkable.groupBy("node").agg(F.first("n_shingles").alias("n"))
    pairs = meetings.filter("a <> b")
    for end in ("a", "b"):
        pairs = pairs.join(sizes.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}")), end)
    pairs = pairs.filter(rule.may_overlap(F.col("n_a"), F.col("n_b"), F.col("times"))).select("a", "b", "open")
    if n_crowd:
        for end in ("a", "b"):
            pairs = pairs.join(sent(crowd.select(F.col("node").alias(end), F.lit(True).alias(f"crowd_{end}")), n_crowd),
                               end, "left")
        pairs = pairs.filter("crowd_a is null or crowd_b is null").select("a", "b", "open")
        chosen = _id_filter(crowd)
        again = _meetings(map_arrow(named, lambda b: _meet_by_parts(b, rule, common, chosen),
                                    "part long, a long, b long"), False).filter("a <> b")
        pairs = pairs.union(again.select("a", "b", "open")).groupBy("a", "b").agg(F.min("open").alias("open"))
    meetings, _ = stage(pairs, "pairs")
    shapes = linkable.groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("bits").alias("bits"))
    pairs = meetings.filter("open").select("a", "b")
    for end in ("a", "b"):
        pairs = pairs.join(shapes.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"),
                                         F.col("bits").alias(f"bits_{end}")), end)
    meetings = meetings.filter("not open").select("a", "b").union(
        map_arrow(pairs, lambda b: _may_link(b, rule), "a long, b long"))
    roots, _ = stage(components(meetings, "meetings"), "roots")
    # A root stands for itself too.
    clusters = roots.union(roots.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed(
        "root", "cluster")
    members = (
        linkable.groupBy("node", "check").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"))
        .join(clusters, "node")
    )
    members, n_members = stage(members, "members")
    need = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES))
    sizes, _ = stage(members.groupBy("cluster").agg(need.cast("int").alias("parts")), "clusters")
    cut = bool(sizes.filter("parts > 1").limit(1).count())
    wanted = _id_filter(members)
    sets = map_arrow(named, lambda b: _fetch(b, rule, wanted), "doc_id long, node long, check long, set array<long>")
    named_sets, _ = stage(members.join(sizes, "cluster").select("doc_id", "node", "check", "cluster", "parts"), "named-sets")
    sets = sets.join(sent(named_sets, n_members), ["doc_id", "node", "check"])
    sets = sets.withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int")).select(
        "cluster", "part", "parts", "node", "set")
    sets, _ = stage(sets, "block-sets")
    links = _links(sets, cut, rule)

    # Rows with one id but several texts are one document.
    same_id = linkable.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b")
    twice = linkable.join(same_id.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b"))
    twice, n_twice = stage(twice, "same-id")
    if cut or n_twice:
        roots = components(links.union(twice), "components")
    else:  # each link is from the root of a block's component
        roots = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    classes = linkable.groupBy("node").agg(F.min("doc_id").alias("first"))
    classes = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = classes.groupBy("root").agg(F.min("first").alias("component"))
    classes = classes.join(smallest, "root").select(F.col("node").alias("_node"), "component")
    linked = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("node"))
    joined = described.select("doc_id", "n_shingles", linked.alias("_of")).join(
        classes, F.col("_of") == F.col("_node"), "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def one_per_group(docs: DataFrame, words_per_shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents with the smallest id of their component, with their own columns.

    Of rows that repeat such an id, one stays: that with the smallest text. Rows without
    words and rows with null id all stay.
    """
    found, _ = stage(near_duplicates(docs, words_per_shingle, percent), "near")
    gone, n = stage(found.filter("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    kept = docs.join(sent(gone, n), F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
    again = found.filter("n_shingles > 0 and doc_id is not null").groupBy("doc_id").count().filter("count > 1")
    again, n_again = stage(again.select(F.col("doc_id").alias("_again")), "repeated-ids")
    if not n_again:
        return kept
    same = F.col("doc_id").cast("long") == F.col("_again")
    repeated = kept.join(again, same, "left_semi").filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    row = F.struct(*[F.col(c) for c in kept.columns])
    one = repeated.groupBy(F.col("doc_id").alias("_id")).agg(F.min_by(row, "text").alias("_row")).select("_row.*")
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return kept.join(again, same & has_words, "left_anti").unionByName(one)
