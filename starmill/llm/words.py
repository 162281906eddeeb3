"""Words of many texts at once, as positions and 64-bit hashes in numpy arrays.

A word is a maximal run of word bytes of the lower-cased text (A-Z only). All
separators are ASCII, so runs of bytes are runs of code points. The hash of a word is a
polynomial over random values of its bytes, taken from running sums, so no loop runs over
words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_RANDOM = np.random.RandomState(20240917)
_VALUES = _RANDOM.randint(1, 1 << 62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_BYTES = LOWER.tobytes()


def _separators(ranges: list[tuple[int, int]]) -> np.ndarray:
    table = np.ones(256, bool)
    for first, last in ranges:
        table[first:last + 1] = False
    return table


# Letters, digits and everything beyond ASCII.
ALPHANUMERIC = _separators([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
ALPHANUMERIC[65:91] = True  # lower-cased first
# Everything but ASCII white space.
NOT_SPACE = _separators([(0x20, 0x20), (0x09, 0x0D)])


class _Powers:
    """Powers of the base and of its inverse, grown as needed."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up), 1 << 16)
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        return cls.up, cls.down


def mix(h: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit values whose every output bit depends on every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass(frozen=True)
class Words:
    """Words of a run of texts: byte spans, hashes, and where each text's words begin."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # n + 1 indexes into the arrays above

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = NOT_SPACE) -> Words:
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = table[data]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    starts[cuts] = inside[1:-1][cuts]
    ends[cuts - 1] = inside[1:-1][cuts - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _Powers.of(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[LOWER[data]] * up[:n], out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * down[start])
    return Words(start, end, hashes, np.searchsorted(start, offsets))


_FACTORS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
            0x589965CC75374CC3)


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of several, in their order."""
    total = np.zeros(len(parts[0]), np.uint64)
    for k, part in enumerate(parts):
        total = mix(total + part * np.uint64(_FACTORS[k % len(_FACTORS)]))
    return total


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words, and the text that each belongs to.

    A text with fewer words, but not none, has one shingle: all its words.
    """
    n = len(w.hash)
    text = w.text
    if n >= size:
        runs = combine([w.hash[k:n - size + 1 + k] for k in range(size)])
        whole = text[:n - size + 1] == text[size - 1:]
        runs, owner = runs[whole], text[:n - size + 1][whole]
    else:
        runs, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((w.counts > 0) & (w.counts < size))
    if len(short):
        extra = [combine([w.hash[i:i + 1] for i in range(w.first[d], w.first[d + 1])])[0] ^ np.uint64(1)
                 for d in short]
        runs = np.concatenate([runs, np.array(extra, np.uint64)])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        runs, owner = runs[order], owner[order]
    return runs, owner
