"""Byte-pair encoding by segment trees, and decoding, of whole texts.

Text becomes words as the tokenizer file says: special strings are cut out first, the rest is
normalised, lower-cased and split by the file's pattern. A word is a row of symbols, one a
byte. The ranks of its adjacent pairs are the leaves of a segment tree whose inner nodes hold
the least (rank, position) below them, so its root is the leftmost pair of the lowest rank.
That pair is merged, the leaves of the pairs beside it change and their ancestors are
recomputed, one node a level, until no pair at the root can be merged. A merge thus costs the
logarithm of the word's length, and a word of a million letters needs no special case.

Words of a slice of texts are merged together: trees of one width are rows of a matrix and
take their steps at once. Equal words are merged once, and a task remembers a bounded number
of them. Rows are neither moved nor dropped, so nothing depends on how often a key occurs.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.llm.batches import filled, map_arrow, slices

# Words remembered by a task, and the longest one worth remembering, in bytes.
REMEMBERED = 200_000
REMEMBERED_LENGTH = 64
# Leaves of the trees that take their steps at once, and the widest such tree; wider ones are
# few and go one by one.
FOREST_LEAVES = 1 << 20
FOREST_WIDTH = 128
# Ids decoded in one call.
CALL_IDS = 1 << 18

_NONE = np.iinfo(np.int64).max
_POSITION = (1 << 32) - 1


def _letters_of_bytes() -> list[str]:
    """The letter that stands for each byte in a vocabulary: printable ones for themselves,
    the others for the letters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    stand_in = {b: 256 + k for k, b in enumerate(others)}
    return [chr(stand_in.get(b, b)) for b in range(256)]


class Vocabulary:
    """Symbols, merges and rules of splitting of one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        kinds = [p["type"] for p in spec["pre_tokenizer"].get("pretokenizers", [])]
        norms = [n["type"] for n in spec["normalizer"].get("normalizers", [])]
        if model["type"] != "BPE" or kinds != ["Split", "ByteLevel"] or norms != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path} is no byte-level BPE over lower-cased words")
        vocab = model["vocab"]
        letters = _letters_of_bytes()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + self.suffix] for c in letters], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.base = max(vocab.values()) + 1
        pairs = np.array([vocab[a] * self.base + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(pairs, kind="stable")
        self._pairs, self._ranks = pairs[order], order.astype(np.int64)
        self.rank = dict(zip(pairs.tolist(), range(len(pairs))))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.word = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self._rules = Tokenizer.from_file(path)
        tokens = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        self.tokens = pa.array([tokens.get(i) for i in range(max(tokens) + 1)], pa.large_string())

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; ``_NONE`` where there is no merge."""
        pair = left * self.base + right
        at = np.minimum(np.searchsorted(self._pairs, pair), len(self._pairs) - 1)
        return np.where(self._pairs[at] == pair, self._ranks[at], _NONE)

    def words(self, text: str) -> list[str]:
        """Words of a text without special strings, in order."""
        if _PLAIN.fullmatch(text):
            spaced = _SPACES.sub(" ", unicodedata.normalize("NFC", text))
            return self.word.findall(spaced.lower())
        # Other scripts: the file's own rules, whose tables of letters may be of another year.
        normal = self._rules.normalizer.normalize_str(text)
        return [normal[a:b] for _, (a, b) in self._rules.pre_tokenizer.pre_tokenize_str(normal)]


# Letters on which all tables of letters agree, combining ones not among them.
_PLAIN = regex.compile(r"[\x00-ɏ‐-‧‰-⁞€]*")
_SPACES = regex.compile(r"\s+")


def _forest(v: Vocabulary, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols left of words of up to ``width`` + 1 bytes each, one after the other, and their numbers.

    ``data`` holds the bytes of all words. Each word's tree is a row: leaf i, at width + i,
    is the pair of the symbol at i and the next one that is left.
    """
    n = len(starts)
    column = np.arange(width + 1)
    inside = column < sizes[:, None]
    at = np.where(inside, starts[:, None] + column, 0)
    symbol = np.where(inside, v.inner[data[at]], -1)
    last = sizes - 1
    rows = np.arange(n)
    symbol[rows, last] = v.final[data[starts + last]]
    follow = np.where(column < last[:, None], column + 1, -1)
    before = np.broadcast_to(column - 1, symbol.shape).copy()

    tree = np.full((n, 2 * width), _NONE, np.int64)
    pair = column[:-1] < last[:, None]
    ranks = np.full((n, width), _NONE, np.int64)
    ranks[pair] = v.ranks(symbol[:, :-1][pair], symbol[:, 1:][pair])
    tree[:, width:] = np.where(ranks == _NONE, _NONE, (ranks << 32) | column[:-1])
    level = width
    while level > 1:
        tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
        level //= 2

    def leaf(r, left, right):
        """Set the leaves of the pairs (left, right) of rows; right -1 means that there is none."""
        rank = np.full(len(r), _NONE, np.int64)
        there = right >= 0
        rank[there] = v.ranks(symbol[r[there], left[there]], symbol[r[there], right[there]])
        tree[r, width + left] = np.where(rank == _NONE, _NONE, (rank << 32) | left)

    def climb(r, position):
        node = (width + position) >> 1
        while node[0]:
            tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
            node = node >> 1

    rows = rows[tree[:, 1] < _NONE]
    while len(rows):
        root = tree[rows, 1]
        left = root & _POSITION
        right = follow[rows, left]
        beyond = follow[rows, right]
        symbol[rows, left] = v.merged[root >> 32]
        symbol[rows, right] = -1
        follow[rows, left] = beyond
        linked = beyond >= 0
        before[rows[linked], beyond[linked]] = left[linked]
        leaf(rows, left, beyond)
        dead = right < width
        tree[rows[dead], width + right[dead]] = _NONE
        earlier = before[rows, left]
        preceded = earlier >= 0
        if preceded.any():
            leaf(rows[preceded], earlier[preceded], left[preceded])
            climb(rows[preceded], earlier[preceded])
        climb(rows, left)
        if dead.any():
            climb(rows[dead], right[dead])
        rows = rows[tree[rows, 1] < _NONE]
    return symbol[symbol >= 0], (symbol >= 0).sum(axis=1)


def _single(v: Vocabulary, word: bytes) -> list[int]:
    """``_forest`` for one long word, node by node."""
    symbol = v.inner[np.frombuffer(word, np.uint8)].tolist()
    symbol[-1] = int(v.final[word[-1]])
    n = len(symbol)
    width = 1 << max(0, (n - 2).bit_length())
    rank, base, merged, none = v.rank, v.base, v.merged.tolist(), (_NONE, 0)
    tree = [none] * (2 * width)
    for i in range(n - 1):
        found = rank.get(symbol[i] * base + symbol[i + 1])
        if found is not None:
            tree[width + i] = (found, i)
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    follow, before = [*range(1, n), -1], list(range(-1, n - 1))

    def put(i: int) -> None:
        after = follow[i]
        found = rank.get(symbol[i] * base + symbol[after]) if after >= 0 else None
        node = width + i
        tree[node] = none if found is None else (found, i)
        while node > 1:
            node >>= 1
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b

    while tree[1] < none:
        found, i = tree[1]
        gone = follow[i]
        symbol[i], follow[i] = merged[found], follow[gone]
        symbol[gone], follow[gone] = -1, -1
        if follow[i] >= 0:
            before[follow[i]] = i
        if gone < width:
            put(gone)
        put(i)
        if before[i] >= 0:
            put(before[i])
    return [s for s in symbol if s >= 0]


class Encoder:
    """Ids of texts as little-endian 32-bit numbers, with a bounded memory of words."""

    def __init__(self, path: str):
        self.vocabulary = _vocabulary(path)
        self._known: dict[str, bytes] = {}

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of each word, merged by its segment tree."""
        v = self.vocabulary
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(w) for w in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        starts = np.cumsum(sizes) - sizes
        # Leaves of a tree: pairs of the word, up to the next power of two.
        widths = 1 << np.ceil(np.log2(np.maximum(sizes - 1, 1))).astype(np.int64)
        found: list[bytes] = [b""] * len(raw)
        for width in np.unique(widths).tolist():
            of_width = np.flatnonzero(widths == width)
            if width > FOREST_WIDTH:
                for k in of_width.tolist():
                    found[k] = np.array(_single(v, raw[k]), "<u4").tobytes()
                continue
            step = max(1, FOREST_LEAVES // width)
            for first in range(0, len(of_width), step):
                some = of_width[first:first + step]
                symbols, counts = _forest(v, data, starts[some], sizes[some], width)
                flat, ends = symbols.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
                for k, a, b in zip(some.tolist(), [0, *ends], ends):
                    found[k] = flat[a:b]
        return found

    def __call__(self, texts: list[str]) -> list[bytes]:
        v = self.vocabulary
        # Parts of a text: words, or the number of a special string.
        parts: list[list] = []
        for text in texts:
            own: list = []
            for piece in v.cut.split(text):
                if piece in v.special:
                    own.append(v.special[piece])
                elif piece:
                    own += v.words(piece)
            parts.append(own)
        if len(self._known) > REMEMBERED:
            self._known = {}
        known = self._known
        new = list({w for own in parts for w in own if w.__class__ is str and w not in known})
        ids = dict(zip(new, self.merge(new)))
        ids.update((i, i.to_bytes(4, "little")) for i in v.special.values())
        known.update((w, ids[w]) for w in new if len(w) <= REMEMBERED_LENGTH)
        get = known.get
        return [b"".join([k if (k := get(w)) is not None else ids[w] for w in own]) for own in parts]


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def with_ids(docs: DataFrame, tokenizer_path: str, text: str = "text", name: str = "ids") -> DataFrame:
    """Add the ids of a text column, as binary: each a little-endian unsigned 32-bit number.

    ``tokenizer_path`` is a byte-level BPE file of the ``tokenizers`` library, with lower-cased
    words, that every executor has. No token is added at begin or end, none is cut off or
    padded; a special string in a text is its special token, as is the library's default. A
    null text counts as the empty one, whose ids are empty. Rows stay as they are, repeated
    ones too; an empty table gives an empty one. A column called ``name`` is replaced. A text
    of any length is encoded whole, in memory in proportion to it.
    """
    docs = docs.drop(name)
    fields = [*docs.schema.fields, T.StructField(name, T.BinaryType(), False)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer_path)
        for batch in slices(batches, text):
            ids = encode(filled(batch.column(text)).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], names=[*batch.schema.names, name])

    return map_arrow(docs, run, T.StructType(fields))


def decode(ids: list[bytes], v: Vocabulary) -> pa.Array:
    """Texts of ids: their tokens, joined by spaces; ids outside the vocabulary are skipped."""
    counts = np.array([len(i) // 4 for i in ids], np.int64)
    flat = np.frombuffer(b"".join(i[:4 * n] for i, n in zip(ids, counts.tolist())), "<u4").astype(np.int64)
    tokens = v.tokens.take(pa.array(np.minimum(flat, len(v.tokens) - 1)))
    valid = (flat < len(v.tokens)) & np.asarray(tokens.is_valid())
    if not valid.all():
        owner = np.repeat(np.arange(len(ids)), counts)[valid]
        tokens, counts = tokens.filter(pa.array(valid)), np.bincount(owner, minlength=len(ids))
    offsets = np.concatenate([[0], np.cumsum(counts)])
    lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), tokens)
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string()))


def with_decoded(encoded: DataFrame, tokenizer_path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the text of a column of ids as ``with_ids`` makes it, special tokens included.

    The files that ``with_ids`` takes name no decoder, so tokens are joined by spaces. Null or
    empty ids give the empty text. Rows stay as they are; a column called ``name`` is replaced.
    """
    encoded = encoded.drop(name)
    fields = [*encoded.schema.fields, T.StructField(name, T.StringType(), False)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabulary(tokenizer_path)
        for batch in batches:
            values = [i or b"" for i in batch.column(ids).to_pylist()]
            start = 0
            while start < len(values):
                stop, n = start + 1, len(values[start])
                while stop < len(values) and n + len(values[stop]) <= 4 * CALL_IDS:
                    n += len(values[stop])
                    stop += 1
                texts = decode(values[start:stop], v).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(start, stop - start).columns, texts], names=[*batch.schema.names, name])
                start = stop

    return map_arrow(encoded, run, T.StructType(fields))


def bpe_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A row for each row of ``docs``, in any order; a null text counts as the empty one, which
    has no ids and whose digests are those of no bytes. Other columns are not read.
    """
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = with_ids(texts, tokenizer_path).drop("text")
    return with_decoded(ids, tokenizer_path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
