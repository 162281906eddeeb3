"""Toxicity from a learned lexicon, misspellings included, in context.

The lexicon holds words, and stems with many endings, that labelled toxic documents have
far more often than others. It is kept as a trie. A word of a text is turned into a
Levenshtein automaton, which runs over the trie and finds the terms within one or two
edits. Each hit is weighed by its term and by the words around it: windows of labelled
documents say which of them, and whether quotation marks, go with abuse or with talk about
it. A logistic curve over the sum makes the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.batches import filled, map_arrow, sent, slices, without
from starmill.sources.stage import stage

THRESHOLD = 0.3
# The model is fitted on at most about this many labelled documents, by hash of the id.
MAX_TRAIN = 200_000
# A term is in this share of the toxic documents of the fit, and in two at least. As a
# document has a bounded number of words on average, that bounds the terms.
MIN_SHARE = 0.002
# Times more frequent in toxic documents than in others, and so clearly that chance would
# give less than this many such terms in all.
MIN_RATIO = 8.0
CHANCE = 0.1
STEM_LENGTHS = (4, 5, 6, 7, 8)
STEM_FORMS = 4
WINDOW = 6
REMEMBERED = 150_000

_QUOTES = "\"'“”„«»‘’"
_QUOTED = "\x00quoted"
_ALL = "\x00all"
# No hit counts for more than this.
MAX_WEIGHT = 6.0
_TABLE = bytes(c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))
_WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def allowed_edits(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


class Automaton:
    """All strings within ``edits`` of a word. A state maps positions in the word to edits."""

    def __init__(self, word: str, edits: int):
        self.word, self.edits = word, edits

    def start(self) -> dict[int, int]:
        return {i: i for i in range(min(self.edits, len(self.word)) + 1)}

    def step(self, state: dict[int, int], char: str) -> dict[int, int]:
        after: dict[int, int] = {}
        for i, e in state.items():  # positions ascend
            if e < after.get(i, self.edits + 1) and e + 1 <= self.edits:
                after[i] = min(after.get(i, e + 1), e + 1)  # char is extra
            if i < len(self.word):
                cost = e + (self.word[i] != char)
                if cost <= self.edits:
                    after[i + 1] = min(after.get(i + 1, cost), cost)
        for i in sorted(after):  # a char of the word is missing
            e = after[i] + 1
            j = i + 1
            while j <= len(self.word) and e <= self.edits and e < after.get(j, self.edits + 1):
                after[j] = e
                j, e = j + 1, e + 1
        return dict(sorted(after.items()))

    def distance(self, state: dict[int, int]) -> int | None:
        return state.get(len(self.word))


class Trie:
    def __init__(self, terms):
        self.root: dict = {}
        for term in terms:
            node = self.root
            for char in term:
                node = node.setdefault(char, {})
            node[""] = term

    def within(self, word: str) -> tuple[str, int] | None:
        """The nearest term, and how many edits away; of several, the first by name."""
        most = allowed_edits(len(word) + 2)
        automaton, best = Automaton(word, most), None
        stack = [(self.root, automaton.start())]
        while stack:
            node, state = stack.pop()
            for char, child in node.items():
                if char == "":
                    d = automaton.distance(state)
                    if d is not None and d <= allowed_edits(len(child)) and (best is None or (d, child) < best):
                        best = (d, child)
                    continue
                after = automaton.step(state, char)
                if after:
                    stack.append((child, after))
        return None if best is None else (best[1], best[0])


def _cut(term: str, pieces: int) -> list[tuple[int, str]]:
    ends = [round(len(term) * k / pieces) for k in range(pieces + 1)]
    return [(a, term[a:b]) for a, b in zip(ends, ends[1:])]


class Matcher:
    """Finds the term of a word. Of k + 1 pieces of a term, k edits leave one whole: the first
    one where it was, the last one at the end, a middle one at most k - 1 places off. Every
    such piece has a trie of its terms, and a word runs over the tries of its pieces alone,
    which hold all terms within the edits."""

    def __init__(self, terms, stems, harmless):
        self._terms, self._harmless = frozenset(terms), frozenset(harmless)
        self._stems = {n: frozenset(s for s in stems if len(s) == n) for n in {len(s) for s in stems}}
        # Per length of a word: spans (from, to), the pieces that may stand there, and their
        # terms, which become a trie when first met.
        self._pieces: dict[int, dict[tuple[int, int], dict[str, list[str] | Trie]]] = {}
        for term in terms:
            k = allowed_edits(len(term))
            if not k:
                continue
            (_, first), *middle, (_, last) = _cut(term, k + 1)
            for length in range(len(term) - k, len(term) + k + 1):
                spans = self._pieces.setdefault(length, {})
                spans.setdefault((0, len(first)), {}).setdefault(first, []).append(term)
                spans.setdefault((length - len(last), length), {}).setdefault(last, []).append(term)
                for at, piece in middle:
                    for shift in (-1, 0, 1):
                        at_span = spans.setdefault((at + shift, at + shift + len(piece)), {})
                        at_span.setdefault(piece, []).append(term)
        self._known: dict[bytes, tuple[str, int] | None] = {}

    def _find(self, word: str) -> tuple[str, int] | None:
        if word in self._terms:
            return word, 0
        for n, stems in self._stems.items():
            if word[:n] in stems:
                return word[:n] + "*", 0
        if word in self._harmless:
            return None
        best = None
        for (a, b), pieces in self._pieces.get(len(word), {}).items():
            own = pieces.get(word[a:b])
            if own is None:
                continue
            if isinstance(own, list):
                own = pieces[word[a:b]] = Trie(own)
            found = own.within(word)
            if found is not None and (best is None or found[::-1] < best[::-1]):
                best = found
        return best

    def __call__(self, word: bytes) -> tuple[str, int] | None:
        try:
            return self._known[word]
        except KeyError:
            if len(self._known) > REMEMBERED:
                self._known.clear()
            found = self._known[word] = self._find(word.decode())
            return found

    def hits(self, text: str) -> dict[bytes, tuple[str, int]]:
        """The words of a lower-cased text that have a term."""
        known, found = self._known, {}
        for word in set(text.encode().translate(_TABLE).split()):
            try:
                term = known[word]
            except KeyError:
                term = self(word)
            if term is not None:
                found[word] = term
        return found


@dataclass(frozen=True)
class ToxicityModel:
    """``terms`` are words and ``stems`` beginnings of words, with how often a word of a clean
    text is one. ``harmless`` are words within edits of a term that the fit saw in documents
    that are not toxic."""

    terms: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    harmless: frozenset[str] = frozenset()
    misspelt: float = 0.0
    context: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, float, float] = (-3.0, 1.0, 0.0)

    def matcher(self) -> Matcher:
        return Matcher(self.terms, self.stems, self.harmless)

    def weight(self, term: str, edits: int, n_words: int) -> float:
        """Log odds of one hit more than chance gives in a text of so many words."""
        rate = self.stems[term[:-1]] if term.endswith("*") else self.terms[term]
        own = min(MAX_WEIGHT, math.log1p(1 / (rate * max(n_words, 20))))
        return min(own, self.misspelt) if edits else own


def windows(text: str, found: dict[bytes, tuple[str, int]]) -> Iterator[tuple[bytes, set[str]]]:
    """Every hit of a lower-cased text with the words around it, and the mark of quotation if
    it stands between quotation marks within the window."""
    spans = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    listed = [text[a:b] for a, b in spans]
    encoded = [w.encode() for w in listed]
    for i, word in enumerate(encoded):
        if word in found:
            low, high = max(0, i - WINDOW), min(len(spans), i + WINDOW + 1)
            around = {listed[j] for j in range(low, high) if encoded[j] not in found}
            before, after = text[spans[low][0]:spans[i][0]], text[spans[i][1]:spans[high - 1][1] + 1]
            if any(c in _QUOTES and not _inside_word(before, c) for c in before) and any(c in _QUOTES for c in after):
                around.add(_QUOTED)
            yield word, around


def _inside_word(text: str, char: str) -> bool:
    """Whether a mark in a text is only ever an apostrophe between letters."""
    return all(0 < k < len(text) - 1 and text[k - 1].isalnum() and text[k + 1].isalnum()
               for k in range(len(text)) if text[k] == char)


def evidence(model: ToxicityModel, matcher: Matcher, text: str) -> tuple[float, int]:
    """The weights of the words of a text that have a term, each at its most abusive place,
    and their number."""
    lowered = text.lower()
    found = matcher.hits(lowered)
    if not found:
        return 0.0, 0
    n_words = len(lowered.encode().translate(_TABLE).split())
    best: dict[bytes, float] = {}
    for word, around in windows(lowered, found):
        shift = sum(model.context.get(w, 0.0) for w in around)
        weight = max(0.0, model.weight(*found[word], n_words) + max(-6.0, min(1.0, shift)))
        best[word] = max(best.get(word, 0.0), weight)
    return sum(best.values()), len(best)


def _listed(text: str) -> list[str]:
    return text.lower().encode().translate(_TABLE).decode().split(" ")


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, n): documents per word."""
    for batch in slices(batches, "text"):
        counts: Counter[str] = Counter()
        for text in filled(batch.column("text")).to_pylist():
            counts.update(set(filter(None, _listed(text))))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])


def _toxic_terms(train: DataFrame, least: int) -> dict[str, int]:
    """Documents per word, and summed over forms per stem (with a star) that has enough of them."""
    found = map_arrow(train.select("text"), _words, "term string, n long")
    words, _ = stage(found.groupBy("term").agg(F.sum("n").alias("n")), "toxic-words")
    cuts = F.array(*[F.substring("term", 1, k) for k in STEM_LENGTHS])
    stems = words.select(F.explode(F.filter(cuts, lambda c: F.length(c) < F.length("term"))).alias("stem"), "n")
    stems = stems.groupBy("stem").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("forms"))
    long = F.length("stem").isin(*STEM_LENGTHS) & (F.col("forms") >= STEM_FORMS)
    stems = stems.filter(long).select(F.concat("stem", F.lit("*")).alias("term"), "n")
    return {r["term"]: r["n"] for r in words.union(stems).filter(F.col("n") >= least).collect()}


def _clean_terms(train: DataFrame, wanted: frozenset[str]) -> dict[str, int]:
    """Documents per wanted word, summed over forms for a stem, and the number of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts: Counter[str] = Counter()
            for text in filled(batch.column("text")).to_pylist():
                listed = list(filter(None, _listed(text)))
                counts[_ALL] += len(listed)
                own = set(listed)
                counts.update(own & wanted)
                for word in own:
                    counts.update({word[:n] + "*" for n in STEM_LENGTHS if len(word) > n} & wanted)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    found = map_arrow(train.select("text"), run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r["term"]: r["n"] for r in found.collect()}


def training_labels(labels: DataFrame, usable, limit: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, toxic) of usable ids; a document with several labels is toxic if one says so.

    At most about ``limit`` rows, chosen by a hash of the id.
    """
    rows = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & usable(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    n = rows.count()
    if n > limit:
        rows = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(limit * 1_000_000 // n))
    return rows


def _log_odds(toxic: float, clean: float, n_toxic: int, n_clean: int) -> float:
    return math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))


def _surprise(bad: int, good: int, base: float) -> float:
    """At most this is -log of the chance of ``bad`` toxic documents among these (Chernoff)."""
    share = bad / (bad + good)
    part = share * math.log(share / base)
    if good:
        part += (1 - share) * math.log((1 - share) / (1 - base))
    return (bad + good) * part


def _distinct_texts(train: DataFrame) -> tuple[DataFrame, int, int]:
    """One row per text and label, and the numbers of toxic and of other ones, so that
    copies count once on both sides. Only hashes move; texts stay where they are."""
    named = train.withColumn("_row", F.monotonically_increasing_id())
    named, _ = stage(named.withColumn("_text", F.xxhash64(F.coalesce("text", F.lit("")))), "toxicity-train")
    kept, n = stage(named.groupBy("_text", "toxic").agg(F.min("_row").alias("_row")), "toxicity-texts")
    n_toxic = kept.filter("toxic = 1").count()
    return named.join(sent(kept.select("_row"), n), "_row", "left_semi").drop("_row", "_text"), n_toxic, n - n_toxic


def fit(docs: DataFrame, labels: DataFrame, usable, limit: int = MAX_TRAIN) -> ToxicityModel:
    """Learn a model from the documents whose ids ``usable`` (a condition on a column) admits.

    Equal texts with one label count once. Without toxic or without other documents among them, the model knows no term and
    gives every text the share of toxic ones, 0.05 if there are none at all.
    """
    chosen = training_labels(labels, usable, limit)
    train = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), "doc_id")  # bounded by the limit
    train, n_toxic, n_clean = _distinct_texts(train)
    n = n_toxic + n_clean
    if not n_toxic or not n_clean:
        share = (n_toxic + 0.5) / (n + 1) if n else 0.05
        return ToxicityModel(curve=(math.log(share / (1 - share)), 0.0, 0.0))

    least = max(2, math.ceil(MIN_SHARE * n_toxic))
    toxic = _toxic_terms(train.filter("toxic = 1"), least)
    clean = _clean_terms(train.filter("toxic = 0"), frozenset(toxic))
    clean_words = max(1, clean.get(_ALL, 0))
    odds = {t: _log_odds(k, clean.get(t, 0), n_toxic, n_clean) for t, k in toxic.items()}
    base, bar = n_toxic / n, math.log(max(1, len(toxic)) / CHANCE)
    strong = {t: (clean.get(t, 0) + 0.5) / clean_words for t, w in odds.items()
              if w >= math.log(MIN_RATIO) and len(t) >= 3 and _surprise(toxic[t], clean.get(t, 0), base) >= bar}
    stems = {}
    for t in sorted((t for t in strong if t.endswith("*")), key=len):
        if not any(t[:n] in stems for n in STEM_LENGTHS if n < len(t) - 1):
            stems[t[:-1]] = strong[t]
    # A word stays beside its stem if clean texts have it much less often.
    terms = {t: w for t, w in strong.items()
             if not t.endswith("*") and all(2 * w < stems[t[:n]] for n in STEM_LENGTHS if t[:n] in stems)}

    draft = ToxicityModel(terms, stems)
    near = _near_words(train, draft)
    harmless = frozenset(w for w, (bad, good) in near.items() if _log_odds(bad, good, n_toxic, n_clean) < 1.0)
    rest = [v for w, v in near.items() if w not in harmless]
    misspelt = _log_odds(sum(v[0] for v in rest), sum(v[1] for v in rest), n_toxic, n_clean) if near else 3.0
    draft = ToxicityModel(terms, stems, harmless, max(0.0, min(misspelt, 5.0)))
    draft = ToxicityModel(terms, stems, harmless, draft.misspelt, _context(train, draft))
    curve = _curve(train, draft)
    return ToxicityModel(terms, stems, harmless, draft.misspelt, draft.context, curve)


def _counted(train: DataFrame, model: ToxicityModel, keys) -> DataFrame:
    """(key, bad, good): documents of either label per key that ``keys`` gives for a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for batch in slices(batches, "text"):
            counts: Counter[tuple[str, int]] = Counter()
            texts = filled(batch.column("text")).to_pylist()
            for text, toxic in zip(texts, batch.column("toxic").to_pylist()):
                counts.update((k, toxic) for k in keys(matcher, text.lower()))
            bad = [n if t else 0 for (_, t), n in counts.items()]
            good = [0 if t else n for (_, t), n in counts.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in counts], pa.string()), pa.array(bad, pa.int64()), pa.array(good, pa.int64())],
                names=["key", "bad", "good"])

    found = map_arrow(train.select("text", "toxic"), run, "key string, bad long, good long")
    return found.groupBy("key").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def _near_words(train: DataFrame, model: ToxicityModel) -> dict[str, tuple[int, int]]:
    def keys(matcher: Matcher, text: str) -> set[str]:
        return {w.decode() for w, (_, edits) in matcher.hits(text).items() if edits}

    return {r["key"]: (r["bad"], r["good"]) for r in _counted(train, model, keys).collect()}


def _context(train: DataFrame, model: ToxicityModel) -> dict[str, float]:
    """How the words of a window shift the odds that its hit is abuse. Words seen in few
    windows count little. Quotation marks start from eight windows of which one in four is
    abuse."""
    def keys(matcher: Matcher, text: str) -> set[str]:
        found = matcher.hits(text)
        return {_ALL}.union(*(around for _, around in windows(text, found))) if found else set()

    rows = _counted(train, model, keys)
    whole = rows.filter(F.col("key") == _ALL).first()
    if whole is None:
        return {_QUOTED: -2.0}
    share = (whole["bad"] + 1) / (whole["bad"] + whole["good"] + 2)
    base = math.log(share / (1 - share))

    def shift(bad: int, good: int, prior: float, strength: float) -> float:
        p = (bad + strength * prior) / (bad + good + strength)
        return math.log(p / (1 - p)) - base

    least = max(20, math.ceil(MIN_SHARE * (whole["bad"] + whole["good"])))
    kept = rows.filter((F.col("key") != _ALL) & (F.col("key") != _QUOTED) & (F.col("bad") + F.col("good") >= least)
                       & (F.col("good") > 0)).collect()
    context = {r["key"]: shift(r["bad"], r["good"], share, 20.0) for r in kept}
    quoted = rows.filter(F.col("key") == _QUOTED).first() or {"bad": 0, "good": 0}
    context = {w: max(-2.0, min(0.5, s)) for w, s in context.items() if abs(s) > 0.2}
    context[_QUOTED] = max(-4.0, min(0.5, shift(quoted["bad"], quoted["good"], 0.25, 8.0)))
    return context


def _features(total: float, n: int) -> tuple[float, float]:
    return min(round(2 * total) / 2, 30.0), float(min(n, 20))


def _curve(train: DataFrame, model: ToxicityModel) -> tuple[float, float, float]:
    """Logistic coefficients of evidence and number of terms, from counts per value of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        for batch in slices(batches, "text"):
            counts: Counter = Counter()
            texts = filled(batch.column("text")).to_pylist()
            for text, toxic in zip(texts, batch.column("toxic").to_pylist()):
                counts[(*_features(*evidence(model, matcher, text)), toxic)] += 1
            keys = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in keys], pa.float64()) for i in range(2)]
                + [pa.array([k[2] for k in keys], pa.int32()), pa.array(list(counts.values()), pa.int64())],
                names=["total", "terms", "toxic", "n"])

    found = map_arrow(train.select("text", "toxic"), run, "total double, terms double, toxic int, n long")
    # At most 61 values by 21 by 2.
    rows = found.groupBy("total", "terms", "toxic").agg(F.sum("n").alias("n")).orderBy("total", "terms", "toxic").collect()
    x = np.array([[1.0, r["total"], r["terms"]] for r in rows])
    y, n = np.array([float(r["toxic"] == 1) for r in rows]), np.array([float(r["n"]) for r in rows])
    w, ridge = np.zeros(3), np.diag([1e-3, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (y - p)) - ridge @ w
        curvature = (x * (n * p * (1 - p))[:, None]).T @ x + ridge
        change = np.linalg.solve(curvature, slope)
        w = w + np.clip(change, -2, 2)
        if np.abs(change).max() < 1e-8:
            break
    return float(w[0]), float(max(w[1], 0.0)), float(w[2])


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Per row: doc_id, text_hash, score (0 to 1). Null is the empty text, scored as a text
    without terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = model.matcher()
        a, b, c = model.curve
        for batch in slices(batches, "text"):
            scores = []
            for text in filled(batch.column("text")).to_pylist():
                total, n = _features(*evidence(model, matcher, text))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * total + c * n)))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(scores, pa.float64())],
                names=["doc_id", "text_hash", "score"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return map_arrow(rows.withColumn("text_hash", F.xxhash64("text")), run,
                     "doc_id long, text_hash long, score double")


def id_remainder(doc_id, modulus: int):
    """crc32 of the decimal text of an id, modulo ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def held_out(doc_id):
    return id_remainder(doc_id, 4) == 2


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted (score of ``THRESHOLD`` or more).

    The model is fitted on labelled documents that are not held out. Repeated rows each
    have their score; an empty table gives an empty result.
    """
    model = fit(docs, labels, lambda i: ~held_out(i))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below ``THRESHOLD``, with their own columns."""
    found = score(docs, fit(docs, labels, lambda i: ~held_out(i)))
    return without(docs, found.filter(F.col("score") >= THRESHOLD))
