"""Language-model scores of documents: a log-bilinear model over word classes.

P(word | words before) = P(class | words before) * P(word | class). The first factor is a
log-bilinear neural model: a position-weighted sum of the vectors of the classes before
gives a vector, whose products with all class vectors give the log-probabilities, exactly
normalised. It is trained in numpy by noise-contrastive estimation on all training
documents, twice: tasks train from the same start, and their parameters are averaged by
tokens, which is the start of the second time.
The second factor, and the base score, use exact counts of all training tokens.

Frequent words have a class each; the others fall into classes by their ends, which tell
languages and kinds of words apart.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.batches import filled, map_arrow, slices, utf8
from starmill.llm.words import LOWER, LOWER_BYTES, Words, words
from starmill.sources.stage import stage

OWN_CLASS = 96  # most frequent words with a class of their own
END_CLASSES = 64  # classes of other words
CONTEXT = 3
DIMENSIONS = 16
NOISE = 24
BATCH = 1024
RATE = 0.15
ROUNDS = 2  # each on all training documents; the first gives a common start
SCORED = 1024  # contexts whose products with all classes are held at once
# Tokens that are at least this share of all are known to every task; so at most
# 1 / share tokens are sent. Others are joined.
FREQUENT_SHARE = 2e-6
REMEMBERED = 300_000

_END = ""  # no word is empty


def tokens(text: str) -> list[bytes]:
    """Words without ASCII white space, A-Z lower-cased, as UTF-8."""
    return text.encode().translate(LOWER_BYTES).split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per token of the training documents; the end of a document is a token."""
    counts: Counter[bytes] = Counter()

    def packed() -> pa.RecordBatch:
        keys = pa.array(list(counts), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([keys, pa.array(list(counts.values()), pa.int64())], names=["token", "c"])

    for batch in slices(batches, "text"):
        texts = filled(batch.column("text")).to_pylist()
        for text in texts:
            counts.update(tokens(text))
        counts[b""] += len(texts)
        if len(counts) > REMEMBERED:
            yield packed()
            counts = Counter()
    yield packed()


def token_counts(train: DataFrame) -> DataFrame:
    """(token, c) over all training documents; the empty token is the end of a document."""
    found = map_arrow(train.select("text"), _count, "token string, c long")
    return found.groupBy("token").agg(F.sum("c").alias("c")).filter("c > 0")


@dataclass(frozen=True)
class Classes:
    """``own`` are words with a class each; class 0 is the end of a document. Other words fall
    into classes by their last three bytes."""

    own: tuple[str, ...]
    end_classes: int = END_CLASSES

    @property
    def number(self) -> int:
        return 1 + len(self.own) + self.end_classes

    def column(self, token: Column) -> Column:
        """The class of a token, as ``Known`` gives it."""
        last = F.conv(F.hex(F.substring(token.cast("binary"), -3, 3)), 16, 10).cast("long")
        ends = F.pmod(F.shiftright(last * 40503, 4), F.lit(self.end_classes)).cast("int")
        own = F.array_position(F.array(*[F.lit(w) for w in self.own]), token).cast("int") if self.own else F.lit(0)
        return F.when(token == _END, 0).when(own > 0, own).otherwise(1 + len(self.own) + ends)

    def by_ends(self, data: np.ndarray, w: Words) -> np.ndarray:
        """Classes of words by their ends alone."""
        last = data[w.end - 1].astype(np.int64)
        for k in (2, 3):
            there = w.end - k >= w.start
            last += np.where(there, data[np.maximum(w.end - k, 0)], 0).astype(np.int64) << (8 * (k - 1))
        return 1 + len(self.own) + (last * 40503 >> 4) % self.end_classes


class Known:
    """Classes of words, and log10 of one more than the counts of frequent ones, by the hashes
    of words in an open table. ``NaN`` stands for words that are not in it."""

    def __init__(self, classes: Classes, counts: dict[str, int]):
        self.classes = classes
        own = {w: k for k, w in enumerate(classes.own, 1)}
        listed = [w for w in {**counts, **own} if w]
        data = np.frombuffer(" ".join(listed).encode(), np.uint8)
        hashes = words(data, np.array([0, len(data)])).hash
        size = 1 << max(4, int(np.ceil(np.log2(max(1, len(listed)) * 2.5))))
        self._shift, self._last = np.uint64(64 - int(np.log2(size))), size - 1
        self._keys = np.zeros(size, np.uint64)
        self._used = np.zeros(size + 1, bool)
        self._class = np.zeros(size, np.int32)
        self._log = np.full(size, np.nan)
        left, at = np.arange(len(listed)), (hashes >> self._shift).astype(np.int64)
        while len(left):
            chosen, first = np.unique(at, return_index=True)
            free = ~self._used[chosen]
            slot, who = chosen[free], left[first[free]]
            self._keys[slot], self._used[slot] = hashes[who], True
            self._class[slot] = [own.get(listed[i], 0) for i in who]
            self._log[slot] = [np.log10(counts[listed[i]] + 1) if listed[i] in counts else np.nan for i in who]
            rest = ~np.isin(left, who)
            left, at = left[rest], (at[rest] + 1) & self._last

    def __call__(self, data: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Class and log of each word."""
        found = np.full(len(w.hash), -1, np.int64)
        left, at = np.arange(len(w.hash)), (w.hash >> self._shift).astype(np.int64)
        while len(left):
            used = self._used[at]
            hit = used & (self._keys[at] == w.hash[left])
            found[left[hit]] = at[hit]
            on = used & ~hit
            left, at = left[on], (at[on] + 1) & self._last
        kinds, logs = self.classes.by_ends(data, w), np.full(len(found), np.nan)
        there = found >= 0
        logs[there] = self._log[found[there]]
        own = np.zeros(len(found), np.int64)
        own[there] = self._class[found[there]]
        return np.where(own > 0, own, kinds), logs


def with_ends(values: np.ndarray, w: Words, end) -> np.ndarray:
    """Values of words with one more after each text, for its end."""
    out = np.full(len(values) + len(w.first) - 1, end, values.dtype)
    out[np.arange(len(values)) + w.text] = values
    return out


@dataclass(frozen=True)
class LogBilinear:
    """Class vectors before (r) and of the next class (q), bias (b), weights of positions (c)."""

    r: np.ndarray
    q: np.ndarray
    b: np.ndarray
    c: np.ndarray

    @classmethod
    def start(cls, unigram: np.ndarray) -> LogBilinear:
        """Small random vectors, and the frequencies of classes as bias."""
        n = len(unigram)
        random = np.random.RandomState(7)
        draw = lambda: random.normal(0, 0.1, (n + 1, DIMENSIONS)).astype(np.float32)
        return cls(draw(), draw()[:n], np.log(unigram).astype(np.float32),
                   np.ones((CONTEXT, DIMENSIONS), np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.r, self.q, self.b, self.c)])

    def of_flat(self, values: np.ndarray) -> LogBilinear:
        out, at = [], 0
        for x in (self.r, self.q, self.b, self.c):
            out.append(values[at:at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return LogBilinear(*out)

    def predicted(self, context: np.ndarray) -> np.ndarray:
        return (self.r[context] * self.c).sum(axis=1)

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logs of P(target class | context classes), normalised over all classes.

        The normaliser is that of a context, so it is found once for each that occurs.
        """
        if not len(target):
            return np.zeros(0)
        code = context[:, 0].astype(np.int64)
        for k in range(1, CONTEXT):
            code = code * len(self.r) + context[:, k]
        order = np.argsort(code)
        code = code[order]
        new = np.concatenate([[True], code[1:] != code[:-1]])
        which = np.empty(len(code), np.int64)
        which[order] = np.cumsum(new) - 1
        h = self.predicted(context[order[new]])
        whole = np.empty(len(h))
        for a in range(0, len(h), SCORED):
            scores = self.q @ h[a:a + SCORED].T
            scores += self.b[:, None]
            top = scores.max(axis=0)
            scores -= top
            whole[a:a + SCORED] = np.log(np.exp(scores, out=scores).sum(axis=0)) + top.astype(np.float64)
        own = np.einsum("ij,ij->i", h.take(which, axis=0), self.q.take(target, axis=0)) + self.b[target]
        return own.astype(np.float64) - whole[which]


def contexts(classes: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
    """The ``CONTEXT`` classes before each token, nearest first; ``start`` stands before a
    document's first token."""
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = np.arange(len(classes))
    out = np.full((len(classes), CONTEXT), start, np.int32)
    for k in range(1, CONTEXT + 1):
        inside = place - k >= first
        out[inside, k - 1] = classes[place[inside] - k]
    return out


def _sums(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows at each of ``n`` indexes; rows begin anew if there are more indexes."""
    index = index.astype(np.uint16)  # sorted in linear time
    order = np.argsort(index, kind="stable")
    index = index.take(order)
    begin = np.flatnonzero(np.concatenate([[True], index[1:] != index[:-1]]))
    if len(order) > len(rows):
        order %= len(rows)
    total = np.zeros((n, rows.shape[1]), np.float32)
    total[index[begin]] = np.add.reduceat(rows.take(order, axis=0), begin, axis=0)
    return total


class Trainer:
    """Noise-contrastive estimation by AdaGrad: the classes that came next against classes
    drawn by frequency, without normalising."""

    def __init__(self, model: LogBilinear, unigram: np.ndarray, seed: int):
        self.m = LogBilinear(*(x.copy() for x in (model.r, model.q, model.b, model.c)))
        self._squares = [np.full(x.shape, 1e-2, np.float32) for x in (model.r, model.q, model.b, model.c)]
        self._noise = np.log(unigram * NOISE).astype(np.float32)
        self._ends = np.cumsum(unigram)
        self._random = np.random.RandomState(seed & 0x7FFFFFFF)
        self.seen = 0

    def _step(self, x: np.ndarray, k: int, slope: np.ndarray) -> None:
        squares = self._squares[k]
        squares += slope * slope
        x += RATE * slope / np.sqrt(squares)

    def learn(self, context: np.ndarray, target: np.ndarray) -> None:
        m, n = self.m, len(target)
        size = len(m.r)
        drawn = np.searchsorted(self._ends, self._random.random_sample(NOISE) * self._ends[-1]).astype(np.int64)
        drawn = np.minimum(drawn, len(m.b) - 1)
        # Class vectors by position, one table; places of the contexts in it.
        weighed = (m.c[:, None, :] * m.r).reshape(CONTEXT * size, DIMENSIONS)
        at = context.T + np.arange(0, CONTEXT * size, size)[:, None]
        h = weighed.take(at[0], axis=0)
        for k in range(1, CONTEXT):
            h += weighed.take(at[k], axis=0)
        q, noise_q = m.q.take(target, axis=0), m.q[drawn]
        real = np.einsum("ij,ij->i", h, q) + (m.b - self._noise).take(target)
        up = 1 / (1 + np.exp(np.clip(real, -30, 30)))
        down = h @ -noise_q.T
        down -= (m.b - self._noise)[drawn]
        np.exp(np.clip(down, -30, 30, out=down), out=down)
        down += 1
        np.divide(-1, down, out=down)
        slope_h = down @ noise_q
        q *= up[:, None]
        slope_h += q
        slope_q = _sums(target, up[:, None] * h, len(m.q))
        np.add.at(slope_q, drawn, down.T @ h)
        slope_b = np.bincount(target, up, len(m.b)).astype(np.float32)
        slope_b += np.bincount(drawn, down.sum(axis=0), len(m.b)).astype(np.float32)
        # Slopes of a class at a position, of which those of r and c are made.
        placed = _sums(at.ravel(), slope_h, CONTEXT * size).reshape(CONTEXT, size, DIMENSIONS)
        slope_r = (placed * m.c[:, None, :]).sum(axis=0)
        slope_c = (placed * m.r).sum(axis=1)
        for k, (x, slope) in enumerate(((m.r, slope_r), (m.q, slope_q), (m.b, slope_b), (m.c, slope_c))):
            self._step(x, k, slope / n)
        self.seen += n


def _train(batches: Iterator[pa.RecordBatch], model: LogBilinear, classes: Classes, unigram: np.ndarray
           ) -> Iterator[pa.RecordBatch]:
    """Parameters after a pass over this task's documents, each weighed by its tokens."""
    from pyspark import TaskContext

    known = Known(classes, {})
    trainer = Trainer(model, unigram, 1 + TaskContext.get().partitionId())
    random = np.random.RandomState(TaskContext.get().partitionId())
    for batch in slices(batches, "text"):
        data, offsets = utf8(batch.column("text"))
        w = words(data, offsets)
        own = with_ends(known(LOWER[data], w)[0], w, 0)
        before = contexts(own, w.counts + 1, classes.number)
        order = random.permutation(len(own))
        for a in range(0, len(order), BATCH):
            pick = order[a:a + BATCH]
            trainer.learn(before.take(pick, axis=0), own[pick])
    if trainer.seen:
        values = trainer.m.flat().astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values * trainer.seen),
             pa.array(np.full(len(values), trainer.seen, np.int64))], names=["i", "total", "n"])


@dataclass(frozen=True)
class LanguageModel:
    classes: Classes
    bilinear: LogBilinear
    train_tokens: int
    vocabulary: int
    class_log: np.ndarray  # log10 of the tokens of a class and one for each of its words, and one


def fit(train: DataFrame, counts: DataFrame) -> LanguageModel:
    """Train on all documents of ``train`` (a table with text) and their counts."""
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    frequent = counts.filter(F.col("token") != _END).orderBy(F.col("c").desc(), "token").limit(OWN_CLASS)
    classes = Classes(tuple(r["token"] for r in frequent.collect()))
    per_class = counts.groupBy(classes.column(F.col("token")).alias("k")).agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    c, words = np.zeros(classes.number), np.zeros(classes.number)
    for r in per_class:
        c[r["k"]], words[r["k"]] = r["c"], r["v"]
    # A class with one word of its own can be no other word.
    single = np.arange(classes.number) <= len(classes.own)
    class_log = np.where(single, np.log10(c + 1), np.log10(c + words + 1))
    unigram = (c + 1) / (c + 1).sum()
    model = LogBilinear.start(unigram)
    for _ in range(ROUNDS):
        sent = map_arrow(train.select("text"), lambda b, m=model: _train(b, m, classes, unigram),
                         "i int, total double, n long")
        rows = sent.groupBy("i").agg((F.sum("total") / F.sum("n")).alias("x")).collect()
        if rows:
            values = model.flat().astype(np.float64)
            values[[r["i"] for r in rows]] = [r["x"] for r in rows]
            model = model.of_flat(values)
    return LanguageModel(classes, model, int(n), int(v), class_log)


_SCAN = "doc_id long, row long, n_tokens long, known long, logs double, neural double, rare array<string>"


def _score(batches: Iterator[pa.RecordBatch], model: LanguageModel, frequent: dict[str, int]
           ) -> Iterator[pa.RecordBatch]:
    """Per document what the model and the frequent tokens give, and its other tokens."""
    known = Known(model.classes, frequent)
    end_log, end_known = np.log10(frequent.get(_END, 0) + 1), int(_END in frequent)
    start, base10 = model.classes.number, 1 / np.log(10)
    for batch in slices(batches, "text"):
        data, offsets = utf8(batch.column("text"))
        w = words(data, offsets)
        lowered = LOWER[data]
        kinds, logs = known(lowered, w)
        own, lengths = with_ends(kinds, w, 0), w.counts + 1
        neural = model.bilinear.log_probabilities(contexts(own, lengths, start), own) * base10
        neural -= model.class_log[own]
        rare = np.isnan(logs)
        starts = np.cumsum(lengths) - lengths
        raw, at = lowered.tobytes(), np.flatnonzero(rare)
        tokens_ = pa.array([raw[a:b] for a, b in zip(w.start[at].tolist(), w.end[at].tolist())], pa.binary()).cast(pa.string())
        ends = np.searchsorted(at, w.first).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row"), pa.array(lengths),
             pa.array(np.add.reduceat(with_ends((~rare).astype(np.int64), w, end_known), starts)),
             pa.array(np.add.reduceat(with_ends(np.where(rare, 0.0, logs), w, end_log), starts)),
             pa.array(np.add.reduceat(neural, starts)), pa.ListArray.from_arrays(pa.array(ends), tokens_)],
            names=["doc_id", "row", "n_tokens", "known", "logs", "neural", "rare"])


def held_out(doc_id: Column) -> Column:
    remainder = F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(7))
    return remainder == 2


def language_scores(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from documents that are not held out. ``base_score`` is the add-one unigram
    log10 probability, ``score`` that of the model; an unseen word counts like one more
    word of its class. Null is the empty text, one end token. Repeated rows each have
    their score. If all documents are held out, the model knows no token.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    train = rows.filter(~held_out(F.col("doc_id")))
    counts, _ = stage(token_counts(train), "lm-counts")
    model = fit(train, counts)
    often = F.col("c") >= max(1.0, FREQUENT_SHARE * model.train_tokens)
    common = counts.filter(often | (F.col("token") == _END)).collect()
    frequent = {r["token"]: r["c"] for r in common}

    scanned = map_arrow(rows.withColumn("row", F.xxhash64("text")), lambda b: _score(b, model, frequent), _SCAN)
    scanned, _ = stage(scanned, "lm-scan")
    # Repeated rows are counted, as their tokens come together.
    rare = (
        scanned.filter(F.size("rare") > 0).select("doc_id", "row", F.explode("rare").alias("token"))
        .join(counts.hint("shuffle_hash"), "token").groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row"))
        .agg(F.sum(F.log10(F.col("c") + 1)).alias("rare_logs"), F.count(F.lit(1)).alias("rare_known"))
    )
    times = scanned.groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(F.count(F.lit(1)).alias("_times"))
    times = times.filter("_times > 1")
    times, n_times = stage(times, "lm-repeated")
    joined = scanned.drop("rare")
    for side in (rare, *([times] if n_times else [])):
        joined = joined.join(
            side, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")), "left").drop("_id", "_row")
    times = F.coalesce("_times", F.lit(1)) if n_times else F.lit(1)
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0)) / times
    whole = F.lit(float(np.log10(model.train_tokens + model.vocabulary + 1)))
    return joined.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) / times).cast("long").alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * whole).alias("base_score"), (logs + F.col("neural")).alias("score"))
