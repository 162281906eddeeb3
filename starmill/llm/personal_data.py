"""Personal data: fixed patterns, and more of it by bootstrapped contexts.

What the fixed patterns find is the seed. Every identifier-like token of a text is an
instance, and what stands before it (one or two words, with the mark between) is a
pattern if it names something; tokens and patterns form a graph. A pattern is as good as
the share of known ones among its instances, an instance as good as its patterns
together make it. Scores are passed along the graph a few times, and instances of patterns
that end with a high score are found as well, with the kind their pattern brings.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.batches import filled, map_arrow, slices
from starmill.sources.stage import stage

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
# A pattern counts if it has this many different known instances, and finds new ones from
# this score on.
LEAST_KNOWN = 3
LEAST_SCORE = 0.6

# The base patterns. Every start of a run of digits that can match is tried
# once, so long runs take linear time and matches are the leftmost ones.
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHAR = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHAR:
            start -= 1
        found = _LOCAL.match(text, start) if start < at else None
        if found:
            end = found.end()
            yield found.span()
            at = text.find("@", end)
        else:
            end = max(end, at + 1)
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start; kind is an index of ``KINDS``."""
    spans = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    spans += [(1, *m.span()) for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    if "+" in text:
        spans += [(3, *m.span()) for m in _PHONE.finditer(text)
                  if 8 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return spans


def _listed(spans, kinds=KINDS) -> str:
    return ",".join(f"{kinds[k]}:{a}:{b}" for k, a, b in spans)


# An identifier: a token with a digit or an at sign, of four characters at least.
_TOKEN = re.compile(r"[^\s\"'<>|,;()\[\]{}]*[0-9@][^\s\"'<>|,;()\[\]{}]*")
# A context names what follows: a word and one of these marks, or a word and "is" or "no".
_NAMED = re.compile(r"([^\W\d_][\w.-]{1,30})\s?[:=#]\s?$|([^\W\d_][\w.-]{1,30}\s(?:is|no|nr|number|n°|id)\.?)\s$",
                    re.IGNORECASE)
_WORDS = re.compile(r"(\S{1,30})\s(\S{1,30})\s$")


def shape(token: str) -> str:
    """Letters, digits and marks of a token, runs cut to two: a19-4 is a99-9."""
    out: list[str] = []
    for c in token[:64]:
        kind = "9" if c.isdigit() else "a" if c.isalpha() else c
        if out[-2:] != [kind, kind]:
            out.append(kind)
    return "".join(out)


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, str, int, int, int]]:
    """(pattern, instance, kind or -1, start, end) of every identifier in a context."""
    found = []
    known = sorted((a, b, k) for k, a, b in spans)
    tokens = [(m.start(), m.start() + len(m.group().rstrip(".:!?")), -1) for m in _TOKEN.finditer(text)]
    taken, i = [], 0
    for a, b, _ in tokens:  # tokens that touch no known span; both ascend
        while i < len(known) and known[i][1] <= a:
            i += 1
        j = i
        while j < len(known) and known[j][0] < b and known[j][1] <= a:
            j += 1
        if b - a >= 4 and not any(x < b and a < y for x, y, _ in known[j:j + 4]):
            taken.append((a, b, -1))
    for a, b, kind in [*known, *taken]:
        before = text[max(0, a - 70):a]
        marks = shape(text[a:b])
        named = _NAMED.search(before)
        if named:
            label = (named[1] or named[2]).lower()
            found.append((f"{label}\t{marks if kind < 0 else KINDS[kind]}", text[a:b], kind, a, b))
            found.append((f"{label}\t", text[a:b], kind, a, b))
            continue
        words = _WORDS.search(before)
        if words:
            found.append((f"{words[1]} {words[2]}\t".lower(), text[a:b], kind, a, b))
    return found


_SCAN = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, row string, "
         "found array<struct<pattern:string,instance:string,kind:int,start:int,end:int>>")
_FOUND = pa.list_(pa.struct([("pattern", pa.string()), ("instance", pa.string()), ("kind", pa.int32()),
                             ("start", pa.int32()), ("end", pa.int32())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), filled(batch.column("text")).to_pylist()):
            spans = base_spans(text)
            counts = [sum(k == kind for kind, _, _ in spans) for k in range(4)]
            near = [dict(zip(("pattern", "instance", "kind", "start", "end"), c))
                    for c in (candidates(text, spans) if spans or "@" in text or _DIGIT.search(text) else ())]
            # Rows with equal id and text share their result.
            row = hashlib.blake2b(text.encode(), digest_size=16).hexdigest() if near else None
            rows.append((doc_id, *counts, _listed(spans), row, near or None))
        columns = list(zip(*rows))
        kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), _FOUND]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "row", "found"])


def _noisy_or(score: Column) -> Column:
    return 1 - F.exp(F.sum(F.log(1 - F.least(score, F.lit(0.99)))))


def bootstrap(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, score) of the patterns that are good after some rounds.

    ``edges`` has (pattern, instance, kind), kind -1 for what the base patterns do not
    know. A pattern's score is the smoothed share of its instances' scores, its kind that
    of most of its known instances. Patterns and instances are reduced by key, so one that
    a third of all rows have is never held in one place.
    """
    edges, _ = stage(edges.groupBy("pattern", "instance").agg(F.max("kind").alias("kind")), "pii-edges")
    # A context with no known instance at all, or one, can only matter through instances
    # that several contexts share; it takes part in the rounds like the others.
    seeds = edges.groupBy("instance").agg(F.max("kind").alias("kind"))
    scores = seeds.select("instance", "kind", F.when(F.col("kind") >= 0, 1.0).otherwise(0.0).alias("s"))
    good = None
    for turn in range(rounds):
        linked = edges.select("pattern", "instance").join(scores, "instance")
        known = F.count_if(F.col("s") >= 0.5)
        counts = linked.groupBy("pattern").agg(
            (F.sum("s") / (F.count(F.lit(1)) + 1)).alias("score"), known.alias("known"),
            *[F.sum(F.when(F.col("kind") == k, F.col("s")).otherwise(0.0)).alias(f"k{k}") for k in range(4)])
        most = F.greatest(*[F.col(f"k{k}") for k in range(4)])
        kind = F.when(F.col("k0") == most, 0).when(F.col("k1") == most, 1).when(F.col("k2") == most, 2).otherwise(3)
        good = counts.filter((F.col("known") >= LEAST_KNOWN) & (F.col("score") >= LEAST_SCORE)).select(
            "pattern", kind.alias("kind"), "score")
        good, n = stage(good, "pii-patterns")
        if turn == rounds - 1 or not n:
            break
        lifted = edges.select("pattern", "instance").join(good, "pattern").groupBy("instance").agg(
            _noisy_or(F.col("score")).alias("up"), F.max_by("kind", "score").alias("of"))
        scores = scores.join(lifted, "instance", "left").select(
            "instance", F.when(F.col("kind") >= 0, F.col("kind")).otherwise(F.coalesce("of", F.lit(-1))).alias("kind"),
            F.greatest("s", F.coalesce("up", F.lit(0.0))).alias("s"))
        scores, _ = stage(scores, "pii-scores")
    return good


def personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Per row: doc_id, counts per base kind, base_sha256, spans, n_found.

    ``spans`` lists kind:start:end of base and found spans by kind, then start, in code
    points, end exclusive; ``n_found`` is how many of them contexts added. Null is the
    empty text, which has no spans. Repeated rows each have their result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanned, _ = stage(map_arrow(rows, _scan, _SCAN), "pii-scan")
    each = scanned.filter("found is not null").select("doc_id", "row", F.inline("found"))
    good = bootstrap(each.select("pattern", "instance", "kind"), rounds)
    new = (
        each.filter("kind = -1").drop("kind").join(good, "pattern")
        .groupBy("doc_id", "row", "start", "end").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
        .groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row"))
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("new"))
    )
    # What a document's list holds is bounded by its own text.
    joined = scanned.drop("found").join(
        new, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")), "left")
    names = F.array(*[F.lit(k) for k in KINDS])
    parsed = F.transform(F.filter(F.split("base", ","), lambda x: x != ""), lambda x: F.struct(
        (F.array_position(names, F.split(x, ":")[0]) - 1).cast("int").alias("kind"),
        F.split(x, ":")[1].cast("int").alias("start"), F.split(x, ":")[2].cast("int").alias("end")))
    every = F.array_sort(F.concat(parsed, F.coalesce("new", F.array().cast("array<struct<kind:int,start:int,end:int>>"))))
    text = F.array_join(F.transform(every, lambda x: F.concat_ws(
        ":", names[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))), ",")
    return joined.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"),
        F.when(F.col("new").isNull(), F.col("base")).otherwise(text).alias("spans"),
        F.coalesce(F.size("new"), F.lit(0)).cast("long").alias("n_found"))
