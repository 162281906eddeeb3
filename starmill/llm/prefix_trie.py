"""Prefix trie of conversations, by collapse of whole sequences.

Identical conversations become one weighted sequence, whose list of ends says which they are.
Sequences that are a proper prefix of another one are dropped by an anti-join; those left are
the leaves. The nodes of the trie are then the prefixes of the weighted sequences, summed up.

The name of a prefix is the exclusive or of 128 bits for each turn, hashed from its place, role
and text, so names are running sums, which need no turns beside each other: turns are numbered
and summed up within blocks of a bounded number of places, and the blocks' own sums, one row
each, give what came before. Texts themselves never move, and no conversation, sequence, node
or list of ends is collected into one row or task, however many rows it holds.

Sums over the nodes below a node are sums over the sequences through it. Every node belongs to
the smallest sequence through it, so the nodes of a sequence are the end of its path, and all
nodes below a node are the nodes of the sequences through it, but for those of its own sequence
that lie above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.batches import map_arrow
from starmill.sources.stage import stage, write_once

# A conversation starts with turns of the first one of its group of so many numbers; its own
# number says how many of them, fewer than so many.
GROUP = 100
SHARED = 6
# Places of a conversation, and numbers of turns, that are summed up together.
BLOCK = 1024
# Range of conversation numbers whose ends are one piece of a list.
PIECE = 10_000

_NAME = ["depth", "x", "y"]


def _number(of: Column) -> Column:
    """Places of turns by number, below all others where there is none."""
    return F.coalesce(F.floor(of / BLOCK).cast("long"), F.lit(-(1 << 62)))


def _before(total: Column, key: str, order: str) -> Column:
    earlier = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(total.over(earlier), F.lit(0))


def numbered(conversations: DataFrame) -> DataFrame:
    """Per turn: conv_id, at (from 1), item (digest of role and text), chars.

    Turns are in the order of ``turn``, null first; turns of one number are in the order of
    their MD5 digests. A null role or text counts as the empty one; repeated rows are turns of
    their own. Rows without a conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("item"),
        F.char_length(text).cast("long").alias("chars"))
    within = Window.partitionBy("conv_id", "block").orderBy(F.col("turn").asc_nulls_first(), "item")
    placed = write_once(
        turns.withColumn("block", _number(F.col("turn"))).withColumn("at", F.row_number().over(within)).drop("turn"),
        "turns")
    blocks = placed.groupBy("conv_id", "block").count().select(
        "conv_id", "block", _before(F.sum("count"), "conv_id", "block").alias("earlier"))
    return placed.join(blocks, ["conv_id", "block"]).select(
        "conv_id", (F.col("at") + F.col("earlier")).alias("at"), "item", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as ``numbered`` gives them, with shared beginnings put in; and all conversations.

    Conversation c takes the first h turns of c - c % GROUP (all if it has fewer, none if it is
    not there), then its own turns after its first h, where h is crc32 of c, in decimal, modulo
    SHARED. A conversation may be left without turns.
    """
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", (F.crc32(F.col("conv_id").cast("string")) % SHARED).cast("int").alias("h"))
    heads = turns.where(f"at < {SHARED} AND conv_id % {GROUP} = 0").groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "item", "chars"))).alias("head"))  # SHARED - 1 at most
    convs = convs.withColumn("first", F.expr(f"conv_id - conv_id % {GROUP}")).join(
        heads.withColumnRenamed("conv_id", "first"), "first", "left").select(
        "conv_id", "h", F.expr("slice(coalesce(head, array()), 1, h)").alias("head"))
    own = turns.join(convs.select("conv_id", "h", F.size("head").alias("k")), "conv_id").where("at > h").select(
        "conv_id", F.expr("at - h + k").alias("depth"), "item", "chars")
    shared = convs.select("conv_id", F.explode("head").alias("t")).select(
        "conv_id", F.col("t.at").alias("depth"), "t.item", "t.chars")
    return own.unionByName(shared), convs.select("conv_id")


def prefixes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per turn of ``rebuilt``: the prefix that it ends, and per conversation: all of it.

    A prefix is named by depth, x and y; (px, py) name the one without its last turn, ``chars``
    are the code points of that turn, ``before`` those of the turns above it.
    """
    within = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    own = turns.select(
        "conv_id", "depth", F.floor((F.col("depth") - 1) / BLOCK).alias("block"), "chars",
        F.xxhash64("depth", "item").alias("hx"), F.xxhash64(F.reverse("item"), F.col("depth")).alias("hy"))
    local = write_once(own.select(
        "*", F.bit_xor("hx").over(within).alias("lx"), F.bit_xor("hy").over(within).alias("ly"),
        F.sum("chars").over(within).alias("so_far")), "prefixes")
    blocks = write_once(local.groupBy("conv_id", "block").agg(
        F.max("depth").alias("depth"), F.bit_xor("hx").alias("x"), F.bit_xor("hy").alias("y"),
        F.sum("chars").alias("total")), "blocks")
    offsets = blocks.select("conv_id", "block", *[
        _before(f, "conv_id", "block").alias(name)
        for f, name in ((F.bit_xor("x"), "ox"), (F.bit_xor("y"), "oy"), (F.sum("total"), "above"))])
    named = local.join(offsets, ["conv_id", "block"]).selectExpr(
        "conv_id", "depth", "lx ^ ox AS x", "ly ^ oy AS y", "lx ^ ox ^ hx AS px", "ly ^ oy ^ hy AS py", "chars",
        "above + so_far - chars AS before")
    whole = blocks.groupBy("conv_id").agg(
        F.max("depth").alias("depth"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("total").alias("length"))
    return named, whole


def collapsed(whole: DataFrame, convs: DataFrame) -> DataFrame:
    """The sequence of every conversation; those left without turns have the empty one."""
    return convs.join(whole, "conv_id", "left").select("conv_id", *[
        F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in (*_NAME, "length")])


def end_lists(ends: DataFrame) -> DataFrame:
    """Conversations of each sequence, in pieces: name, piece (ascending), ids (ascending, joined by commas)."""
    return ends.groupBy(*_NAME, F.floor(F.col("conv_id") / PIECE).alias("piece")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each run of pieces of one name."""
    name, digest, done = None, None, []

    def out() -> pa.RecordBatch:
        rows = pa.table({c: pa.array([d[i] for d in done], pa.int64()) for i, c in enumerate(_NAME)} | {
            "ends_sha256": pa.array([d[3] for d in done], pa.string())})
        done.clear()
        return rows.combine_chunks().to_batches()[0]

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*_NAME, "ids")]
        for *of, ids in zip(*columns):
            if of == name:
                digest.update(b",")
            else:
                if name is not None:
                    done.append((*name, digest.hexdigest()))
                name, digest = of, hashlib.sha256()
            digest.update(ids.encode())
        if len(done) >= 4096:
            yield out()
    if name is not None:
        done.append((*name, digest.hexdigest()))
    if done:
        yield out()


def ends_digests(pieces: DataFrame) -> DataFrame:
    """SHA-256 of the whole list of each name, read piece by piece."""
    ordered = pieces.repartition(*_NAME).sortWithinPartitions(*_NAME, "piece")
    return map_arrow(ordered.select(*_NAME, "ids"), _digests, "depth long, x long, y long, ends_sha256 string")


def trie(named: DataFrame, ends: DataFrame) -> DataFrame:
    """Nodes of the trie: name, name of the parent, conv_id and the counts of ``trie_digest``.

    ``named`` are prefixes, ``ends`` the sequence of every conversation.
    """
    sequences, _ = stage(ends.groupBy(*_NAME).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"), F.max("length").alias("length")), "sequences")
    # Every sequence once, with the root as its first prefix.
    last = sequences.select("conv_id", F.col("depth").alias("last"))
    zero = F.lit(0).cast("long")
    path = named.join(last, "conv_id").unionByName(last.select(
        "conv_id", "last", *[zero.alias(c) for c in (*_NAME, "px", "py", "chars", "before")]))
    path, _ = stage(path, "paths")

    inner = path.where("depth < last").select(*_NAME).distinct()
    leaves = sequences.join(inner, _NAME, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    own = path.groupBy(*_NAME).agg(F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars")).groupBy(
        "conv_id").agg(F.sum("chars").alias("own"))
    weighted = sequences.select("conv_id", "weight", "length").join(own, "conv_id", "left").join(leaves, "conv_id", "left")
    weighted, _ = stage(weighted.na.fill(0, ["own", "leaf"]), "weighted")

    summed = path.drop("last").join(weighted, "conv_id").groupBy(*_NAME).agg(
        F.min(F.struct("conv_id", "own", "length")).alias("first"),
        *[F.max(c).alias(c) for c in ("px", "py", "chars", "before")],
        F.sum("weight").alias("n_convs"), F.sum("leaf").alias("n_leaves"),
        F.sum(F.col("weight") * F.col("length")).alias("lengths"), F.sum("own").alias("owned"))
    # Code points of all conversations below, less those of every node once.
    return summed.select(
        *_NAME, "px", "py", F.col("first.conv_id").alias("conv_id"), "chars", "n_convs", "n_leaves",
        F.expr("lengths - n_convs * before - (owned - first.own + first.length - before)").alias("saved_tokens"))


def trie_digest(conversations: DataFrame) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, over the rebuilt conversations.

    Turns are ordered and nulls are read as ``numbered`` says; equal conversations, whether
    repeated or rebuilt, are members of one node. A conversation without turns left is a member
    of the root and ends there. Without conversations there is no node, not even the root. Texts
    of any length are hashed where they are. Other columns are not read.
    """
    turns = write_once(numbered(conversations.select("conv_id", "turn", "role", "text")), "numbered")
    turns, convs = rebuilt(turns)
    named, whole = prefixes(turns)
    ends, _ = stage(collapsed(whole, convs), "ends")
    nodes, _ = stage(trie(named, ends), "nodes")
    up = [(F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y")]
    children = nodes.where("depth > 0").groupBy(*up).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("depth").alias("_depth"), F.col("x").alias("_x"), F.col("y").alias("_y"),
                           F.col("conv_id").alias("parent_conv_id"))
    above = (F.col("depth") - 1 == F.col("_depth")) & (F.col("px") == F.col("_x")) & (F.col("py") == F.col("_y"))
    full = nodes.join(children, _NAME, "left").join(ends_digests(end_lists(ends)), _NAME, "left").join(parents, above, "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return full.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))
