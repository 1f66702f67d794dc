"""Operator 13, trie of conversation prefixes in minimal-perfect-hash node tables.

Each turn becomes two longs of the SHA-256 of its role and text. A prefix's
digest is the exclusive or of hashes that bind each of its turns to its place, so it
is a running fold that can be taken band by band (``BAND`` turns) without reading
a long conversation in one task. Nodes are the distinct digests; every node is
verified to have one depth, parent and last turn, and digests are drawn anew with
another salt should two prefixes ever share one.

Subtree figures are summed in shards. A shard holds the prefixes of some
conversations within one band: conversations go by their first turn, and by a hash
of their id as well where many share it. In a shard the distinct digests get slots
of a minimal perfect hash (each level of it places the keys that meet no other; a
slot's stored key is compared on every look-up). Counts are scattered into flat
arrays by slot and accumulated through the array of parent slots, deepest first. A
node's own figure is counted once, in the shard of its smallest conversation, all of
whose prefixes are there; so sums over shards are exact. What a conversation owns
below a band is added at the band's last turn.

Defined cases: turns are ordered by number, NULL first, equal numbers by a digest of
role and text; NULL role or text is empty; rows without a conv_id belong to no
conversation and enter no node; repeated rows are turns of their own; texts are hashed
whole; further columns are not read; an empty table gives no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, stage

#: Turns of a conversation that one shard may hold.
BAND = 4096
#: Prefixes of conversations that a shard is to hold.
SHARD_ROWS = 200_000
#: Conversations of one block of a node's list of ends, as a power of two.
END_BITS = 13
KEY = ["k1", "k2"]
PART = "k1 bigint, k2 bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"


# ------------------------------------------------------------------- turns


def turns(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, n, x1, x2, size) of ``rows(conv_id, turn, role, text)``: place from 1 on, turns of the conversation,
    digest of role and text, UTF-8 bytes of the text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    sha = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    narrow = rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), sha.alias("sha"),
        F.octet_length(text).cast("bigint").alias("size"))
    long = lambda at: F.conv(F.substring("sha", at, 15), 16, 10).cast("bigint")
    narrow = stage(narrow.select("conv_id", "turn", long(1).alias("x1"), long(16).alias("x2"), "size"), "turns")
    order = [F.col("turn").asc_nulls_first(), F.col("x1"), F.col("x2"), F.col("size")]
    return numbered(narrow, ["conv_id"], order).withColumn("pos", F.col("pos") + 1).drop("turn")


def whole(rows: DataFrame) -> DataFrame:
    """Conversations as they are: (conv_id, d, length, x1, x2, size), ``d`` = 0 being the start that every one has."""
    return _with_starts(rows.select("conv_id", F.col("pos").alias("d"), F.col("n").alias("length"), "x1", "x2", "size"),
                        rows.filter("pos = 1").select("conv_id", F.col("n").alias("length")))


def grafted(rows: DataFrame, group: int, heads: int) -> DataFrame:
    """Conversations rebuilt on a shared start, as ``whole`` gives them.

    Conversation c takes the first h turns of conversation c - c % group, with h
    the unsigned CRC-32 of c in decimal modulo ``heads``, then its own turns after its first h.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    convs = rows.filter("pos = 1").select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group)
                                          .alias("base"))
    first = rows.filter((F.col("pos") < heads) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "base")
    have = first.filter("pos = 1").select("base", F.col("n").alias("base_n"))
    convs = convs.join(have, "base", "left").withColumn("b", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = stage(convs.select("conv_id", "base", "h", "b", (F.col("b") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
                               .alias("length")), "rebuilt")
    head = first.drop("n").join(convs, "base").filter("pos <= h").select(
        "conv_id", F.col("pos").alias("d"), "length", "x1", "x2", "size")
    tail = rows.filter(F.col("pos") > h).join(convs, "conv_id").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("b")).alias("d"), "length", "x1", "x2", "size")
    return _with_starts(head.unionByName(tail), convs)


def _with_starts(rows: DataFrame, convs: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return rows.unionByName(convs.select("conv_id", zero.alias("d"), "length", zero.alias("x1"), zero.alias("x2"),
                                         zero.alias("size")))


# ------------------------------------------------------------------ digests


def prefixes(rows: DataFrame, salt: int = 0) -> DataFrame:
    """``rows`` with the digest (k1, k2) of each prefix, its parent's (p1, p2), and the first turn's (f1, f2).

    The start has digest (0, 0).
    """
    tag = lambda lane: F.when(F.col("d") > 0, F.xxhash64(F.lit(2 * salt + lane), "d", "x1", "x2")).otherwise(0)
    rows = rows.withColumn("band", F.expr(f"d div {BAND}")).withColumns({"t1": tag(0), "t2": tag(1)})
    fold = {c: F.bit_xor(c) for c in ("t1", "t2")}
    inside = Window.partitionBy("conv_id", "band").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    start = (rows.filter(F.col("length") >= BAND).groupBy("conv_id", "band").agg(*[f.alias(c) for c, f in fold.items()])
             .select("conv_id", "band", *[F.bit_xor(c).over(before).alias(f"b{i}") for i, c in ((1, "t1"), (2, "t2"))]))
    first = rows.filter("d = 1").select("conv_id", F.col("t1").alias("f1"), F.col("t2").alias("f2"))
    out = rows.withColumns({f"r{i}": fold[f"t{i}"].over(inside) for i in (1, 2)})
    out = out.join(start, ["conv_id", "band"], "left").join(first, "conv_id", "left")
    out = out.withColumns({f"k{i}": F.col(f"r{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0))) for i in (1, 2)})
    return out.withColumns({f"p{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"t{i}")) for i in (1, 2)}).select(
        "conv_id", "d", "length", "band", *KEY, "p1", "p2", "f1", "f2", "x1", "x2", "size")


def distinct_prefixes(paths: DataFrame) -> DataFrame:
    """A node per digest: depth, parent, members, smallest member, whether no member goes on, its share of saved bytes."""
    same = ["d", "p1", "p2", "x1", "x2", "size"]
    nodes = paths.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("length").alias("longest"),
        *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"{c}_max") for c in same],
        F.max("f1").alias("f1"), F.max("f2").alias("f2"))
    one = F.lit(True)
    for c in same:
        one = one & (F.col(c) == F.col(f"{c}_max"))
    return nodes.select(*KEY, "d", "p1", "p2", "f1", "f2", "n_convs", "conv_id",
                        (F.col("longest") == F.col("d")).cast("bigint").alias("leaf"),
                        ((F.col("n_convs") - 1) * F.col("size")).alias("saved"), one.alias("one"))


# ------------------------------------------------------- minimal perfect hash


class SlotTable:
    """Minimal perfect hash of distinct 128-bit keys, with the keys by slot for verification.

    Level by level, keys that are alone at their place in a table as large as
    the keys that are left get a slot, the number of taken places before theirs; the others go on.
    """

    def __init__(self, k1: np.ndarray, k2: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        n = len(k1)
        self.k1, self.k2 = np.zeros(n, np.int64), np.zeros(n, np.int64)
        left, given = np.arange(n), 0
        while len(left):
            at = self._place(k1[left], k2[left], len(self.levels), len(left))
            taken = np.bincount(at, minlength=len(left)) == 1
            slot = given + np.cumsum(taken) - 1
            self.levels.append((taken, slot))
            alone = taken[at]
            self.k1[slot[at[alone]]], self.k2[slot[at[alone]]] = k1[left[alone]], k2[left[alone]]
            left, given = left[~alone], given + int(taken.sum())

    @staticmethod
    def _place(k1: np.ndarray, k2: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            x = k1.view(np.uint64) ^ (k2.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(
                (level + 1) * 0xBF58476D1CE4E5B9 & (2 ** 64 - 1))
            for shift in (30, 27, 31):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(0x94D049BB133111EB)
        return ((x >> np.uint64(11)) % np.uint64(size)).astype(np.int64)

    def slots(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that the table does not hold."""
        out, left = np.full(len(k1), -1, np.int64), np.arange(len(k1))
        for level, (taken, slot) in enumerate(self.levels):
            at = self._place(k1[left], k2[left], level, len(taken))
            out[left[taken[at]]] = slot[at[taken[at]]]
            left = left[~taken[at]]
        known = np.flatnonzero(out >= 0)
        wrong = known[(self.k1[out[known]] != k1[known]) | (self.k2[out[known]] != k2[known])]
        out[wrong] = -1
        return out


def shard_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A shard's distinct prefixes -> each one's children and subtree figures inside the shard."""
    col = pa.Table.from_batches(list(batches))
    get = lambda c: col.column(c).to_numpy()
    k1, k2, p1, p2, depth = (get(c) for c in ("k1", "k2", "p1", "p2", "d"))
    table = SlotTable(k1, k2)
    slot = table.slots(k1, k2)
    n = len(slot)
    if (slot < 0).any() or len(np.unique(slot)) != n:
        raise ValueError("digests of a shard are not distinct")
    own, leaves, saved, up, at_depth = (np.zeros(n, np.int64) for _ in range(5))
    for flat, values in ((own, get("own")), (leaves, get("leaf")), (saved, get("saved")), (at_depth, depth),
                         (up, table.slots(p1, p2))):
        flat[slot] = values
    children = np.zeros(n, np.int64)
    inside = up >= 0
    np.add.at(children, up[inside], own[inside])
    order = np.argsort(-at_depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(at_depth[order])) + 1):
        level = level[inside[level]]
        np.add.at(leaves, up[level], leaves[level])
        np.add.at(saved, up[level], saved[level])
    out = [table.k1, table.k2, children, leaves, saved]
    gone = ~inside[slot] & (get("own") > 0)  # parents in the band above, or the start
    zero = np.zeros(int(gone.sum()), np.int64)
    more = [p1[gone], p2[gone], get("own")[gone], zero, zero]
    names = ["k1", "k2", "n_children", "n_leaves", "saved_tokens"]
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(out, more)], names)


# --------------------------------------------------------------------- trie


def _sharded(paths: DataFrame, rows: int) -> tuple[Column, DataFrame]:
    """Shard of a conversation by its first turn; conversations of a frequent first turn are split by their ids."""
    frequent = (paths.filter("d > 0").groupBy("f1", "f2").agg(F.count("*").alias("__n"))
                .filter(F.col("__n") > SHARD_ROWS)
                .select("f1", "f2", F.ceil(F.col("__n") / SHARD_ROWS).cast("int").alias("splits")))
    shards = max(1, -(-rows // SHARD_ROWS))
    part = F.pmod(F.xxhash64("conv_id"), F.coalesce("splits", F.lit(1)))
    return F.pmod(F.xxhash64("f1", "f2", part), F.lit(shards)).cast("int"), stage(frequent, "frequent-starts")


def subtrees(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """(k1, k2, n_children, n_leaves, saved_tokens) of every node."""
    shard, frequent = _sharded(paths, paths.count())
    none = F.lit(0).cast("bigint")
    cols = ["shard", "band", *KEY, "p1", "p2", "d", "own", "leaf", "saved"]
    rows = paths.filter("d > 0").join(frequent, ["f1", "f2"], "left").withColumn("shard", shard)
    there = rows.select(*cols[:7], none.alias("own"), none.alias("leaf"), none.alias("saved"))
    owned = (nodes.filter("d > 0").withColumn("band", F.expr(f"d div {BAND}")).join(frequent, ["f1", "f2"], "left")
             .withColumn("shard", shard).withColumn("own", F.lit(1).cast("bigint")))
    # what a conversation owns in deeper bands, at the last turn of each band before them
    totals = owned.filter("band > 0").groupBy("conv_id", "band").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    bands = paths.filter(F.col("length") >= BAND).select("conv_id", "band").distinct().join(totals, ["conv_id", "band"], "left")
    below = Window.partitionBy("conv_id").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    deeper = bands.select("conv_id", "band", F.sum("leaf").over(below).alias("leaf"),
                          F.sum("saved").over(below).alias("saved")).filter("leaf IS NOT NULL")
    ends = rows.filter(((F.col("d") + 1) % BAND == 0) & (F.col("length") > F.col("d"))).join(deeper, ["conv_id", "band"]).select(
        *cols[:7], none.alias("own"), "leaf", "saved")
    pieces = there.unionByName(owned.select(*cols)).unionByName(ends).groupBy("shard", "band", *KEY).agg(
        *[F.min(c).alias(c) for c in ("p1", "p2", "d")], *[F.sum(c).alias(c) for c in ("own", "leaf", "saved")])
    sums = pieces.groupBy("shard", "band").applyInArrow(shard_sums, PART)
    start = nodes.agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.count("*").alias("__n")).filter(
        "__n > 0").select(none.alias("k1"), none.alias("k2"), none.alias("n_children"), "n_leaves", "saved_tokens")
    return sums.unionByName(start).groupBy(*KEY).agg(
        *[F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])


def digest_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted blocks of ids -> one SHA-256 per key over the ids of all its blocks, joined by commas."""
    key, sha = None, hashlib.sha256()

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()),
                                           pa.array([sha.hexdigest()])], ["k1", "k2", "ends_sha256"])

    for batch in batches:
        keys = zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist())
        for k, ids in zip(keys, batch.column("ids").to_pylist()):
            if k != key:
                if key is not None:
                    yield row()
                key, sha = k, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
    if key is not None:
        yield row()


def end_digests(paths: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) of the nodes at which conversations end.

    Ids are gathered in blocks of neighbouring ids; a node with one block is hashed in
    place, longer lists are streamed block by block in order.
    """
    ends = paths.filter("d = length").groupBy(*KEY, F.shiftright("conv_id", END_BITS).alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    ends = stage(ends, "ends")
    several = ends.groupBy(*KEY).agg(F.count("*").alias("blocks"))
    counted = ends.join(several, KEY)
    short = counted.filter("blocks = 1").select(*KEY, F.sha2("ids", 256).alias("ends_sha256"))
    long = (counted.filter("blocks > 1").select(*KEY, "block", "ids").repartition(*KEY)
            .sortWithinPartitions(*KEY, "block").drop("block"))
    return short.unionByName(long.mapInArrow(digest_lists, "k1 bigint, k2 bigint, ends_sha256 string"))


def trie(rows: DataFrame) -> DataFrame:
    """The node table of conversations ``rows(conv_id, d, length, x1, x2, size)``, see ``whole`` and ``grafted``.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256):
    ``conv_id`` is the smallest member, members start with the node's turns.
    """
    rows = stage(rows, "rebuilt-turns")
    salt = 0
    while True:
        paths = stage(prefixes(rows, salt), "prefixes")
        nodes = stage(distinct_prefixes(paths), "nodes")
        if nodes.filter("NOT one").isEmpty():
            break
        salt += 1
    sums, ends = subtrees(paths, nodes), end_digests(paths)
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("of_parent"))
    above = nodes.filter("d > 0").join(parents, ["p1", "p2"]).select(*KEY, "of_parent")
    out = nodes.join(sums, KEY).join(ends, KEY, "left").join(above, KEY, "left")
    return out.select("conv_id", F.col("d").alias("depth"), F.col("of_parent").alias("parent_conv_id"),
                      "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
