"""Operator 9, best-fit packing with conflicts.

Documents become pieces of at most ``capacity`` tokens (words plus one end of
document); a full piece fills a bin, the rest is packed best-fit, longest
first. Bins are ordered by residual. A bin carries two bitmaps, of its
sources and of its duplicate clusters; a piece may not join a bin that has its
source or a copy of it. The search starts at the smallest residual that holds
the piece and goes on to successors until a compatible bin is found, so it is
the tightest compatible one; if there is none a new bin is opened.

Scale: documents are dealt by hash into packing groups of about
``group_docs`` documents. A group is packed by one task, in memory bounded by that
number, so the number of groups grows with the input and the work stays linear;
bins never span groups. The deal does not look at source or cluster, so a hot
source is spread evenly, and so are equal rows, by their copy number. Only ids,
sizes and hashes are shuffled, never texts.

Clusters are those of near copies: the components of ``simhash_pivot``, unless
the caller names a column that has them.

Defined cases: NULL and empty texts are one end token; a NULL source is a
source of its own; texts longer than a bin are split, never cut off; repeated rows are packed one
by one, and as copies of each other never share a bin (nor do near copies in
general); NULL doc_ids are dealt by their text, and where no document with an id has
their fingerprint, they cluster by it alone; a NULL in the caller's cluster column
is the cluster of equal texts; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import copy_numbers, text_or_empty, word_count
from .simhash_pivot import near_duplicates

CAPACITY, GROUP_DOCS = 2048, 4096


class Bins:
    """Open bins of one packing group, ordered by residual."""

    def __init__(self, capacity: int):
        self.capacity, self.order, self.sources, self.clusters = capacity, [], [], []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset) for a piece; ``source`` and ``cluster`` are its bits (0: no conflict)."""
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            residual, b = self.order[at]
            if not (self.sources[b] & source or self.clusters[b] & cluster):
                del self.order[at]
                break
            at += 1
        else:
            residual, b = self.capacity, len(self.sources)
            self.sources.append(0)
            self.clusters.append(0)
        self.sources[b] |= source
        self.clusters[b] |= cluster
        if residual > size:
            insort(self.order, (residual - size, b))
        return b, self.capacity - residual


def pack_group(sizes: list[int], sources: list[int], clusters: list[int], capacity: int,
               one_per_source: bool = True) -> list[tuple[int, int, int, int]]:
    """(item, piece, bin, offset) of every piece, items longest rest first; sources and clusters are codes."""
    copies = np.bincount(clusters) if clusters else []
    bins, out = Bins(capacity), []
    rest = []
    for i, size in enumerate(sizes):
        whole, tail = divmod(size, capacity)
        for k in range(whole):  # fills a bin on its own
            b, at = bins.place(capacity, 0, 0)
            out.append((i, k, b, at))
        if tail or not whole:
            rest.append((-tail, i, whole))
    bit: dict[int, int] = {}  # clusters with one member cannot conflict
    for tail, i, k in sorted(rest):
        c = clusters[i]
        mark = 1 << bit.setdefault(c, len(bit)) if copies[c] > 1 else 0
        b, at = bins.place(-tail, 1 << sources[i] if one_per_source else 0, mark)
        out.append((i, k, b, at))
    return out


def pack(docs: DataFrame, capacity: int = CAPACITY, group_docs: int = GROUP_DOCS,
         one_per_source: bool = True, cluster: str | None = None) -> DataFrame:
    """One row per piece: doc_id, source, n_tokens of the document, piece, piece_tokens,
    pack_group, bin, bin_offset, cluster (the value of column ``cluster``, hashed)."""
    given = F.lit(None).cast("bigint") if cluster is None else F.xxhash64(F.col(f"`{cluster}`").cast("string"))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), "text",
        (word_count(F.col("text")) + 1).alias("n_tokens"), F.xxhash64(text_or_empty(F.col("text"))).alias("content"),
        (given if cluster is None else F.when(F.col(f"`{cluster}`").isNotNull(), given)).alias("cluster"))
    if cluster is None:
        found = near_duplicates(rows, carry=("source", "n_tokens", "content"))
        mark = F.when(F.col("component_id").isNotNull(), F.xxhash64(F.col("component_id").cast("string")))
        rows = found.withColumn("cluster", F.coalesce(mark, F.xxhash64(F.lit("fp"), "fp")))
    items = rows.select("doc_id", "source", "n_tokens", "content",
                        F.coalesce("cluster", F.xxhash64(F.lit("text"), "content")).alias("cluster"))
    # equal rows are dealt apart by their copy number, so the deal depends on the rows alone
    key = ["doc_id", "source", "n_tokens", "content"]
    items = copy_numbers(items, key)
    groups = max(1, -(-items.count() // group_docs))
    dealt = items.withColumn("pack_group", F.pmod(F.xxhash64(*key, "copy"), F.lit(groups)))

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("content", "ascending"),
                       ("source", "ascending"), ("copy", "ascending")])
        code = lambda c: t.column(c).combine_chunks().dictionary_encode(
            null_encoding="encode").indices.to_pylist()
        sizes = t.column("n_tokens").to_pylist()
        placed = pack_group(sizes, code("source"), code("cluster"), capacity, one_per_source)
        item, piece, b, at = (np.array(x, np.int64) for x in zip(*placed))
        whole = np.array(sizes, np.int64)[item]
        out = {c: t.column(c).take(pa.array(item)) for c in ("doc_id", "source", "n_tokens")}
        return pa.table(out | {"piece": piece, "piece_tokens": np.minimum(whole - piece * capacity, capacity),
                               "pack_group": t.column("pack_group").take(pa.array(item)), "bin": b, "bin_offset": at,
                               "cluster": t.column("cluster").take(pa.array(item))})

    return dealt.groupBy("pack_group").applyInArrow(run, (
        "doc_id bigint, source string, n_tokens bigint, piece bigint, piece_tokens bigint, pack_group bigint, "
        "bin bigint, bin_offset bigint, cluster bigint"))
