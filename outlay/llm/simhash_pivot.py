"""Operator 8, SimHash near-dedup with pivot distance tables.

A fingerprint is the bitwise majority of the XXH64 values of a text's word
shingles. Distinct fingerprints are the units; copies only add a member. Two
fingerprints within ``max_bits`` agree on all but ``max_bits`` of any ``b``
bands, so each is filed under every choice of ``b - max_bits`` bands, and
only rows of one bucket are compared (an exact filter, not all pairs). Inside
a bucket a table holds the Hamming distances of every row to ``PIVOTS`` reference
fingerprints. By the triangle inequality a pair whose distances to any
reference differ by more than ``max_bits`` cannot link: rows sorted by the
first distance are compared only within that difference, the further
coordinates discard more, and the survivors are verified bit by bit. A bucket
answers with a spanning set of its links, never with all pairs.

Defined cases: lower-casing touches A-Z only; fewer words than a shingle give
the whole sequence as one shingle; no words (NULL or empty text) give
fingerprint 0, which links like any other; rows with a NULL doc_id get the
component of their fingerprint's other documents, or NULL; a doc_id repeated
with different texts joins the components of these texts; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import pair_blocks, stage, tasks_for, text_slices
from .components import components, local_components

SHINGLE, MAX_BITS, SEED = 4, 4, 42
PIVOTS = 16
SLICE_BYTES = 4 << 20


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> list[int]:
    words = (text or "").encode().lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    at = list(accumulate((len(w) + 1 for w in words), initial=0))
    return [xxhash.xxh64_intdigest(joined[a:b - 1], SEED) for a, b in zip(at, at[shingle:])]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each text from the concatenated hashes of all; ``counts`` per text."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.cumsum(counts[full]) - counts[full]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * ones > counts[full][:, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) of every row and its columns ``carry``; ``fp`` holds the 64 bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SLICE_BYTES):
            hashed = [shingle_hashes(t, shingle) for t in part.column("text").to_pylist()]
            flat = np.fromiter((h for hs in hashed for h in hs), np.uint64)
            fp = majority(flat, np.array([len(h) for h in hashed], np.int64))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp.view(np.int64)),
                                              *[part.column(c) for c in carry]], ["doc_id", "fp", *carry])

    rows = docs.select(F.col("doc_id").cast("bigint"), "text", *carry)
    types = "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in carry)
    return rows.mapInArrow(run, "doc_id bigint, fp bigint" + types)


def band_masks(max_bits: int, distinct: int, target: int = 64) -> list[int]:
    """Masks of which any two fingerprints within ``max_bits`` agree on one at least.

    The number of bands grows until a bucket of evenly spread fingerprints
    has at most ``target`` rows; the links found are the same for each choice.
    """
    for b in range(max_bits + 1, max_bits + 6):
        edges = [64 * i // b for i in range(b + 1)]
        bands = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
        masks = [sum(c) for c in combinations(bands, b - max_bits)]
        if distinct / 2 ** min(m.bit_count() for m in masks) <= target:
            break
    return masks


def references(count: int = PIVOTS) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"reference {i}", SEED) for i in range(count)], np.uint64)


def linked(fp: np.ndarray, bucket: np.ndarray, part: np.ndarray, cross: np.ndarray, max_bits: int,
           pivots: np.ndarray) -> np.ndarray:
    """Root row of each row, over the links between rows of one bucket.

    ``cross`` marks blocks in which only rows of different ``part`` are compared.
    """
    table = np.bitwise_count(fp[:, None] ^ pivots[None, :]).astype(np.int8)
    order = np.lexsort((table[:, 0], bucket))
    fp, bucket, part, cross, table = fp[order], bucket[order], part[order], cross[order], table[order]
    n = len(fp)
    us, vs, held = [], [], 0
    rows, shift = np.arange(n), 1
    while len(rows):
        rows = rows[rows + shift < n]
        other = rows + shift
        near = (bucket[rows] == bucket[other]) & (table[other, 0] - table[rows, 0] <= max_bits)
        rows = rows[near]
        u, v = rows, rows + shift
        for p in range(len(pivots) + 1):
            if p == 0:
                ok = ~cross[u] | (part[u] != part[v])
            elif p < len(pivots):
                ok = np.abs(table[u, p] - table[v, p]) <= max_bits
            else:
                ok = np.bitwise_count(fp[u] ^ fp[v]) <= max_bits
            u, v = u[ok], v[ok]
        us.append(u)
        vs.append(v)
        held += len(u)
        if held > 2_000_000:  # fold the links into their roots
            root = local_components(n, np.concatenate(us), np.concatenate(vs))
            us, vs, held = [np.arange(n)], [root], 0
        shift += 1
    root = local_components(n, np.concatenate(us), np.concatenate(vs)) if us else np.arange(n)
    out = np.empty(n, np.int64)
    out[order] = order[root]
    return out


def links(classes: DataFrame, max_bits: int = MAX_BITS, cap: int = 2048, per_task: int = 60_000) -> DataFrame:
    """Edges (u, v) that connect the linked rows of ``classes`` (fp, node)."""
    spark = classes.sparkSession
    distinct = classes.count()
    masks = band_masks(max_bits, distinct)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    filed = classes.select("fp", "node", F.explode(F.array(*[
        F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m).cast("bigint")).alias("value"))
        for i, m in enumerate(signed)])).alias("k")).select("fp", "node", "k.*")
    blocks = pair_blocks(filed, ["mask", "value"], "fp", cap)
    groups = tasks_for(spark, distinct * len(masks), per_task)
    pivots = references()

    def run(t: pa.Table) -> pa.Table:
        col = {c: t.column(c).to_numpy() for c in ("fp", "node", "mask", "value", "part", "bi", "bj")}
        order = np.lexsort((col["bj"], col["bi"], col["value"], col["mask"]))
        col = {k: v[order] for k, v in col.items()}
        new = np.zeros(len(order), bool)
        for c in ("mask", "value", "bi", "bj"):
            new[1:] |= col[c][1:] != col[c][:-1]
        root = linked(col["fp"].view(np.uint64), np.cumsum(new), col["part"], col["bi"] != col["bj"], max_bits, pivots)
        hit = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"u": col["node"][hit], "v": col["node"][root[hit]]})

    return (blocks.withColumn("task", F.pmod(F.xxhash64("mask", "value", "bi", "bj"), F.lit(groups)))
            .groupBy("task").applyInArrow(run, "u bigint, v bigint"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (signed long), component_id and columns ``carry`` for every row of ``docs``."""
    fps = stage(fingerprints(docs, shingle, carry), "fingerprints")
    classes = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("node")), "classes")
    edges = links(classes.filter("node IS NOT NULL"), max_bits)
    several = (fps.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b"))
               .filter("a <> b").select("doc_id"))
    same_id = (fps.join(several, "doc_id", "left_semi").join(classes, "fp")
               .select(F.col("doc_id").alias("u"), F.col("node").alias("v")))
    found = components(edges.unionByName(same_id))
    placed = classes.join(found, "node", "left").select(
        "fp", F.coalesce("component", "node").alias("component_id"))
    return fps.join(placed, "fp").select("doc_id", "fp", "component_id", *carry)


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each set of rows whose fingerprints link: that with the smallest doc_id,
    and of several with this doc_id the one with the smallest text (NULL first).

    Only links count here: unlike texts under one doc_id are documents of their
    own, and a row goes only if its own fingerprint reaches a smaller document or
    an equal or linked row. Rows without doc_id stay and link with nothing.
    """
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("content"))
    named = named.filter("doc_id IS NOT NULL")
    fps = stage(fingerprints(named, shingle, ("content",)), "fingerprints")
    classes = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    found = components(links(classes.select("fp", F.col("fp").alias("node")), max_bits))
    placed = classes.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    firsts = placed.groupBy("component").agg(F.min("first").alias("first"))
    judged = stage(fps.join(placed.drop("first").join(firsts, "component"), "fp").drop("fp"), "judged")

    stay = judged.filter("doc_id = first")
    tied = (stay.groupBy("doc_id", "component").agg(F.min("content").alias("a"), F.max("content").alias("b"))
            .filter("a <> b").select("doc_id", "component"))
    close = stay.join(tied, ["doc_id", "component"], "left_semi").select("doc_id", "component", "content").distinct()
    best = (named.join(close, ["doc_id", "content"]).groupBy("doc_id", "component")
            .agg(F.min_by("content", F.struct("text")).alias("best")))
    behind = close.join(best, ["doc_id", "component"]).filter("content <> best")
    gone = (judged.filter("doc_id <> first").select("doc_id", "content")
            .unionByName(behind.select("doc_id", "content")).distinct())

    whole = docs.select(F.col("doc_id").cast("bigint").alias("__id"), F.xxhash64("text").alias("__content"),
                        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("__row"))
    left = whole.filter("__id IS NOT NULL").join(
        gone, (F.col("__id") == F.col("doc_id")) & (F.col("__content") == F.col("content")), "left_anti")
    nth = F.row_number().over(Window.partitionBy("__id", "__content").orderBy("__row.text"))
    one = left.withColumn("__nth", nth).filter("__nth = 1").select("__row")
    return one.unionByName(whole.filter("__id IS NULL").select("__row")).select("__row.*")
