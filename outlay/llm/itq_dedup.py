"""Operator 4, embedding near-dedup: iterative quantisation, multi-index Hamming tables, rerank.

ITQ: on a bounded, documented sample (``FIT_ROWS`` rows by hash of the id) a
rotation is learned that makes the signs of the rotated vectors the best
binary code for them, after the sample's mean is taken off, so that bits are balanced. Several rotations, from
different random starts, give as many bits as the tables need. Every row is coded.

Retrieval: the code is cut into one key per table; rows of one label that
agree on a whole key are candidates. Key length grows with the logarithm of the
largest label, and the number of tables follows from it and from how far the sample's
vectors lie from their mean, so that a pair at the threshold agrees on a key with the
probability ``RECALL`` even if its bits flip as often as for random hyperplanes through
the mean (ITQ flips fewer). Nothing is dropped:
buckets of any size are split into blocks in which each pair meets once.

Rerank: a candidate pair is linked if the cosine of the original vectors, in
double precision, is at least the threshold. A pair is counted in the first
table on whose key it agrees. Blocks return link counts and a spanning set of
their links, never the pairs. Equal vectors of a label are one class with a
weight, so copies cost nothing.

Defined cases: NULL labels, NULL, empty or zero vectors, and vectors with NULL,
NaN or infinite components link with nothing (0 links, component = own id);
vectors of different lengths never link; repeated vec_ids count as separate
vectors and share a component; a NULL vec_id is kept with a NULL component and
counts as a neighbour; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pair_blocks, stage, tasks_for
from .components import components, local_components

THRESHOLD, RECALL = 0.98, 0.999
FIT_ROWS, ITERATIONS, BUCKET_ROWS = 20_000, 30, 64
#: Tables from which shorter keys are taken instead.
MOST_TABLES = 64


def table_plan(largest_label: int, threshold: float = THRESHOLD, recall: float = RECALL,
               bucket_rows: int = BUCKET_ROWS, radii: np.ndarray | None = None) -> tuple[int, int]:
    """(bits per key, number of tables).

    ``radii`` are distances of unit vectors from their centre, 1 by default. Two
    vectors at the threshold are 2 sin(angle / 2) apart; seen from a centre nearer to
    them the angle between them is wider and more bits flip, so more tables, then
    shorter keys, make up for it. ``recall`` is the mean over ``radii``.
    """
    bits = min(30, max(4, math.ceil(math.log2(max(largest_label, 1) / bucket_rows + 1))))
    half = math.sin(math.acos(threshold) / 2)
    angles = np.array([math.acos(threshold)]) if radii is None else 2 * np.arcsin(np.minimum(1, half / np.maximum(radii, half)))
    while True:
        missed = 1 - (1 - angles / math.pi) ** bits
        tables = math.ceil(math.log(1 - recall) / math.log(missed.mean()))
        while (missed ** tables).mean() > 1 - recall and tables < MOST_TABLES:
            tables += 1
        if (missed ** tables).mean() <= 1 - recall or bits == 1:
            return bits, tables
        bits -= 1


def centre(sample: np.ndarray) -> np.ndarray:
    """Mean of the unit vectors ``sample`` (n, d), from which codes are read: about half of the rows lie on either
    side of a plane through it, also where all vectors share an offset."""
    return sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])


def learn_rotations(sample: np.ndarray, count: int, iterations: int = ITERATIONS, seed: int = 42) -> np.ndarray:
    """``count`` rotations (count, d, d) learned on centred vectors ``sample`` (n, d)."""
    d, out = sample.shape[1], []
    axes = np.linalg.eigh(sample.T @ sample)[1] if len(sample) else np.eye(d)
    turned = sample @ axes
    rng = np.random.default_rng(seed)
    for _ in range(count):
        r = np.linalg.qr(rng.standard_normal((d, d)))[0]
        for _ in range(iterations if len(sample) else 0):
            signs = np.where(turned @ r >= 0, 1.0, -1.0)
            u, _, vt = np.linalg.svd(turned.T @ signs)  # best rotation towards the present codes
            r = u @ vt
        out.append(axes @ r)
    return np.stack(out)


def keys(x: np.ndarray, rotations: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """(n, tables) keys of the rows of ``x``."""
    signs = np.concatenate([x @ r >= 0 for r in rotations], axis=1)[:, :bits * tables]
    return signs.reshape(len(x), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def _block(x: np.ndarray, norm: np.ndarray, key: np.ndarray, weight: np.ndarray, part: np.ndarray, cross: bool,
           table: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(weight linked to each row, root row) over the pairs that belong to this table."""
    hit = (x @ x.T) / (norm[:, None] * norm[None, :]) >= threshold
    for t in range(table):  # an earlier table has this pair
        hit &= key[:, None, t] != key[None, :, t]
    if cross:
        hit &= part[:, None] != part[None, :]
    np.fill_diagonal(hit, False)
    u, v = np.nonzero(np.triu(hit))
    return hit @ weight, local_components(len(x), u, v)


def _dense(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def link(vectors: DataFrame, threshold: float = THRESHOLD, cap: int = 1024, per_task: int = 20_000) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("x"), "label")
    usable = (F.col("label").isNotNull() & F.coalesce(
        F.forall("x", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)) & ~F.isnan(c))
        & F.exists("x", lambda c: c != 0), F.lit(False)))
    v = stage(v.withColumn("usable", usable), "vectors")
    equal = v.filter("usable").groupBy("label", "x").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
    # numbered once and written, so every later read sees the same numbers
    classes = stage(equal.withColumns({"class_id": F.monotonically_increasing_id(), "dim": F.size("x")}), "classes")
    by_dim = {r["dim"]: r["n"] for r in classes.groupBy("dim", "label").agg(F.count("*").alias("c"))
              .groupBy("dim").agg(F.max("c").alias("n")).collect()}
    parts = [_links_of(classes.filter(F.col("dim") == d), d, n, threshold, cap, per_task)
             for d, n in sorted(by_dim.items())]
    if not parts:
        return v.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    found = stage(found, "links")
    count = found.groupBy("class_id").agg(F.sum("links").alias("links"))
    root = found.filter("class_id <> root").select(F.col("class_id").alias("u"), F.col("root").alias("v"))
    comp = components(root)
    members = (classes.select("class_id", "label", "x", "node", "weight")
               .join(comp.withColumnRenamed("node", "class_id"), "class_id", "left")
               .withColumn("component", F.coalesce("component", "class_id")))
    smallest = members.groupBy("component").agg(F.min("node").alias("component_id"))
    members = (members.join(smallest, "component").join(count, "class_id", "left")
               .select("label", "x", "component_id",
                       (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    linked = v.filter("usable").join(members, ["label", "x"]).select(
        "vec_id", "n_links", F.when(F.col("vec_id").isNotNull(), F.col("component_id")).alias("component_id"))
    alone = v.filter("NOT usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                                          F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone)


def _links_of(classes: DataFrame, dim: int, largest: int, threshold: float, cap: int, per_task: int) -> DataFrame:
    """(class_id, links, root) per class and block, for vectors of one length."""
    spark = classes.sparkSession
    fit = classes.orderBy(F.xxhash64("x"), "node").limit(FIT_ROWS).select("x").toArrow()
    sample = _dense(fit.column("x"), dim)
    sample = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    middle = centre(sample)
    bits, tables = table_plan(largest, threshold, radii=np.linalg.norm(sample - middle, axis=1) if len(sample) > 1 else None)
    rotations = learn_rotations(sample - middle, -(-bits * tables // dim))

    def code(batches):
        for b in batches:
            x = _dense(pa.chunked_array([b.column("x")]), dim)
            k = keys(x / np.linalg.norm(x, axis=1, keepdims=True) - middle, rotations, bits, tables)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.FixedSizeListArray.from_arrays(pa.array(k.ravel()), tables).cast(pa.list_(pa.int64()))],
                [*b.schema.names, "keys"])

    coded = classes.select("class_id", F.col("label").cast("string").alias("label"), "x", "weight").mapInArrow(
        code, "class_id bigint, label string, x array<double>, weight bigint, keys array<bigint>")
    filed = coded.select("*", F.posexplode("keys").alias("tab", "key"))
    blocks = pair_blocks(filed, ["label", "tab", "key"], "class_id", cap)
    groups = tasks_for(spark, classes.count() * tables, per_task)

    def run(t: pa.Table) -> pa.Table:
        x = _dense(t.column("x"), dim)
        key = t.column("keys").combine_chunks().flatten().to_numpy().reshape(-1, tables)
        label = t.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        col = {c: t.column(c).to_numpy() for c in ("class_id", "weight", "tab", "key", "part", "bi", "bj")}
        order = np.lexsort((col["bj"], col["bi"], col["key"], col["tab"], label))
        new = np.zeros(len(order), bool)
        for c in (label, *(col[c] for c in ("tab", "key", "bi", "bj"))):
            new[1:] |= c[order][1:] != c[order][:-1]
        norm = np.linalg.norm(x, axis=1)
        ids, links, roots = [], [], []
        for rows in np.split(order, np.flatnonzero(new)):
            if len(rows) < 2:
                continue
            first = rows[0]
            n, root = _block(x[rows], norm[rows], key[rows], col["weight"][rows], col["part"][rows],
                             col["bi"][first] != col["bj"][first], int(col["tab"][first]), threshold)
            hit = np.flatnonzero(n)
            ids.append(col["class_id"][rows[hit]])
            links.append(n[hit])
            roots.append(col["class_id"][rows[root[hit]]])
        join = lambda a: np.concatenate(a).astype(np.int64) if a else np.zeros(0, np.int64)
        return pa.table({"class_id": join(ids), "links": join(links), "root": join(roots)})

    return (blocks.withColumn("task", F.pmod(F.xxhash64("label", "tab", "key", "bi", "bj"), F.lit(groups)))
            .groupBy("task").applyInArrow(run, "class_id bigint, links bigint, root bigint"))
