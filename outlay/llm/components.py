"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def local_components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest reachable index for each of ``n`` nodes; edges ``u[i]``-``v[i]``."""
    root = np.arange(n)
    while True:
        a, b = root[u], root[v]
        if (a == b).all():
            return root
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(root, hi, lo)
        while True:  # compress the paths
            up = root[root]
            if (up == root).all():
                break
            root = up


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes in ``edges(u, v)``, two long columns.

    ``component`` is the smallest node reachable. Nodes without an edge to
    another node are not listed. Each round links every node to the smallest
    one near it (first over all neighbours, then over smaller ones); the
    number of rounds grows with the logarithm of a component's size. Each
    round is written to the shared folder; the driver sees only a row count
    and a checksum. NULL ends and loops are ignored, repeated edges count once.
    """
    e = stage(edges.filter(F.col("u") != F.col("v"))
              .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == seen:
            break
        seen = mark
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = both.join(near, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "star")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
