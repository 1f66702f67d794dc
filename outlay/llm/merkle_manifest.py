"""Operator 12, Merkle manifest of a dataset.

Every row is a leaf, the SHA-256 of its fields. Leaves of a group are numbered in
order through range partitions and cut into aligned blocks of ``fanout ** LEVELS``
leaves. In a block each level is one window: a node's digest stands on the row of
its first leaf, lag and lead columns at that level's fixed offsets, masked by
the node's slot and its run's length, are its siblings, and the first child's
row hashes the parent. The rows of block heads are the next pass's nodes, so a
tree of n leaves takes log(n) / LEVELS passes, each over a small part of the one
before, and no task holds more than its blocks, however large a group is. A leaf
takes the siblings of its ancestors inside the block from the last marked row
above it, and those further up from the pass above. The groups' roots are
the leaves of one more tree, in order of group.

Digests are lower-case hex text; a parent hashes its children's text joined.
A level with one node left ends its group's tree; a last run may be of one node,
which is hashed alone.

Defined cases: a NULL group is one of its own and comes first; NULL identifiers
come first; rows of equal identifier are ordered by leaf, so repeated rows give
the same tree in any order; NULL fields count as such and differ from empty ones;
texts are hashed whole; further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, stage

FANOUT, LEVELS = 2, 8
#: One element per level of a leaf's path: digests of the run's other nodes, joined, on either side.
PATH = "array<struct<left:string,right:string>>"


def field(c: Column) -> Column:
    """``-`` for NULL, else the UTF-8 byte count, a colon and the value; integers in decimal."""
    s = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_of(*fields: Column) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def _block(nodes: DataFrame, fanout: int) -> tuple[DataFrame, Column]:
    """``nodes`` with the levels of its blocks: the digest after them, and each row's path inside its block."""
    nodes = nodes.withColumn("block", F.expr(f"pos div {fanout ** LEVELS}"))
    rows = Window.partitionBy("grp", "block").orderBy("pos")
    so_far = rows.rowsBetween(Window.unboundedPreceding, 0)
    nodes = nodes.withColumn("d0", F.col("digest"))
    for level in range(LEVELS):
        step, d = fanout ** level, f"d{level}"
        count, index = F.expr(f"(n + {step - 1}) div {step}"), F.expr(f"pos div {step}")
        slot = index % fanout
        run = F.least(F.lit(fanout).cast("bigint"), count - (index - slot))
        here = (F.col("pos") % step == 0) & (count > 1)
        left = F.concat(F.lit(""), *[F.when(slot >= k, F.lag(d, step * k).over(rows)).otherwise("")
                                     for k in range(fanout - 1, 0, -1)])
        right = F.concat(F.lit(""), *[F.when(slot + k < run, F.lead(d, step * k).over(rows)).otherwise("")
                                      for k in range(1, fanout)])
        nodes = nodes.withColumn(f"s{level}", F.when(here, F.struct(left.alias("left"), right.alias("right"))))
        nodes = nodes.withColumn(f"d{level + 1}", F.when(here & (slot == 0), F.sha2(
            F.concat(F.col(d), F.col(f"s{level}.right")), 256)).otherwise(F.col(d)))
    path = F.filter(F.array(*[F.last(f"s{level}", ignorenulls=True).over(so_far) for level in range(LEVELS)]),
                    lambda e: e.isNotNull())
    return nodes, path


def paths(nodes: DataFrame, largest: int, fanout: int = FANOUT) -> tuple[DataFrame, DataFrame]:
    """Paths and roots of the trees over ``nodes(grp, n, pos, digest, ...)``, one tree per ``grp``.

    ``pos`` counts from 0 without gaps up to the group's size ``n``, ``largest`` is
    the largest ``n``. Returns ``nodes`` with ``path`` and ``top``, and (grp, top) of every group.
    """
    own = [F.col(c) for c in nodes.columns]
    if largest <= 1:
        return (nodes.select(*own, F.array().cast(PATH).alias("path"), F.col("digest").alias("top")),
                nodes.select("grp", F.col("digest").alias("top")))
    size = fanout ** LEVELS
    marked, path = _block(nodes, fanout)
    heads = stage(marked.filter(F.col("pos") % size == 0).select(
        "grp", F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("block").alias("pos"),
        F.col(f"d{LEVELS}").alias("digest")), "merkle-heads")
    upper, tops = paths(heads, -(-largest // size), fanout)
    upper = upper.select("grp", F.col("pos").alias("block"), F.col("path").alias("above"), "top")
    return (marked.withColumn("path", path).join(upper, ["grp", "block"])
            .select(*own, F.concat("path", "above").alias("path"), "top"), tops)


def manifest(rows: DataFrame, ident: str, group: str, leaf: Column, claim: Column | None = None,
             fanout: int = FANOUT) -> DataFrame:
    """(ident, group, leaf, claim, subroot, root, path) of every row.

    ``leaf`` is the digest that enters the tree; ``claim`` is another digest carried
    along, such as that of a copy which is to be verified. ``path`` holds the
    siblings from the leaf to the root.
    """
    grp = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = stage(rows.select(grp.alias("grp"), F.col(ident).alias("ident"), F.col(group).alias("of"),
                               leaf.alias("digest"), (leaf if claim is None else claim).alias("claim")), "merkle-leaves")
    leaves = stage(numbered(leaves, ["grp"], [F.col("ident"), F.col("digest")]), "merkle-numbered")
    inside, tops = paths(leaves, leaves.agg(F.max("n")).first()[0] or 0, fanout)
    tops = stage(tops, "merkle-tops")
    ranked = stage(numbered(tops.select(F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("top").alias("digest")),
                            ["grp"], [F.col("key")]), "merkle-groups")
    across, _ = paths(ranked, ranked.agg(F.max("n")).first()[0] or 0, fanout)
    across = across.select(F.col("key").alias("grp"), F.col("path").alias("above"), F.col("top").alias("root"))
    return inside.join(across, "grp").select(
        F.col("ident").alias(ident), F.col("of").alias(group), F.col("digest").alias("leaf"), "claim",
        F.col("top").alias("subroot"), "root", F.concat("path", "above").alias("path"))


def proof_digest(path: Column) -> Column:
    """SHA-256 of the siblings, level by level from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda e: F.concat(e["left"], e["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda d, e: F.sha2(F.concat(e["left"], d, e["right"]), 256))


def verify(rows: DataFrame, stored: DataFrame, ident: str, leaf: Column) -> DataFrame:
    """Rows of a later copy against a stored manifest, without its other rows: (ident, verified).

    ``stored`` has ``ident``, ``root`` and ``path``. A row whose identifier the
    manifest lacks is not verified; of a repeated identifier any stored path may fit.
    """
    found = rows.select(F.col(ident), leaf.alias("leaf")).join(stored.select(ident, "root", "path"), ident, "left")
    ok = F.coalesce(fold(F.col("leaf"), F.col("path")) == F.col("root"), F.lit(False))
    return found.groupBy(ident, "leaf").agg(F.max(ok).alias("verified")).select(ident, "verified")

