"""Operator 7, sharding: a Feistel permutation of global row numbers. DataFrame functions only.

Every row gets a dense global number r (0 .. N-1), the permutation maps it to
a position p, and shard = p mod S, slot = p div S. Shard and slot of any row
are so computable from (r, N, seed) alone, shard sizes differ by one at most
and slots have no gaps (law ``rows``).

The domain is a x b with a = ceil(sqrt N), b = ceil(N / a): rounds add a
keyed hash of one half to the other, modulo a or b, which is a bijection for
any a, b. Positions >= N are walked on through the same permutation until they
fall below N. Fewer than a of the domain's a*b points lie outside, and the
longest walk among them is determined beforehand, so the unrolled walk is
exact for every row.

Defined cases: a NULL text has size 8 and the CRC of an empty text; NULL and
repeated doc_ids are numbered like others (ties by size and CRC, rows equal in
all of these are interchangeable); an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import copy_numbers, stage, tasks_for, text_or_empty

ROUNDS = 6


def whole_quotient(x: Column, by: int) -> Column:
    """``x`` div ``by`` in whole numbers: exact over all of bigint."""
    return F.call_function("div", x.cast("bigint"), F.lit(by).cast("bigint"))


def feistel(x: Column, a: int, b: int, seed: int, rounds: int = ROUNDS) -> Column:
    """Image of ``x`` under the permutation of 0 .. a*b-1."""
    left = x % F.lit(a).cast("bigint")
    pair = F.struct(left.alias("l"), whole_quotient(x, a).alias("r"))

    def step(s: Column, k: Column) -> Column:
        key = F.xxhash64(F.lit(seed).cast("bigint"), k)
        to_l = F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], key), F.lit(a).cast("bigint")), F.lit(a).cast("bigint"))
        to_r = F.pmod(s["r"] + F.pmod(F.xxhash64(s["l"], key), F.lit(b).cast("bigint")), F.lit(b).cast("bigint"))
        even = k % 2 == 0
        return F.struct(F.when(even, to_l).otherwise(s["l"]).alias("l"),
                        F.when(even, s["r"]).otherwise(to_r).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), pair, step, lambda s: s["r"] * a + s["l"])


def permute(x: Column, n: int, a: int, b: int, seed: int, walk: int) -> Column:
    """Position of row number ``x`` among ``n``; ``walk`` applications at most, stopping below n."""
    start = feistel(x, a, b, seed)
    if walk <= 1:
        return start
    return F.aggregate(F.sequence(F.lit(2), F.lit(walk)), start,
                       lambda p, _: F.when(p < n, p).otherwise(feistel(p, a, b, seed)))


def domain(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def longest_walk(spark, n: int, a: int, b: int, seed: int) -> int:
    """Applications that the slowest row needs: 1 plus the longest run of points outside 0 .. n-1.

    The outside points still outside after each application shrink until only
    cycles that no row enters are left (or none).
    """
    steps, left, outside = 1, a * b - n, spark.range(n, a * b).select(F.col("id").alias("p"))
    while left:
        outside = outside.select(feistel(F.col("p"), a, b, seed).alias("p")).filter(F.col("p") >= n)
        now = outside.count()
        if now == left:
            break
        steps, left = steps + 1, now
    return steps


def row_numbers(rows: DataFrame, order: list[str], per_bucket: int = 200_000) -> tuple[DataFrame, int]:
    """Rows with ``row_no`` (dense, from 0) and their number.

    Rows are ordered by (hash bucket, ``order``, copy); bucket sizes give each
    bucket's first number, so only buckets are sorted, never the table. The
    hash takes in the copy number, so equal rows are dealt over all buckets.
    """
    spark = rows.sparkSession
    rows = stage(copy_numbers(rows, order), "numbered")
    order = [*order, "copy"]
    n = rows.count()
    buckets = tasks_for(spark, n, per_bucket)
    keyed = rows.withColumn("__b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = keyed.groupBy("__b").agg(F.count("*").alias("__n"))
    first = sizes.select("__b", (F.sum("__n").over(Window.orderBy("__b")) - F.col("__n")).alias("__first"))
    at = F.row_number().over(Window.partitionBy("__b").orderBy(*[F.col(c).asc_nulls_first() for c in order]))
    numbered = keyed.withColumn("__at", at).join(first, "__b")
    return numbered.withColumn("row_no", F.col("__first") + F.col("__at") - 1).drop("__b", "__at", "__first", "copy"), n


def assign(docs: DataFrame, shards: int = 24, seed: int = 42) -> DataFrame:
    """doc_id, size, text_crc32, row_no, position, shard, slot for every row of ``docs``."""
    rows = docs.select("doc_id", (F.octet_length(text_or_empty(F.col("text"))) + 8).cast("bigint").alias("size"),
                       F.crc32(text_or_empty(F.col("text"))).cast("bigint").alias("text_crc32"))
    numbered, n = row_numbers(rows, ["doc_id", "size", "text_crc32"])
    a, b = domain(n)
    walk = longest_walk(docs.sparkSession, n, a, b, seed)
    return (numbered.withColumn("position", permute(F.col("row_no"), n, a, b, seed, walk).cast("bigint"))
            .withColumn("shard", (F.col("position") % shards).cast("int"))
            .withColumn("slot", whole_quotient(F.col("position"), shards)))
