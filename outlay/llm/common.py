"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_folder

#: A word is a maximal run of characters outside this class; the same six
#: characters are what ``bytes.split()`` separates on.
SPACES = r"[\x20\x09-\x0D]+"


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def words_of(c: Column) -> Column:
    """Words of a text as an array; a NULL text has none."""
    return F.array_remove(F.split(text_or_empty(c), SPACES, -1), "")


def word_count(c: Column) -> Column:
    return F.regexp_count(text_or_empty(c), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A plain reference inside a lambda of a higher-order function would be
    evaluated again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return scratch_folder(spark, "outlay-llm", label)


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    so a lost executor costs a re-read and not the steps before. ``options`` are the writer's."""
    path = scratch(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what runs inside; the session gets its own setting back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def tasks_for(spark: SparkSession, rows: int, per_task: int) -> int:
    """Number of groups so that each holds about ``per_task`` rows."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // per_task), 1)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so each slice holds about ``max_bytes`` of text; a
    single longer text is a slice of its own."""
    for batch in batches:
        start = size = 0
        for i, n in enumerate(pa.compute.binary_length(batch.column(column)).to_pylist()):
            n = n or 0
            if i > start and size + n > max_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def numbered(rows: DataFrame, within: list[str], order: list[Column]) -> DataFrame:
    """``rows`` with ``pos``, the place from 0 on in ``order``, and ``n``, the number of rows, per group of ``within``.

    Rows are dealt into ranges of the whole key and written, the counts of the
    ranges before give a range's first place, and only ranges are sorted: a
    group of any size is spread over ranges. Columns of ``within`` must not be NULL.
    """
    ranged = rows.repartitionByRange(*[F.col(c) for c in within], *order).withColumn("__range", F.spark_partition_id())
    ranged = stage(ranged, "ranges")
    counts = ranged.groupBy(*within, "__range").agg(F.count("*").alias("__n"))
    group = Window.partitionBy(*within)
    before = group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    places = counts.select(*within, "__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"),
                           F.sum("__n").over(group).alias("n"))
    at = F.row_number().over(Window.partitionBy(*within, "__range").orderBy(*order))
    return (ranged.withColumn("__at", at).join(places, [*within, "__range"])
            .withColumn("pos", F.col("__first") + F.col("__at") - 1).drop("__range", "__first", "__at"))


def copy_numbers(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows``, written, with ``copy``: 0, 1, ... among the rows that are equal in ``key``.

    Equal rows are numbered within the input partition that they come from, and
    its first number follows from the counts of the partitions before: a row
    that a third of a table repeats is spread over as many tasks as it comes from.
    """
    placed = stage(rows.withColumns({"__key": F.xxhash64(*key), "__from": F.spark_partition_id()}), "copies")
    within = Window.partitionBy("__key").orderBy("__from").rowsBetween(Window.unboundedPreceding, -1)
    first = (placed.groupBy("__key", "__from").agg(F.count("*").alias("__n"))
             .select("__key", "__from", F.coalesce(F.sum("__n").over(within), F.lit(0)).alias("__first")))
    at = F.row_number().over(Window.partitionBy("__key", "__from").orderBy("__key"))
    return (placed.withColumn("__at", at).join(first, ["__key", "__from"])
            .withColumn("copy", F.col("__first") + F.col("__at") - 1).drop("__key", "__from", "__first", "__at"))


def pair_blocks(rows: DataFrame, key: list[str], ident: str, cap: int) -> DataFrame:
    """Split buckets of more than ``cap`` rows into blocks.

    Adds ``part`` (the row's slice of its bucket) and ``bi``, ``bj`` (the block).
    A bucket of n rows is dealt into g = ceil(n / cap) slices; block (i, j)
    holds slices i and j, so any two rows of a bucket meet in one block: in
    (i, i) when they share a slice, else in (i, j). No block holds much more
    than 2 * cap rows however hot the bucket is, and no row is left out.
    Bucket keys must not be NULL.
    """
    heavy = (rows.groupBy(*key).agg(F.count("*").alias("__n")).filter(F.col("__n") > cap)
             .withColumn("__g", F.ceil(F.col("__n") / cap).cast("int")).drop("__n"))
    g = F.coalesce("__g", F.lit(1))
    return (rows.join(heavy, key, "left")
            .withColumn("part", F.pmod(F.xxhash64(ident), g).cast("int"))
            .withColumn("__o", F.explode(F.sequence(F.lit(0), g - 1)))
            .withColumn("bi", F.least("part", "__o")).withColumn("bj", F.greatest("part", "__o"))
            .drop("__g", "__o"))
