"""Operator 5, mixing sources to target weights along a time-varying curriculum.

Training time t runs from 0 to 1. Each source has a weight schedule, piecewise
linear in t. Its integral, scaled to the source's target, is the cumulative
token demand. Documents of a source stand in a fixed hash order; the demand is
inverted at a document's token offset, which gives its training position, and
the documents are range-sorted by position. A source whose target exceeds its
size is read again from the start; the document in which the demand ends is
taken in part, so a source's taken words equal its rounded target.

Targets: source k (code point order, NULL last) weighs ``WEIGHTS[k mod 3]``;
together the sources get ``budget`` times all sizes; a target stops at
``max_epochs`` times its source's size and the excess goes to the others by
weight until none is above.

Skew: a source's prefix sums are taken over hash ranges of its documents, then
within each range, so a source with a third of all rows is spread over many
tasks. The hash order does not depend on the number of ranges, so results are
the same at any parallelism and on reruns.

Defined cases: NULL and empty texts have size 0 and take 0; an empty source
string differs from NULL; NULL and repeated doc_ids are ordered by (hash,
doc_id, size) and all stay, equal rows are interchangeable; a source of size 0
has target 0; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, tasks_for, word_count

WEIGHTS = (3, 1, 2)
BUDGET, MAX_EPOCHS = 1.5, 2


@dataclass(frozen=True)
class Schedule:
    """Relative weight at the knots of training time; linear between them."""
    knots: tuple[tuple[float, float], ...] = ((0.0, 1.0), (1.0, 1.0))

    def pieces(self) -> list[tuple[float, float, float, float, float]]:
        """(t0, t1, w0, slope, demand before), with the whole demand scaled to 1."""
        total = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:]))
        out, done = [], 0.0
        for (t0, w0), (t1, w1) in zip(self.knots, self.knots[1:]):
            out.append((t0, t1, w0 / total, (w1 - w0) / (t1 - t0) / total, done))
            done += (t1 - t0) * (w0 + w1) / 2 / total
        return out

    def invert(self, share: Column) -> Column:
        """Time at which ``share`` of the demand (0 .. 1) has been met."""
        at = F.lit(self.knots[-1][0])
        for t0, t1, w0, slope, done in reversed(self.pieces()):
            rest = F.greatest(share - done, F.lit(0.0))
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * rest, F.lit(0.0)))
            here = F.lit(t0) + F.when(rest > 0, 2 * rest / (F.lit(w0) + root)).otherwise(F.lit(0.0))
            meets = done + (t1 - t0) * (w0 + slope * (t1 - t0) / 2)
            at = F.when(share <= meets, F.least(here, F.lit(t1))).otherwise(at)
        return at


#: By weight class: early, even, late, as a curriculum from broad to select sources.
SCHEDULES = (Schedule(((0.0, 1.5), (1.0, 0.5))), Schedule(), Schedule(((0.0, 0.5), (1.0, 1.5))))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET,
            max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size), one row per source, with ``class`` and ``target``.

    Sources ordered by cap per weight: the first k are at their cap, the rest
    share what is left by weight, for the first k at which no further one is above.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = sizes.withColumn("class", F.pmod(nth, F.lit(len(weights))).cast("int"))
    w = w.withColumn("w", F.get(F.array(*[F.lit(float(x)) for x in weights]), F.col("class")))
    w = w.withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    order = Window.orderBy((F.col("cap") / F.col("w")), F.col("source").asc_nulls_last())
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    w = (w.withColumn("rank", F.row_number().over(order))
         .withColumn("given", F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
         .withColumn("w_left", F.sum("w").over(later))
         .withColumn("budget", F.sum("source_size").over(all_rows) * budget))
    level = (F.col("budget") - F.col("given")) / F.col("w_left")
    w = w.withColumn("free", level * F.col("w") <= F.col("cap")).withColumn("level", level)
    first = F.min(F.when(F.col("free"), F.struct("rank", "level"))).over(all_rows)
    return w.withColumn("first", first).select(
        "source", "source_size", "class",
        F.when(F.col("first").isNotNull() & (F.col("rank") >= F.col("first.rank")),
               F.least(F.col("first.level") * F.col("w"), F.col("cap"))).otherwise(F.col("cap")).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, schedules: tuple[Schedule, ...] = SCHEDULES,
        budget: float = BUDGET, max_epochs: int = MAX_EPOCHS, per_range: int = 100_000,
        carry: list[str] | None = None, whole: bool = False) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, ``parts`` and columns ``carry``.

    ``parts`` has an entry per reading that takes words: (epoch, words, position).
    The document in which a source's demand ends gives its first words, or with
    ``whole`` all of them or none, whichever is nearer to the demand.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                       *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []))
    rows = rows.withColumns({"h": F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")),
                             "sk": F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))})
    slim = rows if carry else stage(rows, "sizes")
    width = max(tasks_for(spark, slim.count(), per_range), int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges = 1 << (width - 1).bit_length()  # of each source: a hot one fills as many tasks as a shuffle has
    digits = 6  # of the hash: 2^24 ranges at most
    bucket = F.floor(F.conv(F.substring("h", 1, digits), 16, 10).cast("bigint") / max(1, 16 ** digits // ranges))
    slim = slim.withColumn("b", bucket.cast("int"))
    per_bucket = slim.groupBy("source", "b").agg(F.sum("size").alias("bucket_size"))
    sizes = per_bucket.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    by_source = Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    first = per_bucket.select("source", "b", F.coalesce(F.sum("bucket_size").over(by_source), F.lit(0)).alias("first"))
    plan = targets(sizes, weights, budget, max_epochs)
    side = (first.withColumn("sk", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))).drop("source")
            .join(plan.withColumn("sk", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")))
                  .drop("source"), "sk"))
    local = (Window.partitionBy("sk", "b").orderBy("h", F.col("doc_id").asc_nulls_first(), "size")
             .rowsBetween(Window.unboundedPreceding, -1))
    out = (slim.withColumn("__in", F.coalesce(F.sum("size").over(local), F.lit(0)))
           .join(side, ["sk", "b"]).withColumn("before", F.col("first") + F.col("__in")))
    demand = F.round(F.col("target")).cast("bigint")

    def reading(epoch: int) -> Column:
        at = F.col("before") + F.col("source_size") * epoch
        words = F.least(F.greatest(demand - at, F.lit(0)), F.col("size"))
        if whole:
            words = F.when(2 * words >= F.col("size"), F.col("size")).otherwise(0)
        share = F.least(at / F.greatest(demand, F.lit(1)), F.lit(1.0))
        position = F.lit(None).cast("double")
        for k, s in enumerate(schedules):
            position = F.when(F.col("class") % len(schedules) == k, s.invert(share)).otherwise(position)
        return F.struct(F.lit(epoch + 1).alias("epoch"), words.cast("bigint").alias("words"),
                        position.alias("position"))

    parts = F.filter(F.array(*[reading(e) for e in range(max_epochs)]), lambda p: p["words"] > 0)
    return out.select("doc_id", "source", "size", "source_size", "target", parts.alias("parts"),
                      *(["carried"] if carry else []))


def in_training_order(mixed: DataFrame) -> DataFrame:
    """One row per reading, range-sorted by training position."""
    return (mixed.withColumn("part", F.explode("parts")).drop("parts")
            .select("*", "part.epoch", "part.words", "part.position").drop("part")
            .repartitionByRange("position", "source", "doc_id", "epoch")
            .sortWithinPartitions("position", "source", "doc_id", "epoch"))


def materialize(docs: DataFrame) -> DataFrame:
    """The mixed corpus: columns of ``docs``, a row per reading, range-sorted by position; every reading is of a whole document."""
    rows = in_training_order(mix(docs, carry=docs.columns, whole=True))
    return rows.select(*[F.col(f"carried.`{c}`").alias(c) for c in docs.columns])
