"""Operator 11, exact dedup by sorting content.

Texts are normalised (A-Z to lower case, nothing else) and written once.
Sampled splitters then range-partition the normalised bytes and each task sorts
its range externally, so equal texts lie next to each other. Splitters are drawn
from the sort key (leading bytes, digest, identifier), whose size is fixed:
samples stay small however long texts are, and a group of copies of any
size is cut between identifiers, never gathered in one task. Each sorted range
is read once as a stream that compares every text in full with its neighbour
and numbers the runs of equal ones. A run that may go on in another range
hands on its text; such ends, two per range, meet by comparing texts in full.

Defined cases: a NULL text is empty, so NULL and empty texts are copies of
each other; of equal texts the one row with the smallest identifier stays (the
largest on request), any other only when all identifiers are NULL; rows that
repeat text and identifier keep one of them; a text is never cut; further columns
are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_slices

#: Leading bytes of a text in the sort key.
HEAD = 64
SLICE_BYTES = 16 << 20
KEYED = "doc_id bigint, head binary, digest binary, norm string"
#: Documents (kind 0) and runs of equal texts (kind 1) of each sorted range.
MARKED = "kind int, part int, run bigint, doc_id bigint, first boolean, n bigint, digest binary, norm string"


def normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_slices(batches, "text", SLICE_BYTES):
        norm = pc.ascii_lower(pc.fill_null(part.column("text"), ""))
        raw = norm.cast(pa.binary())
        digest = pa.array([hashlib.sha256(x.as_buffer()).digest() for x in raw], pa.binary())
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), pc.binary_slice(raw, 0, HEAD), digest, norm],
                                         ["doc_id", "head", "digest", "norm"])


class _Run:
    """A run of equal texts in a sorted range; the identifier of its first row is the one that stays."""

    __slots__ = ("digest", "keep", "n", "number", "text")

    def __init__(self, number: int, keep: int | None, digest: bytes, text: pa.Scalar):
        self.number, self.keep, self.digest, self.text, self.n = number, keep, digest, text, 0


def mark_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted range -> (range, run) of each document, and a row per run.

    Runs whose digest is the range's first or last hand on their text: only
    these can have parts in other ranges.
    """
    schema = pa.schema([("kind", pa.int32()), ("part", pa.int32()), ("run", pa.int64()), ("doc_id", pa.int64()),
                        ("first", pa.bool_()), ("n", pa.int64()), ("digest", pa.binary()), ("norm", pa.string())])
    part = TaskContext.get().partitionId()
    first_digest: bytes | None = None
    held: list[_Run] = []  # the open run, after closed ones of the same digest

    def as_rows(runs: list[_Run], last: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([
            {"kind": 1, "part": part, "run": r.number, "doc_id": r.keep, "n": r.n, "digest": r.digest,
             "norm": r.text.as_py() if last or r.digest == first_digest else None} for r in runs], schema)

    for batch in batches:
        m = batch.num_rows
        if not m:
            continue
        ids, digests, texts = (batch.column(c) for c in ("doc_id", "digest", "norm"))
        new = np.ones(m, bool)
        new[1:] = pc.not_equal(texts.slice(1), texts.slice(0, m - 1)).to_numpy(zero_copy_only=False)
        if held:
            new[0] = not texts[0].equals(held[-1].text)
        run = (held[-1].number if held else -1) + np.cumsum(new)
        none = pa.nulls(m)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(m, np.int32)), pa.array(np.full(m, part, np.int32)), pa.array(run), ids, pa.array(new),
             none.cast(pa.int64()), none.cast(pa.binary()), none.cast(pa.string())], schema=schema)
        starts = np.flatnonzero(new)
        if held:
            held[-1].n += int(starts[0]) if len(starts) else m
        done: list[_Run] = []
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), m]):
            r = _Run(int(run[a]), ids[a].as_py(), digests[a].as_py(), texts[a])
            r.n = b - a
            if first_digest is None:
                first_digest = r.digest
            if held and held[0].digest != r.digest:
                done += held
                held = []
            held.append(r)
        if done:
            yield as_rows(done, False)
    if held:
        yield as_rows(held, True)


def dedup(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs(doc_id, text)``."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    keyed = stage(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(normalised, KEYED), "normalised",
                  compression="zstd")
    ident = F.col("doc_id").desc_nulls_last() if keep == "largest" else F.col("doc_id").asc_nulls_last()
    ranged = keyed.repartitionByRange("head", "digest", ident).sortWithinPartitions("head", "digest", "norm", ident)
    marked = stage(ranged.mapInArrow(mark_runs, MARKED), "runs")
    runs = marked.filter("kind = 1").withColumnRenamed("doc_id", "keep_id")
    if keep == "largest":
        best = F.max(F.struct(F.col("keep_id"), (-F.col("part")).alias("order")))
        winner = -F.col("best.order")
    else:
        best = F.min(F.struct(F.col("keep_id").isNull(), F.col("keep_id"), F.col("part").alias("order")))
        winner = F.col("best.order")
    ends = runs.filter("norm IS NOT NULL")
    whole = ends.groupBy("norm").agg(F.sum("n").alias("size"), best.alias("best")).select(
        "norm", "size", F.col("best.keep_id").alias("of"), winner.alias("in"))
    inner = runs.filter("norm IS NULL").select("part", "run", "keep_id", F.col("n").alias("size"), F.lit(True).alias("wins"),
                                               "digest")
    both = inner.unionByName(ends.join(whole, "norm").select(
        "part", "run", F.col("of").alias("keep_id"), "size", (F.col("part") == F.col("in")).alias("wins"), "digest"))
    return (marked.filter("kind = 0").select("part", "run", "doc_id", "first").join(both, ["part", "run"])
            .select("doc_id", "keep_id", F.col("size").alias("group_size"),
                    (F.col("first") & F.col("wins")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")))
