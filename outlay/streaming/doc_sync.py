"""D3: the document reconcile (D1) applied per micro-batch with foreachBatch.

Arrivals are rows of project listings. A listing has a ``snapshot_id`` that
grows with time, and one closing row (NULL ``doc_id``) that says in
``snapshot_docs`` how many document rows it has. A listing is applied once it is
complete, whatever batches its rows came in; until then its rows wait in the
sync state. Of several complete listings of a project the newest counts, and
one older than the last applied is dropped. Rows that have waited for longer than
``max_wait_s`` are dropped, so a listing that never completes does not wait for ever.

Documents and sync state are kept in buckets by project, and an index in buckets
by document says which project a document is stored under. A batch reads and
rewrites only the buckets of its projects. Documents that these buckets do not
have are looked up in their buckets of the index; only where one is stored under
another project that project's bucket joins in. Each batch is a new version
whose number follows the log, not the batch id; the log lines are written last.
A batch that the log already has from the same stream is skipped, so a retried
batch changes nothing and a new checkpoint goes on from the stored table.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.documents import reconcile
from ..sources import sinks
from ..sources.fixtures import DOC_COLUMNS

INCOMING_SCHEMA = (
    "doc_id string, project_id string, folder_id string, folder_category string, sub_folder string, "
    "doc_name string, doc_url string, doc_type string, doc_size string, uploaded_by string, uploaded_at string, "
    "last_checked string, arrival_seq long, snapshot_id long, snapshot_docs long"
)
INCOMING_SCHEMA_COLUMNS = [c.split()[0] for c in INCOMING_SCHEMA.split(", ")]
STORED_SCHEMA = (
    "doc_id string, project_id string, folder_id string, folder_category string, sub_folder string, "
    "doc_name string, doc_url string, doc_type string, doc_size string, uploaded_by string, uploaded_at string, "
    "last_checked string, is_deleted int"
)


#: How long rows of a listing wait for the rest of it.
MAX_WAIT_S = 7 * 24 * 3600.0
STATE_SCHEMA = f"{INCOMING_SCHEMA}, applied boolean, arrived double"


def _buckets(keys: DataFrame, key: str) -> list[int]:
    return [r[0] for r in keys.select(sinks.doc_bucket(key).alias("b")).distinct().collect()]  # DOC_BUCKETS values at most


def _read_state(spark: SparkSession, paths: dict[int, str], buckets: list[int]) -> DataFrame:
    found = [paths[b] for b in buckets if b in paths]
    return spark.read.schema(STATE_SCHEMA).parquet(*found) if found else spark.createDataFrame([], STATE_SCHEMA)


def merge_batch(spark: SparkSession, root: str, now: str, batch: DataFrame, batch_id: int, stream: str = "",
                max_wait_s: float = MAX_WAIT_S, clock: float | None = None) -> None:
    """Reconcile one micro-batch into the stored table (D1 on its complete listings).

    ``clock`` is the time of arrival in seconds, the wall clock by default.
    """
    clock = time.time() if clock is None else clock
    log = sinks.doc_log(spark, root)
    version = 0
    if log is not None:
        seen = log.agg(F.max("version").alias("v"), F.max(F.when(F.col("stream") == stream, F.col("batch"))).alias("b")).first()
        if seen["b"] is not None and batch_id <= seen["b"]:
            return
        version = (seen["v"] if seen["v"] is not None else -1) + 1
    batch = batch.select(*INCOMING_SCHEMA_COLUMNS).filter("project_id IS NOT NULL").persist()
    theirs = _buckets(batch, "project_id")
    state = _read_state(spark, sinks.doc_paths(log, "state"), theirs).filter(
        F.col("applied") | (F.col("arrived") >= F.lit(clock - max_wait_s)))
    arrived = batch.withColumns({"applied": F.lit(False), "arrived": F.lit(float(clock))})
    rows = arrived.unionByName(state.filter("NOT applied"))
    done = state.filter("applied").select("project_id", F.col("snapshot_id").alias("last"))
    listings = rows.groupBy("project_id", "snapshot_id").agg(
        F.count("doc_id").alias("n"), F.max("snapshot_docs").alias("want"))
    ready = (listings.filter("n >= want").groupBy("project_id").agg(F.max("snapshot_id").alias("newest"))
             .join(done, "project_id", "full")
             .select("project_id", "newest", "last", F.greatest("newest", "last").alias("upto")))
    placed = rows.join(ready, "project_id", "left")
    fresh = F.col("newest").isNotNull() & (F.col("last").isNull() | (F.col("newest") > F.col("last")))
    incoming = placed.filter(fresh & (F.col("snapshot_id") == F.col("newest")) & F.col("doc_id").isNotNull()).select(
        *INCOMING_SCHEMA_COLUMNS).persist()
    attempted = ready.filter(fresh).select("project_id")
    waiting = placed.filter("upto IS NULL OR snapshot_id > upto").select(*rows.columns)
    kinds = dict(c.split() for c in STATE_SCHEMA.split(", "))
    marks = ready.filter("upto IS NOT NULL").select(*[
        F.col("project_id") if c == "project_id" else F.col("upto").alias(c) if c == "snapshot_id"
        else F.lit(True).alias(c) if c == "applied" else F.lit(None).cast(kinds[c]).alias(c) for c in rows.columns])

    own = _buckets(attempted, "project_id")
    here = sinks.read_documents(spark, root, STORED_SCHEMA, own).select("doc_id") if own else None
    unknown = incoming.select("doc_id").distinct()
    unknown = (unknown if here is None else unknown.join(here, "doc_id", "left_anti")).persist()
    folders = sinks.doc_folders(log, "index", _buckets(unknown, "doc_id"))
    elsewhere = unknown.join(sinks.read_index(spark, [p for ps in folders.values() for p in ps]), "doc_id").persist()
    touched = sorted({*own, *_buckets(elsewhere, "project_id")})
    stored = sinks.read_documents(spark, root, STORED_SCHEMA, touched) if touched else spark.createDataFrame(
        [], STORED_SCHEMA)
    out = reconcile(stored, incoming, attempted, now).select(*DOC_COLUMNS)
    new = out.join(unknown.join(elsewhere, "doc_id", "left_anti"), "doc_id").select("doc_id", "project_id")
    sinks.write_documents(spark, out, root, version, stream, batch_id, touched, (waiting.unionByName(marks), theirs), new)
    for df in (batch, incoming, unknown, elsewhere):
        df.unpersist()


def start_doc_sync(spark: SparkSession, incoming_dir: str, table_root: str, checkpoint: str, now: str,
                   available_now: bool = True, max_wait_s: float = MAX_WAIT_S,
                   files_per_batch: int | None = None) -> StreamingQuery:
    """Start the stream: parquet snapshot files -> foreachBatch(D1)."""
    options = {} if files_per_batch is None else {"maxFilesPerTrigger": files_per_batch}
    src = spark.readStream.schema(INCOMING_SCHEMA).options(**options).parquet(incoming_dir)

    def apply(df: DataFrame, batch_id: int) -> None:
        # the stream's own id: a checkpoint that was started anew has another one
        stream = spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]
        merge_batch(spark, table_root, now, df, batch_id, stream, max_wait_s)

    w = src.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def as_listings(incoming: DataFrame, attempted: DataFrame, snapshot_id: int = 1) -> DataFrame:
    """One complete listing per attempted project, as arrivals: its documents and a closing row."""
    kinds = dict(c.split() for c in INCOMING_SCHEMA.split(", "))
    number = F.lit(snapshot_id).cast("long").alias("snapshot_id")
    rows = incoming.select(*INCOMING_SCHEMA_COLUMNS[:-2], number, F.lit(None).cast("long").alias("snapshot_docs"))
    counts = attempted.join(incoming.groupBy("project_id").agg(F.count(F.lit(1)).alias("n")), "project_id", "left")
    closing = counts.select(*[
        number if c == "snapshot_id" else F.coalesce("n", F.lit(0)).alias(c) if c == "snapshot_docs"
        else F.col(c) if c == "project_id" else F.lit(None).cast(kinds[c]).alias(c) for c in INCOMING_SCHEMA_COLUMNS])
    return rows.unionByName(closing)


def read_current(spark: SparkSession, table_root: str) -> DataFrame:
    return sinks.read_documents(spark, table_root, STORED_SCHEMA)
