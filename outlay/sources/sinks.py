"""Sinks: versioned table writes with a pointer and retention (S7, S8), bucketed document table with an index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, list_dirs, path_exists, plain, unchanged_for

#: Buckets of the document table. A batch rewrites only those it touches.
DOC_BUCKETS = 256


def write_version(spark: SparkSession, df: DataFrame, table_root: str, version: int) -> str:
    """Write ``df`` as a new version, then record it as current.

    The data lands before its pointer: readers see either the old or the new
    version, never a partial one; a retried write overwrites its own version.
    """
    path = f"{table_root.rstrip('/')}/v={version}"
    df.write.mode("overwrite").parquet(path)
    record_version(spark, table_root, version, path)
    return path


def record_version(spark: SparkSession, root: str, version: int, path: str) -> None:
    (spark.createDataFrame([(version, path)], "version long, path string").coalesce(1)
     .write.mode("append").json(f"{root.rstrip('/')}/_versions"))


def current_version(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """(version, path) of the newest recorded version; None only when none was ever recorded."""
    marks = f"{root.rstrip('/')}/_versions"
    if not path_exists(spark, marks):
        return None
    row = spark.read.schema("version long, path string").json(marks).agg(
        F.max("version").alias("v"), F.max_by("path", "version").alias("path")).first()
    return None if row["v"] is None else (row["v"], row["path"])


def read_current(spark: SparkSession, table_root: str) -> DataFrame:
    """Newest recorded version of a table written by ``write_version``."""
    return spark.read.parquet(current_version(spark, table_root)[1])


def expire_versions(spark: SparkSession, root: str, keep: int, min_age_s: float = 0) -> list[str]:
    """Delete versions of ``root`` that are older than the newest ``keep`` recorded ones, and their marks.

    Folders that no mark names (of runs that failed) go too, once nothing in them is younger than
    ``min_age_s``; so do old versions, which lets readers of a version before finish. Run
    it from the process that refreshes. Returns the deleted folders.
    """
    marks = f"{root.rstrip('/')}/_versions"
    if not path_exists(spark, marks):
        return []
    named = (spark.read.schema("version long, path string").json(marks).withColumn("_file", F.input_file_name())
             .orderBy(F.desc("version")).collect())  # one row per refresh since the last expiry
    live = sorted({r["version"] for r in named}, reverse=True)[:max(1, keep)]
    kept = {plain(r["path"]) for r in named if r["version"] in live}
    gone = [d for d in list_dirs(spark, root) if not d.endswith("/_versions") and plain(d) not in kept
            and unchanged_for(spark, d, min_age_s)]
    for d in gone:
        delete_path(spark, d)
    left = {plain(d) for d in list_dirs(spark, root)}
    for r in named:
        if r["version"] not in live and plain(r["path"]) not in left:
            delete_path(spark, r["_file"])
    return gone


# ------------------------------------------------------------ document table

#: A line says where a bucket of a kind is since a version: ``docs`` and ``state`` by project, ``index`` by document.
#: A ``whole`` line replaces the lines of that bucket before it, another adds to them.
LOG = "version long, stream string, batch long, kind string, bucket int, whole boolean, path string"
#: Folders of an index bucket that are read before a batch that adds to it writes them as one.
INDEX_FOLDERS = 16


def doc_bucket(key: Column | str, buckets: int = DOC_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def doc_log(spark: SparkSession, root: str) -> DataFrame | None:
    """Lines of the log: its last base and what came after it."""
    path, base = f"{root.rstrip('/')}/_log", current_version(spark, f"{root.rstrip('/')}/_base")
    log = spark.read.schema(LOG).json(path) if path_exists(spark, path) else None
    if base is None:
        return log
    kept = spark.read.schema(LOG).json(base[1])
    return kept if log is None else kept.unionByName(log.filter(F.col("version") > base[0]))


def _current_lines(log: DataFrame) -> DataFrame:
    """Lines that say where something is now."""
    at = log.filter("kind IS NOT NULL")
    since = at.filter("whole").groupBy("kind", "bucket").agg(F.max("version").alias("_since"))
    return at.join(since, ["kind", "bucket"], "left").filter(
        "path IS NOT NULL AND version >= coalesce(_since, version)").drop("_since")


def doc_folders(log: DataFrame | None, kind: str, buckets: list[int] | None = None) -> dict[int, list[str]]:
    """Current folders of each bucket of a kind; at most DOC_BUCKETS x INDEX_FOLDERS rows reach the driver."""
    out: dict[int, list[str]] = {}
    if log is not None:
        lines = _current_lines(log).filter(F.col("kind") == kind)
        for r in (lines if buckets is None else lines.filter(F.col("bucket").isin(buckets))).collect():
            out.setdefault(r["bucket"], []).append(r["path"])
    return out


def doc_paths(log: DataFrame | None, kind: str = "docs") -> dict[int, str]:
    """The one current folder of each bucket of documents or of sync state."""
    return {b: paths[0] for b, paths in doc_folders(log, kind).items()}


def _buckets_of(spark: SparkSession, base: str) -> dict[int, str]:
    return {int(d.rsplit("=", 1)[1]): d for d in list_dirs(spark, base) if "bucket=" in d.rsplit("/", 1)[1]}


def _write_buckets(df: DataFrame, key: str, path: str, order: list[str]) -> None:
    """A folder per bucket of ``key``. Rows are dealt by bucket first, so a bucket is few files; one that is
    large is split over tasks."""
    (df.withColumn("bucket", doc_bucket(key)).hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", *order)
     .write.mode("overwrite").partitionBy("bucket").parquet(path))


def write_documents(spark: SparkSession, docs: DataFrame, root: str, version: int, stream: str = "", batch: int = -1,
                    touched: list[int] | None = None, state: tuple[DataFrame, list[int]] | None = None,
                    placed: DataFrame | None = None) -> None:
    """Write the rows of the touched buckets as version ``version``, then log it.

    Without ``touched`` all buckets are replaced, and the index with them. Rows are
    sorted by project within a file, so min/max statistics serve per-project lookups.
    ``placed`` has the (doc_id, project_id) that the index lacks, all of ``docs`` by
    default: a stored document never changes its project, so entries are only added.
    ``state`` is the sync state of the named buckets.
    """
    top = root.rstrip("/")
    log = doc_log(spark, root) if touched is not None else None
    base, lines = f"{top}/v={version}", []
    _write_buckets(docs, "project_id", base, ["project_id", "doc_id"])
    have = _buckets_of(spark, base)
    lines += [("docs", b, True, have.get(b)) for b in (touched if touched is not None else range(DOC_BUCKETS))]
    entries = (docs if placed is None else placed).select("doc_id", "project_id").filter("doc_id IS NOT NULL").distinct()
    _write_buckets(entries, "doc_id", f"{top}/index/v={version}", ["doc_id"])
    added = _buckets_of(spark, f"{top}/index/v={version}")
    full = {b: [*paths, added[b]] for b, paths in doc_folders(log, "index", list(added)).items() if len(paths) >= INDEX_FOLDERS}
    if full:
        merged = read_index(spark, [p for paths in full.values() for p in paths]).distinct()
        _write_buckets(merged, "doc_id", f"{top}/index/v={version}-merged", ["doc_id"])
        added |= _buckets_of(spark, f"{top}/index/v={version}-merged")
    lines += [("index", b, touched is None or b in full, added.get(b))
              for b in (range(DOC_BUCKETS) if touched is None else added)]
    if state is not None:
        rows, buckets = state
        _write_buckets(rows, "project_id", f"{top}/state/v={version}", ["project_id", "snapshot_id"])
        kept = _buckets_of(spark, f"{top}/state/v={version}")
        lines += [("state", b, True, kept.get(b)) for b in buckets]
    spark.createDataFrame([(version, stream, batch, *x) for x in lines] or [(version, stream, batch, None, None, None, None)],
                          LOG).coalesce(1).write.mode("append").json(f"{top}/_log")


def read_index(spark: SparkSession, folders: list[str]) -> DataFrame:
    """(doc_id, project_id) of index folders."""
    kind = "doc_id string, project_id string"
    return spark.read.schema(kind).parquet(*folders) if folders else spark.createDataFrame([], kind)


def read_documents(spark: SparkSession, root: str, schema: str, buckets: list[int] | None = None) -> DataFrame:
    """The current document table, or the named buckets of it."""
    paths = [p for b, p in doc_paths(doc_log(spark, root)).items() if buckets is None or b in buckets]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def expire_documents(spark: SparkSession, root: str) -> int:
    """Delete document, index and state folders that no current line names, and fold the log into a base.

    Run it when no batch runs. The base has the current lines and the last batch of
    each stream; log files that it covers are deleted after it is recorded, and ignored before.
    """
    top, log = root.rstrip("/"), doc_log(spark, root)
    if log is None:
        return 0
    lines = _current_lines(log).select(*[c.split()[0] for c in LOG.split(", ")])
    live = {plain(r["path"]) for r in lines.select("path").collect()}
    tops = [d for d in list_dirs(spark, root) if "/v=" in d]
    tops += [d for k in ("index", "state") for d in list_dirs(spark, f"{top}/{k}")]
    gone = [d for v in tops for d in list_dirs(spark, v) if plain(d) not in live]
    for d in gone:
        delete_path(spark, d)
    for v in tops:
        if not list_dirs(spark, v):
            delete_path(spark, v)
    version = log.agg(F.max("version")).first()[0]
    done = log.groupBy("stream").agg(F.max("batch").alias("batch")).select(
        F.lit(version).cast("long").alias("version"), "stream", "batch",
        *[F.lit(None).cast(t).alias(c) for c, t in (("kind", "string"), ("bucket", "int"), ("whole", "boolean"), ("path", "string"))])
    base = current_version(spark, f"{top}/_base")
    if base is None or base[0] < version:
        path = f"{top}/_base/v={version}"
        lines.unionByName(done).coalesce(1).write.mode("overwrite").json(path)
        record_version(spark, f"{top}/_base", version, path)
    files = (spark.read.schema(LOG).json(f"{top}/_log").select("version", F.input_file_name().alias("f")).groupBy("f")
             .agg(F.max("version").alias("v")).filter(F.col("v") <= version).collect()
             if path_exists(spark, f"{top}/_log") else [])
    for r in files:
        delete_path(spark, r["f"])
    expire_versions(spark, f"{top}/_base", 1)
    return len(gone)
