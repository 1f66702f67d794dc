"""SparkSession construction and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session of ours wants; the cluster may override sizes.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, creating a local one when none exists."""
    builder = SparkSession.builder.appName("outlay")
    if master:
        # Only takes effect when this call launches the JVM (local runs);
        # on a cluster the submitter sizes the driver.
        builder = builder.master(master).config("spark.driver.memory",
                                                os.environ.get("OUTLAY_DRIVER_MEMORY", "12g"))
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Apply the runtime SQL settings our plans rely on (idempotent)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled", "spark.sql.ansi.enabled"):
        try:
            spark.conf.set(k, _DEFAULTS[k])
        except Exception:  # static or locked conf on some clusters
            pass


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for cut lineage and staged tables: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a scratch folder; on a
    cluster a machine-local folder would be invisible to other executors, so a
    missing setting is an error there.
    """
    sc = spark.sparkContext
    chosen = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if chosen:
        return chosen
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="outlay-ckpt-", dir=os.environ.get("OUTLAY_SCRATCH", "/tmp")))
    return sc.getCheckpointDir()


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes under ``path`` (file-system metadata only, no data read)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength())


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there; any other trouble with the file system is an error."""
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().toString() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, modification time) of every file below ``path``, at any depth."""
    fs, p = _fs(spark, path)
    out, it = [], fs.listFiles(p, True)
    while it.hasNext():
        s = it.next()
        out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(out)


def plain(path: str) -> str:
    """A path without its scheme, so that spellings of one path compare equal."""
    return "/" + path.split(":", 1)[-1].strip("/")


def unchanged_for(spark: SparkSession, path: str, seconds: float) -> bool:
    """Whether nothing at or below ``path`` changed in that time; a folder that changed itself is not listed."""
    fs, p = _fs(spark, path)
    before = (time.time() - seconds) * 1000
    return fs.getFileStatus(p).getModificationTime() <= before and all(t <= before for _, _, t in list_files(spark, path))


#: Folders of scratch below the checkpoint folder, and the age from which a run's scratch is no longer in use.
SCRATCH_AREAS = ("outlay-llm", "outlay-places", "outlay-folders", "outlay-written")
SCRATCH_MAX_AGE_S = 7 * 24 * 3600.0
_TIDIED: set[tuple[str, str]] = set()


def expire_scratch(spark: SparkSession, max_age_s: float = SCRATCH_MAX_AGE_S) -> list[str]:
    """Delete scratch folders in which nothing changed for ``max_age_s``; returns them.

    Scratch is written once and read by the job that wrote it, so age tells
    what a job that ended, or failed, has left.
    """
    top = checkpoint_dir(spark).rstrip("/")
    gone = [d for area in SCRATCH_AREAS for d in list_dirs(spark, f"{top}/{area}") if unchanged_for(spark, d, max_age_s)]
    for d in gone:
        delete_path(spark, d)
    return gone


def scratch_folder(spark: SparkSession, area: str, label: str = "") -> str:
    """A fresh folder in the shared scratch; an application's first one in an area drops what is too old there."""
    top = checkpoint_dir(spark).rstrip("/")
    if area not in SCRATCH_AREAS:
        raise ValueError(f"unknown scratch area {area!r}")
    if (spark.sparkContext.applicationId, top) not in _TIDIED:
        _TIDIED.add((spark.sparkContext.applicationId, top))
        expire_scratch(spark)
    return f"{top}/{area}/{uuid.uuid4().hex}{'-' if label else ''}{label}"


def shuffle_partitions(spark: SparkSession, nbytes: int, target_bytes: int = 256 << 20) -> int:
    """About one partition per ``target_bytes`` of input, two per core at least."""
    return max(2 * max(1, spark.sparkContext.defaultParallelism), -(-nbytes // target_bytes))


#: Input for one partition of a refresh's shuffles: about half a million lines, which a task sorts in its memory.
REFRESH_TARGET_BYTES = 16 << 20


@contextmanager
def with_settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings inside the block; the session's own come back after it."""
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@contextmanager
def sized_shuffle(spark: SparkSession, nbytes: int, target_bytes: int = 256 << 20) -> Iterator[int]:
    """Size shuffles for an input of ``nbytes`` inside the block; the session's own settings come back after it.

    AQE coalesces small partitions to the same advisory size, so small inputs
    do not pay for many tiny tasks.
    """
    n = shuffle_partitions(spark, nbytes, target_bytes)
    with with_settings(spark, {"spark.sql.shuffle.partitions": str(n),
                               "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes)}):
        yield n
