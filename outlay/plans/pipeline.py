"""R9 end to end: refresh sinks (S7-S10), source freshness (A24, R10), audit."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge
from ..params import UNKNOWN_TS, SourceParams
from ..session import REFRESH_TARGET_BYTES, input_bytes, sized_shuffle
from ..sources import fixtures, sinks
from . import curated as C

log = logging.getLogger(__name__)


def _freshness_row(df: DataFrame, ts_col: str, key: str, label: str, refreshed_at: str) -> DataFrame:
    latest = F.max(F.col(ts_col).try_cast("timestamp"))
    return df.agg(latest.alias("_ts")).select(
        F.lit(key).alias("source_key"), F.lit(label).alias("source_label"),
        F.coalesce(F.concat(F.date_format("_ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")), F.lit(UNKNOWN_TS))
        .alias("source_last_updated"),
        F.lit(refreshed_at + " UTC").alias("refreshed_at"))


def source_freshness(raw: fixtures.RawInputs, documents: DataFrame, params: SourceParams) -> DataFrame:
    """A24 + S11: newest update per source (NULL -> 'Unknown'), ordered by key."""
    rows = [
        _freshness_row(raw.enrichment, "ods_updated", "enrichment", "Project enrichment", params.refreshed_at),
        _freshness_row(raw.projects, "date_modified", "project_master", "Project master", params.refreshed_at),
        _freshness_row(raw.po_lines, "ods_updated", "po_lines", "PO lines", params.refreshed_at),
        _freshness_row(documents, "last_checked", "documents", "Documents", params.refreshed_at),
    ]
    return reduce(DataFrame.unionByName, rows).orderBy("source_key")


def upsert_freshness(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Replace rows by source_key, keep the other stored ones."""
    return stored.join(fresh.select("source_key"), "source_key", "left_anti").unionByName(fresh)


AUDIT = "stage string, metric string, value long"


def load_audit(st: C.Stages, cur: C.Curated) -> DataFrame:
    """Found / mapped / skipped / merged / recovered / loaded / backfilled counts.

    The PO figures come from the merge itself, which counts the rows it chooses
    from: one pass over the line facts. A refresh observes the same figures on its own writes (``audit_rows``).
    """
    figures = merge.merge_figures()
    one = st.groups.agg(*[c.cast("long").alias(n.replace(".", "__")) for n, c in figures.items()])
    po_part = one.select(F.explode(F.array(*[
        F.struct(*[F.lit(x).alias(k) for k, x in zip(("stage", "metric"), n.split("."))],
                 F.col(n.replace(".", "__")).alias("value")) for n in figures])).alias("x")).select("x.*")

    def count(df: DataFrame, stage: str, metric: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(stage).alias("stage"), F.lit(metric).alias("metric"),
                                                               "value")

    return reduce(DataFrame.unionByName, [
        po_part, count(st.pulled, "pull", "projects_found"), count(st.store_map, "umbrella", "store_keys"),
        count(cur.projects, "load", "projects"), count(cur.budgets, "load", "budgets"), count(cur.pos, "load", "pos"),
        count(cur.projects.join(cur.pos.select("proj_def").distinct(), "proj_def", "left_semi"), "backfill", "contractor"),
    ])


def audit_rows(spark: SparkSession, found: dict[str, int | str | None]) -> DataFrame:
    """The figures that a refresh observed, in the form of ``load_audit``."""
    return spark.createDataFrame([(*n.split("."), v) for n, v in found.items() if not isinstance(v, str | None)], AUDIT)


Source = tuple[str, str, Callable[[], DataFrame], str]


def checked_freshness(spark: SparkSession, sources: list[Source], refreshed_at: str,
                      known: list[tuple[str, str, str | None]] | None = None) -> DataFrame:
    """A24 with each source on its own: (key, label, frame, timestamp column).

    A source that cannot be read shows 'Unknown' and leaves the others as they
    are. One row per source reaches the driver. ``known`` are sources whose newest
    update a read has shown already: (key, label, update or NULL).
    """
    rows = [(key, label, UNKNOWN_TS if at is None else f"{at} UTC", refreshed_at + " UTC") for key, label, at in known or []]
    for key, label, frame, column in sources:
        try:
            row = tuple(_freshness_row(frame(), column, key, label, refreshed_at).first())
        except Exception as e:  # the failure is the finding; the label tells it apart from an empty source
            log.warning("source %s cannot be read: %s", key, str(e)[:200])
            row = (key, label, UNKNOWN_TS, refreshed_at + " UTC")
        rows.append(row)
    return spark.createDataFrame(
        rows, "source_key string, source_label string, source_last_updated string, refreshed_at string")


def stored_freshness(spark: SparkSession, out_root: str) -> DataFrame:
    """The stored freshness rows, by key."""
    return sinks.read_current(spark, f"{out_root.rstrip('/')}/source_freshness").orderBy("source_key")


#: Versions that a refresh leaves: the one it wrote and the one before, whose readers go on.
KEEP_VERSIONS = 2


def refresh(spark: SparkSession, raw: fixtures.RawInputs, documents: Callable[[], DataFrame], out_root: str,
            params: SourceParams | None = None, nbytes: int = 0, keep_versions: int = KEEP_VERSIONS,
            min_age_s: float = 0) -> C.Curated:
    """Extracts -> curated tables (S7, S8) -> audit (A27) -> freshness.

    Each run writes a new version below ``out_root`` (a shared location) and
    moves the pointer when all of its tables are complete; readers of the
    version before are not disturbed, and a failed run is never visible. The line facts
    are read once: audit and freshness of the lines are observed on that read and on the writes.
    Versions before the newest ``keep_versions`` are deleted once unchanged for ``min_age_s``, as are
    folders that a failed run left.
    """
    p, root = params or SourceParams(), out_root.rstrip("/")
    done = sinks.current_version(spark, f"{root}/curated")
    version = done[0] + 1 if done else 0
    path = f"{root}/curated/v={version}"
    with sized_shuffle(spark, nbytes, REFRESH_TARGET_BYTES):
        cur, found = C.write_tables(spark, raw, path, p)
        audit_rows(spark, found).coalesce(1).write.mode("overwrite").parquet(f"{path}/load_audit")
    sinks.record_version(spark, f"{root}/curated", version, path)
    fresh = checked_freshness(spark, [
        ("enrichment", "Project enrichment", lambda: raw.enrichment, "ods_updated"),
        ("project_master", "Project master", lambda: raw.projects, "date_modified"),
        ("documents", "Documents", documents, "last_checked")], p.refreshed_at,
        [("po_lines", "PO lines", found["pull.lines_updated"])])
    stored = sinks.current_version(spark, f"{root}/source_freshness")
    rows = upsert_freshness(spark.read.parquet(stored[1]), fresh) if stored else fresh
    sinks.write_version(spark, rows, f"{root}/source_freshness", stored[0] + 1 if stored else 0)
    for table in ("curated", "source_freshness"):
        sinks.expire_versions(spark, f"{root}/{table}", keep_versions, min_age_s)
    return cur


def current(spark: SparkSession, out_root: str) -> C.Curated:
    """The curated tables that the last complete refresh wrote."""
    return C.read_tables(spark, sinks.current_version(spark, f"{out_root.rstrip('/')}/curated")[1])


def run_refresh(spark: SparkSession, sf_dir: str, out_root: str, params: SourceParams | None = None) -> C.Curated:
    """R9 over the test tables' fixture; ``refresh`` takes any landed extracts."""
    p = params or SourceParams()
    return refresh(spark, fixtures.load_raw(spark, sf_dir, p), lambda: fixtures.doc_old(spark, sf_dir, p), out_root, p,
                   input_bytes(spark, sf_dir))
