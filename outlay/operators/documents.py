"""Document snapshot reconcile (D1, D2), tree and counts (A20-A23), sync audit.

D1 is one full-outer join of the stored table with the latest incoming row
per doc_id, for all projects at once. Deletion is only inferred for
projects in the explicit ``attempted`` set: a folder listing that failed
says nothing about its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import default_label, doc_kind
from ..params import GENERAL_FOLDER, UNCATEGORISED
from ..sources.fixtures import DOC_COLUMNS
from .precedence import pick_by

UPDATED = ["folder_category", "sub_folder", "doc_name", "doc_url", "doc_type", "doc_size", "uploaded_by",
           "uploaded_at", "last_checked"]
DOC_FIELDS = ["doc_id", "doc_name", "doc_url", "doc_type", "doc_size", "uploaded_by", "uploaded_at"]


def reconcile(stored: DataFrame, incoming: DataFrame, attempted: DataFrame, now: str) -> DataFrame:
    """D1 + D2: upsert by doc_id, soft-delete unseen live docs of attempted projects.

    * seen doc: all fields but project_id / folder_id take the incoming
      values, ``is_deleted`` = 0 (un-delete);
    * new doc: inserted live;
    * unseen live doc of an attempted project: ``is_deleted`` = 1 and
      ``last_checked`` = ``now``; already-deleted and not-attempted docs are
      left as they are.

    Duplicate ids in one snapshot: the last arrival wins.
    """
    inc = pick_by(incoming.select(*DOC_COLUMNS[:-1], "arrival_seq"), ["doc_id"], [F.col("arrival_seq")],
                  last=True)
    att = attempted.select("project_id").distinct().withColumn("_attempted", F.lit(True))
    old = stored.join(att, "project_id", "left").withColumn("_old", F.lit(True))
    o = old.select(*[F.col(c).alias("o_" + c) for c in old.columns])
    i = inc.withColumn("_new", F.lit(True)).select(*[F.col(c).alias("i_" + c) for c in inc.columns + ["_new"]])
    j = o.join(i, F.col("o_doc_id") == F.col("i_doc_id"), "full")
    seen = F.col("i__new").isNotNull()
    has_old = F.col("o__old").isNotNull()
    delete = ~seen & F.coalesce(F.col("o__attempted"), F.lit(False)) & (F.col("o_is_deleted") == 0)
    cols = [F.coalesce("o_doc_id", "i_doc_id").alias("doc_id"),
            F.when(has_old, F.col("o_project_id")).otherwise(F.col("i_project_id")).alias("project_id"),
            F.when(has_old, F.col("o_folder_id")).otherwise(F.col("i_folder_id")).alias("folder_id")]
    for c in UPDATED:
        v = F.when(seen, F.col("i_" + c)).otherwise(F.col("o_" + c))
        if c == "last_checked":
            v = F.when(delete, F.lit(now)).otherwise(v)
        cols.append(v.alias(c))
    cols.append(F.when(seen, F.lit(0)).when(delete, F.lit(1)).otherwise(F.col("o_is_deleted")).cast("int")
                .alias("is_deleted"))
    return j.select(*cols).select(*DOC_COLUMNS)


def sync_summary(projects: DataFrame, incoming: DataFrame, attempted: DataFrame) -> DataFrame:
    """Docs synced (incoming rows, duplicates included), failed projects, projects.

    The universe is the project table: a project without documents counts too.
    """
    att = attempted.select("project_id").distinct().withColumn("_a", F.lit(1))
    proj = projects.select("project_id").distinct().join(att, "project_id", "left").agg(
        F.count(F.lit(1)).alias("projects"), F.count(F.when(F.col("_a").isNull(), 1)).alias("errors"))
    synced = incoming.agg(F.count(F.lit(1)).alias("docs_synced"))
    # two one-row aggregates side by side, without a join
    return (proj.select("projects", "errors", F.lit(None).cast("long").alias("docs_synced"))
            .unionByName(synced.select(F.lit(None).cast("long").alias("projects"),
                                       F.lit(None).cast("long").alias("errors"), "docs_synced"))
            .agg(F.max("docs_synced").alias("docs_synced"), F.max("errors").alias("errors"),
                 F.max("projects").alias("projects")))


def _labelled(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("is_deleted") == 0).select(
        "project_id", *DOC_FIELDS,
        F.col("folder_category").alias("raw_category"), F.col("sub_folder").alias("raw_sub_folder"),
        default_label(F.col("folder_category"), UNCATEGORISED).alias("folder_category"),
        default_label(F.col("sub_folder"), GENERAL_FOLDER).alias("sub_folder"),
    )


def tree_rows(docs: DataFrame, raw: bool = False) -> DataFrame:
    """A23 flattened: active docs with category / sub-folder labels and positions.

    NULL and '' merge into the default label at the place of the first raw
    key in (category, sub-folder, name) order. Positions are ranked on the
    small per-(project, folder) aggregates, never over a whole project's docs.
    ``raw`` keeps the raw keys, which order the documents of a merged label.
    """
    rows = _labelled(docs)
    folders = rows.groupBy("project_id", "folder_category", "sub_folder").agg(
        F.min(F.struct("raw_category", "raw_sub_folder")).alias("_k"))
    # a struct, so that a NULL key is the lowest; min() alone would pass it over
    first = F.min(F.struct(F.col("_k.raw_category").alias("c"))).over(
        Window.partitionBy("project_id", "folder_category"))
    folders = folders.withColumn("_c", first).withColumns({
        "category_position": F.dense_rank().over(Window.partitionBy("project_id").orderBy("_c")).cast("int"),
        "sub_folder_position": F.dense_rank().over(
            Window.partitionBy("project_id", "folder_category").orderBy("_k")).cast("int")}).drop("_k", "_c")
    out = rows if raw else rows.drop("raw_category", "raw_sub_folder")
    return (out.join(folders, ["project_id", "folder_category", "sub_folder"], "inner")
            .withColumn("doc_kind", doc_kind(F.coalesce(F.col("doc_type"), F.lit("")))))


def doc_tree(docs: DataFrame, project_id: str) -> DataFrame:
    """A23 nested for one project: [{folder_category, subfolders: [{sub_folder, docs: [...]}]}].

    A point lookup, so the arrays hold one project's documents only.
    """
    r = tree_rows(docs.filter(F.col("project_id") == F.lit(project_id)), raw=True)
    doc = F.struct(F.struct("raw_category", "raw_sub_folder", "doc_name").alias("_sort"), *DOC_FIELDS)
    subs = r.groupBy("project_id", "folder_category", "category_position", "sub_folder", "sub_folder_position").agg(
        F.array_sort(F.collect_list(doc)).alias("docs"))
    subs = subs.withColumn("docs", F.transform("docs", lambda d: d.dropFields("_sort")))
    cats = subs.groupBy("project_id", "folder_category", "category_position").agg(
        F.array_sort(F.collect_list(F.struct("sub_folder_position", "sub_folder", "docs"))).alias("subfolders"))
    cats = cats.withColumn("subfolders", F.transform("subfolders", lambda s: s.dropFields("sub_folder_position")))
    return cats.groupBy("project_id").agg(
        F.array_sort(F.collect_list(F.struct("category_position", "folder_category", "subfolders"))).alias("folders")
    ).withColumn("folders", F.transform("folders", lambda c: c.dropFields("category_position")))


def doc_counts(docs: DataFrame) -> DataFrame:
    """Active-document counts per category and per (category, sub-folder)."""
    rows = _labelled(docs)
    g = rows.rollup("project_id", "folder_category", "sub_folder").agg(
        F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias("doc_count"))
    return g.filter(F.col("_gid").isin(0, 1)).select(
        "project_id", "folder_category", "sub_folder",
        F.when(F.col("_gid") == 0, "sub_folder").otherwise("category").alias("level"), "doc_count")


def project_doc_summary(docs: DataFrame) -> DataFrame:
    """A20 + A21: last check (deleted docs included) and active count per project."""
    return docs.groupBy("project_id").agg(
        F.max("last_checked").alias("last_checked"),
        F.count(F.when(F.col("is_deleted") == 0, 1)).alias("doc_count"))


TREE_TYPE = ("array<struct<folder_category:string,subfolders:array<struct<sub_folder:string,docs:array<struct<"
             + ",".join(f"{c}:string" for c in DOC_FIELDS) + ">>>>>>")


def _as_json(*fields: str) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("json")


def document_payload(docs: DataFrame, project_id: str) -> DataFrame:
    """S13 without a sync: {project_id, last_checked, folders} as one JSON row, also for an empty project."""
    s = project_doc_summary(docs.filter(F.col("project_id") == F.lit(project_id)))
    one = docs.sparkSession.range(1).select(F.lit(project_id).alias("project_id"))
    out = one.join(s, "project_id", "left").join(doc_tree(docs, project_id), "project_id", "left")
    return out.withColumn("folders", F.coalesce("folders", F.array().cast(TREE_TYPE))).select(
        _as_json("project_id", "last_checked", "folders"))


def refresh_result(docs: DataFrame, incoming: DataFrame, project_id: str) -> DataFrame:
    """{project_id, doc_count, last_checked, folders} as one JSON row."""
    s = project_doc_summary(docs.filter(F.col("project_id") == F.lit(project_id))).select("project_id", "last_checked")
    n = incoming.filter(F.col("project_id") == F.lit(project_id)).agg(F.count(F.lit(1)).alias("doc_count"))
    out = (n.withColumn("project_id", F.lit(project_id)).join(s, "project_id", "left")
           .join(doc_tree(docs, project_id), "project_id", "left"))
    return out.withColumn("folders", F.coalesce("folders", F.array().cast(TREE_TYPE))).select(
        _as_json("project_id", "doc_count", "last_checked", "folders"))
