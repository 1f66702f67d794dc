"""Landed folder-tree / folder-document JSON.

A folder tree arrives as raw JSON text per project: a bare list of
``{id, text, numFiles, children: [...]}`` nodes, or that list wrapped under
``children`` or ``data``. Depth is unknown, so the tree is flattened level
by level: each level is parsed with ``from_json`` keeping ``children`` as
raw JSON text for the next level. The loop runs once per tree *level*, never
per row.

Folder document lists arrive the same way (bare list, or under ``data`` /
``rows``) with inconsistent key names; records are parsed to
``map<string,string>`` and the alternatives resolved with ``coalesce`` on
key presence (a missing key falls back, a present NULL does not).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import mime_type
from ..params import SourceParams
from ..session import scratch_folder

NODE_SCHEMA = "array<struct<id:string,text:string,numFiles:bigint,children:string>>"
RECORD_SCHEMA = "array<map<string,string>>"


def _as_list(payload: Column, *wrappers: str) -> Column:
    """JSON text of the node list: the payload itself, or its wrapped list.

    The first wrapper key that is present decides, also when it holds null
    or no list: there are no nodes then.
    """
    keys = F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>"))
    wrapped = F.lit("[]")
    for w in reversed(wrappers):
        wrapped = F.when(F.array_contains(keys, w), F.get_json_object(payload, f"$.{w}")).otherwise(wrapped)
    return _list_or_none(F.when(F.ltrim(payload).startswith("["), payload).otherwise(wrapped))


def _list_or_none(json: Column) -> Column:
    """Only a JSON list holds nodes; an object does not."""
    return F.when(F.ltrim(json).startswith("["), json)


def flatten_folders(trees: DataFrame) -> DataFrame:
    """(project_id, payload) -> one row per folder, at any depth.

    Depth 0 names the category; deeper folders use their *own* name as the
    sub-folder (not a path) and inherit the category. Each level is written
    to the shared folder and the next is parsed from it, until a level is
    empty: no level is parsed twice and a lost executor re-reads one level.
    """
    spark = trees.sparkSession
    root = scratch_folder(spark, "outlay-folders")

    def write(level: DataFrame, depth: int) -> DataFrame:
        level.write.parquet(f"{root}/depth={depth}")
        return spark.read.schema(level.schema).parquet(f"{root}/depth={depth}")

    fields = ["n.id", "n.text", "n.numFiles", "n.children"]
    level = write(trees.select(
        "project_id", F.explode(F.from_json(_as_list(F.col("payload"), "children", "data"), NODE_SCHEMA)).alias("n"))
        .select("project_id", F.col("n.text").alias("category"), F.lit("").alias("sub_folder"), *fields), 0)
    depth = 0
    while not level.isEmpty():
        depth += 1
        level = write(level.select("project_id", "category", F.explode(
            F.from_json(_list_or_none(F.col("children")), NODE_SCHEMA)).alias("n"))
            .select("project_id", "category", F.coalesce("n.text", F.lit("")).alias("sub_folder"), *fields), depth)
    whole = spark.read.schema(f"{_ddl(level)}, depth int").parquet(root)
    return whole.select("project_id", "depth", F.col("id").alias("folder_id"), F.col("text").alias("folder_name"),
                        "category", "sub_folder", F.coalesce("numFiles", F.lit(0)).alias("num_files"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{n} {t}" for n, t in df.dtypes)


def _pick(m: Column, keys: list[str], default: str = "") -> Column:
    """``rec.get(k1, rec.get(k2, ...default))``: first *present* key wins."""
    out: Column = F.lit(default)
    for k in reversed(keys):
        out = F.when(F.map_contains_key(m, k), m[k]).otherwise(out)
    return out


def normalise_documents(folder_docs: DataFrame, folders: DataFrame, checked_at: str,
                        params: SourceParams | None = None) -> DataFrame:
    """S6 + X26 + X27: (folder_id, payload) lists -> document rows.

    Only folders with files contribute; a folder listing without a matching
    folder row is ignored.
    """
    p = params or SourceParams()
    recs = folder_docs.select(
        "folder_id", F.explode(F.from_json(_as_list(F.col("payload"), "data", "rows"), RECORD_SCHEMA)).alias("r"))
    r = F.col("r")
    doc_id = _pick(r, ["ID", "id", "documentID"])
    name = _pick(r, ["name", "Name"])
    docs = recs.select(
        "folder_id",
        doc_id.alias("doc_id"), name.alias("doc_name"),
        _pick(r, ["size", "Size"]).alias("doc_size"),
        _pick(r, ["uploadedBy", "UploadedBy", "author"]).alias("uploaded_by"),
        _pick(r, ["date", "Date"]).alias("uploaded_at"),
    )
    live = folders.filter(F.col("num_files") > 0).select("project_id", "folder_id", "category", "sub_folder")
    j = docs.join(live, "folder_id", "inner")
    return j.select(
        "doc_id", "project_id", "folder_id",
        F.col("category").alias("folder_category"), "sub_folder", "doc_name",
        F.format_string(f"{p.doc_url_base}/download?documentID=%s&folderID=%s", F.col("doc_id"), F.col("folder_id"))
        .alias("doc_url"),
        mime_type(F.coalesce(F.col("doc_name"), F.lit(""))).alias("doc_type"),
        "doc_size", "uploaded_by", "uploaded_at",
        F.lit(checked_at).alias("last_checked"),
    )


def landed_from_documents(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Render the fixture documents as landed JSON (trees per project, one list per doc).

    Category folders hold no files themselves; each (category, source)
    sub-folder holds the documents. Key names vary with the doc id, and
    every third project's tree arrives wrapped under ``children``.
    """
    d = docs.select(
        "project_id", "doc_id", "doc_name", "doc_size", "uploaded_by", "uploaded_at",
        F.coalesce("folder_category", F.lit("")).alias("cat"),
        F.coalesce("sub_folder", F.lit("")).alias("sub"),
    ).withColumn("cat_id", F.concat(F.col("project_id"), F.lit("/"), F.col("cat"))) \
     .withColumn("sub_id", F.concat(F.col("cat_id"), F.lit("/"), F.col("sub")))
    subs = d.groupBy("project_id", "cat", "cat_id", "sub", "sub_id").agg(F.count(F.lit(1)).alias("n"))
    cats = subs.groupBy("project_id", "cat", "cat_id").agg(
        F.collect_list(F.struct(F.col("sub_id").alias("id"), F.col("sub").alias("text"),
                                F.col("n").alias("numFiles"))).alias("children"))
    trees = cats.groupBy("project_id").agg(
        F.to_json(F.collect_list(F.struct(F.col("cat_id").alias("id"), F.col("cat").alias("text"),
                                          F.lit(0).alias("numFiles"), "children"))).alias("payload"))
    trees = trees.withColumn("payload", F.when(F.abs(F.hash("project_id")) % 3 == 0,
                                               F.concat(F.lit('{"children":'), F.col("payload"), F.lit("}")))
                             .otherwise(F.col("payload")))
    n = F.col("doc_id").cast("long")
    rec = (F.when(n % 3 == 0, F.create_map(F.lit("ID"), F.col("doc_id"), F.lit("name"), F.col("doc_name"),
                                           F.lit("size"), F.col("doc_size"), F.lit("uploadedBy"), F.col("uploaded_by"),
                                           F.lit("date"), F.col("uploaded_at")))
           .when(n % 3 == 1, F.create_map(F.lit("id"), F.col("doc_id"), F.lit("Name"), F.col("doc_name"),
                                          F.lit("Size"), F.col("doc_size"), F.lit("UploadedBy"), F.col("uploaded_by"),
                                          F.lit("Date"), F.col("uploaded_at")))
           .otherwise(F.create_map(F.lit("documentID"), F.col("doc_id"), F.lit("name"), F.col("doc_name"),
                                   F.lit("size"), F.col("doc_size"), F.lit("author"), F.col("uploaded_by"),
                                   F.lit("date"), F.col("uploaded_at"))))
    lists = d.select(F.col("sub_id").alias("folder_id"),
                     F.when(n % 2 == 0, F.to_json(F.array(rec)))
                     .otherwise(F.concat(F.lit('{"data":'), F.to_json(F.array(rec)), F.lit("}"))).alias("payload"))
    return trees, lists
