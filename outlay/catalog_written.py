"""Registered queries of what is written and read back: refresh, sinks, JSON, the document stream.

Each writes its whole result to the shared scratch and returns what a reader finds there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalog as K
from . import oracle_sql as O
from .operators import documents as DOC
from .operators.gram_index import read_index
from .operators.sorted_copy import SortedCopy, read_sorted
from .params import PoFilter
from .plans import pipeline as PL
from .plans import pos as POS
from .plans import projects as PR
from .session import list_files, scratch_folder
from .sources import sinks
from .streaming import doc_sync

P = K.P
register = K.register

# ------------------------------------------------------------------ refresh

_RUNS: dict[tuple, str] = {}
STORED_BEFORE = [("documents", "Documents", "Unknown", "before"), ("retired", "Retired source", "Unknown", "before")]


def _refreshed(spark: SparkSession, d: str) -> str:
    """A folder that a refresh of ``d`` has written; one refresh a session and input."""
    key = (spark.sparkContext.applicationId, d, repr(list_files(spark, d)))
    if key not in _RUNS:
        root = scratch_folder(spark, "outlay-written", "refresh")
        before = spark.createDataFrame(STORED_BEFORE, "source_key string, source_label string, source_last_updated string, "
                                                      "refreshed_at string")
        sinks.write_version(spark, before, f"{root}/source_freshness", 0)
        PL.run_refresh(spark, d, root, P)
        _RUNS[key] = root
    return _RUNS[key]


@register("refreshed_pos", O.sql(f"SELECT {K._PO_OUT_SQL} FROM po", "po"))
def q_refreshed_pos(spark, d):
    """R9 + S7 + S8: the POs that a refresh wrote, found through its pointer."""
    return K._po_out(PL.current(spark, _refreshed(spark, d)).pos)


@register("refreshed_projects", O.sql(f"SELECT {K._PROJ_OUT_SQL} FROM projects", "projects"))
def q_refreshed_projects(spark, d):
    """R9 + S7 + A18: the projects that a refresh wrote, contractors backfilled from the written POs."""
    return K._proj_out(PL.current(spark, _refreshed(spark, d)).projects)


@register("refreshed_audit", K.ORACLE["load_audit"])
def q_refreshed_audit(spark, d):
    """A27 in R9: the figures that a refresh observed on its own writes."""
    path = sinks.current_version(spark, f"{_refreshed(spark, d)}/curated")[1]
    return spark.read.parquet(f"{path}/load_audit")


@register("refreshed_freshness", K.ORACLE["source_freshness"]
          + " UNION ALL SELECT 'retired', 'Retired source', 'Unknown', 'before'")
def q_refreshed_freshness(spark, d):
    """S10 + S11 + R10: fresh rows replace stored ones by key, the others stay."""
    return PL.stored_freshness(spark, _refreshed(spark, d))


# ---------------------------------------------------------------- documents


@register("doc_stream_table", O.sql("SELECT * FROM docs_after", "docs_after"))
def q_doc_stream_table(spark, d):
    """D3 + S9: the stored documents after a stream of several batches with listings split over them."""
    root = scratch_folder(spark, "outlay-written", "doc-stream")
    old, inc, att = K._docs(spark, d)
    sinks.write_documents(spark, old, f"{root}/docs", 0)
    doc_sync.as_listings(inc, att).repartition(3).write.parquet(f"{root}/in")
    run = doc_sync.start_doc_sync(spark, f"{root}/in", f"{root}/docs", f"{root}/checkpoint", P.refreshed_at, files_per_batch=1)
    run.awaitTermination()
    if run.exception() is not None:
        raise run.exception()
    return doc_sync.read_current(spark, f"{root}/docs")


#: The project whose documents are looked up.
DOC_PROJECT = "100001"
_FOLDERS = f"""
SELECT {{head}} folder_category, sub_folder, doc_id, doc_name, doc_url, doc_type, doc_size, uploaded_by, uploaded_at,
  CAST(dense_rank() OVER (ORDER BY cat_first) AS INTEGER) AS category_position,
  CAST(dense_rank() OVER (PARTITION BY folder_category ORDER BY sub_first) AS INTEGER) AS sub_folder_position,
  CAST(row_number() OVER (PARTITION BY folder_category, sub_folder ORDER BY rn) AS INTEGER) AS doc_position
FROM (SELECT *, min(rn) OVER (PARTITION BY folder_category) AS cat_first,
             min(rn) OVER (PARTITION BY folder_category, sub_folder) AS sub_first
      FROM doc_labelled WHERE project_id = {O.q(DOC_PROJECT)})"""
_CHECKED = f"(SELECT max(last_checked) FROM docs_after WHERE project_id = {O.q(DOC_PROJECT)})"


def _unfold(payload: DataFrame, *head: str) -> DataFrame:
    """The documents of a JSON payload, each with the places of its folders and its own."""
    kind = ", ".join([f"{c} {'bigint' if c == 'doc_count' else 'string'}" for c in head] + [f"folders {DOC.TREE_TYPE}"])
    r = payload.select(F.from_json("json", kind).alias("r")).select("r.*")
    r = r.select(*head, F.posexplode("folders").alias("c", "category"))
    r = r.select(*head, "c", "category.folder_category", F.posexplode("category.subfolders").alias("s", "sub"))
    r = r.select(*head, "c", "folder_category", "s", "sub.sub_folder", F.posexplode("sub.docs").alias("n", "doc"))
    return r.select(*head, "folder_category", "sub_folder", "doc.*",
                    *[(F.col(p) + 1).alias(c) for p, c in (("c", "category_position"), ("s", "sub_folder_position"),
                                                           ("n", "doc_position"))])


@register("document_payload_json", O.sql(_FOLDERS.format(head=f"project_id, {_CHECKED} AS last_checked,"),
                                         "doc_labelled", "docs_after"))
def q_document_payload_json(spark, d):
    """S13 + F20 + O5: the JSON document tree of one project, parsed back with the order of its lists."""
    return _unfold(DOC.document_payload(K._docs_after(spark, d), DOC_PROJECT), "project_id", "last_checked")


@register("document_refresh_json", O.sql(_FOLDERS.format(
    head=f"project_id, (SELECT count(*) FROM doc_incoming WHERE project_id = {O.q(DOC_PROJECT)}) AS doc_count, "
         f"{_CHECKED} AS last_checked,"), "doc_labelled", "docs_after", "doc_incoming"))
def q_document_refresh_json(spark, d):
    """The JSON result of one project's document refresh, parsed back."""
    _, inc, _ = K._docs(spark, d)
    return _unfold(DOC.refresh_result(K._docs_after(spark, d), inc, DOC_PROJECT), "project_id", "doc_count", "last_checked")


# ---------------------------------------------------- nested detail, e-mail


@register("project_detail_orders", O.sql(f"""
SELECT p.project_id, CAST(b.budget_total AS DOUBLE) AS budget_total, o.po_number, CAST(o.po_total AS DOUBLE) AS po_total,
  {O.ts('o.created_date')} AS created_date,
  CAST(row_number() OVER (PARTITION BY p.project_id ORDER BY o.created_date NULLS FIRST, o.po_number NULLS FIRST) AS INTEGER)
    AS position
FROM projects p JOIN po o ON o.proj_def = p.proj_def LEFT JOIN budgets b ON b.proj_def = p.proj_def
WHERE p.project_id = {O.q(K.DETAIL_PROJECT)}""", "projects", "po", "budgets"))
def q_project_detail_orders(spark, d):
    """R3 + O5: the nested detail of one project, its POs unfolded in the order of the list."""
    out = PR.project_detail(K._cur(spark, d), K.DETAIL_PROJECT)
    return out.select("project_id", "budget", F.posexplode("purchase_orders").alias("at", "o")).select(
        "project_id", K.out_money(F.col("budget.budget_total")).alias("budget_total"), "o.po_number",
        K.out_money(F.col("o.po_total")).alias("po_total"), K.ts_text(F.col("o.created_date")).alias("created_date"),
        (F.col("at") + 1).alias("position"))


@register("email_file_lines", K.ORACLE["vendor_email_lines"])
def q_email_file_lines(spark, d):
    """The body lines of the e-mails, read back from the JSON that was written."""
    cur, root = K._cur(spark, d), scratch_folder(spark, "outlay-written", "email")
    selection = K._email_selection(cur)
    POS.write_email_report(cur, selection, root, K.AS_OF)
    return spark.read.schema(POS.vendor_email_lines(cur, selection, K.AS_OF).schema).json(f"{root}/lines")


@register("email_file_sections", K.ORACLE["vendor_email_report"])
def q_email_file_sections(spark, d):
    """The sections per vendor, read back from the JSON that was written."""
    cur, root = K._cur(spark, d), scratch_folder(spark, "outlay-written", "email")
    selection = K._email_selection(cur)
    POS.write_email_report(cur, selection, root, K.AS_OF)
    return spark.read.schema(POS.vendor_email_report(cur, selection, K.AS_OF).schema).json(f"{root}/sections")


@register("email_places", K._with_email("""
SELECT vendor, po_number, project_id, row_number() OVER (ORDER BY vendor NULLS FIRST, po_number NULLS FIRST,
  project_id NULLS FIRST) AS position FROM email_rows"""))
def q_email_places(spark, d):
    """The place of every selected PO row in the e-mail."""
    cur = K._cur(spark, d)
    return POS.email_places(cur, K._email_selection(cur), K.AS_OF)


# ------------------------------------------------------------- sorted copies

#: A deep page under a filter, from the copy in the order of the vendors.
COPY_FILTER = PoFilter(sort="vendor", order="asc", page_size=100, has_remaining=True)
COPY_AFTER = ("Supplier#000000030", "00000500", None)


def _copied_base(spark: SparkSession, d: str, f: PoFilter) -> SortedCopy:
    """The PO base in the order of ``f``, written once a session and input."""
    key = (spark.sparkContext.applicationId, d, repr(list_files(spark, d)), f.sort, f.order)
    if key not in _RUNS:
        _RUNS[key] = scratch_folder(spark, "outlay-written", "sorted")
        POS.sorted_base(K._cur(spark, d), f, _RUNS[key], K.AS_OF)
    return read_sorted(spark, _RUNS[key], POS.sorted_order(f))


@register("po_page_sorted_copy", K.ORACLE["po_page_keyset"])
def q_po_page_sorted_copy(spark, d):
    """O3 + O2: the keyset page from a sorted copy of the PO base; ranges away from the cursor are not read."""
    return POS.po_page_sorted(_copied_base(spark, d, K.KEYSET_FILTER), K.KEYSET_FILTER, K.KEYSET_AFTER)


#: A vendor's number, a part of a PO number, and a term whose wildcard parts it into literal runs.
FOUND_FILTER = PoFilter(sort="vendor", order="asc", search="Supplier#00000001; 0_07", has_remaining=True)


@register("po_search_indexed", O.sql(f"SELECT {O.PO_PRESENT} FROM po_base WHERE {K._po_where(FOUND_FILTER)}", "po_base"))
def q_po_search_indexed(spark, d):
    """F5 + F7: every PO row that a search selects, from the trigram index of a copy sorted by vendor."""
    copy = _copied_base(spark, d, FOUND_FILTER)
    key = (spark.sparkContext.applicationId, d, repr(list_files(spark, d)), "grams")
    if key not in _RUNS:
        _RUNS[key] = scratch_folder(spark, "outlay-written", "grams")
        POS.indexed_base(copy, _RUNS[key])
    return POS.po_search_indexed(read_index(copy, _RUNS[key]), FOUND_FILTER)


@register("po_page_sorted_filtered", O.sql(f"""
SELECT {O.PO_PRESENT} FROM po_base
WHERE remaining_to_invoice > 0 AND (vendor > 'Supplier#000000030' OR (vendor = 'Supplier#000000030'
  AND (po_number > '00000500' OR (po_number = '00000500' AND project_id IS NOT NULL))))
ORDER BY vendor ASC NULLS FIRST, po_number ASC NULLS FIRST, project_id ASC NULLS FIRST LIMIT 100""", "po_base"))
def q_po_page_sorted_filtered(spark, d):
    """O3 + F7: a filtered keyset page from the copy sorted by vendor."""
    return POS.po_page_sorted(_copied_base(spark, d, COPY_FILTER), COPY_FILTER, COPY_AFTER)
