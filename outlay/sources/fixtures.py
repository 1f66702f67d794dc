"""Landed raw inputs derived from the driver tables (FIXTURES.md part B).

In production these frames are the warehouse extracts (project master,
enrichment, PO line view, fund-node report, document snapshots). Here every
one of them is a Spark plan over the TPC-H-like tables, so its size grows
with the scale factor and the filters/projections reach the parquet scans.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expressions import mime_type, money
from ..params import SourceParams
from .testdata import read_table


def proj_key(k: Column) -> Column:
    """6-digit key; customers 8 and 9 of each ten share one (fan-out)."""
    return F.lpad(F.when(k % 10 == 9, k - 1).otherwise(k).cast("string"), 6, "0")


def _customer_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate"])
    return orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"),
        F.max("o_orderdate").alias("last_order"),
    )


def raw_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Project master extract (one row per record)."""
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    k = F.col("c_custkey")
    status = (
        F.when(k % 6 <= 2, "Active").when(k % 6 == 3, "Complete")
        .when(k % 6 == 4, "On Hold").otherwise("Cancelled")
    )
    store_type = (
        F.when(k % 5 == 0, "SUP").when(k % 5 == 1, "sam ").when(k % 5 == 2, "GDC")
        .when(k % 5 == 3, "").otherwise(F.lit(None).cast("string"))
    )
    df = (
        cust
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
        .join(_customer_spans(spark, sf_dir), k == F.col("o_custkey"), "left")
    )
    return df.select(
        k.alias("record_id"),
        # every 7th record belongs to another programme; the program filter (F13) drops it
        F.concat(F.when(k % 7 == 0, F.lit("OTHER ")).otherwise(F.lit("PROG ")), F.col("c_mktsegment"))
        .alias("program_type"),
        (k % 97).alias("store_nbr"),
        F.concat(F.lit("PD-"), proj_key(k)).alias("proj_def"),
        status.alias("project_status"),
        F.col("n_name").alias("state"),
        F.concat(F.lit("City "), (k % 41).cast("string")).alias("city"),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("GC "), (k % 23).cast("string"))).alias("contractor"),
        store_type.alias("store_type"),
        (k % 13 != 0).alias("is_active"),
        F.col("last_order").cast("timestamp").alias("date_modified"),
        F.when(k % 9 == 0, F.lit(None)).otherwise(money(F.abs(F.col("c_acctbal")))).alias("actuals"),
        F.when(k % 3 == 0, money(F.lit(0))).otherwise(money(k)).alias("commitments"),
        money(k * 10).alias("contract"),
        money(k * 2).alias("contractor_po_amount"),
        F.col("first_order").cast("timestamp").alias("created_date"),
        F.when(status == "Complete", F.col("last_order").cast("timestamp"))
        .otherwise(F.lit("9999-12-31 00:00:00").cast("timestamp")).alias("complete_date"),
    )


def enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment extract keyed by project definition (may hold duplicates)."""
    cust = read_table(spark, sf_dir, "customer", ["c_custkey"])
    k = F.col("c_custkey")
    seq = F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise((k + 1000).cast("string"))
    comment = F.when(
        k % 5 == 0,
        F.concat(
            F.lit("see acme po# "), F.lpad(k.cast("string"), 8, "0"),
            F.lit("; installer po "), F.lpad((k + 1).cast("string"), 9, "0"), F.lit(" ok"),
        ),
    )
    # every 20th enrichment row carries a definition no project uses (unmatched J1 side)
    return cust.select(
        F.concat(F.when(k % 20 == 0, F.lit("XD-")).otherwise(F.lit("PD-")), proj_key(k)).alias("proj_def"),
        (k + 100000).alias("entity_id"),
        seq.alias("seq"),
        F.concat((k % 97).cast("string"), F.lit("."), seq).alias("store_seq"),
        F.when(k % 11 == 0, F.lit("Duplicate of earlier"))
        .otherwise(F.concat(F.lit("Replace unit "), k.cast("string"))).alias("scope"),
        F.when(k % 8 == 0, F.lit("!Unknown"))
        .otherwise(F.concat(F.lit("Firm "), (k % 17).cast("string"))).alias("firm"),
        comment.alias("comments_a"),
        F.when(k % 2 == 0, F.lit("reviewed")).alias("comments_b"),
        F.when(k % 10 != 3, F.date_add(F.lit("2001-01-01").cast("date"), (k % 250).cast("int")).cast("timestamp"))
        .alias("ods_updated"),
    )


def raw_po(spark: SparkSession, sf_dir: str, params: SourceParams | None = None) -> DataFrame:
    """PO line view: one row per line; PO value and invoice on separate rows."""
    p = params or SourceParams()
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
                     "l_linestatus", "l_shipdate"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])
    supp = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name"])
    df = (
        li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
        .join(supp, F.col("l_suppkey") == F.col("s_suppkey"), "inner")
    )
    price = money(F.col("l_extendedprice"))
    zero = money(F.lit(0))
    return df.select(
        F.lpad(F.col("l_orderkey").cast("string"), 8, "0").alias("po_nbr"),
        F.when(F.col("l_partkey") % 25 == 0, F.lit(p.umbrella_key))
        .otherwise(F.concat(F.lit("PD"), proj_key(F.col("o_custkey")), F.lit("00000"))).alias("project_definition"),
        (F.col("o_custkey") % 97).alias("store_nbr"),
        F.when(F.col("l_linenumber") % 2 == 0,
               F.concat(((F.col("o_custkey") + 1) % 120).cast("string"), F.lit(p.item_store_suffix)))
        .otherwise(F.lit("misc")).alias("item_text"),
        F.col("s_name").alias("vendor_name"),
        F.when(F.col("l_linestatus") == "O", price).otherwise(zero).alias("net_amt"),
        F.when(F.col("l_linestatus") == "F", price).otherwise(zero).alias("inv_amt"),
        F.when(F.col("o_orderstatus") == "O", "Open").when(F.col("o_orderstatus") == "F", "Closed")
        .otherwise("Partially Invoiced").alias("pur_doc_sts"),
        F.col("o_orderdate").cast("timestamp").alias("document_date"),
        F.col("l_shipdate").cast("timestamp").alias("ods_updated"),
    )


def _amount_text(c: Column) -> Column:
    return money(c).cast("string")


def raw_nodes(spark: SparkSession, sf_dir: str, params: SourceParams | None = None) -> DataFrame:
    """Fund-node report rows; amounts arrive as text (some not numeric)."""
    p = params or SourceParams()
    tracked = [k for k, _ in p.tracked_nodes]
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
                     "l_discount", "l_tax", "l_returnflag", "l_linestatus"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    # upper(lower(x)) = upper(x), so the tracked-node test can already prune part.
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_type"]).filter(F.upper("p_type").isin(tracked))
    df = (
        li.join(part, F.col("l_partkey") == F.col("p_partkey"), "inner")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
    )
    price = money(F.col("l_extendedprice"))
    supplemental = money(F.col("l_quantity") * 100)
    returned = F.when(F.col("l_returnflag") == "R", price).otherwise(money(F.lit(0)))
    current = price + supplemental - returned
    actual = F.when(F.col("l_linestatus") == "F", price).otherwise(money(F.lit(0)))
    commit = F.when(F.col("l_linestatus") == "O", price).otherwise(money(F.lit(0)))
    return df.select(
        F.when(F.col("l_linenumber") == 7, F.lower("p_type")).otherwise(F.col("p_type")).alias("program_position"),
        F.year("o_orderdate").alias("approval_year"),
        F.col("o_custkey").alias("project_no"),
        F.concat(F.col("p_type"), F.lit(" node")).alias("program_position_desc"),
        F.when(F.col("l_linenumber") == 6, F.lit("n/a")).otherwise(_amount_text(price)).alias("original_budget"),
        _amount_text(supplemental).alias("supplemental_budget"),
        _amount_text(returned).alias("returned_budget"),
        _amount_text(current).alias("current_budget"),
        _amount_text(actual).alias("total_actual"),
        _amount_text(commit).alias("total_commitments"),
        _amount_text(current - actual - commit).alias("current_budget_available"),
        _amount_text(F.when(F.col("l_linenumber") == 1, price).otherwise(money(F.lit(0)))).alias("distributed_budget"),
        _amount_text(F.round(F.col("l_discount") * 100).cast("int") * 10).alias("budget_cf_from_previous_fiscal_year"),
        _amount_text(F.round(F.col("l_tax") * 100).cast("int") * 10).alias("budget_cf_to_next_fiscal_year"),
    )


def _doc_base(spark: SparkSession, sf_dir: str, params: SourceParams) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "lang", "source", "n_chars"])
    d = F.col("doc_id")
    ext = (
        F.when(d % 5 == 0, F.lit(".pdf")).when(d % 5 == 1, F.lit(".docx")).when(d % 5 == 2, F.lit(".jpg"))
        .when(d % 5 == 3, F.lit("")).otherwise(F.lit(".PNG"))
    )
    name = F.concat(F.lit("doc_"), d.cast("string"), ext)
    folder_id = F.concat(F.lit("F"), (d % 200).cast("string"), F.lit("-"), F.col("lang"))
    doc_id = d.cast("string")
    return docs.select(
        doc_id.alias("doc_id"),
        (d % 200 + 100000).cast("string").alias("project_id"),
        folder_id.alias("folder_id"),
        F.when(d % 17 == 0, F.lit(None).cast("string")).when(d % 19 == 0, F.lit(""))
        .otherwise(F.col("lang")).alias("folder_category"),
        F.when(d % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("source")).alias("sub_folder"),
        name.alias("doc_name"),
        F.format_string(f"{params.doc_url_base}/download?documentID=%s&folderID=%s", doc_id, folder_id).alias("doc_url"),
        mime_type(name).alias("doc_type"),
        F.col("n_chars").cast("string").alias("doc_size"),
        F.concat(F.lit("user"), (d % 7).cast("string")).alias("uploaded_by"),
        F.date_format(F.date_add(F.lit("2001-01-01").cast("date"), (d % 300).cast("int")), "yyyy-MM-dd").alias("uploaded_at"),
        d.alias("_n"),
    )


def doc_old(spark: SparkSession, sf_dir: str, params: SourceParams | None = None) -> DataFrame:
    """Stored document table before the sync."""
    p = params or SourceParams()
    b = _doc_base(spark, sf_dir, p)
    n = F.col("_n")
    return b.filter(n % 3 != 0).select(
        *[c for c in b.columns if c not in ("_n", "uploaded_by")],
        F.lit("legacy").alias("uploaded_by"),
        F.lit("2001-11-01 00:00:00").alias("last_checked"),
        F.when(n % 10 == 0, 1).otherwise(0).alias("is_deleted"),
    ).select(*DOC_COLUMNS)


def doc_attempted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projects whose folder listing succeeded in this sync (explicit set)."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id"])
    p = F.col("doc_id") % 200
    return docs.filter(p % 6 != 0).select((p + 100000).cast("string").alias("project_id")).distinct()


def doc_incoming(spark: SparkSession, sf_dir: str, params: SourceParams | None = None) -> DataFrame:
    """Snapshot returned by the sync for the attempted projects."""
    p = params or SourceParams()
    b = _doc_base(spark, sf_dir, p)
    n = F.col("_n")
    return b.filter((n % 4 != 0) & ((n % 200) % 6 != 0)).select(
        *[c for c in b.columns if c != "_n"],
        F.lit(p.refreshed_at).alias("last_checked"),
        n.alias("arrival_seq"),
    )


DOC_COLUMNS = [
    "doc_id", "project_id", "folder_id", "folder_category", "sub_folder", "doc_name", "doc_url",
    "doc_type", "doc_size", "uploaded_by", "uploaded_at", "last_checked", "is_deleted",
]


@dataclass
class RawInputs:
    """The landed inputs of one refresh."""

    projects: DataFrame
    enrichment: DataFrame
    po_lines: DataFrame
    nodes: DataFrame


def load_raw(spark: SparkSession, sf_dir: str, params: SourceParams | None = None) -> RawInputs:
    p = params or SourceParams()
    return RawInputs(
        projects=raw_projects(spark, sf_dir),
        enrichment=enrichment(spark, sf_dir),
        po_lines=raw_po(spark, sf_dir, p),
        nodes=raw_nodes(spark, sf_dir, p),
    )
