"""Curated load rules: K2 projects, K3 budgets (X8), X7 banners, A18 backfill."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.expressions import MONEY, banner, zero_money
from .merge import pull_order
from .precedence import pick_by

PROJECT_COLUMNS = [
    "project_id", "project_type", "store", "sequence", "store_sequence", "city", "state", "project_status",
    "proj_def", "scope", "general_contractor", "store_type", "banner", "created_date", "complete_date",
    "comments_a", "comments_b", "updated_at",
]


def load_projects(pulled: DataFrame) -> DataFrame:
    """K2: first row per project id in pull order; NULL type rows never load."""
    src = pulled.filter(F.col("project_type").isNotNull()).withColumn("banner", banner(F.col("store_type")))
    return pick_by(src.select(*PROJECT_COLUMNS, "record_id"), ["project_id"], pull_order(),
                   keep_null_keys=True).select(*PROJECT_COLUMNS)


def load_budgets(pulled: DataFrame) -> DataFrame:
    """K3 + X8: the *last* pulled row per definition supplies the budget.

    This is the oldest-modified project, even one K2 dropped.
    """
    pd = F.col("proj_def")
    act = F.coalesce(F.col("actuals"), zero_money())
    com = F.coalesce(F.col("commitments"), zero_money())
    total = (act + com).cast(MONEY)
    src = pulled.filter(pd.isNotNull() & (pd != "")).select(
        "proj_def",
        F.when(total > 0, total).otherwise(F.coalesce(F.col("contract"), zero_money())).cast(MONEY).alias("budget_total"),
        com.alias("budget_open"),
        F.coalesce(F.col("contractor_po_amount"), zero_money()).alias("budget_committed"),
        act.alias("budget_actuals"),
        "updated_at", "record_id", "project_id",
    )
    return pick_by(src, ["proj_def"], pull_order(), last=True).select(
        "proj_def", "budget_total", "budget_open", "budget_committed", "budget_actuals", "updated_at")


def load_pos(merged: DataFrame) -> DataFrame:
    """Stored PO rows: amounts NULL -> 0 after the subtraction (7.4.13)."""
    return merged.select(
        "po_number", "proj_def", "vendor",
        F.lit(None).cast("string").alias("vendor_email"),  # in the schema, never loaded
        F.coalesce("po_total", zero_money()).cast(MONEY).alias("po_total"),
        F.coalesce("invoiced_to_date", zero_money()).cast(MONEY).alias("invoiced_to_date"),
        F.coalesce("remaining_to_invoice", zero_money()).cast(MONEY).alias("remaining_to_invoice"),
        "po_status", "created_date", "last_update",
    )


def top_vendor(pos: DataFrame) -> DataFrame:
    """Per definition, the vendor with the largest PO value.

    Ties go to the smaller vendor name (NULL lowest). Two partial
    aggregates; nothing is collected per definition.
    """
    per_vendor = pos.filter(F.col("proj_def").isNotNull()).groupBy("proj_def", "vendor").agg(
        F.sum("po_total").alias("vendor_total"))
    return per_vendor.groupBy("proj_def").agg(
        F.min_by(F.col("vendor"), F.struct((-F.col("vendor_total")).alias("t"), F.col("vendor").alias("v")))
        .alias("top_vendor"))


def backfill_contractor(projects: DataFrame, pos: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Overwrite the contractor of every project that has POs.

    ``seen`` observes the projects and those overwritten as the result is written.
    """
    tv = top_vendor(pos).withColumn("_has_po", F.lit(True))
    j = projects.join(tv, "proj_def", "left")
    if seen is not None:
        j = j.observe(seen, F.count(F.lit(1)).alias("load.projects"), F.count("_has_po").alias("backfill.contractor"))
    return j.select(
        *[F.when(F.col("_has_po"), F.col("top_vendor")).otherwise(F.col("general_contractor")).alias(c)
          if c == "general_contractor" else F.col(c) for c in PROJECT_COLUMNS]
    )
