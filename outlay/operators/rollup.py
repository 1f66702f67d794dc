"""PO line rollups (A8, A9, A10) and the fund-node report rollup.

PO value and invoice value sit on separate line rows, so both are summed
independently per PO group and only then compared (HAVING, not a row
filter). Sums are DECIMAL; the remainder is subtracted first and coalesced
to 0 at load time, as the reference stores it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import MONEY, po_key
from ..params import SourceParams


_MEASURES = {"po_total": "decimal(28,2)", "invoiced_to_date": "decimal(28,2)"}


def _roll_up(lines: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Totals, status and dates of each group of lines that holds any value.

    The status is a string, and a string maximum would make Spark sort all
    lines. Lines are therefore first hash-aggregated with the status as a
    further key; its maximum is taken over the few rows that are left.
    """
    first = lines.groupBy(*[c.alias(n) for n, c in keys.items()], "pur_doc_sts").agg(
        F.sum("net_amt").alias("po_total"), F.sum("inv_amt").alias("invoiced_to_date"),
        F.min("document_date").alias("created_date"), F.max("ods_updated").alias("last_update"))
    net, inv = (F.sum(c).cast(t) for c, t in _MEASURES.items())
    return first.groupBy(*keys).agg(
        net.alias("po_total"), inv.alias("invoiced_to_date"), (net - inv).cast(MONEY).alias("remaining_to_invoice"),
        F.max("pur_doc_sts").alias("po_status"), F.min("created_date").alias("created_date"),
        F.max("last_update").alias("last_update"),
    ).filter((F.col("po_total") > 0) | (F.col("invoiced_to_date") > 0))


def program_keys(raw_projects: DataFrame, params: SourceParams) -> DataFrame:
    """U3/J2 key side: distinct program project definitions and their PO form.

    No active flag here (F14): POs of inactive projects load without a
    project row.
    """
    pd = F.col("proj_def")
    return (
        raw_projects
        .filter(F.upper("program_type").contains(params.program_token.upper()) & pd.isNotNull() & (pd != ""))
        .select("proj_def").distinct()
        .select("proj_def", po_key(pd).alias("po_key"))
    )


def direct_rollup(po_lines: DataFrame, keys: DataFrame) -> DataFrame:
    """(po, project definition, vendor) rollup of lines on program keys."""
    j = po_lines.join(keys, po_lines["project_definition"] == keys["po_key"], "inner")
    return _roll_up(j, {"po_number": F.col("po_nbr"), "proj_def": F.col("proj_def"), "vendor": F.col("vendor_name")})


def vendor_allowed(vendor: Column, vendors: tuple[str, ...]) -> Column:
    """OR of case-insensitive substring tests against the allow-list."""
    up = F.upper(vendor)
    return reduce(lambda a, b: a | b, [up.contains(v.upper()) for v in vendors])


def umbrella_rollup(po_lines: DataFrame, params: SourceParams) -> DataFrame:
    """Umbrella-key lines of listed vendors by (store, po, vendor, item_text)."""
    src = po_lines.filter((F.col("project_definition") == params.umbrella_key)
                          & vendor_allowed(F.col("vendor_name"), params.umbrella_vendors))
    return _roll_up(src, {"store_nbr": F.col("store_nbr"), "po_number": F.col("po_nbr"),
                          "vendor": F.col("vendor_name"), "item_text": F.col("item_text")})


def comment_rollup(po_lines: DataFrame, referenced: DataFrame) -> DataFrame:
    """A10: (po, vendor) rollup of the PO numbers mined from comments.

    ``referenced`` (one row per PO number) restricts the lines by a semi
    join; its size follows the project table, so the planner (and AQE at
    run time) decides whether it is broadcast.
    """
    src = po_lines.join(referenced.select(F.col("po_number").alias("po_nbr")), "po_nbr", "left_semi")
    return _roll_up(src, {"po_number": F.col("po_nbr"), "vendor": F.col("vendor_name")})


#: Rollups of the line facts, by the rank of their source in the merge.
DIRECT, UMBRELLA, COMMENT = 1, 2, 3


def tagged_rollup(po_lines: DataFrame, keys: DataFrame, referenced: DataFrame, params: SourceParams) -> DataFrame:
    """A8, A9 and A10 in one pass over the line facts.

    Every line is tagged with the rollups it feeds (a line can feed several) and
    the lines are grouped once by rollup and key: ``source_rank``, ``po_number``, ``vendor``,
    and ``proj_def`` (direct, comment) or ``store_nbr`` and ``item_text`` (umbrella).

    Lines are dealt by PO number once, after their definition is known and with the
    fields of other rollups left out. Every later key holds the PO number, so the look-up of the
    references, both steps of the rollup and the merge need no further exchange.
    """
    # definitions that share a key make copies of a line; only the first copy bears the other tags
    turn = F.row_number().over(Window.partitionBy("po_key").orderBy("proj_def"))
    defs = keys.select("po_key", F.col("proj_def").alias("_def"), (turn == 1).alias("_one"))
    refs = referenced.select(F.col("po_number").alias("_ref_po"), F.col("proj_def").alias("_ref_def"))
    measures = ["net_amt", "inv_amt", "pur_doc_sts", "document_date", "ods_updated"]
    umbrella = (F.col("project_definition") == params.umbrella_key) & vendor_allowed(F.col("vendor_name"), params.umbrella_vendors)
    lines = po_lines.select("po_nbr", "vendor_name", "project_definition", umbrella.alias("_umbrella"),
                            *[F.when(umbrella, F.col(c)).alias(c) for c in ("store_nbr", "item_text")], *measures)
    j = (lines.join(defs, F.col("project_definition") == F.col("po_key"), "left").drop("project_definition", "po_key")
         .repartition("po_nbr").join(refs, F.col("po_nbr") == F.col("_ref_po"), "left"))
    none, text = F.lit(None).cast("long"), F.lit(None).cast("string")

    def tag(cond: Column, rank: int, proj_def: Column, store: Column = none, item: Column = text) -> Column:
        return F.when(cond, F.struct(F.lit(rank).alias("source_rank"), proj_def.alias("proj_def"),
                                     store.cast("long").alias("store_nbr"), item.alias("item_text")))

    one = F.coalesce("_one", F.lit(True))
    tags = F.array(tag(F.col("_def").isNotNull(), DIRECT, F.col("_def")),
                   tag(F.col("_umbrella") & one, UMBRELLA, text, F.col("store_nbr"), F.col("item_text")),
                   tag(F.col("_ref_po").isNotNull() & one, COMMENT, F.col("_ref_def")))
    tagged = j.select("po_nbr", "vendor_name", *measures, F.explode(tags).alias("_t")).filter(
        F.col("_t").isNotNull()).select("po_nbr", "vendor_name", *measures, "_t.*")
    return _roll_up(tagged, {"source_rank": F.col("source_rank"), "po_number": F.col("po_nbr"),
                             "proj_def": F.col("proj_def"), "vendor": F.col("vendor_name"),
                             "store_nbr": F.col("store_nbr"), "item_text": F.col("item_text")})


NODE_MEASURES = [
    ("original_budget", "original_budget"),
    ("supplemental_budget", "supplemental_budget"),
    ("returned_budget", "returned_budget"),
    ("current_budget", "current_budget"),
    ("total_actual", "actuals"),
    ("total_commitments", "open_commitments"),
    ("current_budget_available", "budget_available"),
    ("distributed_budget", "distributed_budget"),
    ("budget_cf_from_previous_fiscal_year", "budget_cf_from_prev"),
    ("budget_cf_to_next_fiscal_year", "budget_cf_to_next"),
]


def node_year_rollup(raw_nodes: DataFrame, params: SourceParams) -> DataFrame:
    """Tracked node x year; text amounts read through try_cast.

    A string maximum and a distinct count beside the sums would make Spark sort all rows and
    shuffle every sum once a project. Each row therefore counts twice: under its description,
    with the amounts, and under its project, without. Both are hash-aggregated; few rows are left for the maximum.
    """
    tracked = [k for k, _ in params.tracked_nodes]
    outs = [out for _, out in NODE_MEASURES]
    src = raw_nodes.filter(F.upper("program_position").isin(tracked) & F.col("approval_year").isNotNull()).select(
        "program_position", "approval_year", "program_position_desc", "project_no",
        *[F.expr(f"try_cast({src_col} AS {MONEY})").alias(out) for src_col, out in NODE_MEASURES],
        F.explode(F.array(F.lit(False), F.lit(True))).alias("_by_project"))
    whole, single = ~F.col("_by_project"), F.col("_by_project")
    keys = ["program_position", "approval_year", "_by_project"]
    first = src.groupBy(*keys, F.when(whole, F.col("program_position_desc")).alias("_desc"),
                        F.when(single, F.col("project_no")).alias("_project")).agg(
        *[F.sum(F.when(whole, F.col(m))).alias(m) for m in outs])
    few = first.groupBy(*keys, "_desc").agg(F.count("_project").alias("_projects"), *[F.sum(m).alias(m) for m in outs])
    return few.groupBy(*keys[:2]).agg(
        F.max("_desc").alias("description"), F.sum("_projects").cast("int").alias("project_count"),
        *[F.sum(m).cast("decimal(28,2)").alias(m) for m in outs])
