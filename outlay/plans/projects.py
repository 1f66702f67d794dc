"""Dashboard and project reports: A1-A7, R1, R2 (F1/F2/F4/X9/O1), R3, A25.

Search (F2) optionally includes the PO/vendor existence test (F4). It is a
left join with the set of definitions whose POs match each term, so the PO
table is never collected and NULL keys simply do not match.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import MONEY, out_money, ts_text, zero_money
from ..functions.search import like_contains, parse_project_fields, project_search, split_terms
from ..operators.fund_nodes import node_years
from ..operators.load import PROJECT_COLUMNS
from ..operators.places import with_places
from ..params import TOP_K, ProjectFilter
from .curated import Curated


def _with_po_flags(projects: DataFrame, pos: DataFrame, search: str | None, fields) -> tuple[DataFrame, list[str]]:
    """Attach one boolean per search term: some PO of the definition matches."""
    terms = split_terms(search)
    if not terms or "po" not in parse_project_fields(fields):
        return projects, []
    flags = [f"_po_match_{i}" for i in range(len(terms))]
    hit = [F.coalesce(like_contains(F.col("po_number"), t) | like_contains(F.col("vendor"), t), F.lit(False))
           for t in terms]
    hits = (pos.filter(reduce(lambda a, b: a | b, hit) & F.col("proj_def").isNotNull()).groupBy("proj_def")
            .agg(*[F.max(h).alias(n) for n, h in zip(flags, hit)]))
    return projects.join(hits, "proj_def", "left"), flags


def search_projects(cur: Curated, search: str | None, fields=None, projects: DataFrame | None = None) -> DataFrame:
    """Projects matching the multi-term search (all rows when blank)."""
    base = projects if projects is not None else cur.projects
    withflags, flags = _with_po_flags(base, cur.pos, search, fields)
    terms = split_terms(search)

    def po_match(term: str) -> Column:
        return F.coalesce(F.col(flags[terms.index(term)]), F.lit(False))

    pred = project_search(search, fields, po_match if flags else None)
    out = withflags.filter(pred) if pred is not None else withflags
    return out.drop(*flags)


def _scope_defs(matched: DataFrame) -> DataFrame:
    return matched.filter(F.col("proj_def").isNotNull()).select("proj_def").distinct()


def kpi_stats(cur: Curated, search: str | None = None) -> DataFrame:
    """A1: six KPIs in one pass: a tagged union of the three tables, one aggregate.

    With a search, budgets and POs are scoped to the matched projects'
    definitions (J6, semi joins).
    """
    projects = search_projects(cur, search)
    budgets, pos = cur.budgets, cur.pos
    if split_terms(search):
        defs = _scope_defs(projects)
        budgets = budgets.join(defs, "proj_def", "left_semi")
        pos = pos.join(defs, "proj_def", "left_semi")
    nm = F.lit(None).cast(MONEY)
    ns = F.lit(None).cast("string")
    u = (
        projects.select(F.lit("p").alias("_t"), F.col("project_status").alias("_status"), nm.alias("_bt"),
                        nm.alias("_ba"), nm.alias("_rem"))
        .unionByName(budgets.select(F.lit("b").alias("_t"), ns.alias("_status"), F.col("budget_total").alias("_bt"),
                                    F.col("budget_actuals").alias("_ba"), nm.alias("_rem")))
        .unionByName(pos.select(F.lit("o").alias("_t"), ns.alias("_status"), nm.alias("_bt"), nm.alias("_ba"),
                                F.col("remaining_to_invoice").alias("_rem")))
    )
    t = F.col("_t")
    return u.agg(
        F.count(F.when(t == "p", 1)).alias("total_projects"),
        F.count(F.when((t == "p") & (F.col("_status") == "Active"), 1)).alias("active_projects"),
        out_money(F.coalesce(F.sum("_bt"), zero_money())).alias("total_budget"),
        out_money(F.coalesce(F.sum("_ba"), zero_money())).alias("total_actuals"),
        out_money(F.coalesce(F.sum("_rem"), zero_money())).alias("remaining_to_invoice"),
        F.count(F.when(t == "o", 1)).alias("total_pos"),
    )


def projects_by(cur: Curated, column: str, search: str | None = None) -> DataFrame:
    """A2 / A3: project count per type or status, largest first."""
    return (search_projects(cur, search).groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
            .orderBy(F.desc("cnt"), F.asc(column)))


def _with_budget(cur: Curated, search: str | None) -> DataFrame:
    return search_projects(cur, search).join(cur.budgets.drop("updated_at"), "proj_def", "left")


def budget_by_type(cur: Curated, search: str | None = None) -> DataFrame:
    """A4: four budget sums per type over J3; NULL -> 0."""
    cols = ("budget_total", "budget_actuals", "budget_committed", "budget_open")
    return (_with_budget(cur, search).groupBy("project_type")
            .agg(*[out_money(F.coalesce(F.sum(c), zero_money())).alias(c) for c in cols])
            .orderBy(F.desc("budget_total"), F.asc("project_type")))


def top_contractors(cur: Curated, search: str | None = None, k: int = TOP_K) -> DataFrame:
    """Top-k contractors by project count (NULL is a group)."""
    return (_with_budget(cur, search).groupBy("general_contractor")
            .agg(F.count(F.lit(1)).alias("project_count"),
                 out_money(F.coalesce(F.sum("budget_total"), zero_money())).alias("total_budget"))
            .orderBy(F.desc("project_count"), F.asc("general_contractor"))
            .limit(k))


def po_status_summary(cur: Curated, search: str | None = None, coalesce_total: bool = False) -> DataFrame:
    """PO count and value per status (export variant coalesces the sum)."""
    pos = cur.pos
    if split_terms(search):
        pos = pos.join(_scope_defs(search_projects(cur, search)), "proj_def", "left_semi")
    total = F.sum("po_total")
    if coalesce_total:
        total = F.coalesce(total, zero_money())
    return (pos.groupBy("po_status").agg(F.count(F.lit(1)).alias("cnt"), out_money(total).alias("total"))
            .orderBy(F.desc("cnt"), F.asc("po_status")))


def po_totals_by_def(pos: DataFrame) -> DataFrame:
    """PO totals per definition (aggregated before the J4 join)."""
    return pos.groupBy("proj_def").agg(F.sum("po_total").alias("total_po"),
                                       F.sum("invoiced_to_date").alias("total_invoiced"))


# Fixed values (API keys).
PROJECT_SORT = {
    "project_id": "project_id",
    "project_type": "project_type",
    "store": "store",
    "banner": "banner",
    "location": "city",
    "project_status": "project_status",
    "scope": "scope",
    "general_contractor": "general_contractor",
    "budget_total": "budget_total",
    "budget_actuals": "budget_actuals",
    "created_date": "created_date",
    "construction_complete_date": "complete_date",
}

AMOUNTS = ("budget_total", "budget_actuals", "budget_committed", "budget_open")


def project_rows(cur: Curated, f: ProjectFilter) -> DataFrame:
    """R2 rows before sorting: F22 + J3 + J4 + X9 + F1 + F2/F4."""
    projects = cur.projects
    for value, col in ((f.project_type, "project_type"), (f.status, "project_status"),
                       (f.contractor, "general_contractor"), (f.banner, "banner")):
        if value:
            projects = projects.filter(F.col(col) == F.lit(value))
    projects = search_projects(cur, f.search, f.search_fields, projects)
    b = cur.budgets.select("proj_def", *[F.col(c).alias("b_" + c) for c in AMOUNTS])
    j = projects.join(b, "proj_def", "left").join(po_totals_by_def(cur.pos), "proj_def", "left")
    z = zero_money()
    return j.select(
        *PROJECT_COLUMNS,
        F.coalesce("total_po", "b_budget_total", z).cast(MONEY).alias("budget_total"),
        F.coalesce("total_invoiced", "b_budget_actuals", z).cast(MONEY).alias("budget_actuals"),
        F.coalesce("total_po", "b_budget_committed", z).cast(MONEY).alias("budget_committed"),
        F.coalesce(F.col("total_po") - F.col("total_invoiced"), "b_budget_open", z).cast(MONEY).alias("budget_open"),
    )


def present_projects(df: DataFrame) -> DataFrame:
    ts = ("created_date", "complete_date", "updated_at")
    return df.select(*[ts_text(F.col(c)).alias(c) if c in ts else out_money(F.col(c)).alias(c) if c in AMOUNTS
                       else F.col(c) for c in df.columns])


def project_list(cur: Curated, f: ProjectFilter | None = None) -> DataFrame:
    """R2: filtered projects with PO-first amounts, allow-listed sort (O1).

    The sort is the report's edge; ties fall back to project_id.
    """
    f = f or ProjectFilter()
    return present_projects(project_rows(cur, f).orderBy(*list_order(f)))


def list_order(f: ProjectFilter) -> list[Column]:
    """O1 with its project_id tie-break."""
    key = F.col(PROJECT_SORT.get(f.sort or "", "project_id"))
    return [key.desc() if f.order == "desc" else key.asc(), F.asc("project_id")]


def project_places(cur: Curated, f: ProjectFilter) -> DataFrame:
    """O1: the place of every project of the list."""
    narrow = dict.fromkeys(("project_id", PROJECT_SORT.get(f.sort or "", "project_id")))
    return with_places(project_rows(cur, f).select(*narrow), list_order(f)).select("project_id", "position")


def project_detail_rows(cur: Curated, project_id: str) -> DataFrame:
    """R3 flattened: the project, its budget and one row per PO (by created date)."""
    p = cur.projects.filter(F.col("project_id") == F.lit(project_id))
    b = cur.budgets.select("proj_def", *[F.col(c).alias(c) for c in AMOUNTS],
                           F.col("updated_at").alias("budget_updated_at"))
    po = cur.pos.filter(F.col("proj_def").isNotNull()).select(
        "proj_def", "po_number", "vendor", F.col("po_total"), F.col("invoiced_to_date"),
        F.col("remaining_to_invoice"), "po_status", F.col("created_date").alias("po_created_date"),
        F.col("last_update").alias("po_last_update"))
    j = p.join(b, "proj_def", "left").join(po, "proj_def", "left")
    money_cols = set(AMOUNTS) | {"po_total", "invoiced_to_date", "remaining_to_invoice"}
    ts = {"created_date", "complete_date", "updated_at", "budget_updated_at", "po_created_date", "po_last_update"}
    return j.select(*[out_money(F.col(c)).alias(c) if c in money_cols else ts_text(F.col(c)).alias(c) if c in ts
                      else F.col(c) for c in j.columns])


def project_detail(cur: Curated, project_id: str) -> DataFrame:
    """R3 nested: one row, ``budget`` struct and ``purchase_orders`` array.

    A point lookup: the array holds one project's POs, sorted by created date.
    """
    p = cur.projects.filter(F.col("project_id") == F.lit(project_id))
    b = cur.budgets.select("proj_def", F.struct(*[F.col(c) for c in cur.budgets.columns]).alias("budget"))
    po = (cur.pos.join(p.select("proj_def"), "proj_def", "left_semi")
          .groupBy("proj_def")
          .agg(F.array_sort(F.collect_list(F.struct("created_date", *[c for c in cur.pos.columns
                                                                      if c != "created_date"])))
               .alias("purchase_orders")))
    return (p.join(b, "proj_def", "left").join(po, "proj_def", "left")
            .withColumn("purchase_orders", F.coalesce("purchase_orders", F.array())))


def project_options(cur: Curated) -> DataFrame:
    """A25 (project side): distinct option values with their place in the list.

    Types and statuses stand by number of projects, years newest first,
    contractors and banners ascending. One pass over the projects.
    """
    def entry(option: str, value: Column, counted: bool) -> Column:
        return F.struct(F.lit(option).alias("option"), value.alias("value"), F.lit(counted).alias("any"))

    p = F.explode(F.array(
        entry("project_type", F.col("project_type"), True), entry("project_status", F.col("project_status"), True),
        entry("contractor", F.when(F.col("general_contractor") != "", F.col("general_contractor")), False),
        entry("banner", F.col("banner"), False))).alias("o")
    counted = (cur.projects.select(p).select("o.*").filter(F.col("any") | F.col("value").isNotNull())
               .groupBy("option", "value", "any").agg(F.count(F.lit(1)).alias("n")))
    years = node_years(cur.fund_nodes).select(
        F.lit("fiscal_year").alias("option"), F.col("approval_year").cast("string").alias("value"),
        F.lit(True).alias("any"), F.col("approval_year").cast("long").alias("n"))
    place = F.row_number().over(Window.partitionBy("option").orderBy(
        F.when(F.col("any"), F.col("n")).desc(), F.col("value").asc()))
    return counted.unionByName(years).select("option", "value", place.alias("position"))


def dashboard(cur: Curated, search: str | None = None) -> dict[str, DataFrame]:
    """The dashboard's datasets; the search scopes all but the fund nodes."""
    from ..operators.fund_nodes import node_budgets
    return {
        "stats": kpi_stats(cur, search),
        "by_type": projects_by(cur, "project_type", search),
        "by_status": projects_by(cur, "project_status", search),
        "budget_by_type": budget_by_type(cur, search),
        "contractors": top_contractors(cur, search),
        "po_summary": po_status_summary(cur, search),
        "fund_nodes": node_budgets(cur.fund_nodes),
        "fund_years": node_years(cur.fund_nodes),
    }


TYPE_WORDS = ("HOUSEHOLD", "MACHINERY", "BUILDING")


def display_rows(rows: DataFrame, program_token: str, words: tuple[str, ...] = TYPE_WORDS) -> DataFrame:
    """Display fields of the project table."""
    from ..functions.expressions import (blank_sentinel, currency_text, date_prefix, location_text,
                                         short_currency, type_category, type_label)
    return rows.select(
        "*",
        type_label(F.col("project_type"), program_token).alias("type_label"),
        type_category(F.col("project_type"), words).alias("type_category"),
        location_text(F.col("city"), F.col("state")).alias("location"),
        date_prefix(F.col("created_date")).alias("created_day"),
        date_prefix(blank_sentinel(F.col("complete_date"))).alias("completed_day"),
        currency_text(F.col("budget_total")).alias("budget_total_text"),
        short_currency(F.col("budget_actuals")).alias("budget_actuals_short"),
    )
