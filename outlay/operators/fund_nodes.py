"""Fund nodes: A11 load with K4 and J13, A12 / A16 rollups, A17 totals, X22/X23/X34."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import MONEY, safe_pct, zero_money
from ..params import NOT_FOUND_DESCRIPTION, SourceParams
from .precedence import pick_by
from .rollup import NODE_MEASURES, node_year_rollup

MEASURES = [out for _, out in NODE_MEASURES]
NODE_COLUMNS = ["node_key", "approval_year", "node_label", "description", *MEASURES, "project_count", "last_updated"]


def _label_map(params: SourceParams) -> Column:
    items = []
    for k, v in params.tracked_nodes:
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def load_fund_nodes(raw_nodes: DataFrame, params: SourceParams) -> DataFrame:
    """A11 + K4 + J13: the stored node x year table.

    The rollup groups by the raw node text; the key is upper-cased only
    afterwards, and the last group in (node, year) order wins (K4). Tracked
    nodes absent from the report get placeholder rows for every year seen.
    """
    rows = node_year_rollup(raw_nodes, params).withColumn("node_key", F.upper("program_position"))
    won = pick_by(rows, ["node_key", "approval_year"], [F.col("program_position")], last=True)
    stamp = F.lit(params.refreshed_at + " UTC")
    loaded = won.select(
        "node_key",
        F.coalesce(F.col("approval_year"), F.lit(0)).cast("int").alias("approval_year"),
        F.coalesce(_label_map(params)[F.col("node_key")], F.col("node_key")).alias("node_label"),
        "description",
        *[F.coalesce(F.col(m), zero_money()).cast(MONEY).alias(m) for m in MEASURES],
        F.coalesce(F.col("project_count"), F.lit(0)).cast("int").alias("project_count"),
        stamp.alias("last_updated"),
    )
    # Placeholders come from two small sets, the years and the keys found;
    # the stored rows stay rows. At most tracked nodes x years placeholders.
    g = loaded.agg(F.collect_set("approval_year").alias("years"), F.collect_set("node_key").alias("found"))
    tracked = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("label")) for k, v in params.tracked_nodes])
    years = F.when(F.size("years") > 0, F.col("years")).otherwise(F.array(F.lit(0)))
    missing = F.filter(tracked, lambda t: ~F.array_contains(F.col("found"), t["k"]))

    def placeholder(t, y):
        return F.struct(t["k"].alias("node_key"), y.cast("int").alias("approval_year"),
                        t["label"].alias("node_label"), F.lit(NOT_FOUND_DESCRIPTION).alias("description"),
                        *[zero_money().alias(m) for m in MEASURES], F.lit(0).alias("project_count"),
                        stamp.alias("last_updated"))

    extra = F.flatten(F.transform(missing, lambda t: F.transform(years, lambda y: placeholder(t, y))))
    return loaded.select(*NODE_COLUMNS).unionByName(g.select(F.explode(extra).alias("r")).select("r.*"))


def node_budgets(nodes: DataFrame, year: int | None = None) -> DataFrame:
    """A12 (+F25): one year's rows as stored, or all years summed per node."""
    if year:
        return nodes.filter(F.col("approval_year") == year).select(*NODE_COLUMNS).orderBy("node_key")
    return nodes.groupBy("node_key", "node_label").agg(
        F.max("description").alias("description"),
        F.lit(0).alias("approval_year"),
        *[F.sum(m).cast(MONEY).alias(m) for m in MEASURES],
        F.sum("project_count").cast("long").alias("project_count"),
        F.max("last_updated").alias("last_updated"),
    ).select(*NODE_COLUMNS).orderBy("node_key")


def node_years(nodes: DataFrame) -> DataFrame:
    """Distinct positive fiscal years (A25 years; shown newest first)."""
    return nodes.filter(F.col("approval_year") > 0).select("approval_year").distinct()


def node_panel(nodes: DataFrame, year: int | None = None) -> DataFrame:
    """R7 cards: A12 plus X22 percentages and X23 over-budget figures."""
    b = node_budgets(nodes, year)
    cur, avail = F.col("current_budget"), F.col("budget_available")
    spent = safe_pct(F.col("actuals"), cur)
    return b.select(
        "node_key", "node_label", "approval_year", "project_count",
        *[F.col(m).cast("double").alias(m) for m in ("current_budget", "actuals", "open_commitments", "budget_available")],
        (cur > 0).alias("has_budget"),
        spent.alias("pct_spent"),
        safe_pct(F.col("open_commitments"), cur).alias("pct_committed"),
        safe_pct(avail, cur).alias("pct_available"),
        (avail < 0).alias("over_budget"),
        F.when(avail < 0, F.abs(avail)).otherwise(zero_money()).cast("double").alias("over_budget_amount"),
        F.least(spent, F.lit(100.0)).alias("bar_spent"),
    )


def node_totals(node_rows: DataFrame) -> DataFrame:
    """Cross-node totals of A12 rows, present only when the budget > 0."""
    t = node_rows.agg(
        F.sum("current_budget").alias("total_budget"),
        F.sum("actuals").alias("total_spent"),
        F.sum("open_commitments").alias("total_committed"),
        F.sum("budget_available").alias("total_available"),
    )
    return t.filter(F.col("total_budget") > 0).select(*[F.col(c).cast("double").alias(c) for c in t.columns])


STATIC_MEASURES = [m for m in MEASURES if m != "distributed_budget"]


def static_node_rollup(nodes: DataFrame, year: int | None = None) -> DataFrame:
    """A16 + J14: per node over one year (or all); nodes without rows stay.

    Label and description come from the node's first row (lowest year).
    Nodes with no row in the chosen year show budget 0 and no other figures.
    """
    first = nodes.groupBy("node_key").agg(
        F.min_by(F.struct("node_label", "description"), F.col("approval_year")).alias("_f"))
    rows = nodes.filter(F.col("approval_year") == year) if year else nodes
    agg = rows.groupBy("node_key").agg(
        F.min_by(F.struct("node_label", "description"), F.col("approval_year")).alias("_y"),
        *[F.sum(m).cast(MONEY).alias(m) for m in STATIC_MEASURES],
        F.sum("project_count").cast("long").alias("project_count"),
    )
    j = first.join(agg, "node_key", "left")
    has = F.col("_y").isNotNull()
    return j.select(
        "node_key",
        F.when(has, F.col("_y.node_label")).otherwise(F.col("_f.node_label")).alias("node_label"),
        F.when(has, F.col("_y.description")).alias("description"),
        *[(F.coalesce(F.col(m), zero_money()) if m == "current_budget" else F.col(m)).cast("double").alias(m)
          for m in STATIC_MEASURES],
        "project_count",
    )


MOVEMENTS = [
    ("original", "original_budget"),
    ("supplemental", "supplemental_budget"),
    ("returned", "returned_budget"),
    ("carry_in", "budget_cf_from_prev"),
    ("carry_out", "budget_cf_to_next"),
]


def budget_movements(node_rows: DataFrame) -> DataFrame:
    """Movement rows of each node card.

    The block shows only when supplemental, returned or carry-in is non-zero;
    inside it the original always shows and the rest only when non-zero.
    """
    shown = (F.col("supplemental_budget") != 0) | (F.col("returned_budget") != 0) | (F.col("budget_cf_from_prev") != 0)
    stacked = node_rows.filter(shown).select(
        "node_key", "approval_year",
        F.explode(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(name).alias("movement"),
                                     F.col(c).cast(MONEY).alias("amount")) for i, (name, c) in enumerate(MOVEMENTS)]))
        .alias("m"),
    ).select("node_key", "approval_year", "m.*")
    return stacked.filter((F.col("movement") == "original") | (F.col("amount") != 0)).select(
        "node_key", "approval_year", F.col("position").cast("int").alias("position"), "movement",
        F.col("amount").cast("double").alias("amount"))
