"""PO reports: R4 page + count + A13 summary, R5 detail, A14, A19/R6 e-mail.

``po_base`` (F21 over J5) is built once and every PO report derives from it.
The join keeps the fan-out: a PO whose definition matches several projects
is listed (and summed) once per project, as the original does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import aging_days, default_label, out_money, safe_pct, ts_text, zero_money
from ..functions.search import PO_SEARCH_FIELDS, po_search
from ..operators.gram_index import GramIndex, like_grams, write_index
from ..operators.gram_index import search as search_index
from ..operators.places import places_by, with_places
from ..operators.sorted_copy import SortedCopy, behind, page_after, write_sorted
from ..params import DEFAULT_AS_OF, UNKNOWN_VENDOR, PoFilter
from .curated import Curated

# Fixed values (API keys): allow-listed sort keys (O2); amounts sort on the stored column.
PO_SORT = {
    "po_number": "po_number",
    "vendor": "vendor",
    "store_sequence": "store_sequence",
    "city": "city",
    "state": "state",
    "project_status": "project_status",
    "po_status": "po_status",
    "po_total": "raw_po_total",
    "invoiced_to_date": "raw_invoiced_to_date",
    "remaining_to_invoice": "raw_remaining_to_invoice",
    "give_back_amount": "give_back_dec",
    "days_since_last_invoice": "days_since_last_invoice",
    "created_date": "created_ts",
    "last_update": "last_update_ts",
    "sap_project_definition": "proj_def",
}

PO_BASE_COLUMNS = [
    "po_number", "vendor", "vendor_email", "store", "sequence", "store_sequence", "city", "state", "project_id",
    "project_status", "po_status", "po_total", "invoiced_to_date", "remaining_to_invoice", "is_over_invoiced",
    "give_back_flag", "give_back_amount", "days_since_last_invoice", "created_date", "last_update", "proj_def",
    "general_contractor", "project_type", "scope",
]


def give_back(project_status: Column, remaining: Column) -> Column:
    """F8 / X11: project complete (any case) and something left to invoice."""
    return (F.lower(project_status) == "complete") & (F.coalesce(remaining, zero_money()) > 0)


def po_base(cur: Curated, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """F21 + J5: curated POs left-joined to projects, 7 computed columns.

    Money stays DECIMAL here (``*_dec``); the output edge casts to DOUBLE.
    """
    proj = cur.projects.select("proj_def", "store", "sequence", "store_sequence", "city", "state", "project_id",
                               "project_status", "general_contractor", "project_type", "scope", "banner")
    j = cur.pos.join(proj, "proj_def", "left")
    tot = F.coalesce("po_total", zero_money())
    inv = F.coalesce("invoiced_to_date", zero_money())
    rem = F.coalesce("remaining_to_invoice", zero_money())
    gb = give_back(F.col("project_status"), F.col("remaining_to_invoice"))
    return j.select(
        "po_number", "vendor", "vendor_email", "store", "sequence", "store_sequence", "city", "state",
        "project_id", "project_status", "po_status",
        tot.alias("po_total_dec"), inv.alias("invoiced_dec"), rem.alias("remaining_dec"),
        F.when(inv > tot, 1).otherwise(0).alias("is_over_invoiced"),
        F.when(gb, 1).otherwise(0).alias("give_back_flag"),
        F.when(gb, rem).otherwise(zero_money()).alias("give_back_dec"),
        aging_days(F.coalesce("last_update", "created_date"), as_of).alias("days_since_last_invoice"),
        F.col("created_date").alias("created_ts"), F.col("last_update").alias("last_update_ts"),
        "proj_def", "general_contractor", "project_type", "scope", "banner",
        F.col("po_total").alias("raw_po_total"), F.col("invoiced_to_date").alias("raw_invoiced_to_date"),
        F.col("remaining_to_invoice").alias("raw_remaining_to_invoice"),
    )


def present(base: DataFrame) -> DataFrame:
    """Output edge of the PO base: DOUBLE money, text timestamps."""
    return base.select(
        *[c for c in PO_BASE_COLUMNS[:11]],
        out_money(F.col("po_total_dec")).alias("po_total"),
        out_money(F.col("invoiced_dec")).alias("invoiced_to_date"),
        out_money(F.col("remaining_dec")).alias("remaining_to_invoice"),
        "is_over_invoiced", "give_back_flag",
        out_money(F.col("give_back_dec")).alias("give_back_amount"),
        "days_since_last_invoice",
        ts_text(F.col("created_ts")).alias("created_date"),
        ts_text(F.col("last_update_ts")).alias("last_update"),
        "proj_def", "general_contractor", "project_type", "scope",
    )


def po_filter(f: PoFilter) -> Column | None:
    """F5-F9 + F6 as one predicate; None when nothing filters."""
    preds = []
    for value, col in ((f.vendor, "vendor"), (f.state, "state"), (f.project_status, "project_status"),
                       (f.po_status, "po_status"), (f.sap_def, "proj_def")):
        if value:
            preds.append(F.col(col) == F.lit(value))
    if f.has_remaining:
        preds.append(F.col("remaining_dec") > 0)
    if f.give_back_only:
        preds.append(give_back(F.col("project_status"), F.col("raw_remaining_to_invoice")))
    if f.aging_30:
        preds.append(F.col("days_since_last_invoice") >= 30)
    s = po_search(f.search, f.search_fields)
    if s is not None:
        preds.append(s)
    return reduce(lambda a, b: a & b, preds) if preds else None


def filtered(cur: Curated, f: PoFilter, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    base = po_base(cur, as_of)
    p = po_filter(f)
    return base.filter(p) if p is not None else base


def sort_columns(f: PoFilter) -> list[Column]:
    """O2 with a (po_number, project_id) tie-break so pages are stable."""
    key = F.col(PO_SORT.get(f.sort or "", "po_number"))
    main = key.desc() if f.order == "desc" else key.asc()
    return [main, F.col("po_number").asc(), F.col("project_id").asc()]


def po_page(cur: Curated, f: PoFilter, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """R4 rows of one page (O3): sort, skip (page-1)*size, take size.

    Each task hands on offset + limit rows; deep pages belong to ``po_page_after``.
    """
    page = max(1, int(f.page))
    rows = filtered(cur, f, as_of).orderBy(*sort_columns(f))
    return present(rows.offset((page - 1) * f.page_size).limit(f.page_size))


def po_places(cur: Curated, order: str = "asc", as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """O2: the place of every row under every sort key, from one read of the base, dealt once."""
    return places_by(po_base(cur, as_of), ["po_number", "project_id"], PO_SORT, order == "desc", _ranges(cur, COPY_RANGE_ROWS))


CURSOR = ("sort_value", "po_number", "project_id")


def po_page_after(cur: Curated, f: PoFilter, after: tuple | None, as_of: str = DEFAULT_AS_OF,
                  cursor: bool = False) -> DataFrame:
    """Keyset page: the ``f.page_size`` rows behind cursor ``after``; no OFFSET at any depth.

    The cursor is the last row's (sort value, po_number, project_id): a PO
    joined to several projects may end a page anywhere in its rows. With
    ``cursor`` the page carries these values as column ``cursor``.
    """
    key = PO_SORT.get(f.sort or "", "po_number")
    rows = filtered(cur, f, as_of)
    if after is not None:
        rows = rows.filter(behind([(F.col(key), f.order == "desc", after[0]), (F.col("po_number"), False, after[1]),
                                   (F.col("project_id"), False, after[2])]))
    page = rows.orderBy(*sort_columns(f)).limit(f.page_size)
    if not cursor:
        return present(page)
    at = F.struct(F.col(key).alias(CURSOR[0]), "po_number", "project_id")
    return page.select(at.alias("cursor"), *PO_KEYS)


PO_KEYS = ["po_number", "project_id"]


def sorted_order(f: PoFilter) -> list[tuple[str, bool]]:
    return [(PO_SORT.get(f.sort or "", "po_number"), f.order == "desc"), ("po_number", False), ("project_id", False)]


#: Rows of a range of a sorted copy, which a task sorts in its memory.
COPY_RANGE_ROWS = 500_000


def base_rows(cur: Curated) -> int:
    """Rows of ``po_base``, whose projects multiply a PO, from the counts by definition."""
    fan = cur.projects.groupBy("proj_def").agg(F.count(F.lit(1)).alias("fan"))
    pos = cur.pos.groupBy("proj_def").agg(F.count(F.lit(1)).alias("n"))
    return pos.join(fan, "proj_def", "left").agg(F.sum(F.col("n") * F.coalesce("fan", F.lit(1)))).first()[0] or 0


def _ranges(cur: Curated, rows: int) -> int:
    """Ranges of about ``rows`` rows for the PO base, two per core at least."""
    return max(2 * cur.pos.sparkSession.sparkContext.defaultParallelism, base_rows(cur) // rows)


def sorted_base(cur: Curated, f: PoFilter, path: str, as_of: str = DEFAULT_AS_OF, ranges: int | None = None) -> SortedCopy:
    """A copy of the PO base in the order of ``f``, for ``po_page_sorted``; as many ranges as its rows need, or ``ranges``."""
    ranges = _ranges(cur, COPY_RANGE_ROWS) if ranges is None else ranges
    return write_sorted(po_base(cur, as_of), sorted_order(f), path, ranges)


def po_page_sorted(copy: SortedCopy, f: PoFilter, after: tuple | None) -> DataFrame:
    """O3: the page of ``po_page_after`` from a sorted copy, reading only ranges behind the cursor until it is full."""
    return present(page_after(copy, after, f.page_size, po_filter(f)))


def indexed_base(copy: SortedCopy, path: str, ranges: int | None = None) -> GramIndex:
    """The grams of all search fields (F5) of a copy that ``sorted_base`` has written."""
    return write_index(copy, [F.col(c).cast("string") for c in PO_SEARCH_FIELDS.values()], path, ranges)


def po_search_indexed(index: GramIndex, f: PoFilter) -> DataFrame:
    """All rows of the copy that ``f`` selects, reading only ranges with candidates of its search."""
    s = po_search(f.search, f.search_fields)
    return present(search_index(index, like_grams(f.search) if s is not None else set(), po_filter(f)))


def po_page_count(cur: Curated, f: PoFilter, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """R4 total rows and total pages = max(1, ceil(total / size))."""
    c = filtered(cur, f, as_of).agg(F.count(F.lit(1)).alias("total"))
    return c.select("total", F.greatest(F.lit(1), F.ceil(F.col("total") / F.lit(f.page_size))).cast("long")
                    .alias("total_pages"))


def summary_aggs() -> list[Column]:
    gb = F.col("give_back_flag") == 1
    return [
        F.count(F.lit(1)).alias("total_pos"),
        out_money(F.coalesce(F.sum("raw_po_total"), zero_money())).alias("total_po_value"),
        out_money(F.coalesce(F.sum("raw_invoiced_to_date"), zero_money())).alias("total_invoiced"),
        out_money(F.coalesce(F.sum("raw_remaining_to_invoice"), zero_money())).alias("total_remaining"),
        out_money(F.coalesce(F.sum(F.when(gb, F.col("raw_remaining_to_invoice")).otherwise(zero_money())),
                             zero_money())).alias("total_give_back"),
        F.countDistinct(F.when(gb, F.col("project_id"))).alias("complete_with_open_pos"),
    ]


def po_summary(cur: Curated, f: PoFilter | None = None, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """One global aggregate over the filtered base (partial agg first)."""
    return filtered(cur, f or PoFilter(), as_of).agg(*summary_aggs())


def giveback_summary(cur: Curated, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """The unfiltered give-back figures."""
    s = po_summary(cur, PoFilter(), as_of)
    return s.select("total_pos", "total_give_back", "complete_with_open_pos")


def po_detail(cur: Curated, po_number: str, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """One row for a PO; on fan-out the lowest project id."""
    rows = po_base(cur, as_of).filter(F.col("po_number") == F.lit(po_number))
    return present(rows.orderBy(F.col("project_id").asc()).limit(1))


def po_options(cur: Curated, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """A25 (PO tab): vendors, states and project statuses seen via J5, PO statuses.

    One pass over the base; ``position`` is the ascending place within an option.
    """
    return option_values(po_base(cur, as_of), {
        "vendor": (F.col("vendor"), False), "state": (F.col("state"), True),
        "project_status": (F.col("project_status"), True), "po_status": (F.col("po_status"), True)})


def option_values(rows: DataFrame, options: dict[str, tuple[Column, bool]]) -> DataFrame:
    """Distinct values of several columns in one pass, with their ascending position.

    ``options``: name -> (column, whether '' is a value). NULL never is.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("option"), (c if blank else F.when(c != "", c)).alias("value"))
                      for n, (c, blank) in options.items()])
    found = rows.select(F.explode(pairs).alias("o")).select("o.*").filter("value IS NOT NULL").distinct()
    place = F.row_number().over(Window.partitionBy("option").orderBy("value"))
    return found.select("option", "value", place.alias("position"))


# ---------------------------------------------------------------- e-mail

EMAIL_DASH = "–"


def email_rows(cur: Curated, selection: DataFrame, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """F16: the PO base restricted to the selected PO numbers (semi join)."""
    sel = selection.select("po_number").distinct()
    return po_base(cur, as_of).join(sel, "po_number", "left_semi").withColumn(
        "vendor_label", default_label(F.col("vendor"), UNKNOWN_VENDOR))


def vendor_email_report(cur: Curated, selection: DataFrame, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """A19 + K7 + X28: per-vendor sections and the overall line.

    ``GROUPING SETS ((vendor), ())`` in one aggregate; the overall row has
    ``section = 'total'`` and a NULL vendor.
    """
    rows = email_rows(cur, selection, as_of)
    g = rows.rollup("vendor_label").agg(
        F.grouping("vendor_label").alias("_g"),
        F.count(F.lit(1)).alias("po_count"),
        F.sum("po_total_dec").alias("total"),
        F.sum("invoiced_dec").alias("invoiced"),
        F.sum("remaining_dec").alias("remaining"),
        F.sum("give_back_dec").alias("give_back"),
        F.min_by(F.col("vendor_email"), F.struct("vendor", "po_number", "project_id")).alias("_email"),
        F.min_by(F.col("po_number"), F.struct("vendor", "po_number", "project_id")).alias("_first_po"),
    )
    subject = F.when(F.col("po_count") == 1, F.concat(F.lit(f"PO Status Update {EMAIL_DASH} "), F.col("_first_po"))) \
        .otherwise(F.concat(F.lit(f"PO Status Update {EMAIL_DASH} "), F.col("vendor_label")))
    total = F.when(F.col("_g") == 1, F.lit("total")).otherwise(F.lit("vendor"))
    return g.select(
        total.alias("section"),
        F.col("vendor_label").alias("vendor"),
        F.when(F.col("_g") == 0, F.coalesce(F.col("_email"), F.lit(""))).alias("vendor_email"),
        F.when(F.col("_g") == 0, subject).alias("subject"),
        "po_count",
        out_money(F.col("total")).alias("total"),
        out_money(F.col("invoiced")).alias("invoiced"),
        out_money(F.col("remaining")).alias("remaining"),
        out_money(F.col("give_back")).alias("give_back"),
        safe_pct(F.col("invoiced"), F.col("total")).alias("pct_invoiced"),
        F.when(F.col("_g") == 1, safe_pct(F.col("remaining"), F.col("total"))).alias("pct_remaining"),
    )


def vendor_email_lines(cur: Curated, selection: DataFrame, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """X28 body: plain-text lines in order, as rows (section, part, position, line).

    Per vendor a greeting, per PO its place, scope, amounts and status (with
    the give-back only where there is one), then the vendor's totals and a
    closing. Kept as rows: a body is never gathered into one task.
    """
    rows = email_rows(cur, selection, as_of)
    money = lambda c: F.concat(F.lit("$"), F.format_number(F.col(c).cast("double"), 2))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    shown = lambda c: default_label(F.col(c), "N/A")
    body = F.concat(
        F.lit("PO "), text("po_number"), F.lit(", store "), text("store_sequence"), F.lit(" ("), text("city"),
        F.lit(", "), text("state"), F.lit("); scope: "), shown("scope"), F.lit("; value "), money("po_total_dec"),
        F.lit(", invoiced "), money("invoiced_dec"), F.lit(", open "), money("remaining_dec"), F.lit("; project "),
        shown("project_status"),
        F.when(F.col("give_back_dec") > 0, F.concat(F.lit("; give-back "), money("give_back_dec"))).otherwise(F.lit("")))
    none = F.lit(None).cast("string")
    lines = rows.select(F.col("vendor_label").alias("vendor"), F.lit(1).alias("part"), "po_number", "project_id",
                        body.alias("line"))
    total = rows.groupBy(F.col("vendor_label").alias("vendor")).agg(
        *[F.sum(c).alias(c) for c in ("po_total_dec", "invoiced_dec", "remaining_dec")])
    ends = total.select("vendor", F.explode(F.array(
        F.struct(F.lit(0).alias("part"), F.concat(F.lit("Status of purchase orders for "), F.col("vendor")).alias("line")),
        F.struct(F.lit(2).alias("part"), F.concat(F.lit("Sum of values "), money("po_total_dec"), F.lit(", invoiced "),
                                                  money("invoiced_dec"), F.lit(", open "), money("remaining_dec"))
                 .alias("line")),
        F.struct(F.lit(3).alias("part"), F.lit("Kindly tell us which invoices are still to come and when.")
                 .alias("line")))).alias("e"))
    return lines.unionByName(ends.select("vendor", "e.part", none.alias("po_number"), none.alias("project_id"), "e.line"))


def display_rows(rows: DataFrame, program_token: str) -> DataFrame:
    """Display fields of a PO page."""
    from ..functions.expressions import aging_band, currency_text, date_prefix, location_text
    return rows.select(
        "*",
        currency_text(F.col("po_total")).alias("po_total_text"),
        currency_text(F.col("remaining_to_invoice")).alias("remaining_text"),
        aging_band(F.col("days_since_last_invoice")).alias("aging_band"),
        date_prefix(F.col("created_date")).alias("created_day"),
        location_text(F.col("city"), F.col("state")).alias("location"),
    )


def email_places(cur: Curated, selection: DataFrame, as_of: str = DEFAULT_AS_OF) -> DataFrame:
    """The place of every selected PO row in the e-mail, by vendor, PO number and project."""
    order = ["vendor", "po_number", "project_id"]
    rows = email_rows(cur, selection, as_of).select(*order)
    return with_places(rows, [F.col(c).asc() for c in order])


def write_email_report(cur: Curated, selection: DataFrame, root: str, as_of: str = DEFAULT_AS_OF) -> None:
    """Per-vendor sections and the plain-text body lines as JSON datasets."""
    base = root.rstrip("/")
    vendor_email_report(cur, selection, as_of).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{base}/sections")
    (vendor_email_lines(cur, selection, as_of).orderBy("vendor", "part", "po_number", "project_id")
     .write.mode("overwrite").option("ignoreNullFields", "false").json(f"{base}/lines"))
