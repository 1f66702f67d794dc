"""Hand-made frames per K / X / F / A rule (ties, NULL, '', fan-out, empties)."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from outlay.functions.expressions import aging_days, banner, mime_type, short_currency
from outlay.functions.search import like_contains, po_search, project_search, split_terms
from outlay.operators import load, merge, rollup
from outlay.params import SourceParams

P = SourceParams()
LINE = ("po_nbr string, project_definition string, store_nbr long, item_text string, vendor_name string, "
        "net_amt decimal(18,2), inv_amt decimal(18,2), pur_doc_sts string, document_date timestamp, "
        "ods_updated timestamp")
T0 = datetime(2001, 1, 1)


def _keys(spark):
    return spark.createDataFrame([("PD-000001", "PD00000100000")], "proj_def string, po_key string")


def test_separate_row_invoice(spark):
    lines = spark.createDataFrame([
        ("00000001", "PD00000100000", 1, "misc", "V", Decimal("17000"), Decimal("0"), "Open", T0, T0),
        ("00000001", "PD00000100000", 1, "misc", "V", Decimal("0"), Decimal("8500"), "Open", T0, T0),
    ], LINE)
    r = rollup.direct_rollup(lines, _keys(spark)).collect()[0]
    assert (r.po_total, r.invoiced_to_date, r.remaining_to_invoice) == (17000, 8500, 8500)


def test_all_null_invoice_stores_zero_remainder(spark):
    lines = spark.createDataFrame([
        ("00000001", "PD00000100000", 1, "misc", "V", Decimal("100"), None, "Open", T0, T0)], LINE)
    d = rollup.direct_rollup(lines, _keys(spark))
    r = load.load_pos(merge.merge_sources(d, d.limit(0).withColumn("store_nbr", F.lit(1).cast("long"))
                                          .withColumn("item_text", F.lit("x")), d.limit(0))).collect()[0]
    assert (float(r.po_total), float(r.invoiced_to_date), float(r.remaining_to_invoice)) == (100.0, 0.0, 0.0)


def test_having_drops_zero_groups(spark):
    lines = spark.createDataFrame([
        ("00000002", "PD00000100000", 1, "misc", "V", Decimal("0"), Decimal("0"), "Open", T0, T0)], LINE)
    assert rollup.direct_rollup(lines, _keys(spark)).count() == 0


PO = ("po_number string, proj_def string, vendor string, po_total decimal(18,2), invoiced_to_date decimal(18,2), "
      "remaining_to_invoice decimal(18,2), po_status string, created_date timestamp, last_update timestamp")


def test_source_precedence_and_null_keys(spark):
    direct = spark.createDataFrame([
        ("1", "A", "v2", Decimal(1), Decimal(0), Decimal(1), "Open", datetime(2001, 1, 1), T0),
        ("1", "A", "v1", Decimal(2), Decimal(0), Decimal(2), "Open", datetime(2001, 1, 1), T0),
        (None, "A", "v1", Decimal(3), Decimal(0), Decimal(3), "Open", T0, T0),
        (None, "B", "v1", Decimal(4), Decimal(0), Decimal(4), "Open", T0, T0)], PO)
    umb = spark.createDataFrame([
        ("1", "U", "v0", Decimal(9), Decimal(0), Decimal(9), "Open", T0, T0, 5, "x"),
        ("2", "U", "v9", Decimal(5), Decimal(0), Decimal(5), "Open", T0, T0, 7, "x"),
        ("2", "W", "v9", Decimal(6), Decimal(0), Decimal(6), "Open", T0, T0, 3, "y")],
        PO + ", store_nbr long, item_text string")
    com = spark.createDataFrame([
        ("2", "C", "v0", Decimal(7), Decimal(0), Decimal(7), "Open", T0, T0),
        ("3", "C", "v0", Decimal(8), Decimal(0), Decimal(8), "Open", T0, T0)], PO)
    m = {(r.po_number, r.proj_def): r for r in merge.merge_sources(direct, umb, com).collect()}
    assert m[("1", "A")].vendor == "v1"          # direct wins; vendor breaks the tie
    assert ("2", "W") in m                        # umbrella: lowest store wins
    assert ("3", "C") in m                        # comment-only PO recovered
    assert sum(1 for k in m if k[0] is None) == 2  # NULL keys never collide
    pos = [k[0] for k in m if k[0] is not None]
    assert len(pos) == len(set(pos))


def test_top_vendor_tie_breaks_on_name(spark):
    pos = spark.createDataFrame([
        ("1", "A", "Zed", Decimal(10), Decimal(0), Decimal(10), "Open", T0, T0),
        ("2", "A", "Abe", Decimal(10), Decimal(0), Decimal(10), "Open", T0, T0),
        ("3", "B", "Bob", Decimal(1), Decimal(0), Decimal(1), "Open", T0, T0),
        ("4", "B", "Al", Decimal(2), Decimal(0), Decimal(0), "Open", T0, T0)], PO)
    got = {r.proj_def: r.top_vendor for r in load.top_vendor(pos).collect()}
    assert got == {"A": "Abe", "B": "Al"}


PULLED = "store string, proj_def string, scope string, project_status string, updated_at timestamp, record_id long, project_id string"


def test_store_map_last_eligible_else_first(spark):
    rows = spark.createDataFrame([
        ("1", "P-new", "Replace", "Active", datetime(2001, 5, 1), 1, "a"),
        ("1", "P-old", "Replace", "Active", datetime(2001, 1, 1), 2, "b"),
        ("1", "P-dup", "Duplicate", "Active", datetime(2000, 1, 1), 3, "c"),
        ("2", "Q-new", "cancelled job", "Active", datetime(2001, 5, 1), 4, "d"),
        ("2", "Q-old", "Replace", "On Hold", datetime(2001, 1, 1), 5, "e"),
        ("", "R", "Replace", "Active", datetime(2001, 1, 1), 6, "f")], PULLED)
    got = {r.store: r.proj_def for r in merge.store_key_map(rows).collect()}
    assert got == {"1": "P-old", "2": "Q-new"}


def test_comment_po_mining(spark):
    df = spark.createDataFrame([("PD-1", "Acme PO# 12345678; acme po 999999991", datetime(2001, 1, 1), 1, "a"),
                                ("PD-2", "installer po12345678", datetime(2000, 1, 1), 2, "b"),
                                ("PD-3", "   ", datetime(1999, 1, 1), 3, "c")],
                               "proj_def string, comments_a string, updated_at timestamp, record_id long, project_id string")
    got = {r.po_number: r.proj_def for r in merge.comment_po_map(df, P).collect()}
    assert got == {"12345678": "PD-2", "99999999": "PD-1"}  # the oldest project wins


def test_aging_truncates_and_rejects_junk(spark):
    as_of = "2001-12-01 12:00:00"
    df = spark.createDataFrame([("2001-11-01 12:14:24",), ("2001-11-01 12:00:00",), ("2001-12-02 09:36:00",),
                                ("not a date",)], "ts string")
    got = [r[0] for r in df.select(aging_days(F.col("ts"), as_of)).collect()]
    assert got == [29, 30, 0, None]


def test_banner_and_mime(spark):
    df = spark.createDataFrame([("sam ", "a.PDF"), ("", "noext"), (None, "x.tar.zip"), ("weird", "b.docx")],
                               "st string, name string")
    got = df.select(banner(F.col("st")), mime_type(F.col("name"))).collect()
    assert [r[0] for r in got] == ["Club", "Unknown", "Unknown", "Main"]
    assert [r[1] for r in got] == ["application/pdf", "application/octet-stream", "application/zip",
                                   "application/vnd.openxmlformats-officedocument.wordprocessingml.document"]


def test_blank_search_means_no_filter():
    for s in (None, "", " ; "):
        assert split_terms(s) == []
        assert project_search(s, None, None) is None
        assert po_search(s, None) is None
    assert po_search("x", ["bogus"]) is None  # no valid PO field => no filter


def test_like_is_ascii_case_insensitive_with_wildcards(spark):
    df = spark.createDataFrame([("aXb",), ("AYB",), ("ab",), ("ÉCOLE",), (None,)], "c string")
    assert [r.c for r in df.filter(like_contains(F.col("c"), "A_B")).collect()] == ["aXb", "AYB"]
    assert df.filter(like_contains(F.col("c"), "école")).count() == 0   # ASCII folding only
    assert df.filter(like_contains(F.col("c"), "é")).count() == 0


def test_short_currency(spark):
    df = spark.createDataFrame([(1_250_000.0,), (3_499.0,), (5.0,), (None,), (-1500.0,)], "v double")
    assert [r[0] for r in df.select(short_currency(F.col("v"))).collect()] == ["$1.2M", "$3K", "$5", "$0", "$-2K"]


def test_precedence_on_a_hot_key_aggregates_before_the_shuffle(spark):
    from outlay.operators.precedence import pick_by
    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"))
    out = pick_by(df, ["k"], [F.col("v")], last=True, keep_null_keys=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the map-side (partial) aggregate sits below the exchange
    assert plan.index("partial_max_by") > plan.index("Exchange")
    got = {r.k: r.v for r in out.filter(F.col("k") == "HOT").collect()}
    assert got == {"HOT": max(i for i in range(n) if i % 3 == 0)}
    nulls = out.filter(F.col("k").isNull()).count()
    assert nulls == sum(1 for i in range(n) if i % 3 != 0 and i % 7 == 0)  # NULL keys kept whole


def test_po_search_never_matches_null_definitions(spark):
    from outlay.plans.curated import Curated
    from outlay.plans.projects import search_projects
    projects = spark.createDataFrame([("P1", "D1", "x"), ("P2", None, "x")],
                                     "project_id string, proj_def string, scope string")
    pos = spark.createDataFrame([("1", "D1", "Acme Co"), ("2", None, "ACME")],
                                "po_number string, proj_def string, vendor string")
    cur = Curated(projects=projects, budgets=projects.limit(0), pos=pos, fund_nodes=projects.limit(0))
    got = [r.project_id for r in search_projects(cur, "acme", ("po",)).collect()]
    assert got == ["P1"]
