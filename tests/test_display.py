"""Display expressions, static sort/search, e-mail grouping, movements, keyset paging."""

from decimal import Decimal

from pyspark.sql import functions as F

from conftest import SF001
from outlay.functions.expressions import (aging_band, blank_sentinel, currency_text, date_prefix, doc_kind,
                                          location_text, minute_text, safe_pct, type_category, type_label)
from outlay.functions.search import STATIC_PROJECT_HAYSTACK, haystack_search
from outlay.operators import fund_nodes as fn
from outlay.params import PoFilter, SourceParams
from outlay.plans import curated as C
from outlay.plans import pos as POS
from outlay.plans import static_bundle as SB

P = SourceParams()


def test_text_helpers(spark):
    df = spark.createDataFrame([("2001-02-03T04:05:06", "9999-12-31 00:00:00", "PROG WATER PROG X", 1234.5, -2.0,
                                 "application/pdf", "Austin", None, 61)],
                               "ts string, done string, t string, m double, neg double, mime string, city string, "
                               "state string, days int")
    r = df.select(date_prefix(F.col("ts")), minute_text(F.col("ts")), blank_sentinel(F.col("done")),
                  type_label(F.col("t"), "PROG"), type_category(F.col("t"), ("GAS", "WATER")),
                  currency_text(F.col("m")), currency_text(F.col("neg")), currency_text(F.lit(None)),
                  doc_kind(F.col("mime")), location_text(F.col("city"), F.col("state")), aging_band(F.col("days")),
                  safe_pct(F.lit(1), F.lit(0)), safe_pct(F.lit(1), F.lit(4))).collect()[0]
    assert list(r) == ["2001-02-03", "2001-02-03 04:05", None, "WATER X", "WATER", "$1,234.50", "$-2.00", "$0.00",
                       "pdf", "Austin, ", "60+", 0.0, 25.0]


def test_static_sort_is_locale_order(spark):
    df = spark.createDataFrame([("b",), ("B",), ("a",), ("A",), (None,)], "c string")
    assert [r.c for r in SB.sort_static(df, "c").collect()] == [None, "a", "A", "b", "B"]


def test_haystack_spans_fields_and_keeps_separators(spark):
    df = spark.createDataFrame([("12", "Austin", "TX", None, None, "p1", None, "PROG X")],
                               ", ".join(f"{c} string" for c in STATIC_PROJECT_HAYSTACK))
    assert df.filter(haystack_search("austin tx", STATIC_PROJECT_HAYSTACK)).count() == 1  # spans two fields
    assert df.filter(haystack_search("txp1", STATIC_PROJECT_HAYSTACK)).count() == 0       # '' keeps separators
    assert haystack_search(" ; ", STATIC_PROJECT_HAYSTACK) is None


def test_budget_movements_block_rules(spark):
    cols = ", ".join(f"{m} decimal(18,2)" for m in fn.MEASURES)
    z = [Decimal(0)] * len(fn.MEASURES)

    def row(key, **kw):
        vals = list(z)
        for k, v in kw.items():
            vals[fn.MEASURES.index(k)] = Decimal(v)
        return (key, 0, *vals)

    df = spark.createDataFrame([row("quiet", original_budget=5, budget_cf_to_next=3),
                                row("moved", original_budget=5, returned_budget=-2, budget_cf_to_next=3)],
                               "node_key string, approval_year int, " + cols)
    got = [(r.node_key, r.movement) for r in fn.budget_movements(df).orderBy("node_key", "position").collect()]
    assert got == [("moved", "original"), ("moved", "returned"), ("moved", "carry_out")]


def test_email_sections_and_keyset_pages(spark):
    cur = C.from_testdata(spark, SF001, P)
    sel = cur.pos.select("po_number")
    rep = POS.vendor_email_report(cur, sel).collect()
    total = [r for r in rep if r.section == "total"][0]
    vendors = [r for r in rep if r.section == "vendor"]
    assert total.po_count == sum(r.po_count for r in vendors)
    assert abs(total.total - sum(r.total for r in vendors)) < 1e-6
    assert all(r.vendor_email == "" for r in vendors)          # never loaded => ''
    single = [r for r in vendors if r.po_count == 1]
    assert all(not r.subject.endswith(r.vendor) for r in single)
    # keyset pages walk the same rows as offset pages
    f = PoFilter(page_size=300)
    offset_rows = [tuple(r) for r in POS.po_page(cur, f).select("po_number", "project_id").collect()]
    keyset_rows = [tuple(r) for r in POS.po_page_after(cur, f, None).select("po_number", "project_id").collect()]
    assert offset_rows == keyset_rows


def test_keyset_pages_concatenate_to_the_base(spark):
    cur = C.from_testdata(spark, SF001, P)
    cur = C.Curated(projects=cur.projects.cache(), budgets=cur.budgets, pos=cur.pos.filter("po_number < '00000400'").cache(),
                    fund_nodes=cur.fund_nodes)
    whole = POS.po_base(cur).count()
    for sort, order, size in (("po_number", "asc", 7), ("vendor", "desc", 41), ("state", "asc", 60),
                              ("remaining_to_invoice", "desc", 53), ("created_date", "asc", 90)):
        f = PoFilter(sort=sort, order=order, page_size=size)
        seen, after = [], None
        while True:
            page = POS.po_page_after(cur, f, after, cursor=True).collect()
            seen += [(r.po_number, r.project_id) for r in page]
            if len(page) < size:
                break
            after = tuple(page[-1].cursor)
        assert len(seen) == len(set(seen)) == whole
        if whole < 5000:
            want = [tuple(r) for r in POS.filtered(cur, f).orderBy(*POS.sort_columns(f))
                    .select("po_number", "project_id").collect()]
            assert seen == want


def test_short_currency_rounds_the_binary_value(spark):
    from outlay.functions.expressions import short_currency
    df = spark.createDataFrame([(1_150_000.0,), (2500.0,), (-1_250_000.0,), (0.5,), (None,), (3500.0,)], "v double")
    assert [r[0] for r in df.select(short_currency(F.col("v"))).collect()] == \
        ["$1.1M", "$2K", "$-1.2M", "$0", "$0", "$4K"]
    assert df.select(aging_band(F.lit(None).cast("int"))).first()[0] is None


def test_versioned_sink_roundtrip(spark, scratch):
    from outlay.sources import sinks
    kind = "doc_id string, project_id string, folder_id string"
    df1 = spark.createDataFrame([("1", "P", "f")], kind)
    df2 = spark.createDataFrame([("2", "Q", "g"), ("3", "P", "h")], kind)
    assert sinks.current_version(spark, scratch) is None
    sinks.write_version(spark, df1, scratch, 0)
    sinks.write_version(spark, df2, scratch, 1)
    assert sorted(r.doc_id for r in sinks.read_current(spark, scratch).collect()) == ["2", "3"]


def test_document_table_rewrites_touched_buckets_only(spark, scratch):
    from outlay.sources import sinks
    kind = "doc_id string, project_id string, folder_id string"
    rows = [(str(i), f"P{i}", "f") for i in range(40)]
    sinks.write_documents(spark, spark.createDataFrame(rows, kind), scratch, 0)
    before = sinks.doc_paths(sinks.doc_log(spark, scratch))
    one = spark.createDataFrame([("new", "P3", "f")], kind)
    b = one.select(sinks.doc_bucket("project_id")).first()[0]
    stored = sinks.read_documents(spark, scratch, kind, [b])
    sinks.write_documents(spark, stored.unionByName(one), scratch, 1, touched=[b])
    after = sinks.doc_paths(sinks.doc_log(spark, scratch))
    assert {k for k in before if before[k] != after[k]} == {b}
    assert sinks.read_documents(spark, scratch, kind).count() == 41
    assert sinks.expire_documents(spark, scratch) == 1 and sinks.read_documents(spark, scratch, kind).count() == 41


def test_shuffle_sizing(spark):
    from outlay.session import input_bytes, shuffle_partitions, sized_shuffle
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert shuffle_partitions(spark, 1) == 2 * spark.sparkContext.defaultParallelism  # small input: cores bound
    assert shuffle_partitions(spark, 100 * 2**40) == 409_600                            # 100 TiB / 256 MiB
    with sized_shuffle(spark, 2**40) as n:
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(n) == "4096"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert input_bytes(spark, "/root/testdata/sf0.001") > 0


def test_freshness_upsert_replaces_by_key(spark):
    from outlay.plans.pipeline import upsert_freshness
    cols = "source_key string, source_label string, source_last_updated string, refreshed_at string"
    stored = spark.createDataFrame([("a", "A", "old", "t0"), ("b", "B", "old", "t0")], cols)
    fresh = spark.createDataFrame([("b", "B", "new", "t1"), ("c", "C", "Unknown", "t1")], cols)
    got = {r.source_key: r.source_last_updated for r in upsert_freshness(stored, fresh).collect()}
    assert got == {"a": "old", "b": "new", "c": "Unknown"}
