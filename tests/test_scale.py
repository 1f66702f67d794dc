"""Lines, nodes and lists are dealt once, by keys that later steps need, and no step sorts rows for a string maximum."""

import re

from pyspark.sql import functions as F

from outlay.operators import gram_index, merge, rollup, sorted_copy
from outlay.operators.places import with_places
from outlay.params import SourceParams

P = SourceParams()
LINE = ("po_nbr string, project_definition string, store_nbr long, item_text string, vendor_name string, net_amt decimal(18,2), "
        "inv_amt decimal(18,2), pur_doc_sts string, document_date timestamp, ods_updated timestamp")
NODE = "program_position string, approval_year int, project_no long, program_position_desc string, " + ", ".join(
    f"{c} string" for c, _ in rollup.NODE_MEASURES)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _lines(spark):
    at = "2001-01-01 00:00:00"
    rows = [("1", "PD0000010000", 1, "misc", "v1", "5", "0", "Open", at, at), ("1", "PD0000010000", 1, "misc", "v1", "2", "1", "Partial", at, at),
            ("2", P.umbrella_key, 7, "9TankWork", P.umbrella_vendors[0], "3", "0", "Open", at, at), (None, "PD0000010000", 1, "misc", "v1", "1", "0", "Open", at, at)]
    return spark.createDataFrame(rows, re.sub("decimal.18,2.|timestamp", "string", LINE)).selectExpr(
        *[f"cast({c} as {t}) {c}" for c, t in (x.split(" ") for x in LINE.split(", "))])


def test_lines_are_dealt_by_po_number_once(spark):
    keys = spark.createDataFrame([("PD-000001", "PD0000010000")], "proj_def string, po_key string")
    cmap = spark.createDataFrame([("1", "PD-000009"), ("4", "PD-000009")], "po_number string, proj_def string")
    stores = spark.createDataFrame([("9", "PD-000002")], "store string, proj_def string")
    rows = merge.place_umbrella(rollup.tagged_rollup(_lines(spark), keys, cmap, P), F.broadcast(stores), P)
    groups = merge.by_po_number(rows, cmap)
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)", _plan(groups))
    assert sum(x.startswith("po_nbr#") for x in dealt) == 1
    assert not [x for x in dealt if "source_rank" in x or "_own" in x]  # rollup and merge go on where the lines are
    found = {(r.po_number, r.shared): r for r in groups.collect()}
    assert {k: (r.source_rank, r.proj_def, r.n_direct, r.n_mapped, r.n_comment, r.n_referenced) for k, r in found.items()} == {
        ("1", True): (1, "PD-000001", 1, 0, 1, 1), ("2", True): (2, "PD-000002", 0, 1, 0, 0), ("4", True): (None, None, 0, 0, 0, 1),
        (None, False): (1, "PD-000001", 1, 0, 0, 0), (None, True): (1, "PD-000001", 1, 0, 0, 0)}
    assert found["1", True].po_status == "Partial" and float(found["1", True].po_total) == 7.0


def test_node_sums_are_hash_aggregated(spark):
    money = lambda x: [x] * len(rollup.NODE_MEASURES)
    rows = [("LARGE", 2000, 1, "b", *money("1.50")), ("LARGE", 2000, 1, "a", *money("n/a")), ("LARGE", 2000, 2, "a", *money("2")),
            ("LARGE", 2000, None, None, *money(None)), ("large", 2000, 1, None, *money("x")), ("other", 2000, 1, "a", *money("1"))]
    out = rollup.node_year_rollup(spark.createDataFrame(rows, NODE), P)
    # only the few rows by description meet a string maximum
    assert _plan(out).count("SortAggregate") <= 2 and "count(distinct" not in _plan(out)
    got = {r.program_position: (r.description, r.project_count, r.original_budget) for r in out.collect()}
    assert {k: (d, n, None if b is None else float(b)) for k, (d, n, b) in got.items()} == {
        "LARGE": ("b", 2, 3.5), "large": (None, 1, None)}


def test_places_deal_the_rows_once(spark):
    df = spark.range(500).select((F.col("id") % 3).cast("string").alias("list"), (F.col("id") * 7 % 500).alias("a"), "id")
    placed = with_places(df, [F.col("a").asc()], ("list",), ("list", "a"), 7)
    assert placed.columns == ["list", "a", "position"] and "row_number" not in _plan(placed)
    rows = sorted((r.list, r.a) for r in df.collect())
    want = {r: sum(x[0] == r[0] and x <= r for x in rows) for r in rows}
    assert {(r.list, r.a): r.position for r in placed.collect()} == want


def test_the_manifest_and_the_index_need_no_sort_of_whole_ranges(spark, scratch):
    df = spark.range(400).select((F.col("id") * 7 % 400).alias("id"), F.lit("Common text").alias("a"))
    copy = sorted_copy.write_sorted(df, [("id", True)], f"{scratch}/rows", 5)
    ends = sorted(tuple(r) for r in copy.manifest.select("range", "n", "last.id").collect())
    rows = copy.rows.select("range", "id").collect()
    of = lambda r: [x.id for x in rows if x.range == r]
    assert ends == [(r, len(of(r)), min(of(r))) for r in sorted({x.range for x in rows})] and sum(n for _, n, _ in ends) == 400
    gram_index.RANGE_COPY_ROWS, before = 10, gram_index.RANGE_COPY_ROWS
    try:  # more rows, more ranges
        index = gram_index.write_index(copy, [F.col("a")], f"{scratch}/grams")
    finally:
        gram_index.RANGE_COPY_ROWS = before
    assert index.postings.manifest.count() > 2 * spark.sparkContext.defaultParallelism
    assert gram_index.search(index, {"ext"}, F.col("id") == 3).count() == 1
