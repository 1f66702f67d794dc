"""Driver contract and the streaming form of the document reconcile."""

import os

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001
from outlay.operators import documents as DOC
from outlay.params import SourceParams
from outlay.sources import fixtures, sinks
from outlay.streaming import doc_sync

P = SourceParams()


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() == 1
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 50
    for name in ("po_summary", "project_list", "doc_reconcile", "fund_node_panel"):
        assert q[name](spark, SF001).columns


def _arrivals(spark, rows):
    """rows: (doc_id, project, snapshot, closing count or None)."""
    return spark.createDataFrame([(d, p, "f", "c", "s", "n", "u", "t", "1", "u", "a", "now", i, s, n)
                                  for i, (d, p, s, n) in enumerate(rows)], doc_sync.INCOMING_SCHEMA)


def _live(spark, table):
    return sorted((r.doc_id, r.is_deleted) for r in doc_sync.read_current(spark, table).collect())


def test_stream_matches_batch(spark, scratch):
    old = fixtures.doc_old(spark, SF001, P)
    inc = fixtures.doc_incoming(spark, SF001, P)
    att = fixtures.doc_attempted(spark, SF001)
    table = os.path.join(scratch, "docs")
    sinks.write_documents(spark, old, table, 0)
    types = dict(c.split() for c in doc_sync.INCOMING_SCHEMA.split(", "))
    listed = inc.withColumns({"snapshot_id": F.lit(1).cast("long"), "snapshot_docs": F.lit(None).cast("long")})
    counts = att.join(inc.groupBy("project_id").agg(F.count(F.lit(1)).alias("n")), "project_id", "left")
    closing = counts.select(*[F.col(c) if c == "project_id" else F.lit(1).cast("long").alias(c) if c == "snapshot_id"
                              else F.coalesce("n", F.lit(0)).alias(c) if c == "snapshot_docs"
                              else F.lit(None).cast(types[c]).alias(c) for c in doc_sync.INCOMING_SCHEMA_COLUMNS])
    listed.select(*doc_sync.INCOMING_SCHEMA_COLUMNS).unionByName(closing).write.parquet(
        os.path.join(scratch, "in", "batch0"))
    q = doc_sync.start_doc_sync(spark, os.path.join(scratch, "in", "*"), table, os.path.join(scratch, "ckpt"),
                                P.refreshed_at)
    q.awaitTermination(300)
    assert q.exception() is None
    got = sorted(tuple(r) for r in doc_sync.read_current(spark, table).collect())
    want = sorted(tuple(r) for r in DOC.reconcile(old, inc, att, P.refreshed_at).collect())
    assert got == want


def test_stream_restart_and_retry_keep_the_table(spark, scratch):
    table = os.path.join(scratch, "docs")
    doc_sync.merge_batch(spark, table, "t", _arrivals(spark, [("d1", "P", 1, None), ("d2", "P", 1, None), (None, "P", 1, 2)]), 0, "s1")
    again = _arrivals(spark, [("d3", "Q", 1, None), (None, "Q", 1, 1)])
    doc_sync.merge_batch(spark, table, "t", again, 0, "s1")    # a retried batch of the same stream: nothing
    assert _live(spark, table) == [("d1", 0), ("d2", 0)]
    doc_sync.merge_batch(spark, table, "t", again, 0, "s2")    # a new checkpoint starts at 0 again
    assert _live(spark, table) == [("d1", 0), ("d2", 0), ("d3", 0)]


def test_split_listings_delete_nothing_until_complete(spark, scratch):
    table = os.path.join(scratch, "docs")
    merge = lambda rows, b: doc_sync.merge_batch(spark, table, "t", _arrivals(spark, rows), b, "s")
    merge([("d1", "P", 1, None), ("d2", "P", 1, None), (None, "P", 1, 2)], 0)
    merge([("d1", "P", 2, None), (None, "P", 2, 2)], 1)                        # half a listing
    assert _live(spark, table) == [("d1", 0), ("d2", 0)]
    merge([("d4", "P", 2, None)], 2)                                           # the rest of it
    assert _live(spark, table) == [("d1", 0), ("d2", 1), ("d4", 0)]
    merge([("d1", "P", 3, None), ("d2", "P", 3, None), (None, "P", 3, 2), ("d2", "P", 4, None), (None, "P", 4, 1)], 3)
    assert _live(spark, table) == [("d1", 1), ("d2", 0), ("d4", 1)]            # the newest complete listing counts
    merge([("d1", "P", 3, None), (None, "P", 3, 1)], 4)                        # late and older: dropped
    assert _live(spark, table) == [("d1", 1), ("d2", 0), ("d4", 1)]


def test_deep_folder_trees_keep_every_level(spark):
    from outlay.sources import folder_tree
    tree = '{"id":"f70","text":"n70","numFiles":1}'
    for i in range(69, -1, -1):
        tree = '{"id":"f%d","text":"n%d","numFiles":0,"children":[%s]}' % (i, i, tree)
    rows = [("P", "[" + tree + "]"), ("Q", '[{"id":"q","text":"q","children":{"id":"x","text":"x"}}]'),
            ("R", '{"children":null,"data":[{"id":"r","text":"r"}]}'), ("S", '{"data":[{"id":"s","text":"s"}]}'), ("T", None)]
    out = folder_tree.flatten_folders(spark.createDataFrame(rows, "project_id string, payload string"))
    got = {(r.project_id, r.folder_id): (r.depth, r.category) for r in out.collect()}
    assert len(got) == 73 and got["P", "f70"] == (70, "n0") and got["Q", "q"] == (0, "q") and ("S", "s") in got


def test_landed_extracts_give_the_same_tables(spark, scratch):
    from outlay.plans import curated as C
    from outlay.plans import pipeline as PL
    from outlay.sources import landed
    raw = fixtures.load_raw(spark, SF001, P)
    raw = fixtures.RawInputs(raw.projects, raw.enrichment, raw.po_lines.filter("po_nbr < '00001000'"), raw.nodes)
    names = {"projects": raw.projects, "enrichment": raw.enrichment, "po_lines": raw.po_lines, "nodes": raw.nodes}
    for n, df in names.items():
        df.write.parquet(f"{scratch}/parquet/{n}")
        df.select([F.col(c).cast("string") for c in df.columns]).write.json(f"{scratch}/json/{n}")
    rows = lambda df: sorted(map(str, df.collect()))
    want = C.build(raw, P)
    for fmt in ("parquet", "json"):
        got = C.build(landed.load_landed(spark, fmt=fmt, **{n: f"{scratch}/{fmt}/{n}" for n in names}), P)
        for t in ("budgets", "fund_nodes") + (("pos",) if fmt == "json" else ()):
            assert rows(getattr(got, t)) == rows(getattr(want, t)), (fmt, t)
    out = f"{scratch}/out"
    broken = lambda: spark.read.parquet(f"{scratch}/none")
    first = PL.refresh(spark, raw, broken, out, P)
    PL.refresh(spark, raw, lambda: fixtures.doc_old(spark, SF001, P), out, P)
    assert rows(first.pos) == rows(PL.current(spark, out).pos)          # the version before is still readable
    fresh = {r.source_key: r.source_last_updated for r in PL.stored_freshness(spark, out).collect()}
    assert fresh["documents"] != "Unknown" and fresh["enrichment"] != "Unknown" and len(fresh) == 4


def test_null_po_numbers_across_sources(spark):
    from outlay.operators import merge
    kind = ("po_number string, proj_def string, vendor string, po_total decimal(28,2), invoiced_to_date decimal(28,2), "
            "remaining_to_invoice decimal(18,2), po_status string, created_date timestamp, last_update timestamp, "
            "store_nbr long, item_text string")
    row = lambda po, d, v, s=None: (po, d, v, None, None, None, None, None, None, s, None)
    frame = lambda *r: spark.createDataFrame(list(r), kind)
    merged = lambda d, u, c: sorted((r.po_number or "", r.source_rank, r.vendor) for r in merge.merge_sources(d, u, c).collect())
    none = spark.createDataFrame([], kind)
    u, c = frame(row(None, "D", "u2", 2), row(None, "D", "u1", 1), row("1", "D", "u3", 1)), frame(row(None, "D", "c"))
    d = frame(row(None, "D", "a"), row(None, "D", "b"), row("1", "D", "x"))
    assert merged(d, u, c) == [("", 1, "a"), ("", 1, "b"), ("1", 1, "x")]
    assert merged(none, u, c) == [("", 2, "u1"), ("1", 2, "u3")]
    assert merged(none, none, c) == [("", 3, "c")]


def test_json_keeps_nulls_and_empty_projects(spark, scratch):
    import json
    from outlay.plans import curated as C
    from outlay.plans import static_bundle as SB
    cur = C.shared(spark, SF001, P)
    SB.write_bundle(cur, scratch)
    lines = [json.loads(r.value) for r in spark.read.text(f"{scratch}/pos").collect()]
    assert lines and all(set(x) == set(SB.STATIC_PO_COLUMNS) for x in lines)
    assert spark.read.text(f"{scratch}/insights").count() >= 4
    old = fixtures.doc_old(spark, SF001, P)
    assert json.loads(DOC.refresh_result(old, old, "none").first()[0]) == {
        "project_id": "none", "doc_count": 0, "last_checked": None, "folders": []}
    assert json.loads(DOC.document_payload(old, "none").first()[0]) == {
        "project_id": "none", "last_checked": None, "folders": []}


def test_documents_of_a_merged_label_keep_raw_order(spark):
    cols = "doc_id string, project_id string, " + ", ".join(f"{c} string" for c in (
        "folder_category", "sub_folder", "doc_name", "doc_url", "doc_type", "doc_size", "uploaded_by", "uploaded_at"))
    rows = [("1", "P", None, "s", "z") + (None,) * 5, ("2", "P", "", "s", "a") + (None,) * 5]
    docs = spark.createDataFrame(rows, cols).withColumn("is_deleted", F.lit(0))
    tree = DOC.doc_tree(docs, "P").first().folders
    assert [d.doc_name for d in tree[0].subfolders[0].docs] == ["z", "a"]
