"""Document index, sync state and retention of what refreshes and jobs write."""

import os
import time

from pyspark.sql import functions as F

from conftest import SF001
from outlay import session
from outlay.operators.places import with_places
from outlay.params import SourceParams
from outlay.plans import pipeline as PL
from outlay.sources import fixtures, sinks
from outlay.streaming import doc_sync

P = SourceParams()


def _arrivals(spark, rows):
    """rows: (doc_id, project, snapshot, closing count or None)."""
    return spark.createDataFrame([(d, p, "f", "c", "s", "n", "u", "t", "1", "u", "a", "now", i, s, n)
                                  for i, (d, p, s, n) in enumerate(rows)], doc_sync.INCOMING_SCHEMA)


def _listing(project, snapshot, ids):
    return [(d, project, snapshot, None) for d in ids] + [(None, project, snapshot, len(ids))]


def _stored(spark, table):
    return {r.doc_id: (r.project_id, r.is_deleted) for r in doc_sync.read_current(spark, table).collect()}


def _watch(monkeypatch):
    """Buckets of documents, and folders of the index, that a batch opens."""
    docs, index = [], []
    read_documents, read_index = sinks.read_documents, sinks.read_index

    def documents(spark, root, schema, buckets=None):
        docs.append(None if buckets is None else set(buckets))
        return read_documents(spark, root, schema, buckets)

    def folders(spark, paths):
        index.extend(paths)
        return read_index(spark, paths)

    monkeypatch.setattr(sinks, "read_documents", documents)
    monkeypatch.setattr(sinks, "read_index", folders)
    return docs, index


def test_a_batch_opens_only_its_buckets(spark, scratch, monkeypatch):
    table = os.path.join(scratch, "docs")
    first = [x for p in range(30) for x in _listing(f"P{p}", 1, [f"d{p}-{i}" for i in range(3)])]
    doc_sync.merge_batch(spark, table, "t", _arrivals(spark, first), 0, "s")
    bucket = {f"P{p}": spark.range(1).select(sinks.doc_bucket(F.lit(f"P{p}"))).first()[0] for p in range(30)}
    assert len({bucket["P3"], bucket["P7"], bucket["P9"]}) == 3
    docs, index = _watch(monkeypatch)
    # known documents only: the project's bucket, nothing of the index
    doc_sync.merge_batch(spark, table, "t", _arrivals(spark, _listing("P3", 2, ["d3-0", "d3-1"])), 1, "s")
    assert set().union(*docs) == {bucket["P3"]} and index == []
    # a new document and one that is stored under another project: their buckets of the index, and that project's
    docs.clear()
    doc_sync.merge_batch(spark, table, "t", _arrivals(spark, _listing("P3", 3, ["d3-0", "new", "d7-1"])), 2, "s")
    slots = {spark.range(1).select(sinks.doc_bucket(F.lit(d))).first()[0] for d in ("new", "d7-1")}
    assert set().union(*docs) == {bucket["P3"], bucket["P7"]}
    assert {int(p.rsplit("=", 1)[1]) for p in index} <= slots
    got = _stored(spark, table)
    assert len(got) == 91 and got["new"] == ("P3", 0) and got["d7-1"] == ("P7", 0) and got["d3-1"] == ("P3", 1)
    # the new document is found under its project later on
    doc_sync.merge_batch(spark, table, "t", _arrivals(spark, _listing("P9", 2, ["new"])), 3, "s")
    assert _stored(spark, table)["new"] == ("P3", 0)


def test_index_folders_are_merged(spark, scratch, monkeypatch):
    monkeypatch.setattr(sinks, "INDEX_FOLDERS", 2)
    monkeypatch.setattr(sinks, "DOC_BUCKETS", 1)
    monkeypatch.setattr(sinks.doc_bucket, "__defaults__", (1,))
    table = os.path.join(scratch, "docs")
    for v in range(6):
        doc_sync.merge_batch(spark, table, "t", _arrivals(spark, _listing("P", v, [f"d{i}" for i in range(v + 1)])), v, "s")
        folders = sinks.doc_folders(sinks.doc_log(spark, table), "index")
        assert len(folders[0]) <= 3
        assert sorted(r.doc_id for r in sinks.read_index(spark, folders[0]).collect()) == [f"d{i}" for i in range(v + 1)]


def test_waiting_rows_expire(spark, scratch):
    table = os.path.join(scratch, "docs")
    merge = lambda rows, b, at: doc_sync.merge_batch(spark, table, "t", _arrivals(spark, rows), b, "s", 100, at)
    waiting = lambda: sorted((r.project_id, r.doc_id or "") for r in doc_sync._read_state(
        spark, sinks.doc_paths(sinks.doc_log(spark, table), "state"), list(range(sinks.DOC_BUCKETS)))
        .filter("NOT applied").collect())
    merge([("a", "P", 1, None), (None, "P", 1, 2)], 0, 1000)
    merge([("q", "Q", 1, None)], 1, 1050)
    assert waiting() == [("P", ""), ("P", "a"), ("Q", "q")]
    merge([("b", "P", 1, None)], 2, 1101)        # the rest comes too late: the rows before it are gone
    assert _stored(spark, table) == {} and waiting() == [("P", "b"), ("Q", "q")]
    merge([(None, "Q", 1, 1)], 3, 1150)          # in time
    assert _stored(spark, table) == {"q": ("Q", 0)} and waiting() == [("P", "b")]
    merge([("a", "P", 2, None), (None, "P", 2, 1)], 4, 1160)   # a newer listing ends the wait of an older one
    assert _stored(spark, table) == {"q": ("Q", 0), "a": ("P", 0)} and waiting() == []


def test_restart_after_the_log_was_folded(spark, scratch):
    table = os.path.join(scratch, "docs")
    merge = lambda rows, b: doc_sync.merge_batch(spark, table, "t", _arrivals(spark, rows), b, "s")
    merge(_listing("P", 1, ["a", "b"]) + [("q", "Q", 1, None)], 0)
    merge(_listing("P", 2, ["a"]), 1)
    before = _stored(spark, table)
    assert sinks.expire_documents(spark, table) > 0
    assert session.list_files(spark, f"{table}/_log") == [] or all(".json" not in f[0] for f in session.list_files(spark, f"{table}/_log"))
    assert _stored(spark, table) == before
    merge(_listing("P", 3, ["a", "b"]), 1)       # retried batch: nothing
    assert _stored(spark, table) == before
    merge([(None, "Q", 1, 1), *_listing("P", 1, [])], 2)   # the waiting row is still there; an older listing is dropped
    assert _stored(spark, table) == {**before, "q": ("Q", 0)}
    assert sinks.expire_documents(spark, table) > 0 and sinks.expire_documents(spark, table) == 0
    assert _stored(spark, table) == {**before, "q": ("Q", 0)}
    merge(_listing("R", 1, ["r"]), 3)
    assert _stored(spark, table) == {**before, "q": ("Q", 0), "r": ("R", 0)}


def _versions(spark, root):
    return sorted(int(d.rsplit("=", 1)[1]) for d in session.list_dirs(spark, root) if "/v=" in d)


def test_refreshes_keep_the_newest_versions(spark, scratch):
    raw = fixtures.load_raw(spark, SF001, P)
    small = fixtures.RawInputs(raw.projects, raw.enrichment, raw.po_lines.filter("po_nbr < '00000300'"),
                               raw.nodes.filter("project_no < 30"))
    small = fixtures.RawInputs(*[spark.createDataFrame(df.collect(), df.schema) for df in (
        small.projects, small.enrichment, small.po_lines, small.nodes)])
    docs = lambda: fixtures.doc_old(spark, SF001, P)
    counts = []
    for i in range(3):
        cur = PL.refresh(spark, small, docs, scratch, P)
        counts.append(cur.pos.count())
        if i == 1:
            reader = PL.current(spark, scratch).pos
        spark.range(1).write.mode("overwrite").parquet(f"{scratch}/curated/v=90{i}")   # a run that failed
    assert _versions(spark, f"{scratch}/curated") == [1, 2, 902]
    assert reader.count() == counts[1] and PL.current(spark, scratch).pos.count() == counts[2]
    assert len(PL.stored_freshness(spark, scratch).collect()) == 4
    assert sinks.current_version(spark, f"{scratch}/curated")[0] == 2
    # an age limit leaves what is younger
    assert sinks.expire_versions(spark, f"{scratch}/curated", 1, min_age_s=3600) == []
    assert len(sinks.expire_versions(spark, f"{scratch}/curated", 1)) == 2
    assert _versions(spark, f"{scratch}/curated") == [2] and PL.current(spark, scratch).pos.count() == counts[2]


def test_old_scratch_goes_and_new_scratch_stays(spark):
    df = with_places(spark.range(50), [F.col("id")])
    top = f"{session.checkpoint_dir(spark).rstrip('/')}/outlay-places"
    assert session.list_dirs(spark, top)
    assert [d for d in session.expire_scratch(spark) if "outlay-places" in d] == []
    assert df.filter("position = 50").first()["id"] == 49
    time.sleep(1.1)
    assert any("outlay-places" in d for d in session.expire_scratch(spark, 1))
    assert session.list_dirs(spark, top) == []
