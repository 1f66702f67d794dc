"""Keyset pages from sorted copies against the plain keyset pages."""

import random
import re

from pyspark.sql import functions as F

from conftest import SF001
from outlay.operators import sorted_copy as SC
from outlay.params import PoFilter, SourceParams
from outlay.plans import curated as C
from outlay.plans import pos as POS


def _rows(spark, n=400):
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(12)]), f"k{i:03d}" if i % 7 else None, i) for i in range(n)]
    return rows, spark.createDataFrame(rows, "a int, b string, id long")


def _want(rows, desc):
    nulls = lambda v, down: ((v is None) == down, 0 if v is None else (-v if down else v))
    return sorted(rows, key=lambda r: (nulls(r[0], desc), (r[1] is not None, r[1] or ""), r[2]))


def test_pages_of_a_copy_concatenate(spark, scratch):
    rows, df = _rows(spark)
    for desc in (False, True):
        order = [("a", desc), ("b", False), ("id", False)]
        copy = SC.write_sorted(df, order, f"{scratch}/{desc}", ranges=9)
        assert copy.manifest.count() > 4 and copy.manifest.agg(F.sum("n")).first()[0] == len(rows)
        for where, keep in ((None, lambda r: True), (F.col("id") % 10 == 3, lambda r: r[2] % 10 == 3)):
            got, after = [], None
            while True:
                page = [tuple(r) for r in SC.page_after(copy, after, 37, where).collect()]
                got += page
                if len(page) < 37:
                    break
                after = page[-1]
            assert got == [r for r in _want(rows, desc) if keep(r)]
    assert SC.page_after(copy, (None, "zzz", 0), 5).count() == 0


def test_a_page_reads_the_ranges_at_its_cursor(spark, scratch):
    _, df = _rows(spark)
    order = [("id", False)]
    copy = SC.write_sorted(df, order, scratch, ranges=10)
    page = SC.page_after(copy, (200,), 20)
    assert [r.id for r in page.collect()] == list(range(201, 221))
    scan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(range" in scan
    bounds = {op: int(v) for op, v in re.findall(r"\(range#\d+L? (>=|<=) (\d+)\)", scan)}
    assert 0 <= bounds["<="] - bounds[">="] <= 1 and copy.manifest.count() >= 8
    empty = SC.write_sorted(df.limit(0), order, f"{scratch}/none")
    assert SC.page_after(empty, None, 5).count() == 0


def test_po_pages_equal_the_plain_pages(spark, scratch):
    cur = C.shared(spark, SF001, SourceParams())
    for f, after in ((PoFilter(sort="remaining_to_invoice", order="desc", page_size=50), (900.0, "00000100", None)),
                     (PoFilter(sort="state", order="asc", page_size=80, has_remaining=True), (None, "00000100", "1")),
                     (PoFilter(sort="created_date", order="asc", page_size=30), None)):
        copy = POS.sorted_base(cur, f, f"{scratch}/{f.sort}", ranges=6)
        want = [tuple(r) for r in POS.po_page_after(cur, f, after).collect()]
        assert [tuple(r) for r in POS.po_page_sorted(copy, f, after).collect()] == want and want
