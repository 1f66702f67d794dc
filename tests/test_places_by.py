"""Places under several sort keys: rows are dealt once, values are sorted in place of rows."""

import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from outlay.operators.places import places_by
from outlay.params import SourceParams
from outlay.plans import curated as C
from outlay.plans import pos as POS
from outlay.session import checkpoint_dir

SORTS = {"by_word": "word", "by_day": "day", "by_sum": "total", "by_count": "n", "by_id": "a"}


def _rows(n=900):
    rng = random.Random(8)
    day = lambda: rng.choice([None, dt.datetime(2001, 1, rng.randint(1, 28), 5)])
    return [(rng.choice([None, f"{i // 3:04d}"]), rng.choice([None, str(i % 3)]), rng.choice([None, "", "Zed", "zed", "Äh", "😀"]),
             day(), None if i % 7 == 0 else f"{rng.choice([-5, 0, 3, 10 ** 20])}.25", rng.choice([None, 1, 2])) for i in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "a string, b string, word string, day timestamp, total string, n int").withColumn(
        "total", F.col("total").cast("decimal(28,2)")).repartition(5)


@pytest.mark.parametrize("desc", [False, True])
@pytest.mark.parametrize("piece_rows", [40, 1 << 17])
def test_places_equal_a_sort_of_all_rows(spark, desc, piece_rows):
    df = _frame(spark, _rows())
    out = places_by(df, ["a", "b"], SORTS, desc, 6, piece_rows)
    assert out.columns == ["sort", "a", "b", "position"] and out.schema["position"].dataType.simpleString() == "bigint"
    got = [tuple(r) for r in out.collect()]
    rows = [tuple(r) for r in df.collect()]
    up = lambda v: (v is not None, 0 if v is None else v.encode() if isinstance(v, str) else v)
    for name, column in SORTS.items():
        k = df.columns.index(column)
        ordered = sorted(sorted(rows, key=lambda r: (up(r[0]), up(r[1]))), key=lambda r: up(r[k]), reverse=desc)
        if desc:  # a reversed sort is stable too: rows of equal keys keep the order of the ties
            assert ordered[-1][k] is None
        assert sorted((r[1:] for r in got if r[0] == name), key=lambda r: r[2]) == [(r[0], r[1], i) for i, r in enumerate(ordered, 1)]


def test_no_rows_and_a_key_of_nulls(spark):
    df = _frame(spark, _rows(60))
    assert places_by(df.limit(0), ["a", "b"], SORTS, True, 4).count() == 0
    out = places_by(df.withColumn("word", F.lit(None).cast("string")), ["a", "b"], {"x": "word"}, True, 4)
    assert sorted(r.position for r in out.collect()) == list(range(1, 61))


def test_values_are_sorted_and_not_rows(spark):
    """5,000 rows with three values in each of two keys: a row a value, key and piece is sorted, not one a row and key."""
    top = f"{checkpoint_dir(spark).rstrip('/')}/outlay-places/"
    before = set(glob.glob(f"{top}*-pieces"))
    df = spark.range(5000).select(F.format_string("%05d", "id").alias("a"), F.lit("p").alias("b"), (F.col("id") % 3).alias("x"),
                                  (F.col("id") % 3).cast("string").alias("y"))
    assert places_by(df, ["a", "b"], {"x": "x", "y": "y"}, False, 4).agg(F.max("position")).first()[0] == 5000
    (path,) = set(glob.glob(f"{top}*-pieces")) - before
    assert spark.read.parquet(path).filter("ids IS NULL").count() == 2 * 3 * spark.read.parquet(path).filter("ids IS NOT NULL").count()
    assert spark.read.parquet(path).filter("ids IS NOT NULL").count() == 4


def test_a_po_of_many_projects_keeps_its_rows_together(spark):
    """Ten projects share each definition: every key's list has all joined rows, those of a PO in the order of the projects."""
    cur = C.shared(spark, "/root/testdata/sf0.001", SourceParams())
    fan = spark.range(10).withColumnRenamed("id", "copy")
    wide = C.Curated(cur.projects.crossJoin(fan).withColumn("project_id", F.concat("project_id", F.col("copy").cast("string"))).drop("copy"),
                     cur.budgets, cur.pos, cur.fund_nodes)
    rows = POS.po_base(wide).select("po_number", "project_id", "vendor").collect()
    got = POS.po_places(wide, "desc").filter("sort = 'vendor'").collect()
    up = lambda v: (v is not None, v or "")
    want = sorted(sorted(rows, key=lambda r: (up(r.po_number), up(r.project_id))), key=lambda r: up(r.vendor), reverse=True)
    assert [(r.po_number, r.project_id) for r in sorted(got, key=lambda r: r.position)] == [(r.po_number, r.project_id) for r in want]
    assert len(want) > 2 * cur.pos.count()
