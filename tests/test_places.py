"""Places of all rows of the sorted lists."""

import random

from pyspark.sql import functions as F

import __spark_entry__ as E
from outlay.operators.places import with_places
from outlay.params import SourceParams
from outlay.plans import curated as C
from outlay.plans import pos as POS
from outlay.plans import static_bundle as SB

P = SourceParams()
SF01 = "/root/testdata/sf0.01"


def test_places_follow_the_whole_sort_key(spark):
    rng = random.Random(3)
    rows = [(rng.choice("xyz"), rng.choice([None, 1, 1, 1, 2, 3]), i) for i in range(700)]
    df = spark.createDataFrame(rows, "list string, a int, i int").repartition(9)
    nulls_first = lambda r: (r[1] is not None, r[1] or 0, r[2])
    placed = with_places(df, [F.col("a").asc(), F.col("i").asc()])
    assert placed.columns == ["list", "a", "i", "position"]
    got = {r.i: r.position for r in placed.collect()}
    assert got == {r[2]: n for n, r in enumerate(sorted(rows, key=nulls_first), 1)}
    down = with_places(df, [F.col("a").desc(), F.col("i").asc()], ("list",)).collect()
    for x in "xyz":
        want = sorted((r for r in rows if r[0] == x), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        assert [r.i for r in sorted((r for r in down if r.list == x), key=lambda r: r.position)] == [r[2] for r in want]
        assert sorted(r.position for r in down if r.list == x) == list(range(1, len(want) + 1))
    assert with_places(df.limit(0), [F.col("a").asc()]).count() == 0


def test_every_project_and_static_po_has_its_place(spark):
    cur = C.shared(spark, SF01, P)
    for name, rows in (("project_places", cur.projects), ("static_po_places", SB.static_pos(cur))):
        places = [r.position for r in E.queries()[name](spark, SF01).collect()]
        assert sorted(places) == list(range(1, rows.count() + 1)) and len(places) > 500


def test_every_po_has_its_place_under_every_key(spark):
    base = POS.po_base(C.shared(spark, SF01, P)).cache()
    rows, cities = base.count(), base.filter("city IS NOT NULL").count()
    assert 0 < cities < rows
    for way, real in (("asc", range(rows - cities + 1, rows + 1)), ("desc", range(1, cities + 1))):
        out = E.queries()["po_places_" + way](spark, SF01)
        figures = out.groupBy("sort").agg(F.count("*"), F.min("position"), F.max("position"), F.count_distinct("position"))
        assert {r[0]: tuple(r)[1:] for r in figures.collect()} == dict.fromkeys(POS.PO_SORT, (rows, 1, rows, rows))
        ends = base.groupBy("po_number", "project_id").agg(F.max("city").alias("city"))
        by_city = (out.filter("sort = 'city' AND project_id IS NOT NULL AND po_number IS NOT NULL")
                   .join(ends, ["po_number", "project_id"]).filter("city IS NOT NULL").orderBy("position").collect())
        got = [r.city for r in by_city]
        assert got == sorted(got, reverse=way == "desc") and len(set(got)) > 1
        assert {r.position for r in by_city} <= set(real)
