"""Postings of the trigram index: a row per gram and chunk, packed where the copy is read."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from outlay.operators import gram_index as G
from outlay.operators import sorted_copy as SC
from outlay.params import SourceParams
from outlay.plans import curated as C
from outlay.plans import pos as POS


def _grams(*values):
    fold = lambda s: "".join(c.lower() if c.isascii() else c for c in s)
    return {fold(v)[i:i + 3] for v in values if v for i in range(len(v) - 2)}


def test_a_gram_of_every_row_is_one_run_a_chunk(spark, scratch):
    df = spark.range(3000).select("id", F.lit("Common text").alias("a"))
    index = G.write_index(SC.write_sorted(df, [("id", False)], f"{scratch}/rows", 4), [F.col("a")], f"{scratch}/grams")
    ranges = index.copy.rows.select("range").distinct().count()
    stored = spark.read.parquet(f"{scratch}/grams/rows")  # 27,000 postings, a run for each gram and range
    assert stored.count() == 9 * ranges and {len(r.runs) for r in stored.collect()} == {4}
    assert {(r.gram, r.n) for r in index.postings.manifest.groupBy("gram").agg(F.sum("n").alias("n")).collect()} == {
        (g, 3000) for g in _grams("common text")}
    assert G.search(index, {"mmo", "ext"}, F.col("id") < 7).count() == 7


def test_packing_equals_the_grams_of_each_row():
    rng = random.Random(6)
    word = lambda: rng.choice([None, "", "Ab", "same text", "".join(rng.choices("aBÄ😀1", k=rng.randint(0, 8)))])
    places = sorted(rng.sample(range((5 << 33) + G.CHUNK - 400, (5 << 33) + G.CHUNK + 400), 600))  # gaps, two chunks
    rows = [(5, p, word(), word()) for p in places]
    of = lambda part: pa.RecordBatch.from_pylist([dict(zip(("range", "place", "v0", "v1"), r)) for r in part],
                                                 pa.schema([("range", pa.int32()), ("place", pa.int64()), ("v0", pa.string()), ("v1", pa.string())]))
    want = sorted((g, p) for _, p, a, b in rows for g in _grams(a, b))
    shuffled = rng.sample(rows, len(rows))
    for parts in ([rows], [rows[:70], rows[70:330], [], rows[330:]], [shuffled[:300], shuffled[300:]]):
        packed = list(G._packed(iter(map(of, parts))))
        got = [(r["gram"], r["at"]) for b in G._unpacked(iter(packed)) for r in b.to_pylist()]
        assert sorted(got) == want and sum(n for b in packed for n in b["n"].to_pylist()) == len(want)


def test_a_chunk_read_by_two_tasks_meets_again(spark, scratch):
    df = spark.createDataFrame([(1, "abcd"), (2, "abc"), (3, "bcd"), (4, "xabcdx")], "id long, a string")
    index = G.write_index(SC.write_sorted(df, [("id", False)], f"{scratch}/rows", 1), [F.col("a")], f"{scratch}/grams")
    whole = index.copy.rows.select("range", "place", F.col("a").alias("v0"))
    halves = whole.filter("place % 2 = 0").mapInArrow(G._packed, G.PACKED_TYPE).unionByName(
        whole.filter("place % 2 = 1").mapInArrow(G._packed, G.PACKED_TYPE))
    split = G.GramIndex(index.copy, G.Postings(halves, index.postings.manifest))
    assert sorted(r.id for r in G.search(split, {"abc", "bcd"}, None).collect()) == [1, 4]


def test_ranges_follow_from_the_rows_after_the_join(spark):
    pos = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "b"), ("4", None), ("5", "z")], "po_number string, proj_def string")
    projects = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), ("y",)], "proj_def string")
    cur = C.Curated(projects, projects, pos, projects)
    assert POS.base_rows(cur) == pos.join(projects, "proj_def", "left").count() == 9
    assert POS.base_rows(C.Curated(projects, projects, pos.limit(0), projects)) == 0
    sf = C.shared(spark, "/root/testdata/sf0.001", SourceParams())
    assert POS.base_rows(sf) == POS.po_base(sf).count()
