"""Operators on vectors, mixes, models, shards, bins and archives, and the pipeline."""

import base64
import hashlib
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from outlay.llm import (best_fit_packing, common, context_tree, curriculum_mix, feistel_shard, itq_dedup, quality_rules,
                        queries, warc)
from outlay.llm.common import stage

from .test_text_ops import EDGE, WORD, frame, measures, without_repeats


def vectors():
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for label in (0, 1, 2):
        for _ in range(25):
            base = rng.standard_normal(16)
            for _ in range(rng.integers(1, 9)):
                rows.append((k, [float(x) for x in base + rng.normal(0, 0.045, 16)], int(label)))
                k += 1
    hot = rng.standard_normal(16)
    rows += [(k + i, [float(x) for x in hot + rng.normal(0, 0.04, 16)], 3) for i in range(150)]
    k += 150
    rows += [(k + i, rows[0][1], 0) for i in range(5)]
    k += 5
    nan, inf = float("nan"), float("inf")
    rows += [(k + i, v, lab) for i, (v, lab) in enumerate([
        (None, 1), ([], 1), ([0.0] * 16, 1), ([nan] + [1.0] * 15, 1), ([inf] + [1.0] * 15, 1), ([None] + [1.0] * 15, 1),
        (rows[0][1], None), ([1.0, 2.0], 1), ([2.0, 4.0], 1), ([-1.0, 2.0], 1)])]
    return rows + [(None, rows[0][1], 0)]


def test_itq_links_match_brute_force(spark):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    good = [i for i, (_, v, lab) in enumerate(rows) if lab is not None and v and all(
        x is not None and math.isfinite(x) for x in v) and any(v)]
    links = defaultdict(set)
    for n, i in enumerate(good):
        for j in good[:n]:
            a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.98:
                links[i].add(j)
                links[j].add(i)
    total = sum(map(len, links.values()))
    for cap in (1024, 20):  # whole buckets, and buckets split into blocks
        got = {r.vec_id: r for r in itq_dedup.link(df, cap=cap, per_task=500).collect()}
        assert len(got) == len(rows)
        assert all(got[rows[i][0]].n_links <= len(links[i]) for i in range(len(rows)))
        assert sum(r.n_links for r in got.values()) >= 0.99 * total
        assert all(got[rows[i][0]].n_links == 0 and got[rows[i][0]].component_id == rows[i][0]
                   for i in range(len(rows)) if not links[i])
        seen: set[int] = set()
        for i in range(len(rows)):
            if i not in seen and rows[i][0] is not None:
                reach, todo = {i}, [i]
                while todo:
                    todo = [y for x in todo for y in links[x] if y not in reach]
                    reach |= set(todo)
                seen |= reach
                low = min(rows[x][0] for x in reach if rows[x][0] is not None)
                assert all(got[rows[x][0]].component_id == low for x in reach if rows[x][0] is not None)
    assert itq_dedup.link(df.limit(0)).count() == 0


def test_itq_table_plan_reaches_the_recall():
    for n in (1, 10 ** 3, 10 ** 6, 10 ** 9, 10 ** 11):
        bits, tables = itq_dedup.table_plan(n)
        agree = (1 - math.acos(0.98) / math.pi) ** bits
        assert 1 - (1 - agree) ** tables >= itq_dedup.RECALL and bits <= 30


def test_itq_codes_stay_balanced_under_a_common_offset(spark):
    """Vectors with an offset of three deviations in every component: even bits, short buckets, whole links."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 24)) + 3
    x[700:1000] = x[:300] + 0.02 * rng.standard_normal((300, 24))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    middle = itq_dedup.centre(unit)
    bits, tables = itq_dedup.table_plan(1500, radii=np.linalg.norm(unit - middle, axis=1))
    turns = itq_dedup.learn_rotations(unit - middle, -(-bits * tables // 24))
    found = itq_dedup.keys(unit - middle, turns, bits, tables)
    ones = (found[:, :, None] >> np.arange(bits) & 1).mean(axis=0)
    assert np.abs(ones - 0.5).mean() < 0.05
    assert np.bincount(found[:, 0]).max() < 1500 / 2
    links = unit @ unit.T >= 0.98
    np.fill_diagonal(links, False)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in itq_dedup.link(df).collect()}
    assert all(got[i] <= links[i].sum() for i in got) and sum(got.values()) >= 0.99 * links.sum() > 500


def test_itq_query_counts_planted_links_as_its_sql(spark, scratch):
    import duckdb
    rng = np.random.default_rng(5)
    rows = []
    for i in range(120):
        v = rng.standard_normal(16)
        for k in range(1 + 3 * (i % 4 == 0)):
            rows.append((len(rows), (v + 0.01 * k * rng.standard_normal(16)).tolist(), i % 3, "clash"))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, x string")
    df.coalesce(1).write.parquet(f"{scratch}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{scratch}/embeddings.parquet/*.parquet')")
    want = sorted(con.execute(queries.ORACLE["op4_itq_dedup"]).fetchall())
    assert sorted(tuple(r) for r in queries.op4_itq_dedup(spark, scratch).collect()) == want
    assert sum(r[1] for r in want) > 100


def shares(sizes, weights=(3, 1, 2), budget=1.5, cap=2):
    """Targets by handing the excess on, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    got, left, open_ = dict.fromkeys(names, 0.0), budget * sum(sizes.values()), set(names)
    while left > 1e-9 and open_:
        total = sum(w[s] for s in open_)
        add = {s: left * w[s] / total for s in open_}
        left = 0.0
        for s, x in add.items():
            got[s] += x
            if got[s] >= cap * sizes[s]:
                left += got[s] - cap * sizes[s]
                got[s] = cap * sizes[s]
                open_.discard(s)
    return got


def near_targets(mixed, rows, sizes, want):
    """Whole documents only, twice at most, and each source within half its longest document of the target."""
    texts, taken, longest = {(r[0], r[1]) for r in rows}, defaultdict(int), defaultdict(int)
    for _, t, s, *_ in rows:
        longest[s] = max(longest[s], len(WORD.findall(t or "")))
    for r in mixed:
        assert (r.doc_id, r.text) in texts
        taken[r.source] += len(WORD.findall(r.text or ""))
    copies, given = Counter((r.doc_id, r.text) for r in mixed), Counter((r[0], r[1]) for r in rows)
    assert all(n <= 2 * given[k] for k, n in copies.items())
    assert all(abs(taken[s] - want[s]) <= longest[s] / 2 + 1 for s in sizes)


def test_mix_targets_and_taken_words(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("x" * rng.randint(0, 40)), rng.choice(["a", "b", "b", "b", "é", "", None, "z"]), 1)
            for i in range(300)]
    rows += [(900, None, "only empty", 1), (901, " \n", "only empty", 1), (None, "null id", "a", 1), (5, rows[5][1], rows[5][2], 1),
             (902, "one " * 5000, "big", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    out = curriculum_mix.mix(df, per_range=20).collect()
    sizes = defaultdict(int)
    for _, t, s, _ in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = shares(sizes)
    taken = defaultdict(int)
    for r in out:
        n = sum(p.words for p in r.parts)
        taken[r.source] += n
        assert n <= 2 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert all(0 <= p.position <= 1 for p in r.parts)
    assert len(out) == len(rows)
    assert all(taken[s] == round(want[s]) for s in sizes)
    again = curriculum_mix.mix(df.repartition(7), per_range=100000).collect()
    assert Counter(map(str, out)) == Counter(map(str, again))
    ordered = [r.position for r in curriculum_mix.in_training_order(curriculum_mix.mix(df)).collect()]
    assert ordered == sorted(ordered)
    whole = curriculum_mix.materialize(df).collect()
    near_targets(whole, rows, sizes, want)
    assert curriculum_mix.materialize(df.limit(0)).count() == 0


def test_schedule_inverts_its_integral(spark):
    s = curriculum_mix.Schedule(((0.0, 2.0), (0.25, 0.0), (0.5, 0.0), (1.0, 3.0)))
    weight = lambda t: np.interp(t, [k for k, _ in s.knots], [w for _, w in s.knots])
    grid = np.linspace(0, 1, 100001)
    total = np.concatenate(([0], np.cumsum((weight(grid[1:]) + weight(grid[:-1])) / 2)))
    total /= total[-1]
    df = spark.range(0, 101).selectExpr("id / 100.0D AS share")
    from pyspark.sql import functions as F
    for r in df.select("share", s.invert(F.col("share")).alias("t")).collect():
        assert np.interp(r.t, grid, total) == pytest.approx(r.share, abs=1e-6)


def brute_tree_score(docs, depth=context_tree.DEPTH):
    """Score per document by recursion over explicit context trees."""
    counts = Counter()
    for i, t in docs:
        if not context_tree.held_out(i):
            counts.update([*(t or "").encode().lower().split(), b"\n"])
    trees = defaultdict(lambda: [0, 0])

    def events(text):
        line = b" " * depth + b"\n " + b"".join(w + b" " for w in [*(text or "").encode().lower().split(), b"\n"])
        for p in range(depth + 2, len(line)):
            for k in range(8):
                q, bit = (1 << k) | line[p] >> (8 - k), line[p] >> (7 - k) & 1
                yield line[p - depth:p], q, bit

    for i, t in docs:
        if not context_tree.held_out(i):
            for ctx, q, bit in events(t):
                for d in range(depth + 1):
                    trees[ctx[depth - d:], q][bit] += 1
    below = defaultdict(set)
    for ctx, q in trees:
        if ctx:
            below[ctx[1:], q].add(ctx)
    kt = lambda n: math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.log(math.pi) - math.lgamma(sum(n) + 1)
    memo = {}

    def weighted(ctx, q):
        if (ctx, q) not in memo:
            own = kt(trees[ctx, q])
            memo[ctx, q] = own if len(ctx) == depth else np.logaddexp(
                math.log(0.5) + own, math.log(0.5) + sum(weighted(c, q) for c in below[ctx, q]))
        return memo[ctx, q]

    def one(ctx, q, d=0):
        here = ctx[depth - d:]
        n = trees.get((here, q), [0, 0])
        p = (n[1] + 0.5) / (sum(n) + 1)
        if d == depth:
            return p
        stop = 0.5 if (here, q) not in trees else math.exp(math.log(0.5) + kt(n) - weighted(here, q))
        return stop * p + (1 - stop) * one(ctx, q, d + 1)

    value = lambda t: sum(math.log10(one(c, q) if b else 1 - one(c, q)) for c, q, b in events(t))
    total, kinds = sum(counts.values()), len(counts)
    for i, t in docs:
        tokens = [*(t or "").encode().lower().split(), b"\n"]
        yield (i, context_tree.held_out(i), len(tokens), sum(counts[w] > 0 for w in tokens), total,
               sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in tokens),
               value(t))


def test_context_tree_matches_brute_force(spark):
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choices("abÄ", k=rng.randint(1, 6))) for _ in range(rng.randint(0, 12))) for _ in range(30)]
    docs = frame(spark, texts + EDGE[:8])
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    key = lambda r: (str(r[0]), r[2], round(r[6], 6))
    got = sorted((tuple(r)[:7] for r in context_tree.score(docs.repartition(3)).collect()), key=key)
    want = sorted(brute_tree_score(rows), key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-8)
    assert context_tree.score(docs.limit(0)).count() == 0
    assert context_tree.score(docs.filter("doc_id = 10 OR doc_id IS NULL")).count() >= 1


def test_context_tree_learns(spark):
    rows = [(i, "the quick brown fox jumps over the lazy dog " * 5) for i in range(50)] + [
        (i, "zqx jvk wpf " * 5) for i in range(1000, 1200) if context_tree.held_out(i)]
    got = context_tree.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    known = [r.bits_per_byte for r in got if r.held_out and r.doc_id < 50]
    strange = [r.bits_per_byte for r in got if r.doc_id >= 1000]
    assert max(known) < 1 < 4 < min(strange)


def test_context_tree_beats_unigrams_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = context_tree.score(docs).filter("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert held[0] > held[1]


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 2, 10, 1e3, 1e5, 2e6, 1e9])
    assert context_tree.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=2e-11)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 26, 101])
def test_feistel_is_a_permutation(spark, n):
    a, b = feistel_shard.domain(n)
    assert a * b >= n and a * b - n < max(a, 2)
    from pyspark.sql import functions as F
    whole = [r[0] for r in spark.range(a * b).select(feistel_shard.feistel(F.col("id"), a, b, 42)).collect()]
    assert sorted(whole) == list(range(a * b))
    walk = feistel_shard.longest_walk(spark, n, a, b, 42)
    got = [r[0] for r in spark.range(n).select(feistel_shard.permute(F.col("id"), n, a, b, 42, walk)).collect()]
    assert sorted(got) == list(range(n))
    for x, y in enumerate(got):  # the walk itself
        p = whole[x]
        while p >= n:
            p = whole[p]
        assert p == y


def test_shards_are_gapless_and_even(spark):
    docs = frame(spark, EDGE * 9)
    out = feistel_shard.assign(docs).collect()
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert len(out) == docs.count() and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 24
    size = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert size == Counter((r.doc_id, r["size"], r.text_crc32) for r in out)
    again = feistel_shard.assign(docs.repartition(5)).collect()
    key = lambda rows: Counter((r.doc_id, r["size"], r.text_crc32, r.shard, r.slot) for r in rows)
    assert key(out) == key(again)
    assert feistel_shard.assign(docs.limit(0)).count() == 0


def brute_pack(sizes, sources, clusters, capacity):
    bins, out = [], []  # [free, sources, clusters]
    for i, s in enumerate(sizes):
        for k in range(s // capacity):
            bins.append([0, set(), set()])
            out.append((i, k, len(bins) - 1, 0))
    rest = [(-(s % capacity), i) for i, s in enumerate(sizes) if s % capacity or s < capacity]
    for tail, i in sorted(rest):
        fits = [(b[0], n) for n, b in enumerate(bins) if b[0] >= max(-tail, 1) and sources[i] not in b[1]
                and clusters[i] not in b[2]]
        n = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([capacity, set(), set()])
        out.append((i, sizes[i] // capacity, n, capacity - bins[n][0]))
        bins[n][0] += tail
        bins[n][1].add(sources[i])
        bins[n][2].add(clusters[i])
    return out


def test_packing_matches_brute_force():
    rng = random.Random(8)
    for _ in range(30):
        n = rng.randint(1, 120)
        sizes = [rng.randint(1, 70) for _ in range(n)]
        sources, clusters = rng.choices(range(5), k=n), rng.choices(range(n), k=n)
        got = best_fit_packing.pack_group(sizes, sources, clusters, 32)
        assert sorted(got) == sorted(brute_pack(sizes, sources, clusters, 32))


def test_packing_keeps_everything_and_separates_copies(spark):
    docs = frame(spark, EDGE * 5 + ["long " * 9000])
    out = best_fit_packing.pack(docs, capacity=64, group_docs=20).collect()
    whole = Counter()
    bins = defaultdict(list)
    for r in out:
        whole[r.doc_id] += r.piece_tokens
        bins[r.pack_group, r.bin].append(r)
    want = Counter()
    for r in docs.collect():
        want[r.doc_id] += len(WORD.findall(r.text or "")) + 1
    assert whole == want
    for rows in bins.values():
        rows.sort(key=lambda r: r.bin_offset)
        assert sum(r.piece_tokens for r in rows) <= 64
        assert all(a.bin_offset + a.piece_tokens == b.bin_offset for a, b in zip(rows, rows[1:]))
        assert len({r.cluster for r in rows}) == len(rows) == len({r.source for r in rows})
    assert best_fit_packing.pack(docs.limit(0)).count() == 0


PAGES = "page_id long, url string, html string, revisit int, sha string"


def pages(spark):
    rng = random.Random(7)
    texts = [None, "", "same", "same", "same", "ünï", "WARC/1.1\r\n\r\n", "\x1f", "gzip \x1f\x08 \r\n\r\nx"]
    texts += ["".join(rng.choices("abc \r\n<>é", k=rng.randint(0, 3000))) for _ in range(60)]
    rows = [(i, f"http://e.org/{i}\r\nX: y" if i % 2 else None, t, 1, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [(None, None, "same", 1, "x"), (None, None, "alone", 1, "x"), rows[4], rows[9]], PAGES)


@pytest.mark.parametrize("split", [61, 4096, 8 << 20])
def test_warc_round_trip_by_ranges(spark, scratch, split):
    df = pages(spark)
    folder = os.path.join(scratch, f"warc{split}")
    manifest = warc.write(df, folder, file_bytes=20000)
    got = warc.read(spark, folder, manifest, split_bytes=split, payload=True).collect()
    rows = [(r.page_id, r.html or "") for r in df.collect()]
    top = {}
    for i, h in rows:
        top[h] = max(top.get(h, -1), -1 if i is None else i)
    want = Counter()
    for i, h in rows:
        again = top[h] >= 0 and (i is None or i < top[h])
        sha = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        want[i, len(h.encode()), sha, "revisit" if again else "response", top[h] if again else None] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    html = dict(rows)
    assert all(bytes(r.payload) == html[r.page_id].encode() for r in got
               if r.record_type == "response" and r.page_id is not None)


def test_warc_reader_skips_what_is_no_record():
    good = [warc.member(warc.record(i, None, b"x" * i * 50, None, False)) for i in range(5)]
    data = (b"junk \x1f\x8b\x08 junk" + good[0] + warc.member(b"no record") + good[1] + b"\x1f\x8b" + good[2]
            + warc.member(warc.record(9, None, b"cut", None, False)[:-20]) + good[3] + good[4][:-9])
    read = lambda at, n: data[at:at + n]
    for step in (1, 7, 50, 10 ** 6):
        got = [r for at in range(0, len(data), step) for r in warc.members(read, at, min(at + step, len(data)))]
        assert [warc._page(r["warc-record-id"]) for _, r in got] == [0, 1, 2, 3]


def test_warc_names_damaged_files(spark, scratch):
    df, folder = pages(spark), os.path.join(scratch, "damaged")
    manifest = warc.write(df, folder, file_bytes=20000)
    assert warc.verify(warc.read(spark, folder, manifest), manifest).count() == df.count()
    hurt = manifest.orderBy("path").first()
    with open(os.path.join(folder.removeprefix("file://"), hurt.path), "r+b") as f:
        f.seek(hurt.bytes // 2)
        f.write(b"\0" * 40)
    with pytest.raises(warc.DamagedArchive, match=rf"{hurt.path}: \d+ of {hurt.records} records"):
        warc.verify(warc.read(spark, folder, manifest), manifest)


def test_warc_empty(spark):
    assert warc.round_trip(pages(spark).limit(0)).count() == 0


def test_pipeline_stages_match_brute_force(spark):
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [" ".join(f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(5, 200))) for _ in range(50)]
    texts += [texts[3], texts[4] + " tail", texts[5] + " " + passage, texts[6] + " " + passage] + EDGE
    docs = frame(spark, texts)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "substring_dedup", "mixing",
                                                      "best_fit_packing"]
    state, seen = docs, {}
    for name, step in corpus_pipeline.STAGES:
        before = state
        state = stage(step(spark, state, ""), name)
        seen[name] = (before, state)
        if name != "best_fit_packing":
            assert state.columns == docs.columns
    rows = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    before, after = seen["quality_rules"]
    good = [x for x in rows(before) if (m := measures(x[1])) and m[0] >= 10 and 5 * m[4] <= m[0] and 10 * m[2] <= 3 * m[0]]
    kept = rows(after)
    assert set(kept) <= set(good) and {(i, t) for i, t in good if i is not None and i < 50} <= set(kept)
    before, after = seen["simhash_near_dedup"]
    assert 50 not in [i for i, _ in rows(after)] and set(rows(after)) <= set(rows(before))
    before, after = seen["substring_dedup"]
    want = Counter((i, tuple(k)) for i, _, k in without_repeats(rows(before)))
    assert Counter((i, tuple(WORD.findall(t))) for i, t in rows(after)) == want
    before, after = seen["mixing"]
    sizes = defaultdict(int)
    for r in before.collect():
        sizes[r.source] += len(WORD.findall(r.text))
    near_targets(after.collect(), [(r.doc_id, r.text, r.source) for r in before.collect()], sizes, shares(sizes))
    before, after = seen["best_fit_packing"]
    assert sum(r.piece_tokens for r in after.collect()) == sum(len(WORD.findall(t)) + 1 for _, t in rows(before))


def test_near_copies_never_share_a_bin(spark):
    """One changed word: another text and another id, the same cluster; so for rows without id."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(400)]
    texts = [" ".join(base[:i] + ["other"] + base[i + 1:]) for i in range(0, 400, 40)]
    rows = [(i, f"s{i}", t) for i, t in enumerate(texts)] + [(None, "n", texts[0])]
    rows += [(100 + i, f"s{i}", " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(400))) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = best_fit_packing.pack(docs, capacity=2048).collect()
    near = [r for r in out if r.doc_id is None or r.doc_id < 100]
    assert len({r.cluster for r in near}) == 1 and len({(r.pack_group, r.bin) for r in near}) == len(near) == 11
    assert len({r.bin for r in out}) == 11  # the other texts join them
    named = docs.withColumn("topic", F.when(F.col("doc_id") < 200, F.col("doc_id") % 2))
    held = defaultdict(list)
    for r in best_fit_packing.pack(named, cluster="topic").collect():
        held[r.pack_group, r.bin].append(2 if r.doc_id is None else r.doc_id % 2)
    assert sum(map(len, held.values())) == 21 and all(len(set(topics)) == len(topics) for topics in held.values())


def test_a_third_of_equal_rows_is_numbered_over_tasks(spark):
    """Copies get 0, 1, ... however they lie, are numbered within their input partition, and are dealt over groups and buckets."""
    rows = [(7, "same")] * 4000 + [(i, f"t{i}") for i in range(8000)] + [(None, None)] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = common.copy_numbers(df, ["doc_id", "text"])
    copies = defaultdict(list)
    for r in got.collect():
        copies[r.doc_id, r.text].append(r["copy"])
    assert all(sorted(c) == list(range(len(c))) for c in copies.values())
    assert len(copies[7, "same"]) == 4000 and copies[None, None] and len(copies) == 8002
    packed = best_fit_packing.pack(df.withColumn("source", F.lit("a")), group_docs=1000)
    groups = Counter(r.pack_group for r in packed.filter("doc_id = 7").collect())
    assert len(groups) == 13 and max(groups.values()) < 2 * 4001 / 13
    out = feistel_shard.assign(df).collect()
    assert sorted(r.row_no for r in out) == list(range(len(rows)))


def test_small_counts_are_read_from_a_table():
    z, o = np.array([0.0, 3, 4095, 4096, 1e7]), np.array([0.0, 9, 1, 4096, 2])
    want = [math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1) for a, b in zip(z, o)]
    assert context_tree.log_kt(z, o) == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_a_block_gives_its_texts_back():
    block = context_tree.Block()
    for i, t in enumerate([b"a b  a", b"", b" \t", "ä z".encode()]):
        block.add(None if i == 1 else i, t)
    words, tokens, sizes = block.tokens()
    ids, words_, tokens_, sizes_ = context_tree._unpack(context_tree._pack(block.ids, words, tokens + (1 << 17), sizes))
    assert words_ == words == [b"a", b"b", b"\n", "ä".encode(), b"z"] and ids.to_pylist() == [0, None, 2, 3]
    assert (tokens_ - (1 << 17)).tolist() == [0, 1, 0, 2, 2, 2, 3, 4, 2] and sizes_.tolist() == [4, 1, 1, 3]


def test_values_return_to_a_block_packed(spark, monkeypatch):
    rng = random.Random(66)
    rows = [(b, k, rng.choice([0, -1, -(1 << 33), 7])) for b in (0, 1 << 32, (1 << 32) + 1)
            for k in [-1, -(1 << 31), 0, (1 << 48) - 1, *rng.choices(range(1 << 48), k=1500)]]
    monkeypatch.setattr(context_tree, "CHUNK_ROWS", 1000)
    with common.arrow_rows(spark, 100):
        got = context_tree._packed(spark.createDataFrame(rows, "block long, key long, value long").repartition(2)).toArrow()
    assert sum(got["n"].to_pylist()) == len(rows) and 3 * 3 < got.num_rows <= 3 * (len(rows) // 1000 + 2)
    back = []
    for b in set(got["block"].to_pylist()):
        key, value = context_tree._unpacked(got.filter(pc.equal(got["block"], b)))
        back += zip([b] * len(key), key.tolist(), value.tolist())
    assert sorted(back) == sorted(rows)


def test_a_block_meets_its_values_in_few_rows(spark, monkeypatch):
    packed, seen = context_tree._packed, []
    monkeypatch.setattr(context_tree, "_packed", lambda rows: seen.append(packed(rows)) or seen[-1])
    rng = random.Random(67)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(40)) for _ in range(60)]
    assert context_tree.score(frame(spark, texts).repartition(2)).count() == len(texts) + 3
    rows = seen[0].agg({"n": "sum", "block": "count"}).first().asDict()
    assert rows["sum(n)"] > 10_000 and rows["count(block)"] < 200


def test_queries_and_oracles():
    assert set(queries.ORACLE) <= set(queries.QUERIES) and len(queries.QUERIES) == 15
    assert quality_rules.FULL.mask() == 63
