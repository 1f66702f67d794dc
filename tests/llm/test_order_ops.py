"""Content sort, Merkle manifest and prefix trie against brute force, and their edge cases."""

import hashlib
import random
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from outlay.llm import common, content_sort, merkle_manifest, prefix_trie, queries

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id long, text string, n long, part int, run string, digest string"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ------------------------------------------------------------ exact dedup


def copies(rows, largest):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = (max if largest else min)(known) if known else None
        stays = [keep, *sorted((i for i in ids), key=lambda i: (i is not None, i or 0))]
        stays = Counter(stays)
        stays[keep] -= 1
        for i in ids:
            out[(i, keep, len(ids), sha(t))] += 1
    return out


def check_copies(spark, rows, **extra):
    df = spark.createDataFrame([(i, t, 5, 6, "x", "clash") for i, t in rows], DOCS)
    for largest in (False, True):
        got = content_sort.dedup(df, "largest" if largest else "smallest").collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == copies(rows, largest)
        kept = Counter(r.text_sha256 for r in got if r.kept)
        assert set(kept.values()) <= {1} and set(kept) == {r.text_sha256 for r in got}
        assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_content_sort_matches_brute_force(spark):
    rng = random.Random(3)
    same_start = "licence " * 30
    texts = [None, "", "É", "é", "ABC", "abc", "aBc", "abc ", "\0", "a\0b", same_start, same_start.upper(), same_start + "x",
             "word " * 200_000, "WORD " * 200_000, "\U0001F600"]
    rows = [(i, t) for i, t in enumerate(rng.choices(texts, k=120))]
    rows += [(7, "abc"), (7, "abc"), (None, "abc"), (None, "only null ids"), (None, "only null ids"), (500, None)]
    check_copies(spark, rows)
    assert content_sort.dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_a_group_of_copies_is_cut_over_tasks(spark):
    """A third of all rows on one text: the sorted ranges hold about the same number of rows."""
    rng = random.Random(4)
    rows = [(i, "The same text" if i % 3 else f"own {i}") for i in range(6000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    keyed = df.mapInArrow(content_sort.normalised, content_sort.KEYED)
    sizes = [r[0] for r in keyed.repartitionByRange(8, "head", "digest", "doc_id").groupBy(F.spark_partition_id()).count()
             .select("count").collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 6000 / 8
    got = content_sort.dedup(df, "largest").filter("group_size > 1")
    assert got.count() == 4000 and got.select("keep_id").distinct().collect() == [(5999,)]
    assert [r.doc_id for r in got.filter("kept").collect()] == [5999]


# --------------------------------------------------------------- manifest


def run_of(level, fanout):
    return [level[i:i + fanout] for i in range(0, len(level), fanout)]


def tree(leaves, fanout=2):
    """Root, and per leaf the (left, right) siblings on its way."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        runs = run_of(level, fanout)
        for i, p in enumerate(at):
            run, slot = runs[p // fanout], p % fanout
            paths[i].append(("".join(run[:slot]), "".join(run[slot + 1:])))
        at, level = [p // fanout for p in at], [sha("".join(r)) for r in runs]
    return level[0], paths


def part_of(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def brute_manifest(rows, fanout=2):
    """rows of (id, group, leaf, claim) -> Counter of (id, leaf, subroot, root, proof, folded)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    subs = {g: tree([r[2] for r in groups[g]], fanout) for g in names}
    root, above = tree([subs[g][0] for g in names], fanout)
    out = Counter()
    for g, up in zip(names, above):
        for r, path in zip(groups[g], subs[g][1]):
            d = r[3]
            for left, right in path + up:
                d = sha(left + d + right)
            out[(r[0], r[2], subs[g][0], root, sha("".join(a + b for a, b in path + up)), d)] += 1
    return out


def shown(df):
    out = df.select("doc_id", "leaf", "subroot", "root", merkle_manifest.proof_digest(F.col("path")),
                    merkle_manifest.fold(F.col("claim"), F.col("path")))
    return Counter(tuple(r) for r in out.collect())


def docs_table(spark, rows, path):
    (spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, grp string, pos long, "
                           "d0 string, block long").write.parquet(f"{path}/documents.parquet"))
    return path


def test_manifest_query_matches_brute_force(spark, scratch):
    rng = random.Random(5)
    rows = [(i, rng.choice(["web", "", None]), rng.choice(["en"] * 6 + ["de", "Zz", "é", "", None]),
             rng.choice([None, 3, -1]), rng.choice([None, "", "ü", "a:b-", "text " * 30_000]), "g", 1, "d", 2)
            for i in rng.sample(range(10_000), 700)]
    rows += [(None, None, None, None, None, "g", 1, "d", 2)] * 2 + [rows[0], (rows[0][0], *rows[1][1:])]
    got = queries.op12_merkle_manifest(spark, docs_table(spark, rows, f"{scratch}/t")).collect()
    plain = []
    for r in rows:
        leaf = lambda n: sha("".join(map(part_of, (r[0], r[1], r[2], n, r[4]))))  # noqa: B023, E731
        bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
        plain.append((r[0], r[2], leaf(r[3]), leaf(r[3] + 1 if bad and r[3] is not None else r[3])))
    assert Counter(tuple(r)[:6] for r in got) == brute_manifest(plain)
    assert all(r.verified == (r.folded_root == r.root) for r in got)
    assert {r.verified for r in got} == {True, False}


def test_manifest_of_any_fanout_size_and_depth(spark, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "LEVELS", 2)
    rng = random.Random(6)
    for sizes, fanout in (((1,), 2), ((2, 1), 2), ((70, 1, 17, 3), 2), ((100, 5), 3), ((33, 64, 1), 4)):
        rows = [(i, f"g{g}", sha(f"{g}/{i}"), sha(f"{g}/{i}")) for g, n in enumerate(sizes) for i in range(n)]
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "doc_id long, lang string, h string, c string")
        got = merkle_manifest.manifest(df, "doc_id", "lang", F.col("h"), F.col("c"), fanout)
        assert shown(got) == brute_manifest(rows, fanout)
    empty = merkle_manifest.manifest(df.limit(0), "doc_id", "lang", F.col("h"))
    assert empty.count() == 0


def test_a_later_copy_is_verified_row_by_row(spark):
    rows = [(i, "en" if i % 4 else "de", f"text {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    leaf = merkle_manifest.leaf_of(F.col("doc_id"), F.col("text"))
    stored = common.stage(merkle_manifest.manifest(df, "doc_id", "lang", leaf), "stored")
    later = spark.createDataFrame([(3, "text 3"), (8, "text 9"), (99, "new"), (None, None)], "doc_id long, text string")
    got = {r.doc_id: r.verified for r in merkle_manifest.verify(later, stored, "doc_id", leaf).collect()}
    assert got == {3: True, 8: False, 99: False, None: False}


# ------------------------------------------------------------------- trie

CHATS = "conv_id long, turn long, role string, text string, d long, length long, band string"


def rem(c, k):
    return c % k if c >= 0 else -(-c % k)


def rebuilt(rows, group=5, heads=9):
    chats = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            chats[c].append((t is not None, t or 0, role or "", text or ""))
    chats = {c: [x[2:] for x in sorted(v)] for c, v in chats.items()}
    out = {}
    for c, own in chats.items():
        h = zlib.crc32(str(c).encode()) % heads
        out[c] = chats.get(c - rem(c, group), [])[:h] + own[h:]
    return out


def brute_trie(chats):
    members = defaultdict(list)
    for c, seq in chats.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children, leaves, saved = Counter(), Counter(), Counter()
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, cs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(cs) - 1) * len(node[-1][1].encode()) if node else 0
    return Counter(
        (min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), children[node], leaves[node], saved[node],
         sha(",".join(str(c) for c in sorted(cs) if len(chats[c]) == len(node)))) for node, cs in members.items())


def chat_rows(rng, n=60):
    rows = []
    for c in range(-12, n):
        if c % 11 == 4:
            continue  # an absent base here and there
        for t in range(rng.randint(1, 12)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if c % 2 else "user", rng.choice(["a", "ü", "bb"]), 1, 2, "x"))
    return rows


def table_of(spark, rows, path):
    spark.createDataFrame(rows, CHATS).write.parquet(f"{path}/conversations.parquet")
    return path


def test_trie_query_matches_brute_force(spark, scratch):
    rng = random.Random(7)
    rows = chat_rows(rng) + [(70, None, None, None, 1, 2, "x"), (70, None, "user", "n" * 300_000, 1, 2, "x"),
                             (None, 1, "user", "no conversation", 1, 2, "x"), (2 ** 62, 0, "", "", 1, 2, "x")]
    got = queries.op13_prefix_trie(spark, table_of(spark, rows, f"{scratch}/a")).collect()
    assert Counter(tuple(r) for r in got) == brute_trie(rebuilt(rows))
    assert queries.op13_prefix_trie(spark, table_of(spark, [], f"{scratch}/b")).count() == 0


def test_trie_over_bands_and_split_shards(spark, monkeypatch):
    """Long conversations, a first turn and a whole conversation that most share, in many small shards and bands."""
    monkeypatch.setattr(prefix_trie, "BAND", 3)
    monkeypatch.setattr(prefix_trie, "SHARD_ROWS", 40)
    monkeypatch.setattr(prefix_trie, "END_BITS", 2)
    rng = random.Random(8)
    chats = {c: [("user", "hello")] * (c % 3 > 0) + [("user", rng.choice("ab")) for _ in range(rng.randint(0, 9))]
             for c in range(1, 50)}
    chats |= {c: [("user", "hello"), ("assistant", "same")] for c in range(100, 130)}
    chats[200] = [("user", "hello")] + [("user", "ab"[i % 2]) for i in range(40)]
    chats[201] = chats[200][:35] + [("user", "other")]
    rows = [(c, t, role, text, 1, 2, "x") for c, seq in chats.items() for t, (role, text) in enumerate(seq)]
    chats = {c: seq for c, seq in chats.items() if seq}
    turns = prefix_trie.turns(spark.createDataFrame(rows, CHATS))
    got = prefix_trie.trie(prefix_trie.whole(turns)).collect()
    assert Counter(tuple(r) for r in got) == brute_trie(chats)


def test_trie_redraws_digests_that_collide(spark, monkeypatch):
    seen, real = [], prefix_trie.prefixes

    def weak(rows, salt=0):
        seen.append(salt)
        out = real(rows, salt)
        return out.withColumns({k: F.col(k) % 7 for k in ("k1", "k2", "p1", "p2")}) if salt == 0 else out

    monkeypatch.setattr(prefix_trie, "prefixes", weak)
    rows = chat_rows(random.Random(9), 20)
    chats = defaultdict(list)
    for c, _, role, text, *_ in rows:
        chats[c].append((role, text))
    turns = prefix_trie.turns(spark.createDataFrame(rows, CHATS))
    got = prefix_trie.trie(prefix_trie.whole(turns)).collect()
    assert seen == [0, 1] and Counter(tuple(r) for r in got) == brute_trie(chats)


def test_slot_table_is_minimal_and_verified():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        k = rng.integers(-2 ** 63, 2 ** 63, (2, n), dtype=np.int64)
        if n > 10:
            k[1, :10] = k[1, 0]  # equal halves
        table = prefix_trie.SlotTable(k[0], k[1])
        slots = table.slots(k[0], k[1])
        assert sorted(slots) == list(range(n)) and (table.k1[slots] == k[0]).all() and (table.k2[slots] == k[1]).all()
        other = rng.integers(-2 ** 63, 2 ** 63, (2, 1000), dtype=np.int64)
        assert (table.slots(other[0], other[1]) == -1).all()


def test_numbered_places_cover_each_group(spark):
    rows = [("a" if i % 3 else "b", i * 7 % 1000) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v long")
    got = common.numbered(df, ["g"], [F.col("v")]).collect()
    for g in "ab":
        mine = sorted((r.pos, r.v, r.n) for r in got if r.g == g)
        assert [p for p, _, _ in mine] == list(range(len(mine))) and {n for _, _, n in mine} == {len(mine)}
        assert [v for _, v, _ in mine] == sorted(v for _, v, _ in mine)
