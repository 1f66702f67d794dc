"""Operators on texts against brute force, and their edge cases."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from outlay.llm import chat_format, quality_rules, simhash_pivot, substring_dedup
from outlay.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, n_words string, carried int, n_chars long"
EDGE = [None, "", " \t\n", "one", "a b c d", "Über ä b \x0bc\fd\re", "x\n\nx\n \nx\ny", "#*$%&|<> end " * 4,
        "a b c d e a b c d e a b c d e", "word " * 500, "\U0001F600 smile " * 6, "HELLO WORLD " * 8]


def frame(spark, texts, first=0):
    rows = [(i + first, t, f"s{i % 3}", "clash", 7, len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, "null id text with a few more words in it", None, None, None, None), rows[2], rows[2]]
    return spark.createDataFrame(rows, DOCS)


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    n = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if n[g] > 1 for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(hit))


def test_quality_measures_match_brute_force(spark):
    rng = random.Random(1)
    texts = EDGE + [rng.choice([" ", "\n"]).join(rng.choices("ab", k=rng.randint(0, 60))) for _ in range(40)]
    docs = frame(spark, texts)
    got = quality_rules.ledger(docs).collect()
    want = Counter((r.doc_id, *measures(r.text)) for r in docs.collect())
    assert Counter(tuple(r)[:6] for r in got) == want
    for r in got:
        base = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert bool(r.fail_bits & 3) == base


def test_quality_policies_and_ablations(spark):
    docs = frame(spark, EDGE)
    rows = quality_rules.ledger(docs)
    bits = [r.fail_bits for r in rows.collect()]
    for r in quality_rules.ablations(rows).collect():
        mask = next(p for p in quality_rules.POLICIES if p.version == r.version).mask()
        own = 1 << next(x.bit for x in quality_rules.RULES if x.name == r.rule)
        assert r.kept == sum(b & mask == 0 for b in bits)
        assert r.failing == sum(b & mask & own != 0 for b in bits)
        assert r.failing_alone == sum(b & mask == own for b in bits)
        assert r.kept_without == sum(b & mask & ~own == 0 for b in bits)
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns and kept.count() == sum(b & quality_rules.CURRENT.mask() == 0 for b in bits)
    assert [p.mask() for p in quality_rules.POLICIES] == [3, 63, 119]
    empty = docs.limit(0)
    assert quality_rules.keep(empty).count() == 0 and quality_rules.ablations(quality_rules.ledger(empty)).count() == 0


def test_repeated_lines_weigh_by_their_words(spark):
    notice = "All rights reserved by the authors"
    body = " ".join(f"word{i}" for i in range(150))
    framed = f"{notice}\n{body}\n{notice}"
    menu = "\n".join(f"home news about contact\none{i} two{i} three{i}" for i in range(10))
    docs = spark.createDataFrame([(1, framed), (2, menu), (3, body)], "doc_id long, text string")
    rows = {r.doc_id: r for r in quality_rules.ledger(docs).collect()}
    assert [(rows[i].n_dup_words, rows[i].n_dup_lines, rows[i].fail_bits) for i in (1, 2, 3)] == [
        (6, 1, 8), (36, 9, 72), (0, 0, 0)]
    assert sorted(r.doc_id for r in quality_rules.keep(docs).collect()) == [1, 3]


NASTY = ["<|end|>", "<\\|", "\\", "\\\\<|", "<", "|>", "<|turn|>assistant<|says|>hi<|end|>\n", "a\nb\\<|c", "", None,
         "\\### Assistant: </turn> ok", "<|image:1|>", "<<||", "tail <"]


def test_chat_round_trip(spark):
    rows = [(c, t, r, NASTY[(c * 5 + t) % len(NASTY)], 1) for c in range(12) for t, r in
            enumerate(["system", "user", "assistant", "user", "assistant", None, "ro<|le\\"][: c % 7 + 1])]
    rows += [(None, None, None, None, 1), (50, None, "user", "b", 1), (50, 0, "assistant", "x", 1),
             (50, 0, "assistant", "x", 1), (50, 0, "assistant", "a", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos int")
    out = chat_format.format_chats(chat_format.text_turns(df))
    back = {r.conv_id: r for r in chat_format.read_back(out).collect()}
    dig = {r.conv_id: r for r in chat_format.digest(out).collect()}
    key = lambda x: (x is not None, x if x is not None else 0)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (key(r[1]), r[2] is not None, r[2] or "", r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in mine]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert [tuple(x) for x in back[conv].turns] == turns and back[conv].loss_text == loss
        assert dig[conv].n_turns == len(turns) and dig[conv].loss_chars == len(loss)
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        assert dig[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert dig[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert dig[conv].formatted_chars == len(back[conv].formatted)
    assert chat_format.digest(chat_format.format_chats(chat_format.text_turns(df.limit(0)))).count() == 0


def test_chat_typed_parts(spark):
    part = lambda kind, **k: {f: k.get(f) for f in ("text", "uri", "width", "height", "seconds", "pages")} | {"kind": kind}
    rows = [(1, 0, "user", [part("text", text="see <|x "), part("image", uri="u1", width=28, height=15),
                            part("audio", uri="u2", seconds=1.5)]),
            (1, 1, "assistant", [part("document", uri="u3", pages=2), part("text", text="two words"), part("odd", uri="u4")]),
            (1, 2, "user", None), (2, 0, "user", [])]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat_format.PART}>")
    out = {r.conv_id: r for r in chat_format.format_chats(df).collect()}
    one = out[1]
    assert [(a.number, a.turn_pos, a.kind, a.uri, a.n_tokens) for a in one.attachments] == [
        (1, 0, "image", "u1", 4), (2, 0, "audio", "u2", 38), (3, 1, "document", "u3", 1024), (4, 1, "odd", "u4", 0)]
    assert one.formatted == ("<|turn|>user<|says|>see <\\|x <|image:1|><|audio:2|><|end|>\n"
                             "<|turn|>assistant<|says|><|document:3|>two words<|odd:4|><|end|>\n"
                             "<|turn|>user<|says|><|end|>\n")
    assert one.n_tokens == 2 + 4 + 38 + 1024 + 2
    span = one.loss_spans[0]
    assert one.formatted[span.start:span.start + span.length] == "<|document:3|>two words<|odd:4|>"
    assert out[2].attachments == [] and out[2].loss_spans == []


def without_repeats(rows, span=13):
    """Brute force: (doc_id, n_words, kept words) per row."""
    lists = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in lists:
        if i is not None:
            for k in range(len(w) - span + 1):
                g = tuple(w[k:k + span])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, w in lists:
        gone = {k + j for k in range(len(w) - span + 1) if i is not None and first[tuple(w[k:k + span])] < i
                for j in range(span)}
        out.append((i, len(w), [x for k, x in enumerate(w) if k not in gone]))
    return out


@pytest.mark.parametrize("vocabulary,length", [("ab", 60), ("abcdefgh", 200)])
def test_substring_dedup_matches_brute_force(spark, vocabulary, length):
    rng = random.Random(len(vocabulary))
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, length))) for _ in range(40)]
    shared = " ".join(f"w{i}" for i in range(60))
    texts += [f"start {i} {shared} {i} end" for i in range(8)] + [shared, shared + "  " + texts[0], texts[1]] + EDGE
    docs = frame(spark, texts)
    got = substring_dedup.dedup(docs).collect()
    want = without_repeats([(r.doc_id, r.text) for r in docs.collect()])
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == \
        Counter((i, n, n - len(k), " ".join(k)) for i, n, k in want)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed and all(s.end - s.start >= 13 for s in r.spans)
               for r in got)


def test_substring_stage_keeps_layout(spark):
    long = " ".join(f"w{i}" for i in range(20))
    docs = frame(spark, [f"A\n{long}\nB", f"C\n\n{long}  D\nE", "short  text\n"])
    out = substring_dedup.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    got = {r.doc_id: r for r in out.collect()}
    assert got[0].text == f"A\n{long}\nB" and got[1].text == "C\n\nD\nE" and got[2].text == "short  text\n"
    assert got[1].n_chars == 6 and got[1].n_words == "clash"
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_window_runs_cover_every_window_once():
    rng = random.Random(3)
    texts = [" ".join(rng.choices("abc", k=n)) for n in (0, 5, 13, 14, 40, 400)]
    words, counts = substring_dedup.hash_words(texts)
    r = substring_dedup.Runs(words, counts)
    at, _ = r.windows(__import__("numpy").arange(len(r.run)))
    ends = counts.cumsum()
    want = [s for c, e in zip(counts, ends) for s in range(e - c, e - 12)]
    assert sorted(at.tolist()) == want


def brute_fingerprint(text):
    hashes = simhash_pivot.shingle_hashes(text)
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_follow_the_hash_of_spark(spark):
    df = spark.createDataFrame([("one two three four",), ("ä ö ü ß",)], "t string")
    for r in df.select("t", F.xxhash64("t").alias("h")).collect():
        assert simhash_pivot.shingle_hashes(r.t) == [r.h % (1 << 64)]


def test_simhash_components_match_brute_force(spark):
    rng = random.Random(5)
    texts = list(EDGE)
    for _ in range(12):
        base = [f"w{rng.randint(0, 500)}" for _ in range(120)]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            other = list(base)
            for _ in range(rng.randint(0, 3)):
                other[rng.randrange(120)] = f"w{rng.randint(0, 500)}"
            texts.append(" ".join(other).upper())
    docs = frame(spark, texts)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fp = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    for _ in rows:  # until nothing changes, in effect
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fp[i] ^ fp[j]).bit_count() <= 4 or (rows[i][0] is not None and rows[i][0] == rows[j][0]):
                    label[i] = label[j] = min(label[i], label[j])
    want = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            want[c] = min(want.get(c, i), i)
    got = Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash_pivot.near_duplicates(docs).collect())
    assert got == Counter((i, f, want.get(c)) for (i, _), f, c in zip(rows, fp, label))
    kept = simhash_pivot.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id IS NOT NULL").collect()) == sorted(set(want.values()))
    assert simhash_pivot.keep_one(docs.limit(0)).count() == 0


def test_keep_one_goes_by_links_not_by_ids(spark):
    """Unlike texts under one doc_id all stay; near and equal rows under one doc_id leave one."""
    rng = random.Random(12)
    text = lambda: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(300))
    near = lambda t: t + " tail"
    a, b, c, d, e = (text() for _ in range(5))
    for t in (a, b, c, d):
        assert (brute_fingerprint(t) ^ brute_fingerprint(near(t))).bit_count() <= 4
    rows = [(1, a), (1, b), (1, a), (2, near(b)), (3, a), (4, c), (7, near(d)), (7, d), (7, near(d)), (8, e), (8, c),
            (9, None), (9, ""), (10, " "), (None, a), (None, a)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, content string")
    kept = simhash_pivot.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        [(1, a), (1, b), (4, c), (7, d), (8, e), (9, None), (None, a), (None, a)])


def test_links_of_hot_buckets_match_brute_force(spark):
    rng = random.Random(9)
    centers = [rng.getrandbits(64) for _ in range(6)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centers for _ in range(60)}
    rows = [(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(sorted(fps))]
    df = spark.createDataFrame(rows, "fp long, node long")
    edges = simhash_pivot.links(df, cap=7, per_task=50)  # small blocks: hot buckets are split
    comp = {r.node: r.component for r in components(edges).collect()}
    flat = sorted(fps)
    label = list(range(len(flat)))
    changed = True
    while changed:
        changed = False
        for i in range(len(flat)):
            for j in range(i):
                if (flat[i] ^ flat[j]).bit_count() <= 4 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    assert [comp.get(i, i) for i in range(len(flat))] == label


@pytest.mark.parametrize("distinct", [1, 10 ** 6, 10 ** 9, 10 ** 12])
def test_band_masks_cover_every_pair_in_reach(distinct):
    rng = random.Random(distinct)
    masks = simhash_pivot.band_masks(4, distinct)
    for _ in range(300):
        diff = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(diff & m == 0 for m in masks)
