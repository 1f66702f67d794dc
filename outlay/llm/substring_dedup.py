"""Operator 3, substring dedup: seed and extend.

Seeds: the 6-word grams of a text are winnowed: of the 8 grams inside every
13-word window the one with the smallest hash is the window's anchor, so two
equal windows always carry the same anchor. Consecutive windows on one anchor
occurrence form a run; the run is the anchor with its words extended to the left
and right as far as that anchor governs.

Join: documents meet on anchors. An anchor in a single document is dropped. If
the runs around a shared anchor are equal in several documents, the whole
extent repeats and every document but the smallest repeats it. Where runs
differ (the repeat ends inside), one representative per distinct run is
extended window by window and matched on (anchor, window). Copies so cost one
row each, no pairs are made, and no link is lost: equal windows imply equal
anchors, and a window's smallest document is the smallest among the
representatives of the runs that hold it.

Adjacent repeated windows are merged into maximal repeats of at least 13 words;
their words are removed. All windows are judged on the input.

Windows are told apart by 64-bit hashes on top of the anchor's own 64 bits.
An anchor's rows meet in one task as narrow rows (a batch of documents sends one
row per distinct run), sorted and spilled by Spark, never held in memory.

Defined cases: NULL and empty texts have no words; texts under 13 words keep
all; a NULL doc_id is neither larger nor smaller than others, so nothing is
removed from or because of it; repeated doc_ids share what is removed between
documents, never between themselves; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, text_slices

GRAM, SPAN = 6, 13
SLICE_BYTES = 4 << 20
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(29))


def hash_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, concatenated, and the number of words per text."""
    counts, out = np.zeros(len(texts), np.int64), []
    for i, t in enumerate(texts):
        words = t.encode().split() if t else []
        counts[i] = len(words)
        out.append(np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words)))
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), counts


class Runs:
    """Windows and winnowed runs of a slice of texts (parallel arrays).

    ``window``: hash per window start; ``first``, ``last``: window starts of each
    run; ``anchor``, ``run``: its hashes; ``doc``: index of its text.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, gram: int = GRAM, span: int = SPAN):
        n, grams = len(words) - span + 1, len(words) - gram + 1
        doc = np.repeat(np.arange(len(counts)), counts)
        if n <= 0:
            self.window = self.anchor = self.run = np.zeros(0, np.uint64)
            self.first = self.last = self.doc = np.zeros(0, np.int64)
            return

        def roll(width: int) -> np.ndarray:
            h = np.zeros(len(words) - width + 1, np.uint64)
            for j in range(width):
                h = _mix(h * _A + words[j:j + len(h)])
            return h

        short = roll(gram)
        self.window = roll(span)
        best, at = short[:n].copy(), np.arange(n)
        for j in range(1, span - gram + 1):
            here = short[j:j + n]
            less = here < best
            best[less] = here[less]
            at[less] = np.flatnonzero(less) + j
        whole = np.flatnonzero(doc[:n] == doc[span - 1:])
        if not len(whole):
            self.anchor = self.run = np.zeros(0, np.uint64)
            self.first = self.last = self.doc = np.zeros(0, np.int64)
            return
        new = np.ones(len(whole), bool)
        new[1:] = (np.diff(whole) != 1) | (np.diff(at[whole]) != 0) | (np.diff(doc[whole]) != 0)
        self.first = whole[new]
        self.last = whole[np.append(np.flatnonzero(new)[1:] - 1, len(whole) - 1)]
        self.anchor, self.doc = best[self.first], doc[self.first]
        self.run = _mix(_mix(self.window[self.first] + (self.last - self.first).astype(np.uint64) * _C) * _A
                        + self.window[self.last])

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window starts of the chosen runs, and the run of each."""
        size = self.last[chosen] - self.first[chosen] + 1
        run = np.repeat(chosen, size)
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return self.first[run] + inside, run


def _anchors(docs: DataFrame) -> DataFrame:
    """(anchor, run, lo, more): the documents of a slice that hold this run."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SLICE_BYTES):
            ids = part.column("doc_id").to_numpy()
            r = Runs(*hash_words(part.column("text").to_pylist()))
            doc = ids[r.doc]
            order = np.lexsort((doc, r.run, r.anchor))
            a, s, d = r.anchor[order], r.run[order], doc[order]
            fresh = np.ones(len(a), bool)
            fresh[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1])
            other = np.ones(len(a), bool)
            other[1:] = fresh[1:] | (d[1:] != d[:-1])
            order, a, s, d, fresh = order[other], a[other], s[other], d[other], fresh[other]
            start = np.flatnonzero(fresh)
            size = np.diff(np.append(start, len(a)))
            extra = ~fresh
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size - 1)).astype(np.int32)),
                                             pa.array(d[extra]))
            lists = pa.compute.if_else(pa.array(size > 1), lists, pa.scalar(None, lists.type))
            near = pa.array(np.argsort(order[start], kind="stable"))  # in text order: compresses better
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[start].view(np.int64)).take(near), pa.array(s[start].view(np.int64)).take(near),
                 pa.array(d[start]).take(near), lists.take(near)], ["anchor", "run", "lo", "more"])

    return (docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
            .mapInArrow(rows, "anchor bigint, run bigint, lo bigint, more array<bigint>"))


def _meet(anchors: DataFrame) -> DataFrame:
    """(doc_id, run, certain): runs that repeat as a whole, and representatives to extend."""
    same, near = Window.partitionBy("anchor", "run"), Window.partitionBy("anchor")
    hi = F.coalesce(F.array_max("more"), F.col("lo"))
    met = (anchors.repartition("anchor")
           .withColumn("first", F.min("lo").over(same))
           .withColumns({"a_lo": F.min("lo").over(near), "a_hi": F.max(hi).over(near),
                         "r_lo": F.min("run").over(near), "r_hi": F.max("run").over(near)})
           .filter("a_lo < a_hi"))
    ids = F.concat(F.array("lo"), F.coalesce("more", F.array().cast("array<bigint>")))
    rep = F.when((F.col("r_lo") < F.col("r_hi")) & (F.col("lo") == F.col("first")),
                 F.array(F.struct(F.col("lo").alias("doc_id"), F.lit(False).alias("certain"))))
    sure = F.transform(F.filter(ids, lambda d: d > F.col("first")),
                       lambda d: F.struct(d.alias("doc_id"), F.lit(True).alias("certain")))
    none = F.array().cast("array<struct<doc_id:bigint,certain:boolean>>")
    return (met.select("run", F.explode(F.concat(sure, F.coalesce(rep, none))).alias("x"))
            .select("x.doc_id", "run", "x.certain"))


def _extend(texts: DataFrame) -> DataFrame:
    """(anchor, window, doc_id) of every window in the ``runs`` listed beside a text."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SLICE_BYTES):
            part = part.filter(pa.compute.is_valid(part.column("runs")))
            if not part.num_rows:
                continue
            r = Runs(*hash_words(part.column("text").to_pylist()))
            chosen = np.flatnonzero(_listed(r.run, r.doc, part.column("runs"), part.num_rows))
            at, run = r.windows(chosen)
            found = np.stack([r.anchor[run].view(np.int64), r.window[at].view(np.int64),
                              part.column("doc_id").to_numpy()[r.doc[run]]], axis=1)
            found = np.unique(found, axis=0) if len(found) else found.reshape(0, 3)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, i]) for i in range(3)],
                                             ["anchor", "window", "doc_id"])

    return texts.mapInArrow(rows, "anchor bigint, window bigint, doc_id bigint")


def _listed(value: np.ndarray, doc: np.ndarray, lists: pa.Array, n: int) -> np.ndarray:
    """Whether ``value[i]`` is in the list beside text ``doc[i]``; ``doc`` ascends."""
    out = np.zeros(len(value), bool)
    cut = np.searchsorted(doc, np.arange(n + 1))
    for i, wanted in enumerate(lists.to_pylist()):
        if wanted and cut[i] < cut[i + 1]:
            here = slice(cut[i], cut[i + 1])
            out[here] = np.isin(value[here].view(np.int64), np.array(wanted, np.int64))
    return out


def _spans(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of true, as (start, end)."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def cut(text: str, spans: list[tuple[int, int]], layout: bool) -> str:
    """``text`` without the words of ``spans``: with its own white space, or joined by single spaces."""
    raw = text.encode()
    if layout:
        at = [m.start() for m in _WORD.finditer(raw)] + [len(raw)]
        bounds = [0] + [at[i] for s in spans for i in s] + [len(raw)]
        return b"".join(raw[a:b] for a, b in zip(bounds[::2], bounds[1::2])).decode()
    words, kept, done = raw.split(), [], 0
    for a, b in spans:
        kept += words[done:a]
        done = b
    return b" ".join(kept + words[done:]).decode()


def dedup(docs: DataFrame, layout: bool = False, carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_text, spans.

    ``spans`` are the maximal repeats removed, as (start, end) word positions.
    ``layout`` keeps the white space of the text; else kept words are joined by
    one space. Columns in ``carry`` are handed through as struct ``carried``.
    """
    # both joins read the same shuffled texts: Spark reuses the exchange
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []))
    met = stage(_meet(_anchors(texts)), "met")
    reps = met.filter("NOT certain").groupBy("doc_id").agg(F.collect_set("run").alias("runs"))
    extended = _extend(texts.join(reps, "doc_id", "left").select("doc_id", "text", "runs"))
    same = Window.partitionBy("anchor", "window")
    repeated = (extended.withColumn("lo", F.min("doc_id").over(same)).filter("doc_id > lo")
                .select("doc_id", F.col("window").alias("hit"), F.lit(False).alias("is_run")))
    hits = (met.filter("certain").select("doc_id", F.col("run").alias("hit"), F.lit(True).alias("is_run"))
            .unionByName(repeated).groupBy("doc_id")
            .agg(F.collect_set(F.when(F.col("is_run"), F.col("hit"))).alias("runs"),
                 F.collect_set(F.when(~F.col("is_run"), F.col("hit"))).alias("windows")))
    joined = texts.join(hits, "doc_id", "left")
    extra = f", carried {joined.schema['carried'].dataType.simpleString()}" if carry else ""
    schema = ("doc_id bigint, n_words bigint, n_removed bigint, kept_text string, "
              "spans array<struct<start:int,end:int>>" + extra)
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", SLICE_BYTES):
            texts_, runs, wins = (part.column(c) for c in ("text", "runs", "windows"))
            texts_ = texts_.to_pylist()
            hit = np.flatnonzero(pa.compute.is_valid(runs).to_numpy(zero_copy_only=False))
            gone: dict[int, list[tuple[int, int]]] = {}
            if len(hit):
                r_words, counts = hash_words([texts_[i] for i in hit])
                r = Runs(r_words, counts)
                which = pa.array(hit)
                sure = _listed(r.run, r.doc, runs.take(which), len(hit))
                at, run = r.windows(np.arange(len(r.run)))
                chosen = sure[run] | _listed(r.window[at], r.doc[run], wins.take(which), len(hit))
                step = np.zeros(len(r_words) + 1, np.int64)
                np.add.at(step, at[chosen], 1)
                np.add.at(step, at[chosen] + SPAN, -1)
                flags, ends = np.cumsum(step[:-1]) > 0, np.cumsum(counts)
                for k, i in enumerate(hit.tolist()):
                    gone[i] = _spans(flags[ends[k] - counts[k]:ends[k]])
            n_words = [len(t.encode().split()) if t else 0 for t in texts_]
            kept = [t if layout and not gone.get(i) else cut(t or "", gone.get(i, []), layout)
                    for i, t in enumerate(texts_)]
            removed = [sum(b - a for a, b in gone.get(i, [])) for i in range(len(texts_))]
            spans = pa.array([[{"start": a, "end": b} for a, b in gone.get(i, [])] for i in range(len(texts_))],
                             span_type)
            cols = [part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()), spans]
            names = ["doc_id", "n_words", "n_removed", "kept_text", "spans"]
            if carry:
                cols, names = [*cols, part.column("carried")], [*names, "carried"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return joined.mapInArrow(rows, schema)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut from ``text``; ``n_chars``, where present, follows."""
    rest = [c for c in docs.columns if c != "text"]
    out = dedup(docs, layout=True, carry=rest).select("carried.*", F.col("kept_text").alias("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
