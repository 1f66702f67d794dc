"""Operator 6, LM scoring by context-tree weighting.

A text is the byte string of its tokens (words in lower case, then one end
token), each closed by a space. A byte is predicted as eight binary decisions;
each decision has a context tree over the ``DEPTH`` bytes before it, across
tokens; before a text stands an end token, as if another text had just ended.
Every node keeps its zero and one counts; a node's weighted probability is half
its Krichevsky-Trofimov estimate and half the product of its children's, and a
decision is predicted by the mixture over all depths with the posterior weights
of the trained tree.

Scale: documents are cut into blocks in place, by size; a block's distinct
words and distinct grams (context and byte) are the only rows that meet
others, so a hot word sends one row per block. The tree is built per context
suffix of two bytes; what is above has at most 256 x 255 nodes, the proven
bound of what goes through the driver and to every task. Values return to the
block, which holds its words and token numbers compressed; of the word counts only those that
other blocks add to return. They return packed, a row per block and ``CHUNK_ROWS`` values, so that what
is sorted by block is small beside the block. Keys are made a slice at a time.

Defined cases: a NULL or empty text is one end token; a NULL doc_id counts as
held out; repeated rows are scored and counted one by one; if nothing is
trained every bit has probability 1/2 and the base score uses N = V = 0; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, stage, tasks_for, text_slices

DEPTH = 5
FOLDS, BLOCK_BYTES, SLICE_WORDS, MERGE_GRAMS = 10, 16 << 20, 1 << 15, 1 << 18
BATCH_ROWS = 500  # of whole texts that pass to Python at once
CHUNK_ROWS = 1 << 18  # values that a task holds to pack those of each block together
END = "\n"
FIXED = 1 << 30  # log10 values travel as multiples of 1 / FIXED: half the bytes of a double
START = (b" " * DEPTH + END.encode() + b" ")[-DEPTH:]
_HALF = np.log(0.5)


def held_out(doc_id: int | None) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % FOLDS == 0


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln(gamma(x)), x > 0: shifted by 8, then Stirling's series."""
    x = np.asarray(x, float)
    shift = np.ones_like(x)
    for k in range(8):
        shift *= np.where(x < 1e6, x + k, 1.0)
    y = np.where(x < 1e6, x + 8, x)
    series = 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7) + 1 / (1188 * y ** 9)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(shift)


#: ln(gamma(n + 1/2)) and ln(gamma(n + 1)) of the small counts that most nodes have
SMALL = 1 << 12
_HALVES, _WHOLES = log_gamma(np.arange(SMALL) + 0.5), log_gamma(np.arange(SMALL) + 1.0)


def _gamma_at(counts: np.ndarray, table: np.ndarray, plus: float) -> np.ndarray:
    """ln(gamma(n + plus)) of whole counts, read from ``table`` where it reaches."""
    out = table.take(counts.astype(np.int64), mode="clip")
    large = np.flatnonzero(counts >= SMALL)
    out[large] = log_gamma(counts[large] + plus)
    return out


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with these (whole) counts."""
    return (_gamma_at(zeros, _HALVES, 0.5) + _gamma_at(ones, _HALVES, 0.5) - np.log(np.pi)
            - _gamma_at(zeros + ones, _WHOLES, 1.0))


def grams_of(words: list[bytes], tokens: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys (context bytes, then the byte) of all predicted bytes and the text of each, in slices.

    ``tokens`` are indices into ``words``, text after text; ``sizes`` tokens per text.
    """
    flat = np.frombuffer(b"".join([*(w + b" " for w in words), START]), np.uint8)
    size = np.array([len(w) + 1 for w in words] + [DEPTH])
    at = np.cumsum(size) - size
    stream = np.insert(tokens, np.cumsum(sizes) - sizes, len(words))  # START before each text
    text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
    tail = np.zeros(DEPTH, np.uint8)
    for i in range(0, len(stream), SLICE_WORDS):
        part = stream[i:i + SLICE_WORDS]
        n = size[part]
        raw = np.concatenate([tail, flat[np.repeat(at[part] - np.cumsum(n) + n, n) + np.arange(n.sum())]])
        tail = raw[-DEPTH:]
        key = np.zeros(len(raw) - DEPTH, np.uint64)
        for j in range(DEPTH + 1):
            key = (key << np.uint64(8)) | raw[j:j + len(key)]
        real = np.repeat(part < len(words), n)
        yield key[real], np.repeat(text[i:i + SLICE_WORDS], n)[real]


def _distinct(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of their counts (1 each if not given)."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")  # keys are a few sorted runs: merged, not sorted
        keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    if counts is None or not len(keys):
        return keys[new], np.diff(np.append(new, len(keys)))
    return keys[new], np.add.reduceat(counts, new)


class _Numbers(dict):
    """Numbers words in order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Block:
    """Documents of a block as they come: ids, distinct words, and tokens as numbers of words."""

    def __init__(self):
        self.ids, self.numbers, self.found, self.size = [], _Numbers(), [], 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        self.ids.append(doc_id)
        self.found.append(np.fromiter(map(self.numbers.__getitem__, [*text.split(), END.encode()]), np.int32))
        self.size += len(text) + 1

    def tokens(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Words in order of first use, the tokens of all texts, and tokens per text; the block gives them up."""
        out = list(self.numbers), np.concatenate(self.found), np.array([len(f) for f in self.found])
        self.numbers, self.found = _Numbers(), []
        return out


class Lookup:
    """Positions in an array of distinct keys: a hash table at most a quarter full."""

    def __init__(self, keys: np.ndarray):
        bits = (4 * len(keys)).bit_length()
        self.keys, self.last, self.shift = keys, (1 << bits) - 1, np.uint64(64 - bits)
        self.slots = np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            out = self.slots[at] != left
            left, at = left[out], (at[out] + 1) & self.last

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._home(keys)
        found = self.slots.take(at, mode="clip")
        off = np.flatnonzero(self.keys.take(found, mode="wrap") != keys)
        while len(off):
            if (found[off] < 0).any():
                raise KeyError("gram without a value")
            at[off] = (at[off] + 1) & self.last
            found[off] = self.slots.take(at[off], mode="clip")
            off = off[self.keys.take(found[off], mode="wrap") != keys[off]]
        return found


def _sum_by(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    u, inverse = np.unique(key, return_inverse=True)
    return u, inverse, [np.bincount(inverse, v, len(u)) for v in values]


class Tree:
    """Nodes of depth ``top`` .. ``depth`` above the given grams.

    ``levels[d]``: (parent index, zeros, ones, ln KT, ln weighted); ``path``: node
    of each (gram, bit) at the last depth; ``bit``: the decision there.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, top: int, depth: int = DEPTH):
        byte, k = grams & np.uint64(255), np.arange(8, dtype=np.uint64)
        self.bit = ((byte[:, None] >> (np.uint64(7) - k)) & np.uint64(1)).astype(np.int64)
        # in the order of the grams the nodes of a decision are runs, so no node is sorted
        order = np.argsort(grams)
        context, byte, n = (grams[order] >> np.uint64(8)) << np.uint64(8), byte[order], counts[order].astype(float)
        self.path = np.empty((len(grams), 8), np.int64)
        ids, zeros, ones, nodes = [], [], [], 0
        for j in range(8):
            node = context | np.uint64(1 << j) | (byte >> np.uint64(8 - j))
            new = np.append(True, node[1:] != node[:-1])[:len(node)]
            at, first = np.cumsum(new) - 1, np.flatnonzero(new)
            one = np.bincount(at, n * self.bit[order, j], len(first))
            ids.append(node[first])
            ones.append(one)
            zeros.append(np.bincount(at, n, len(first)) - one)
            self.path[order, j] = at + nodes
            nodes += len(first)
        ids, zeros, ones = (np.concatenate(v) for v in (ids, zeros, ones))
        kt = log_kt(zeros, ones)
        self.ids, self.levels, weighted = {depth: ids}, {depth: [None, zeros, ones, kt, kt]}, kt
        for d in range(depth - 1, top - 1, -1):
            context = (ids >> np.uint64(8)) & np.uint64((1 << 8 * d) - 1)
            ids, up, (zeros, ones, below) = _sum_by((context << np.uint64(8)) | (ids & np.uint64(255)),
                                                    zeros, ones, weighted)
            self.levels[d + 1][0] = up
            kt = log_kt(zeros, ones)
            weighted = np.logaddexp(_HALF + kt, _HALF + below)
            self.ids[d], self.levels[d] = ids, [None, zeros, ones, kt, weighted]

    def predict(self, mixed: np.ndarray, rest: np.ndarray, depth: int = DEPTH) -> np.ndarray:
        """log10 probability of each gram's byte; ``mixed`` and ``rest`` are the sums down to
        the parents of the top nodes: probability of a one so far, and weight left."""
        for d in sorted(self.levels):
            up, zeros, ones, kt, weighted = self.levels[d]
            if up is not None and d > min(self.levels):
                mixed, rest = mixed[up], rest[up]
            stop = np.exp(_HALF + kt - weighted) if d < depth else 1.0
            mixed = mixed + rest * stop * (ones + 0.5) / (zeros + ones + 1)
            rest = rest * (1 - stop)
        one = mixed[self.path]
        return np.log10(np.where(self.bit == 1, one, 1 - one)).sum(axis=1)


def _blocks(docs: DataFrame) -> DataFrame:
    """Rows of three kinds: 0 the block's documents, 1 a word, 2 a gram."""
    schema = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("key", pa.int64()), ("word", pa.string()),
                        ("n", pa.int64()), ("docs", pa.binary())])

    def rows(kind: int, block: int, size: int, **cols) -> pa.RecordBatch:
        cols |= {"kind": pa.array(np.full(size, kind, np.int32)), "block": pa.array(np.full(size, block, np.int64))}
        return pa.RecordBatch.from_arrays([cols.get(f.name, pa.nulls(size, f.type)) for f in schema], schema=schema)

    def close(block: int, docs: Block) -> Iterator[pa.RecordBatch]:
        words, tokens, sizes = docs.tokens()
        learns = np.array([not held_out(doc_id) for doc_id in docs.ids])
        trained = np.bincount(tokens[np.repeat(learns, sizes)], minlength=len(words))
        own = rows(0, block, 1, docs=pa.array([_pack(docs.ids, words, tokens, sizes)], pa.binary()))
        yield own
        del own
        text = pa.array(words, pa.binary()).cast(pa.string())
        for i in range(0, len(words), SLICE_WORDS):
            some = text.slice(i, SLICE_WORDS)
            yield rows(1, block, len(some), key=pa.array(np.arange(i, i + len(some))), word=some,
                       n=pa.array(trained[i:i + len(some)]))
        keys, counts, held = [], [], 0
        for key, text in grams_of(words, tokens, sizes):
            learnt = learns[text]
            for u, n in (_distinct(key[learnt]), _distinct(key[~learnt])):
                counts.append(n if len(counts) % 2 == 0 else np.zeros_like(n))
                keys.append(u)
                held += len(u)
            if held > MERGE_GRAMS:
                u, n = _distinct(np.concatenate(keys), np.concatenate(counts))
                keys, counts, held = [u, u[:0]], [n, n[:0]], 0
        u, n = _distinct(np.concatenate(keys), np.concatenate(counts))
        for i in range(0, len(u), SLICE_WORDS):
            some = u[i:i + SLICE_WORDS].view(np.int64)
            yield rows(2, block, len(some), key=pa.array(some), n=pa.array(n[i:i + SLICE_WORDS]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, docs = TaskContext.get().partitionId() << 32, Block()
        for part in text_slices(batches, "text", BLOCK_BYTES // 8):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                docs.add(doc_id, (text or "").encode().lower())
                if docs.size >= BLOCK_BYTES:
                    yield from close(block, docs)
                    block, docs = block + 1, Block()
        if docs.ids:
            yield from close(block, docs)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "kind int, block bigint, key bigint, word string, n bigint, docs binary")


def _pack(ids: list[int | None], words: list[bytes], tokens: np.ndarray, sizes: np.ndarray) -> bytes:
    """A block's documents, compressed: ids, distinct words, and the token numbers as their low and high halves."""
    batch = pa.RecordBatch.from_arrays(
        [pa.array([v], t) for v, t in (
            (ids, pa.list_(pa.int64())), (b" ".join(words), pa.binary()), (sizes.astype(np.int32), pa.list_(pa.int32())),
            ((tokens & 0xFFFF).astype(np.uint16).tobytes(), pa.binary()),
            ((tokens >> 16).astype(np.uint16).tobytes(), pa.binary()))], ["ids", "words", "sizes", "low", "high"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(raw: bytes) -> tuple[pa.Array, list[bytes], np.ndarray, np.ndarray]:
    """Ids, distinct words, tokens and tokens per text of a block."""
    t = pa.ipc.open_stream(raw).read_all()
    at = lambda c: t.column(c)[0]
    half = lambda c: np.frombuffer(at(c).as_buffer(), np.uint16).astype(np.int32)
    return at("ids").values, at("words").as_py().split(b" "), half("low") | half("high") << 16, at("sizes").values.to_numpy()


def _squeeze(numbers: np.ndarray) -> bytes:
    """Compressed int64 numbers: all first bytes, all second bytes, and so on."""
    return pa.compress(numbers.view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def _unsqueeze(raw: pa.Buffer, n: int) -> np.ndarray:
    places = np.frombuffer(pa.decompress(raw, decompressed_size=8 * n, codec="zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(places.T).view(np.int64).ravel()


def _packed(rows: DataFrame) -> DataFrame:
    """(block, n, payload): the (block, key, value) rows, n of one block in a payload."""

    def close(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        block, key, value = (t.column(c).to_numpy() for c in ("block", "key", "value"))
        order = np.argsort(block, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(block[order]) != 0))
        own = np.split(order, first[1:])
        return pa.RecordBatch.from_pydict({
            "block": pa.array(block[order[first]]), "n": pa.array([len(i) for i in own], pa.int32()),
            "payload": pa.array([_squeeze(np.concatenate([key[i], value[i]])) for i in own], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= CHUNK_ROWS:
                yield close(held)
                held, size = [], 0
        if held:
            yield close(held)

    return rows.select("block", "key", "value").mapInArrow(run, "block bigint, n int, payload binary")


def _unpacked(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys and values of a block's rows of ``_packed``."""
    sizes = t.column("n").to_pylist()
    key, value, at = np.empty(sum(sizes), np.int64), np.empty(sum(sizes), np.int64), 0
    for n, raw in zip(sizes, t.column("payload")):
        both = _unsqueeze(raw.as_buffer(), 2 * n)
        key[at:at + n], value[at:at + n] = both[:n], both[n:]
        at += n
    return key, value


TOP = 2  # depth from which the tree is built in parts


def _predictions(grams: DataFrame) -> DataFrame:
    """(key, log_p) of every distinct gram in ``grams`` (key, n)."""
    spark = grams.sparkSession
    total = stage(grams.groupBy("key").agg(F.sum("n").alias("n")), "grams")
    groups = tasks_for(spark, total.count(), 250_000)
    suffix = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * TOP) - 1).cast("bigint"))
    parts = total.withColumn("part", F.pmod(F.xxhash64(suffix), F.lit(groups)))

    def tree_of(t: pa.Table) -> Tree:
        return Tree(t.column("key").to_numpy().view(np.uint64), t.column("n").to_numpy(), TOP)

    def top_nodes(t: pa.Table) -> pa.Table:
        tree = tree_of(t)
        ids, (_, zeros, ones, _, weighted) = tree.ids[TOP], tree.levels[TOP]
        return pa.table({"node": (ids & np.uint64(0xFFFF)).astype(np.int64), "zeros": zeros, "ones": ones,
                         "below": weighted})

    # nodes of depth 1: context byte and decision, 256 x 255 rows at most
    upper = (parts.groupBy("part").applyInArrow(top_nodes, "node bigint, zeros double, ones double, below double")
             .groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")]).orderBy("node").toArrow())
    mixed, rest = upper_levels(*[upper.column(c).to_numpy() for c in ("node", "zeros", "ones", "below")])

    def predict(t: pa.Table) -> pa.Table:
        tree = tree_of(t)
        above = (tree.ids[TOP] & np.uint64(0xFFFF)).astype(np.int64)
        return pa.table({"key": t.column("key"), "log_p": tree.predict(mixed[above], rest[above])})

    return parts.groupBy("part").applyInArrow(predict, "key bigint, log_p double")


def upper_levels(node: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Mixture so far and weight left after depths 0 and 1, for each (context byte, decision)."""
    kt = log_kt(zeros, ones)
    weighted = np.logaddexp(_HALF + kt, _HALF + below)
    q = node & 255
    z0, o0, b0 = (np.bincount(q, v, 256) for v in (zeros, ones, weighted))
    kt0 = log_kt(z0, o0)
    stop0 = np.exp(_HALF + kt0 - np.logaddexp(_HALF + kt0, _HALF + b0))
    mixed = np.tile(stop0 * (o0 + 0.5) / (z0 + o0 + 1), 256)
    rest = np.tile(1 - stop0, 256)
    stop = np.full(1 << 16, 0.5)
    one = np.full(1 << 16, 0.5)
    stop[node] = np.exp(_HALF + kt - weighted)
    one[node] = (ones + 0.5) / (zeros + ones + 1)
    return mixed + rest * stop * one, rest * (1 - stop)


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte per row of ``docs``."""
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        blocks = stage(_blocks(docs), "blocks", compression="zstd")
    # a word has one row per block, so no key is hot
    by_word = Window.partitionBy("word")
    words = blocks.filter("kind = 1").select("block", "key", "n", F.sum("n").over(by_word).alias("c"),
                                             (F.col("block") == F.min("block").over(by_word)).alias("first"))
    # a block knows its own counts: the rows of words that no other block trains are empty but for ``known``
    other = lambda c: F.when(F.col("c") != F.col("n"), F.col(c)).alias(c)
    words = stage(words.select(other("block"), other("key").cast("int").alias("key"), other("c"),
                               (F.col("first") & (F.col("c") > 0)).alias("known")), "words", compression="zstd")
    n_train = blocks.filter("kind = 1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    vocabulary = words.filter("known").count()
    words = words.filter("block IS NOT NULL")
    grams = blocks.filter("kind = 2").select("block", "key", "n")
    valued = grams.select("block", "key").join(_predictions(grams.select("key", "n")), "key")
    # a value per word (key < 0) and gram (key >= 0), packed, and the block's own row, which has no n
    row = lambda df, key, value: df.select(
        "block", key.cast("bigint").alias("key"), value.cast("bigint").alias("value"))
    values = row(words, -1 - F.col("key"), F.col("c")).unionByName(
        row(valued, F.col("key"), F.round(F.col("log_p") * FIXED)))
    own = blocks.filter("kind = 0").select("block", F.lit(None).cast("int").alias("n"), F.col("docs").alias("payload"))
    gathered = own.unionByName(_packed(values))
    scale = np.log10(n_train + 0.1 * (vocabulary + 1))

    def finish(t: pa.Table) -> pa.Table:
        whole = t.column("n").is_null()
        doc_ids, words_, token, sizes = _unpack(t.filter(whole).column("payload")[0].as_py())
        key, value = _unpacked(t.filter(pa.compute.invert(whole)))
        held = np.array([held_out(i) for i in doc_ids.to_pylist()])
        count = np.bincount(token[np.repeat(~held, sizes)], minlength=len(words_))
        count[-1 - key[key < 0]] = value[key < 0]
        gram, log_p = key[key >= 0].view(np.uint64), value[key >= 0] / FIXED
        del key, value
        texts = len(sizes)
        scores, find = np.zeros(texts), Lookup(gram)
        for k, doc in grams_of(words_, token, sizes):
            scores += np.bincount(doc, log_p[find(k)], texts)
        base = np.log10(count + 0.1) - scale
        length = np.array([len(w) + 1 for w in words_])
        of = np.repeat(np.arange(texts, dtype=np.int32), sizes)
        total = lambda v: np.bincount(of, v[token], texts)
        return pa.table({
            "doc_id": doc_ids, "held_out": held,
            "n_tokens": sizes.astype(np.int64), "n_known": total(count > 0).astype(np.int64),
            "train_tokens": np.full(texts, n_train, np.int64), "base_score": total(base), "score": scores,
            "bits_per_byte": -scores * np.log2(10) / total(length)})

    return gathered.groupBy("block").applyInArrow(finish, (
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
        "score double, bits_per_byte double"))
