"""Language-model scoring by context-tree weighting over bytes.

A text is a run of tokens: its words and one end, each closed by a space byte. The model codes the
bytes one after the other; a byte's context are the ``depth`` bytes before it, across words (before a
text stand ends and a space, which stand so nowhere else). Each byte is eight binary decisions, and
for every decision the tree of contexts mixes the Krichevsky-Trofimov estimates of all depths: a node
weighs its own estimate against the product of its longer contexts, by how well either would have
coded the training data. No context is dropped; where training has not seen the longer one, the
shorter one's estimate takes its part.

How it is computed: texts are packed into chunks of about ``CHUNK`` bytes. A chunk's distinct grams (context
and byte) are counted and dealt out by their nearest three bytes, so all contexts of depth three and more
under these meet in one task. There the tree is weighed bottom-up; sums over the contexts of two bytes,
at most 65,536, go to the driver, which weighs the tree's top and broadcasts it. The same tasks then know each gram's
cost and send it back to the chunks that asked for it, where texts add theirs up. Costs travel as 32-bit floats.

The base score is the add-one unigram score of the same tokens. Words are counted over all training
texts; those with at least ``hot`` of all tokens (at most 1 / hot) are looked up in a broadcast
table, the others by a join on a 64-bit hash.

Cases: a null text counts as empty and is scored as its end alone; a null key counts as empty
text in the training split; repeated rows are scored each, and train the model each; words never
seen in training are coded by the contexts they share with others; without training rows every
binary decision costs one bit; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import fold, stored

DEPTH = 6
HOT = 1e-5
#: Bytes of text in a chunk; bytes and grams that are worked on at once.
CHUNK, PIECE, GRAMS = 16_000_000, 1_000_000, 100_000
#: A chunk's grams are added up in so many parts, each when it holds so many grams more than twice its last sum.
PARTS, MORE = 8, 30_000
#: Depth of the contexts whose sums meet on the driver.
TOP = 2
END = b"\n"


# ---------------------------------------------------------------------------
# Counts
# ---------------------------------------------------------------------------

def pack(rows: DataFrame, kind: str) -> DataFrame:
    """``chunk, rid, k, held_out, size (lists), data``: the coded bytes of many texts, from
    ``rid, k, held_out, text (binary)``. A chunk's number is its first ``rid``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            columns = [pa.concat_arrays([b.column(c) for b in held]) for c in range(3)]
            columns.append(pa.array(sizes, pa.int64()))
            data = pa.array([pa.compress(b"".join(streams), "zstd", asbytes=True)], pa.binary())
            lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in columns]
            return pa.RecordBatch.from_arrays([columns[0][:1], *lists, data], ["chunk", "rid", "k", "held_out", "size", "data"])

        held, streams, sizes, total = [], [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                held.append(part.select([0, 1, 2]))
                for text in part.column(3).to_pylist():
                    streams.append(b" ".join([*(text or b"").lower().split(), END, b""]))
                    sizes.append(len(streams[-1]))
                    total += sizes[-1]
                if total >= CHUNK:
                    yield out()
                    held, streams, sizes, total = [], [], [], 0
        if held:
            yield out()

    return rows.mapInArrow(work, f"chunk bigint, rid array<bigint>, k array<{kind}>, held_out array<boolean>, "
                                 "size array<bigint>, data binary")


def texts_of(sizes: list[int], data: bytes) -> Iterator[bytes]:
    """The coded bytes of each text of a chunk."""
    data, at = pa.decompress(data, sum(sizes), "zstd", asbytes=True), 0
    for n in sizes:
        yield data[at:at + n]
        at += n


def count_words(chunks: DataFrame) -> DataFrame:
    """``word, h (its hash), c`` from the chunks; words of held-out texts alone have c = 0."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "c"])

        seen: Counter[bytes] = Counter()
        for batch in batches:
            for held, sizes, data in zip(*(batch.column(c).to_pylist() for c in range(3))):
                for h, text in zip(held, texts_of(sizes, data)):
                    words = text.split()
                    words.append(END)
                    if not h:
                        seen.update(words)
                    else:
                        for w in words:
                            if w not in seen:
                                seen[w] = 0
                    if len(seen) > 200_000:
                        yield out()
                        seen.clear()
        yield out()

    counted = chunks.select("held_out", "size", "data").mapInArrow(work, "word binary, c bigint")
    return counted.groupBy("word").agg(F.sum("c").alias("c")).withColumn("h", F.xxhash64("word"))


# ---------------------------------------------------------------------------
# The tree
# ---------------------------------------------------------------------------

def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 8, brought back."""
    y = x + 8
    series = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5)
    for k in range(8):
        series = series - np.log(x + k)
    return series


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of so many zeros and ones, in any order."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - math.log(math.pi) - _log_gamma(zeros + ones + 1.0)


_SMALL = np.arange(4096.0)
_HALF, _WHOLE = _log_gamma(_SMALL + 0.5) - 0.5 * math.log(math.pi), _log_gamma(_SMALL + 1.0)


def _own(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """:func:`log_kt`, small counts by tables."""
    total = zeros + ones
    large = total >= len(_SMALL)
    z, o = np.where(large, 0, zeros).astype(np.int64), np.where(large, 0, ones).astype(np.int64)
    out = _HALF[z] + _HALF[o] - _WHOLE[z + o]
    out[large] = log_kt(zeros[large], ones[large])
    return out


def _starts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values start."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))


def rise(nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, longer: np.ndarray | None, depths: int):
    """Weighs sorted nodes (bits so far, then the context from its nearest byte on) and those of the next shorter
    contexts, for so many depths. ``longer``: the sums over still longer contexts, None if there are none.
    Gives the depths and, for the depth that follows, nodes, zeros, ones and ``longer``."""
    out = []
    for _ in range(depths):
        own = _own(zeros, ones)
        whole = own if longer is None else np.logaddexp(own, longer) - math.log(2)
        weight = np.ones(len(own)) if longer is None else np.exp(own - math.log(2) - whole)
        shorter = nodes >> 8
        starts = _starts(shorter)
        up = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(shorter))))
        out.append((zeros, ones, weight, up))
        nodes, longer = shorter[starts], np.add.reduceat(whole, starts)
        zeros, ones = np.add.reduceat(zeros, starts), np.add.reduceat(ones, starts)
    return out, nodes, zeros, ones, longer


def sink(depths: list, sure: np.ndarray, free: np.ndarray, last: np.ndarray):
    """From the shorter to the longer contexts: the part of the chance of a 1 that is settled, the weight that is left, and
    the estimate that takes it if no longer context was seen."""
    for zeros, ones, weight, up in reversed(depths):
        sure, free, last = sure[up], free[up], last[up]
        seen = zeros + ones > 0
        p = (ones + 0.5) / (zeros + ones + 1)
        sure = np.where(seen, sure + free * weight * p, sure)
        free = np.where(seen, free * (1 - weight), free)
        last = np.where(seen, p, last)
    return sure, free, last


def levels(keys: np.ndarray, n: np.ndarray, depth: int):
    """For each of the eight decisions: the grams' order, bits, nodes' numbers and what :func:`rise` gives down to ``TOP``."""
    byte, context = keys & 255, keys >> 8
    for level in range(8):
        nodes = (1 << level | byte >> (8 - level)) << (8 * depth) | context
        order = np.argsort(nodes, kind="stable")
        nodes, bit, c = nodes[order], (byte >> (7 - level) & 1)[order], n[order].astype(np.float64)
        starts = _starts(nodes)
        node = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(nodes))))
        yield order, bit, node, rise(nodes[starts], np.add.reduceat(c * (1 - bit), starts),
                                     np.add.reduceat(c * bit, starts), None, depth - TOP)


class Top:
    """The contexts of depth 0 to ``TOP``."""

    def __init__(self, nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, longer: np.ndarray):
        order = np.argsort(nodes)
        self.nodes = nodes[order]
        one = np.ones(1)
        self.parts = (np.zeros(0),) * 3 if not len(nodes) else sink(
            rise(self.nodes, zeros[order], ones[order], longer[order], TOP + 1)[0], 0 * one, one, 0.5 * one)

    def of(self, nodes: np.ndarray) -> list[np.ndarray]:
        at = np.searchsorted(self.nodes, nodes)
        return [x[at] for x in self.parts]


def _several(keys: np.ndarray, depth: int) -> Iterator[slice]:
    """Slices of about ``GRAMS`` sorted grams that don't cut a context of depth ``TOP`` + 1."""
    starts = _starts(keys >> 8 * (depth - TOP))
    at = 0
    while at < len(keys):
        i = np.searchsorted(starts, at + GRAMS)
        end = int(starts[i]) if i < len(starts) else len(keys)
        yield slice(at, end)
        at = end


def tally(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted grams and their summed counts."""
    k, c = np.concatenate(keys), np.concatenate(n)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    starts = _starts(k)
    return k[starts], np.add.reduceat(c, starts)


def bucket_of(keys: np.ndarray, depth: int, buckets: int) -> np.ndarray:
    return ((keys >> 8 * (depth - TOP)) * 0x9E3779B1 >> 12) % buckets


class Tallies:
    """Grams and their counts in parts by bucket: adding up copies one part at a time, and a part no more often than it
    doubles, so a task holds little more than a chunk's distinct grams."""

    def __init__(self, depth: int, buckets: int):
        self.depth, self.buckets = depth, buckets
        self.keys, self.n = ([[] for _ in range(PARTS)] for _ in range(2))
        self.held, self.summed = [0] * PARTS, [0] * PARTS

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        part = bucket_of(keys, self.depth, self.buckets) % PARTS
        for p in range(PARTS):
            own = part == p
            self.keys[p].append(keys[own])
            self.n[p].append(n[own])
            self.held[p] += len(self.keys[p][-1])
            if self.held[p] > 2 * self.summed[p] + MORE:
                self._sum(p)

    def _sum(self, p: int) -> None:
        k, c = tally(self.keys[p], self.n[p])
        self.keys[p], self.n[p], self.held[p], self.summed[p] = [k], [c], len(k), len(k)

    def take(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each part's distinct sorted grams and counts; a part that was given is no longer held."""
        for p in range(PARTS):
            if self.held[p]:
                self._sum(p)
                out, self.keys[p], self.n[p] = (self.keys[p][0], self.n[p][0]), [], []
                yield out


def squeezed(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes(), "zstd", asbytes=True)


def unsqueezed(data: bytes, count: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(pa.decompress(data, count * size, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(size, count).T).view(kind).ravel()


def grams(texts: list[bytes], depth: int) -> np.ndarray:
    """For each byte of the texts: its context, nearest byte in the highest place, and the byte in the lowest."""
    before = END * (depth - 1) + b" "
    data = np.frombuffer(before + before.join(texts), np.uint8)
    size = np.array([len(t) for t in texts])
    coded = np.ones(len(data), bool)
    first = np.cumsum(size + depth) - size
    for j in range(1, depth + 1):
        coded[first - j] = False
    coded = coded[depth:]
    n, keys = len(data) - depth, data[depth:].astype(np.int64)
    for j in range(1, depth + 1):
        near = data[depth - j:depth - j + n].astype(np.int64)
        near <<= 8 * (depth - j + 1)
        keys |= near
    del near
    return keys[coded]


def _pieces(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    """Lists of texts of about ``PIECE`` bytes."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= PIECE:
            yield held
            held, size = [], 0
    if held:
        yield held


def asked(chunks: DataFrame, depth: int, buckets: int) -> DataFrame:
    """``bucket, chunk, m, keys, n``: the distinct grams of every chunk, and how often training texts hold them."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, held, sizes, data in zip(*(batch.column(c).to_pylist() for c in range(4))):
                tallies = Tallies(depth, buckets)
                for kind in (False, True):
                    for piece in _pieces(t for h, t in zip(held, texts_of(sizes, data)) if bool(h) == kind):
                        k = np.sort(grams(piece, depth))  # cheaper than a hash table of them, and sums of sorted runs merge
                        starts = _starts(k)
                        tallies.add(k[starts], np.diff(np.append(starts, len(k))) * (not kind))
                for k, c in tallies.take():
                    bucket = bucket_of(k, depth, buckets)
                    order = np.argsort(bucket, kind="stable")
                    k, c, bucket = k[order], c[order], bucket[order]
                    starts = _starts(bucket)
                    out = [(int(bucket[a]), chunk, int(b - a), squeezed(np.diff(k[a:b], prepend=0)), squeezed(c[a:b]))
                           for a, b in zip(starts, np.append(starts[1:], len(k)))]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                        ["bucket", "chunk", "m", "keys", "n"])
                pa.default_memory_pool().release_unused()

    return chunks.select("chunk", "held_out", "size", "data").mapInArrow(
        work, "bucket bigint, chunk bigint, m bigint, keys binary, n binary")


def _of_bucket(asks: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    m = asks.column("m").to_pylist()
    return ([np.cumsum(unsqueezed(x, c, np.int64)) for x, c in zip(asks.column("keys").to_pylist(), m)],
            [unsqueezed(x, c, np.int64) for x, c in zip(asks.column("n").to_pylist(), m)])


def top_of(asks: DataFrame, depth: int) -> Top:
    """The driver gets a row for each decision in each context of ``TOP`` bytes."""
    def work(table: pa.Table) -> pa.Table:
        keys, n = tally(*_of_bucket(table))
        parts = [made[1:] for s in _several(keys, depth) for _, _, _, made in levels(keys[s], n[s], depth)]
        return pa.table([pa.array(np.concatenate([p[i] for p in parts])) for i in range(4)],
                        names=["node", "zeros", "ones", "longer"])

    parts = asks.groupBy("bucket").applyInArrow(work, "node bigint, zeros double, ones double, longer double")
    got = parts.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "longer")]).toArrow()
    return Top(*[got.column(c).to_numpy() for c in ("node", "zeros", "ones", "longer")])


def gram_costs(keys: np.ndarray, n: np.ndarray, depth: int, top: Top) -> np.ndarray:
    """log10 of the byte's probability in its context, for sorted distinct grams."""
    out = np.zeros(len(keys))
    for s in _several(keys, depth):
        here = out[s]
        for order, bit, node, (depths, nodes, *_) in levels(keys[s], n[s], depth):
            sure, free, last = sink(depths, *top.of(nodes))
            one = (sure + free * last)[node]
            here[order] += np.log10(np.where(bit == 1, one, 1 - one))
    return out


def text_scores(chunks: DataFrame, depth: int) -> DataFrame:
    """``rid, model`` (log10 of the text's probability)."""
    buckets = max(16, chunks.count())
    asks = stored(asked(chunks, depth, buckets), "lm-grams")
    top = chunks.sparkSession.sparkContext.broadcast(top_of(asks, depth))

    def answer(table: pa.Table) -> pa.Table:
        keys, n = _of_bucket(table)
        known, c = tally(keys, n)
        del n
        cost = gram_costs(known, c, depth, top.value).astype(np.float32)
        costs = [squeezed(cost[np.searchsorted(known, k)]) for k in keys]
        return table.select(["chunk", "m", "keys"]).append_column("cost", pa.array(costs, pa.binary()))

    answers = asks.groupBy("bucket").applyInArrow(answer, "chunk bigint, m bigint, keys binary, cost binary")

    def add_up(chunk: pa.Table, found: pa.Table) -> pa.Table:
        rid, model = [], []
        if chunk.num_rows:
            rid, sizes, data = (chunk.column(c)[0].as_py() for c in ("rid", "size", "data"))
            m = found.column("m").to_pylist()
            keys = np.concatenate([np.cumsum(unsqueezed(x, c, np.int64)) for x, c in zip(found.column("keys").to_pylist(), m)])
            cost = np.concatenate([unsqueezed(x, c, np.float32) for x, c in zip(found.column("cost").to_pylist(), m)])
            order = np.argsort(keys)
            keys, cost = keys[order], cost[order].astype(np.float64)
            for piece in _pieces(texts_of(sizes, data)):
                asked_for = grams(piece, depth)
                order = np.argsort(asked_for)  # in order they are found without a table of all keys, and near each other
                asked_for = asked_for[order]
                starts = _starts(asked_for)
                costs = np.empty(len(order))
                costs[order] = np.repeat(cost[np.searchsorted(keys, asked_for[starts])], np.diff(np.append(starts, len(order))))
                size = np.array([len(t) for t in piece])
                model.append(np.add.reduceat(costs, np.cumsum(size) - size))
            pa.default_memory_pool().release_unused()
        return pa.table([pa.array(rid, pa.int64()), pa.array(np.concatenate(model) if model else [], pa.float64())],
                        names=["rid", "model"])

    return chunks.select("chunk", "rid", "size", "data").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        add_up, "rid bigint, model double")


# ---------------------------------------------------------------------------
# Scores
# ---------------------------------------------------------------------------

def score(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = 7, held_fold: int = 2,
          depth: int = DEPTH, hot: float = HOT) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``; ``depth`` from 3 to 6 (six
    bytes of context, one more and the node's bits fill 64 bits)."""
    if not TOP < depth <= DEPTH:
        raise ValueError(f"depth must be from {TOP + 1} to {DEPTH}")
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(key).alias("k"),
                       (fold(key, folds) == held_fold).alias("held_out"), F.col(text).cast("binary").alias("text"))
    chunks = stored(pack(rows, kind), "lm-chunks")
    models = stored(text_scores(chunks, depth), "lm-models")
    words = stored(count_words(chunks), "lm-words")
    total, kinds = words.agg(F.sum("c"), F.count_if(F.col("c") > 0)).first()
    total = total or 0
    base = math.log10(total + kinds + 1)
    scored = words.withColumn("base", F.log10(F.col("c") + F.lit(1.0)) - F.lit(base))
    is_hot = (F.col("c") > 0) & (F.col("c") >= F.lit(hot * total))
    top = scored.where(is_hot).select("word", "base").toArrow()
    table = spark.sparkContext.broadcast(dict(zip(top.column("word").to_pylist(), top.column("base").to_pylist())))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bases = table.value
        for batch in batches:
            for row in range(batch.num_rows):
                rid, k, held, sizes = (batch.column(c)[row].values for c in range(4))
                texts = texts_of(sizes.to_pylist(), batch.column(4)[row].as_py())
                for at in range(0, len(rid), 256):
                    n, known, b, rest = [], [], [], []
                    for data in islice(texts, 256):
                        words = data.split()
                        words.append(END)
                        other = [w for w in words if w not in bases]
                        n.append(len(words))
                        known.append(len(words) - len(other))
                        b.append(sum(map(bases.get, words, repeat(0.0))))
                        rest.append(other)
                    yield pa.RecordBatch.from_arrays(
                        [*(x.slice(at, 256) for x in (rid, k, held)), pa.array(n, pa.int64()), pa.array(known, pa.int64()),
                         pa.array(b, pa.float64()), sizes.slice(at, 256), pa.array(rest, pa.list_(pa.binary()))],
                        ["rid", "k", "held_out", "n", "known", "base", "size", "rest"])

    parts = chunks.select("rid", "k", "held_out", "size", "data").mapInArrow(
        look_up, f"rid bigint, k {kind}, held_out boolean, n bigint, known bigint, base double, size bigint, rest array<binary>")
    parts = stored(parts.withColumn("rest", F.transform("rest", lambda w: F.xxhash64(w))), "lm-texts")
    rare = scored.where(~is_hot).select("h", (F.col("c") > 0).cast("int").alias("w_known"), F.col("base").alias("w_base"))
    found = parts.select("rid", F.explode("rest").alias("h")).join(rare, "h").groupBy("rid").agg(
        F.sum("w_known").alias("w_known"), F.sum("w_base").alias("w_base"))
    out = parts.drop("rest").join(models, "rid").join(found, "rid", "left")

    def both(a: str) -> object:
        return F.col(a) + F.coalesce(F.col(f"w_{a}"), F.lit(0))

    return out.select(
        F.col("k").alias(key), "held_out", F.col("n").alias("n_tokens"), both("known").cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"), both("base").cast("double").alias("base_score"),
        F.col("model").alias("score"), (-F.col("model") * F.lit(math.log2(10)) / F.col("size")).alias("bits_per_byte"))
