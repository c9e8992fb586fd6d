"""MinHash near-duplicates on weighted shingles: BagMinHash signatures, banding, exact verification.

A document is the multiset of its five-word shingles (lower-case words between ASCII white space; a text
of fewer words is one shingle). Its signature has ``SIZE`` components; the chance that two documents agree in one is their
weighted Jaccard similarity, sum of minima over sum of maxima of the counts.

Signatures come from hierarchical Poisson processes over the counts' levels: for a shingle, levels
(0,1], (1,2], (2,4], (4,8] ... are cells with a process of points each, at a rate of the cell's width
for every component. Points come in order of time; a point carries its component and its level, and
belongs to the documents whose count reaches that level. A component's value is the earliest point
that belongs to it, so cells stop as soon as their next point is later than the latest component:
long texts need little more than one point per shingle.

Components are hashed in bands; documents that share a band are candidates, and the exact similarity
of candidates is computed from their texts. At 24 bands of 5 a pair of similarity 0.8 is missed with
chance 0.0001.

Near-duplicate classes are the components of verified links. First each document of a band is
compared with the band's most connected one, which joins nearly all that belongs together. What is
still in several classes inside a band is then compared exactly, by an inverted index over the
shingles of a block of documents; large bands are cut into blocks, and every two blocks meet. See
:func:`classes`.

What is compared is the distinct text, known by its 128-bit digest; classes are mapped back to all rows
that hold one of its texts.

Cases: null texts and texts without words are one class; equal texts are one class whatever their
number (they are compared once); rows that repeat a key are kept or dropped with it, and if their texts
differ, each is compared and the key links their classes; null keys are kept and in no class; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import field, packed, stored
from tripmart.llm.graph import components
from tripmart.operators.joins import broadcast_if_small

WORDS, LEAST, BANDS, ROWS = 5, 0.8, 24, 5
SIZE = BANDS * ROWS
#: Pairs of a hub, and documents of a block, that one group holds.
GROUP, BLOCK = 64, 512
#: Bytes of text that Python works on at once (a longer text is worked on alone).
SLICE = 1 << 20

_GOLD = np.uint64(0x9E3779B97F4A7C15)  # fixed values: the splitmix64 mixer's constants
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit number for each number."""
    with np.errstate(over="ignore"):
        x = (x + _GOLD).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
        return x ^ (x >> np.uint64(31))


_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LETTER = mixed(np.arange(1000, 1256, dtype=np.uint64))  # a random number for each byte


def slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``SLICE`` letters together."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "") + 1
        if i > start and size + n > SLICE:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def bags(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text number, shingle, count`` of all distinct shingles, for many texts at once."""
    data = [(t or "").lower().encode() + b" " for t in texts]
    letters = np.frombuffer(b"".join(data), np.uint8)
    none = np.zeros(0, np.int64)
    solid = ~_WHITE[letters]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begin = np.flatnonzero(first)
    if not len(begin):
        return none, none.astype(np.uint64), none
    with np.errstate(over="ignore"):
        # a word's hash: its letters' numbers times powers of an odd number, by place in the word
        where = np.flatnonzero(solid)
        word = np.cumsum(first)[where] - 1
        place = where - begin[word]
        power = np.ones(int(place.max()) + 1, np.uint64)
        power[1:] = _MIX1
        power = np.multiply.accumulate(power)
        value = _LETTER[letters[where]] * power[place]
        h = mixed(np.add.reduceat(value, np.flatnonzero(first[where])))
        ends = np.cumsum([len(d) for d in data])
        owner = np.searchsorted(ends, begin, side="right")
        n = np.bincount(owner, minlength=len(texts))
        # whole windows, and one shingle for each text of fewer words
        full = max(0, len(h) - words + 1)
        out = np.zeros(full, np.uint64)
        for j in range(words):
            out = mixed(out ^ h[j:j + full])
        inside = owner[:full] == owner[words - 1:words - 1 + full]
        doc, shingle = owner[:full][inside], out[inside]
        few = np.flatnonzero((n > 0) & (n < words))
        if len(few):
            at, fold = (np.cumsum(n) - n)[few], np.zeros(len(few), np.uint64)
            for j in range(words - 1):
                more = n[few] > j
                fold[more] = mixed(fold[more] ^ h[at[more] + j])
            doc, shingle = np.concatenate([doc, few]), np.concatenate([shingle, fold])
        both = mixed(shingle ^ mixed(doc.astype(np.uint64) + _MIX2))
    _, place, count = np.unique(both, return_index=True, return_counts=True)
    return doc[place], shingle[place], count


def signatures(texts: int, doc: np.ndarray, shingle: np.ndarray, count: np.ndarray, size: int = SIZE) -> np.ndarray:
    """For each of many bags: which point is the earliest of each component, as a 64-bit mark (0 for
    an empty bag)."""
    best, mark = np.full(texts * size, np.inf), np.zeros(texts * size, np.uint64)
    # the cells: document, state, first level, width, the document's count
    cells = [(doc, shingle, np.zeros(len(doc)), np.ones(len(doc)), count)]
    level = 1
    while (reach := count > level).any():
        n = int(reach.sum())
        cells.append((doc[reach], mixed(shingle[reach] ^ mixed(np.full(n, level, np.uint64))),
                      np.full(n, float(level)), np.full(n, float(level)), count[reach]))
        level *= 2
    doc, state, low, width, top = (np.concatenate(c) for c in zip(*cells))
    time = np.zeros(len(doc))
    latest = np.full(texts, np.inf)
    while len(doc):
        state = mixed(state)
        u = ((state >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53
        time = time - np.log(u) / (size * width)
        alive = np.flatnonzero(time < latest[doc])
        doc, state, time, low, width, top = (x[alive] for x in (doc, state, time, low, width, top))
        other = mixed(state ^ _MIX1)
        at = doc * size + ((other >> np.uint64(32)).astype(np.int64) * size >> 32)
        level = low + ((other & np.uint64(0xFFFFFFFF)).astype(np.float64) + 1) * 2.0 ** -32 * width
        mine = np.flatnonzero(level <= top)
        at, when = at[mine], time[mine]
        np.minimum.at(best, at, when)
        won = best[at] == when
        mark[at[won]] = other[mine][won]
        latest = best.reshape(texts, size).max(axis=1)
    return mark.reshape(texts, size)


def similarities(hub: int, texts: int, doc: np.ndarray, shingle: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of every bag with bag ``hub``; of two empty ones it is 1."""
    total = np.bincount(doc, count, texts)
    own = doc == hub
    order = np.argsort(shingle[own])
    keys, amounts = shingle[own][order], count[own][order]
    both = np.zeros(texts)
    if len(keys):
        at = np.searchsorted(keys, shingle)
        at[at == len(keys)] = 0
        both = np.bincount(doc, np.where(keys[at] == shingle, np.minimum(count, amounts[at]), 0), texts)
    whole = total + total[hub] - both
    return np.where(whole > 0, both / np.maximum(whole, 1), 1.0)


def digest(text: Column) -> Column:
    """128 bits that stand for a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def signed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, same (the text's digest, that of empty text if it has no word), n (shingles), bands (array of 64-bit keys)``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mixed(np.arange(BANDS, dtype=np.uint64))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(2).to_pylist()
                for start, end in slices(texts):
                    own = texts[start:end]
                    doc, shingle, count = bags(own)
                    n = np.bincount(doc, count, len(own)).astype(np.int64)
                    marks = signatures(len(own), doc, shingle, count).reshape(len(own), BANDS, ROWS)
                    keys = np.tile(salt, (len(own), 1))
                    for j in range(ROWS):
                        keys = mixed(keys ^ marks[:, :, j])
                    bands = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * BANDS, pa.int32()),
                                                     pa.array(keys.astype(np.int64).ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).slice(start, end - start), part.column(1).slice(start, end - start), pa.array(n), bands],
                        ["id", "same", "n", "bands"])

    rows = docs.select(F.col(key).cast("bigint"), digest(F.col(text)), F.col(text)).where(F.col(key).isNotNull()).mapInArrow(
        work, "id bigint, same binary, n bigint, bands array<bigint>")
    return rows.withColumn("same", F.when(F.col("n") > 0, F.col("same")).otherwise(digest(F.lit(""))))


def verified(pairs: DataFrame, texts: DataFrame, least: float = LEAST) -> DataFrame:
    """The ``pairs`` (``hub, id``) whose texts (``id, text``) are at least ``least`` similar.

    Pairs of a hub are cut into groups of about ``GROUP``; a group's texts are brought together, the
    hub's once per group, so a hub of any number of pairs is spread over as many groups.
    """
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("_groups"))
    cut = pairs.join(sizes, "hub").withColumn("part", F.pmod(F.xxhash64("id"), F.col("_groups"))).select("hub", "part", "id")
    need = cut.select("id", "hub", "part", F.lit(False).alias("is_hub")).unionByName(
        cut.select(F.col("hub").alias("id"), "hub", "part", F.lit(True).alias("is_hub")).distinct())

    def compare(group: pa.Table) -> pa.Table:
        rows = group.select(["id", "is_hub", "text"]).to_pylist()
        hub = next(r for r in rows if r["is_hub"])
        rest, out = [r for r in rows if not r["is_hub"]], []
        for start, end in slices([r["text"] for r in rest]):
            own = rest[start:end]
            found = similarities(0, len(own) + 1, *bags([hub["text"], *(r["text"] for r in own)]))
            out += [r["id"] for r, x in zip(own, found[1:]) if x >= least]
        return pa.table({"hub": pa.array([hub["id"]] * len(out), pa.binary()), "id": pa.array(out, pa.binary())})

    return need.join(texts, "id").groupBy("hub", "part").applyInArrow(compare, "hub binary, id binary")


class _Joined:
    """Disjoint sets over small numbers."""

    def __init__(self, n: int):
        self.above = list(range(n))

    def root(self, x: int) -> int:
        while self.above[x] != x:
            self.above[x] = self.above[self.above[x]]
            x = self.above[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.above[max(x, y)] = min(x, y)
        return x != y


def links_across(texts: list[str], classes: list[int], sides: list[bool], least: float) -> list[tuple[int, int]]:
    """Pairs of a block's texts (by number) that join its classes: all pairs of different classes
    are compared exactly, and a pair that joins nothing new is left out. If ``sides`` are of both kinds
    only pairs across them count (the others meet in another block)."""
    doc, shingle, count = bags(texts)
    total = np.bincount(doc, count, len(texts))
    number = np.unique(classes, return_inverse=True)[1]
    side = np.array(sides)
    kinds, ids = np.unique(shingle, return_inverse=True)
    order = np.argsort(ids, kind="stable")
    post, amount, begin = doc[order], count[order], np.searchsorted(ids[order], np.arange(len(kinds) + 1))
    by_doc = np.argsort(doc, kind="stable")
    from_, out, joined = np.searchsorted(doc[by_doc], np.arange(len(texts) + 1)), [], _Joined(int(number.max()) + 1)
    most = np.bincount(number).argmax()
    both_sides = bool(side.any() and not side.all())
    for x in np.flatnonzero(number != most):  # the others' pairs cover all pairs of different classes
        own = by_doc[from_[x]:from_[x + 1]]
        size = begin[ids[own] + 1] - begin[ids[own]]
        at = np.repeat(begin[ids[own]] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        both = np.bincount(post[at], np.minimum(amount[at], np.repeat(count[own], size)), len(texts))
        near = both >= least * (total + total[x] - both) - 1e-9
        near &= (number != number[x]) & (total > 0)
        if both_sides:
            near &= side != side[x]
        for y in np.flatnonzero(near):
            if both[y] / (total[y] + total[x] - both[y]) >= least and joined.join(int(number[x]), int(number[y])):
                out.append((int(x), int(y)))
    return out


def across(rows: DataFrame, texts: DataFrame, least: float = LEAST) -> DataFrame:
    """Links ``hub, id`` between the classes of each band, from ``band, id, comp``: every pair of documents
    of different classes in a band is compared. A band is dealt into blocks of about ``BLOCK``
    documents; each two blocks (and each block with itself) are one group."""
    sizes = rows.groupBy("band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = rows.join(sizes, "band").withColumn("q", F.pmod(F.xxhash64("id"), F.col("blocks")))
    dealt = dealt.withColumn("o", F.explode(F.expr("sequence(0L, blocks - 1)")))
    dealt = dealt.select("band", F.least("q", "o").alias("i"), F.greatest("q", "o").alias("j"), "id", "comp",
                         (F.col("q") <= F.col("o")).alias("side"))

    def compare(group: pa.Table) -> pa.Table:
        ids, comps = group.column("id").to_pylist(), group.column("comp").to_pylist()
        found = links_across(group.column("text").to_pylist(), comps, group.column("side").to_pylist(), least) \
            if len(set(comps)) > 1 else []
        return pa.table({"hub": pa.array([ids[x] for x, _ in found], pa.binary()), "id": pa.array([ids[y] for _, y in found], pa.binary())})

    return dealt.join(texts, "id").groupBy("band", "i", "j").applyInArrow(compare, "hub binary, id binary")


def _apart(members: DataFrame, found: DataFrame) -> DataFrame:
    """The rows ``band, id, comp`` of bands that still hold two classes or more."""
    now = members.join(found, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
    spread = now.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("band")
    return now.join(spread, "band")


def _of_one_key(rows: DataFrame) -> DataFrame:
    """Links ``a, b`` between the texts of a key that holds several: each with the key's smallest digest."""
    several = rows.groupBy("id").agg(F.min("same").alias("b"), F.max("same").alias("most")).where("b < most").select("id", "b")
    pairs = rows.select("id", F.col("same").alias("a")).join(broadcast_if_small(several), "id")
    return pairs.where("a <> b").select("a", "b").distinct()


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """``key, class_id (its smallest key), kept (is it)`` per row of ``docs``.

    1. Equal texts become one document, named by their digest.
    2. In every band of two documents or more, each is compared with the band's hub (the document
       with the most candidates in all its bands); a size bound that is exact (the smaller size over
       the larger is at least the similarity) leaves out hopeless pairs.
    3. What is still in two classes inside a band is compared across them, so every candidate pair
       is either verified or already in one class.
    4. A class is named by the smallest key that holds one of its texts; keys with several texts
       link these.
    """
    all_rows = stored(signed(docs, key, text), "minhash-rows")
    same = stored(all_rows.groupBy("same").agg(F.min("id").alias("rep")), "minhash-texts")
    first = all_rows.where("n > 0").join(same, "same").where("id = rep").dropDuplicates(["same"])
    band = first.select(F.col("same").alias("id"), "n", F.posexplode("bands").alias("b", "k")).select("id", "n", F.xxhash64("b", "k").alias("band"))
    crowded = band.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(band.join(crowded, "band"), "minhash-bands")
    degree = members.groupBy("id").agg(F.sum("size").alias("degree"))
    members = stored(members.join(degree, "id").select("band", "id", "n", "degree"), "minhash-members")
    body = docs.select(F.col(key).cast("bigint").alias("k"), F.col(text).alias("text"), digest(F.col(text)).alias("d"))
    # few candidates are sent to the texts; beyond the checked size the texts are shuffled to them
    ids = stored(members.select(F.col("id").alias("same")).distinct().join(same, "same"), "minhash-ids")
    texts = body.join(broadcast_if_small(ids), (F.col("k") == F.col("rep")) & (F.col("d") == F.col("same")))
    texts = stored(texts.groupBy(F.col("same").alias("id")).agg(F.max("text").alias("text")), "minhash-near")
    near = F.least("n", "hn") >= F.lit(least) * F.greatest("n", "hn")
    top = members.groupBy("band").agg(F.max_by(F.struct(F.col("id").alias("hub"), F.col("n").alias("hn")),
                                               F.struct("degree", "id")).alias("top"))
    pairs = members.join(top, "band").select("id", "n", "top.*").where((F.col("id") != F.col("hub")) & near)
    links = stored(verified(stored(pairs.select("hub", "id").distinct(), "minhash-pairs"), texts, least), "minhash-links")
    edges = links.select(F.col("hub").alias("a"), F.col("id").alias("b")).unionByName(
        stored(_of_one_key(all_rows), "minhash-keys"))
    found = stored(components(edges), "minhash-classes")
    apart = stored(_apart(members.select("band", "id"), found.select(F.col("node").alias("id"), "component")), "minhash-apart")
    more = stored(across(apart, texts, least), "minhash-more")
    found = stored(components(edges.unionByName(more.select(F.col("hub").alias("a"), F.col("id").alias("b")))), "minhash-classes")
    linked = same.join(found.select(F.col("node").alias("same"), "component"), "same")
    names = linked.groupBy("component").agg(F.min("rep").alias("class_id"))
    reps = same.join(linked.join(names, "component").select("same", "class_id"), "same", "left").select(
        "same", F.coalesce("class_id", "rep").alias("class_id"))
    out = all_rows.select("id", "same").join(reps, "same").select(F.col("id").alias("_id"), "class_id").groupBy("_id").agg(
        F.min("class_id").alias("class_id"))
    rows = docs.select(F.col(key)).join(out, F.col(key) == F.col("_id"), "left")
    return rows.select(F.col(key), "class_id", F.coalesce(F.col(key) == F.col("class_id"), F.lit(True)).alias("kept"))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that stay: one document (the smallest key) of each class."""
    gone = stored(classes(docs, key, text, least).where("NOT kept").select(F.col(key).alias("_gone")).distinct(), "minhash-gone")
    return packed(docs).join(broadcast_if_small(gone), field(key) == F.col("_gone"), "left_anti").select("row.*")
